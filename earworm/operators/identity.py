"""Track identity, surrogate ids and encodings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earworm.session import write_once


def attach_tracks(log: DataFrame, tracks: DataFrame, how: str = "inner",
                  item: str = "recording_msid", keep: tuple[str, ...] = ("recording_mbid",)) -> DataFrame:
    """Interactions joined to the track dimension on the item key (J1 inner,
    J2 left).  Only the ``keep`` columns of the dimension travel."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    dim = tracks.select(item, *keep)
    return log.join(dim, item, how)


def canonical_map(log: DataFrame, tracks: DataFrame, item: str = "recording_msid",
                  ts: str = "timestamp", mbid: str = "recording_mbid") -> DataFrame:
    """msid -> canonical msid for every msid of the track table.

    The canonical msid of an mbid is the msid of its earliest listen, ties
    broken by the smaller msid.  Because min over rows of (ts, msid) equals min
    over msids of (first ts of msid, msid), the rule runs on aggregates:

      1. first listen per msid         partial hash aggregate of the log
      2. attach the mbid, min_by per mbid   dimension-sized join + aggregate
      3. every track msid -> its mbid's winner (or itself)

    No self-join on the mbid (which emits n^2 rows for a hot mbid), no window
    over a hot mbid, and the log is read once here.  msids without an mbid, or
    whose mbid was never listened to, map to themselves.
    """
    first_seen = log.groupBy(item).agg(F.min(ts).alias("_first_ts"))
    dim = tracks.select(item, mbid)
    winners = (
        first_seen.join(dim.where(F.col(mbid).isNotNull()), item)
        .groupBy(mbid)
        .agg(F.min_by(F.col(item), F.struct(F.col("_first_ts"), F.col(item))).alias("_canonical"))
    )
    # Tracks without an mbid need no join: as one null key they would all meet
    # in one partition.
    known = dim.where(F.col(mbid).isNotNull()).join(winners, mbid, "left").select(
        item, mbid, F.coalesce(F.col("_canonical"), F.col(item)).alias("canonical_msid"))
    return known.unionByName(dim.where(F.col(mbid).isNull()).select(item, mbid, F.col(item).alias("canonical_msid")))


def _resolve(log: DataFrame, tracks: DataFrame, how: str, user: str, item: str, ts: str,
             mbid: str) -> DataFrame:
    """The log with canonical items and a has-mbid flag: one join with the map.

    With ``how='left'`` msids missing from the track table keep their id and
    count as rows without mbid.  A canonical item is either an mbid's msid or
    an msid without mbid, never both, so the flag is constant per item.
    """
    cmap = canonical_map(log, tracks, item, ts, mbid)
    joined = log.join(cmap, item, how)
    return joined.select(
        user,
        F.coalesce(F.col("canonical_msid"), F.col(item)).alias(item),
        ts,
        F.col(mbid).isNotNull().alias("_has_mbid"),
    )


def canonicalize(log: DataFrame, tracks: DataFrame, dedupe: bool | str = True, how: str = "inner",
                 user: str = "user_id", item: str = "recording_msid",
                 ts: str = "timestamp", mbid: str = "recording_mbid") -> DataFrame:
    """Resolve track identity row by row: every msid of an mbid becomes one
    msid (I4, U1, P3, P11).

    Rows without an mbid keep their msid.  ``dedupe=True`` drops repeated
    (user, timestamp, item) rows in the mbid branch only (as the reference
    pipeline does); ``dedupe='both'`` in both branches; ``False`` in none.
    The log is resolved and shuffled once; for counts use
    ``canonical_listens``.
    """
    resolved = _resolve(log, tracks, how, user, item, ts, mbid)
    if not dedupe:
        return resolved.drop("_has_mbid")
    # One count per (user, item, ts); whether an item has an mbid is a property
    # of the item.  A row that may repeat is given back as often as it was.
    rows = resolved.groupBy(user, item, ts).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_has_mbid").alias("_has_mbid"))
    times = F.lit(1).cast("bigint") if dedupe == "both" else F.when(F.col("_has_mbid"), 1).otherwise(F.col("_n"))
    return _repeated(rows, times).select(user, item, ts)


#: Rows that one row is given back as at a time.
REPEATS = 1 << 16


def _repeated(rows: DataFrame, times) -> DataFrame:
    """Each row ``times`` (a bigint, 1 at least) over, by two explodes, so that
    no array has more than ``REPEATS`` elements for up to 2^32 repeats."""
    whole = rows.withColumn("_times", times).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / REPEATS))))
    left = F.least(F.lit(REPEATS).cast("bigint"), F.col("_times") - F.col("_chunk") * REPEATS)
    return whole.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))


def canonical_listens(log: DataFrame, tracks: DataFrame, dedupe: bool | str = True, how: str = "inner",
                      user: str = "user_id", item: str = "recording_msid",
                      ts: str = "timestamp", mbid: str = "recording_mbid",
                      out: str = "listens") -> DataFrame:
    """Listen counts of the canonicalized log in one pass (I4 + A1).

    Equals ``count_listens(canonicalize(...))``.  With de-duplication it is two
    partial aggregates: per (user, item, timestamp) -- which also collapses a
    hot pair's repeats map-side -- then per (user, item), where an mbid row
    counts once per timestamp and a row without mbid counts every time.
    """
    resolved = _resolve(log, tracks, how, user, item, ts, mbid)
    if not dedupe:
        return resolved.groupBy(user, item).agg(F.count(ts).alias(out))
    per_ts = resolved.groupBy(user, item, ts).agg(
        F.count(ts).alias("_n"), F.max("_has_mbid").alias("_has_mbid"))
    once = F.when(F.col(ts).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    weight = once if dedupe == "both" else F.when(F.col("_has_mbid"), once).otherwise(F.col("_n"))
    return per_ts.groupBy(user, item).agg(F.sum(weight).cast("bigint").alias(out))


def dense_ids(values: DataFrame, key: str, id_col: str = "id", num_partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Dense 0..n-1 ids in ascending order of ``key``.

    Equals ``dense_rank() over (order by key) - 1`` without putting every row
    in one window partition:

      1. distinct keys, range-partitioned and sorted within partitions
      2. (partition, position in partition) from spark_partition_id and the
         low bits of monotonically_increasing_id, in one projection
      3. written once, so the positions cannot change on a re-read
      4. per-partition row counts (one row per partition) -> running offsets,
         broadcast back (bounded by the partition count)
    """
    distinct = values.select(key).where(F.col(key).isNotNull()).distinct()
    n = num_partitions or distinct.sparkSession.sparkContext.defaultParallelism
    ranged = distinct.repartitionByRange(n, key).sortWithinPartitions(key)
    located = ranged.select(
        key,
        F.spark_partition_id().alias("_part"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("_pos"),
    )
    if checkpoint:
        located = write_once(located)
    sizes = located.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    return located.join(F.broadcast(offsets), "_part").select(
        key, (F.col("_off") + F.col("_pos")).cast("int").alias(id_col)
    )


def item_vocabulary(frames: list[DataFrame], key: str = "recording_msid") -> DataFrame:
    """Distinct union of the item keys of several frames (U4)."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(key) for f in frames]).distinct()


def encode_items(df: DataFrame, codes: DataFrame, key: str = "recording_msid",
                 code_col: str = "codes", how: str = "inner", replace: bool = False) -> DataFrame:
    """Attach (or substitute) the dense code of ``key`` (J5 inner, J6 left)."""
    joined = df.join(codes.select(key, code_col), key, how)
    if replace:
        joined = joined.drop(key).withColumnRenamed(code_col, key)
    return joined


def encode_dense(df: DataFrame, key: str = "recording_msid", code_col: str = "codes",
                 replace: bool = True, checkpoint: bool = True) -> DataFrame:
    """Give ``key`` dense codes and substitute them in ``df`` (I1 + J5).

    ``df`` is read twice (for the vocabulary and for the join) in two separate
    executions, which cannot share an exchange, so it is written once first
    (unless ``checkpoint=False``): the input is computed once, not twice.
    """
    if checkpoint:
        df = write_once(df)
    codes = dense_ids(df, key, code_col)
    return encode_items(df, codes, key, code_col, replace=replace)
