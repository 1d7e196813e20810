"""Identity and listen counts kept from day to day (I4).

A full rebuild reads the whole log for every new day.  Here each batch of the
log adds one immutable part to a state in shared storage:

  first   (item, mbid, first listen)      of the items that the batch holds
  plays   (user, mbid, timestamp)         of listens that no earlier part holds
  counts  (user, mbid or item, listens)   what the batch adds

``first`` and ``counts`` merge by min and sum, so the state of any number of
parts is an aggregate over them.  Counts are kept by mbid, not by the mbid's
canonical item, so a new canonical item corrects a label, never a number.  A
batch that fails is run again under its own name and overwrites its own part
only; batches may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earworm.session import path_exists, write_once

#: Parts that readers list; a part of another batch is another folder.
TABLES = ("first", "plays", "counts")


class IdentityState:
    """The state below ``path``, for logs with the given columns.

    ``plays`` is split by the month of ``ts``, so a batch is held against the
    stored listens of its own months only.
    """

    def __init__(self, spark: SparkSession, path: str, user: str = "user_id", item: str = "recording_msid",
                 ts: str = "timestamp", mbid: str = "recording_mbid"):
        self.spark, self.path = spark, path.rstrip("/")
        self.user, self.item, self.ts, self.mbid = user, item, ts, mbid

    def _table(self, name: str, but: str | None = None) -> DataFrame | None:
        """All committed parts of a table (but one batch's); None if there is none."""
        batches = self.batches() if but is None else [b for b in self.batches() if b != but]
        if not batches:
            return None
        paths = [f"{self.path}/{name}/batch={b}" for b in batches]
        reader = self.spark.read.option("basePath", f"{self.path}/{name}")
        if name == "plays":  # a batch without plays has no file to tell the columns
            first, counts = (dict(self._table(t).dtypes) for t in ("first", "counts"))
            reader = reader.schema(f"`{self.user}` {counts[self.user]}, `{self.mbid}` {counts[self.mbid]}, "
                                   f"`{self.ts}` {first['first_ts']}, month string, batch string")
        return reader.parquet(*paths).drop("batch")

    def batches(self) -> list[str]:
        """Names of the batches whose last table is committed."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/counts")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(fs_path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(fs_path)]
        return sorted(n.removeprefix("batch=") for n in names
                      if n.startswith("batch=") and path_exists(self.spark, f"{self.path}/counts/{n}/_SUCCESS"))

    def _write(self, df: DataFrame, name: str, batch: str, *split: str) -> None:
        df.write.mode("overwrite").partitionBy(*split).parquet(f"{self.path}/{name}/batch={batch}")

    def merge(self, log: DataFrame, tracks: DataFrame, batch: str) -> DataFrame:
        """Add ``log`` as ``batch``; returns ``changes`` that it brought.

        Listens of items that ``tracks`` does not have are left out (inner
        join).  A listen of an item with an mbid counts once per (user, mbid,
        timestamp), whichever batch brings it first; listens of other items
        count every time; a null timestamp adds no listen, but its pair exists
        with 0.  The track table is taken to keep an item's mbid.
        """
        if not batch or "/" in batch or "=" in batch:
            raise ValueError("a batch needs a name that can be a folder's")
        before = self._labels(but=batch)
        user, item, ts, mbid = self.user, self.item, self.ts, self.mbid
        # read by all that follows: the log, however it is made, is made once
        known = write_once(log.select(user, item, ts).join(tracks.select(item, mbid), item))
        first = known.groupBy(item).agg(F.first(mbid).alias(mbid), F.min(ts).alias("first_ts"))
        self._write(first, "first", batch)

        month = F.date_format(ts, "yyyy-MM").alias("month")
        of_mbid = known.where(F.col(mbid).isNotNull())
        plays = of_mbid.where(F.col(ts).isNotNull()).select(user, mbid, ts).distinct().select("*", month)
        earlier = self._table("plays", but=batch)
        if earlier is not None:
            months = [r.month for r in plays.select("month").distinct().limit(1000).collect()]
            if len(months) < 1000:  # the stored months are pruned to the batch's
                earlier = earlier.where(F.col("month").isin(months)) if months else earlier.limit(0)
            plays = plays.join(earlier.drop("month"), [user, mbid, ts], "left_anti")
        self._write(plays.hint("rebalance", "month"), "plays", batch, "month")

        new = self.spark.read.schema(plays.schema).parquet(f"{self.path}/plays/batch={batch}")
        nothing = F.lit(0).cast("bigint")
        added = new.groupBy(user, mbid).agg(F.count(F.lit(1)).alias("listens")).unionByName(
            of_mbid.select(user, mbid).distinct().withColumn("listens", nothing))
        alone = known.where(F.col(mbid).isNull()).groupBy(user, item).agg(F.count(ts).alias("listens"))
        counts = added.groupBy(user, mbid).agg(F.sum("listens").alias("listens")).select(
            user, mbid, F.lit(None).cast(dict(known.dtypes)[item]).alias(item), "listens").unionByName(
            alone.select(user, F.lit(None).cast(dict(known.dtypes)[mbid]).alias(mbid), item, "listens"))
        self._write(counts, "counts", batch)
        return self._changes(before, batch)

    def _labels(self, but: str | None = None) -> DataFrame | None:
        """mbid -> canonical item: the item of its earliest listen, ties by the
        smaller item (as ``identity.canonical_map`` has it)."""
        first = self._table("first", but)
        if first is None:
            return None
        per_item = first.where(F.col(self.mbid).isNotNull()).groupBy(self.mbid, self.item).agg(
            F.min("first_ts").alias("first_ts"))
        return per_item.groupBy(self.mbid).agg(
            F.min_by(F.col(self.item), F.struct("first_ts", self.item)).alias("canonical"))

    def labels(self) -> DataFrame:
        """(mbid, canonical) of every mbid that has been listened to."""
        found = self._labels()
        if found is None:
            raise ValueError("no batch yet")
        return found

    def counts(self) -> DataFrame:
        """(user, item, listens): equals ``identity.canonical_listens`` of all
        batches' rows together."""
        parts = self._table("counts")
        if parts is None:
            raise ValueError("no batch yet")
        return self._labelled(parts.groupBy(self.user, self.mbid, self.item).agg(F.sum("listens").alias("listens")),
                              self.labels())

    def _labelled(self, counts: DataFrame, labels: DataFrame) -> DataFrame:
        of_mbid = counts.where(F.col(self.mbid).isNotNull()).drop(self.item).join(labels, self.mbid).select(
            self.user, F.col("canonical").alias(self.item), "listens")
        return of_mbid.unionByName(
            counts.where(F.col(self.mbid).isNull()).select(self.user, self.item, "listens"))

    def _changes(self, before: DataFrame | None, batch: str) -> DataFrame:
        """(mbid, old_item, new_item, user, listens): every mbid whose canonical
        item is another one since the batch (``old_item`` null: new), with all
        its users' counts as they now are."""
        now = self.labels()
        touched = self.spark.read.parquet(f"{self.path}/first/batch={batch}").where(
            F.col(self.mbid).isNotNull()).select(self.mbid).distinct()
        now = now.join(touched, self.mbid, "left_semi")
        item_type = dict(now.dtypes)["canonical"]
        old = before.withColumnRenamed("canonical", "old_item") if before is not None else now.select(
            self.mbid, F.lit(None).cast(item_type).alias("old_item")).limit(0)
        moved = now.join(old, self.mbid, "left").where(~F.col("old_item").eqNullSafe(F.col("canonical"))).select(
            self.mbid, "old_item", F.col("canonical").alias("new_item"))
        counts = self._table("counts").where(F.col(self.mbid).isNotNull()).join(
            moved.select(self.mbid), self.mbid, "left_semi").groupBy(self.user, self.mbid).agg(
            F.sum("listens").alias("listens"))
        return moved.join(counts, self.mbid).select(self.mbid, "old_item", "new_item", self.user, "listens")

    def compact(self, path: str, batch: str = "compacted") -> IdentityState:
        """The same state in one part at another ``path``."""
        user, item, ts, mbid = self.user, self.item, self.ts, self.mbid
        state = IdentityState(self.spark, path, user, item, ts, mbid)
        state._write(self._table("first").groupBy(item).agg(F.first(mbid, True).alias(mbid), F.min("first_ts").alias("first_ts")),
                     "first", batch)
        state._write(self._table("plays").hint("rebalance", "month"), "plays", batch, "month")
        state._write(self._table("counts").groupBy(user, mbid, item).agg(F.sum("listens").alias("listens")), "counts", batch)
        return state
