"""Mergeable sketches: user sets (U3, L5, A11) and heavy hitters.

A user set is a theta sketch per part and day; sketches are stored, and the
users of any set of days, or those that two parts have in common, come from the
stored sketches without reading a row again.

Heavy hitters are counted in two passes.  Each task keeps a bounded summary
(Misra-Gries): what it forgot of an item is at most the amount by which it has
lowered all its counters, so the summed lowering bounds what is missing of any
item.  The candidates that the bound leaves are counted exactly in the second
pass; if the bound proves that no other item can be among the first k, their
list is the answer, and if not the exact aggregate is.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earworm.operators.popularity import item_totals, top_of
from earworm.session import write_once

#: log2 of the entries of a sketch: exact up to 4,096 users, then with a
#: standard error of 1 / sqrt(4,096), 1.6 percent.
LG_ENTRIES = 12


def user_sketches(labelled: DataFrame, day: str, user: str = "user_id", label: str = "split",
                  lg_entries: int = LG_ENTRIES) -> DataFrame:
    """(label, day, rows, users): a sketch of the users of each part and day."""
    return labelled.groupBy(label, day).agg(
        F.count(F.lit(1)).alias("rows"), F.theta_sketch_agg(user, lg_entries).alias("users"))


def merged_sketches(sketches: DataFrame, by: str = "split", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """(by, rows, users): the sketches of whatever days ``sketches`` holds as one."""
    return sketches.groupBy(by).agg(F.sum("rows").alias("rows"), F.theta_union_agg("users", lg_entries).alias("users"))


def sketch_overlap(sketches: DataFrame, parts: tuple[str, ...], label: str = "split") -> DataFrame:
    """One row: <part>_rows, <part>_users and common_<a>_<b> of ``sketches``'
    days, from the sketches alone; parts without any: 0."""
    whole = merged_sketches(sketches, label)
    held = whole.agg(*[x for p in parts for x in (
        F.max(F.when(F.col(label) == p, F.col("rows"))).alias(f"r_{p}"),
        F.max(F.when(F.col(label) == p, F.col("users"))).alias(f"u_{p}"))])

    def users(sketch):
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("bigint")

    pairs = [(a, b) for i, a in enumerate(parts) for b in parts[i + 1:]]
    return held.select(
        *[F.coalesce(f"r_{p}", F.lit(0)).cast("bigint").alias(f"{p}_rows") for p in parts],
        *[users(F.col(f"u_{p}")).alias(f"{p}_users") for p in parts],
        *[users(F.when(F.col(f"u_{a}").isNotNull() & F.col(f"u_{b}").isNotNull(),
                       F.theta_intersection(f"u_{a}", f"u_{b}"))).alias(f"common_{a}_{b}") for a, b in pairs])


def task_summaries(log: DataFrame, item: str, capacity: int) -> DataFrame:
    """(item, n, lost): each task's counters, ``capacity`` at most, and in one
    row without an item the amount by which it lowered them."""
    kind = dict(log.dtypes)[item]

    def summarise(batches):
        counters: dict = {}
        lost = 0
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                counters[entry["values"]] = counters.get(entry["values"], 0) + entry["counts"]
            if len(counters) > capacity:
                cut = sorted(counters.values(), reverse=True)[capacity]
                lost += cut
                counters = {i: n - cut for i, n in counters.items() if n > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counters.keys(), None], batch_type), pa.array([*counters.values(), 0], pa.int64()),
             pa.array([0] * len(counters) + [lost], pa.int64())], names=[item, "n", "lost"])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(log.schema[item].dataType)
    return log.select(item).where(F.col(item).isNotNull()).mapInArrow(summarise, f"`{item}` {kind}, n bigint, lost bigint")


def heavy_hitters(log: DataFrame, k: int = 100, item: str = "recording_msid", capacity: int = 10_000,
                  max_candidates: int = 100_000) -> tuple[DataFrame, bool]:
    """((pos, item, score), proven): the rows of ``popularity_total``.

    The first pass shuffles ``capacity`` counters a task at most, whatever the
    number of items.  Of the summed counters, with L the sum of all lowerings,
    an item's listens lie between its counter and its counter + L.  Items whose
    counter + L reaches the k-th counter are candidates; items without a
    counter have at most L listens.  So the candidates hold the answer if the
    k-th counter is above L (``proven``); else, or with over
    ``max_candidates`` candidates, all items are counted.  Runs when called;
    the log is read twice.  Null items are no items.
    """
    log = log.select(item).where(F.col(item).isNotNull())
    summed = write_once(task_summaries(log, item, capacity).groupBy(item).agg(
        F.sum("n").alias("n"), F.sum("lost").alias("lost")))
    lost = summed.where(F.col(item).isNull()).agg(F.sum("lost")).first()[0] or 0
    first = summed.where(F.col(item).isNotNull()).orderBy(F.desc("n")).limit(k).agg(
        F.count(F.lit(1)).alias("n"), F.min("n").alias("kth")).first()
    # without any lowering all counters are exact and complete
    proven = not lost or (first.n == k and first.kth > lost)
    candidates = summed.where(F.col(item).isNotNull() & (F.col("n") + lost >= (first.kth or 0))).select(item)
    if proven and candidates.count() <= max_candidates:
        log = log.join(F.broadcast(candidates), item, "left_semi")
    else:
        proven = False
    return top_of(item_totals(log, item, None, "score"), k, item), proven
