"""Popularity recommenders.

A popularity model is one ranked list of k items shared by every user.  It is
returned in long form ``(pos, item, score)``: k rows, a proven size bound, so
it is the one thing this module broadcasts.  The reference multiplies every
user by the list (a cross join); metrics here join the truth to the list on the
item instead, which touches only the hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_of(scored: DataFrame, k: int = 100, item: str = "recording_msid", score: str = "score") -> DataFrame:
    """Top-k by score desc, item asc, with positions 1..k.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each partition keeps
    its own k best and one task merges partitions x k rows.  The positions are
    numbered over those k rows only.
    """
    top = scored.orderBy(F.col(score).desc(), F.col(item).asc()).limit(k)
    w = Window.orderBy(F.col(score).desc(), F.col(item).asc())
    return top.select(F.row_number().over(w).alias("pos"), item, score)


def item_totals(log: DataFrame, item: str = "recording_msid", weight: str | None = None,
                out: str = "total_listens") -> DataFrame:
    """Listens per item (A2): rows of a log, or the sum of a count column."""
    agg = F.sum(weight).cast("bigint") if weight else F.count(F.lit(1))
    return log.groupBy(item).agg(agg.alias(out))


def popularity_total(log: DataFrame, k: int = 100, item: str = "recording_msid",
                     weight: str | None = None) -> DataFrame:
    """The k items with the most listens."""
    return top_of(item_totals(log, item, weight, "score"), k, item)


def item_average_listens(log: DataFrame, item: str = "recording_msid", user: str = "user_id",
                         out: str = "avg_listens") -> DataFrame:
    """A3: listens per item divided by the item's distinct listeners.

    Written as two grouping levels, (item, user) then item.  That is the plan
    Spark builds for count(distinct), made explicit: the first level combines
    map-side, so a hot item or user is reduced before any shuffle.
    """
    per_pair = log.groupBy(item, user).agg(F.count(F.lit(1)).alias("_n"))
    return per_pair.groupBy(item).agg(
        F.sum("_n").alias("total_count"),
        F.count(F.lit(1)).alias("distinct_users"),
    ).select(item, "total_count", "distinct_users",
             (F.col("total_count") / F.col("distinct_users")).alias(out))


def average_two_level(ratings: DataFrame, item: str = "recording_msid", value: str = "listens",
                      out: str = "avg_listens") -> DataFrame:
    """A4: the same average from listen counts, sum(listens) / count(*)."""
    return ratings.groupBy(item).agg(
        (F.sum(value) / F.count(F.lit(1))).alias(out)
    )


def popularity_average(log: DataFrame, k: int = 100, item: str = "recording_msid",
                       user: str = "user_id") -> DataFrame:
    """R2: the k items with the highest average listens per listener."""
    avg = item_average_listens(log, item, user, "score").select(item, "score")
    return top_of(avg, k, item)


def popularity_list(top: DataFrame, item: str = "recording_msid",
                    out: str = "predicted_recording_msid") -> DataFrame:
    """The ranked list as one array row, order made explicit by position."""
    return top.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", item))), lambda s: s[item]
        ).alias(out)
    )
