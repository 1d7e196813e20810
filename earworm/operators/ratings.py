"""Listen counts, count filters and mean-centring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earworm.functions.exprs import round_half_even
from earworm.operators.ordered import median_of


def count_listens(log: DataFrame, user: str = "user_id", item: str = "recording_msid",
                  ts: str | None = "timestamp", out: str = "listens") -> DataFrame:
    """Listens per (user, item).  Counts non-null ``ts`` when given, else rows.

    A hash aggregate with a map-side partial count, so a hot user or item
    collapses before the shuffle.
    """
    counted = F.count(ts) if ts else F.count(F.lit(1))
    return log.groupBy(user, item).agg(counted.alias(out))


def filter_min_listens(ratings: DataFrame, n: int = 1, value: str = "listens") -> DataFrame:
    """Keep pairs with ``value > n`` (P4).  A narrow filter, no shuffle."""
    return ratings.where(F.col(value) > F.lit(n))


def filter_above_median(ratings: DataFrame, offset: float = 3.0, value: str = "listens") -> DataFrame:
    """Keep ``value > median(value) + offset`` (P5).

    The exact median comes from a sketch and one filtered pass
    (``median_of``, two jobs when this is called) and enters as a number,
    so the filter reaches whatever reads the ratings.  No value: no row.
    """
    median = median_of(ratings, value)
    return ratings.where(F.col(value) > F.lit(median) + F.lit(offset))


def center_ratings(ratings: DataFrame, user: str = "user_id", item: str = "recording_msid",
                   value: str = "listens", out: str = "listens_mean",
                   keep_non_negative: bool = True) -> DataFrame:
    """listens - mean over the user - mean over the item, then the rows with a
    non-negative result, rounded half-even to an integer (A6, F2, F3, P6).

    The means come from this frame itself.  They are two partial hash
    aggregates (dimension-sized) joined back on their key: no window, so a
    user holding a third of the rows never lands whole in one window buffer;
    AQE turns the joins into broadcasts when the mean tables are small and
    splits a skewed user partition otherwise.
    """
    # Null keys never join; stating that once up front keeps the three uses
    # of ``ratings`` identical plans (no per-join inferred filters), so AQE
    # reuses one exchange for them instead of computing the input three times.
    ratings = ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull())
    user_mean = ratings.groupBy(user).agg(F.avg(value).alias("_user_mean"))
    item_mean = ratings.groupBy(item).agg(F.avg(value).alias("_item_mean"))
    centred = (
        ratings.join(user_mean, user).join(item_mean, item)
        .withColumn("_centred", F.col(value) - F.col("_user_mean") - F.col("_item_mean"))
    )
    if keep_non_negative:
        centred = centred.where(F.col("_centred") >= 0)
    return centred.select(
        user, item, value, round_half_even("_centred").cast("bigint").alias(out)
    )
