"""Profiles of a ratings frame (A7-A11, P7, P12, P13): one aggregate pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earworm.operators.ordered import median_between, sketch_bracket
from earworm.session import write_once


def profile_ratings(ratings: DataFrame, value: str = "listens", user: str = "user_id",
                    item: str = "recording_msid", exact_distinct: bool = True) -> DataFrame:
    """One row: rows, users, items, mean, min, max, exact median, approximate
    median, and the number of pairs with value = 1.

    Users and items are counted each by their own group-by (a distinct count of
    both in one aggregate would expand every row).  One pass over the ratings
    gives all plain figures and a sketch that brackets the median; a filtered
    pass selects the median's exact values.  The ratings are written once, as
    each of these reads them; the figures but the two counts are computed when
    this is called.  ``exact_distinct=False`` uses HyperLogLog++ for the user
    and item counts.
    """
    ratings = write_once(ratings.select(user, item, value))

    def distinct(key: str):
        if not exact_distinct:
            return ratings.agg(F.approx_count_distinct(key)).scalar()
        return ratings.groupBy(key).agg(F.lit(1)).agg(F.count(key)).scalar()

    plain = {
        "n_rows": F.count(F.lit(1)),
        "mean_listens": F.avg(value),
        "min_listens": F.min(value),
        "max_listens": F.max(value),
        "approx_median_listens": F.percentile_approx(value, 0.5),
        "n_listens_eq_1": F.count_if(F.col(value) == 1),
    }
    summary = ratings.agg(*[c.alias(name) for name, c in plain.items()], sketch_bracket(value).alias("bracket"))
    figures = summary.first()
    median = median_between(ratings, value, figures["bracket"])
    types = dict(summary.dtypes)

    def known(name: str):
        return F.lit(figures[name]).cast(types[name]).alias(name)

    return ratings.sparkSession.range(1).select(
        known("n_rows"), distinct(user).alias("n_users"), distinct(item).alias("n_items"),
        *[known(name) for name in ("mean_listens", "min_listens", "max_listens")],
        F.lit(median).cast("double").alias("median_listens"), known("approx_median_listens"), known("n_listens_eq_1"))


def profile_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the number of nulls in each column."""
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols])


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without any null."""
    return df.dropna(how="any", subset=subset)
