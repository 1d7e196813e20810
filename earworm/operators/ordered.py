"""Running totals and exact medians without a one-task window or buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earworm.session import write_once


def running_totals(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """``rows`` (one per ``key``) with ``before_<v>``: the total of ``v`` over all
    smaller keys.

    Rows are range-partitioned by key and written once, so a re-read sees the
    same partitions; totals per partition (one row each) give the offsets, which
    are broadcast, and a window inside each partition does the rest.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_once(rows.repartitionByRange(n, key).withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(*[F.sum(v).alias(f"_{v}") for v in values]).select(
        "_part", *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values])
    inside = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    located = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values])
    return located.join(F.broadcast(offsets), "_part").select(
        *rows.columns, *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"before_{v}") for v in values])


#: Entries of the quantile sketch, and how far off in rank it may be: above the
#: 99 percent bound of a sketch of this size (0.4 percent), so the bracket rarely
#: misses; where it does, it is made wider.
SKETCH_ENTRIES, SKETCH_ERROR = 800, 0.006
#: Distinct values of a bracket that come to the driver.
MOST_VALUES = 100_000


def sketch_bracket(value: str, low: float = 0.5, high: float = 0.5, error: float = SKETCH_ERROR):
    """An aggregate (struct of n, low, high): the number of values that are not
    null, and two values between which those of ranks ``low`` to ``high`` (as
    shares) surely almost lie."""
    number = F.col(value).cast("double")
    sketch = F.kll_sketch_agg_double(number, SKETCH_ENTRIES)
    n = F.count(value)
    return F.struct(
        n.alias("n"),
        *[F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(min(1.0, max(0.0, at))))).alias(name)
          for name, at in (("low", low - error), ("high", high + error))])


def median_between(df: DataFrame, value: str, bracket) -> float | None:
    """The interpolating median, from a bracket that ``sketch_bracket`` gave.

    One pass counts what lies below the bracket and, value by value, inside it.
    If the middle places are not inside, or the bracket holds over
    ``MOST_VALUES`` values, the whole histogram is used.
    """
    n, low, high = bracket["n"], bracket["low"], bracket["high"]
    if not n:
        return None
    number = F.col(value).cast("double")
    inside = F.when(number.between(low, high), F.col(value))
    groups = df.where(F.col(value).isNotNull() & (number <= high)).groupBy(inside.alias("v")).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_first("v")).limit(MOST_VALUES + 2).collect()
    below = groups.pop(0).n if groups and groups[0].v is None else 0
    places, found = ((n - 1) // 2, n // 2), []
    if len(groups) <= MOST_VALUES:
        for place in places:
            at = below
            for g in groups if place >= below else ():
                at += g.n
                if place < at:
                    found.append(float(g.v))
                    break
    if len(found) == 2:
        return (found[0] + found[1]) / 2
    return _median_of_histogram(df, value).first().median


def median_of(df: DataFrame, value: str) -> float | None:
    """The interpolating median of the non-null values, None if there are none.

    A sketch (a partial aggregate, a few KB a task) brackets the middle; one
    filtered pass selects the exact values.  No shuffle of the values by
    range, no written table.  ``df`` is read twice; runs when called.
    """
    return median_between(df, value, df.agg(sketch_bracket(value).alias("b")).first().b)


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row, ``median``: ``median_of`` as a table."""
    return df.sparkSession.range(1).select(F.lit(median_of(df, value)).cast("double").alias("median"))


def _median_of_histogram(df: DataFrame, value: str) -> DataFrame:
    """One row, ``median``, from a histogram by value with running totals: the
    one or two middle values are those whose span of places holds place
    (n-1)/2 or n/2."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(counts, "_v", "n")
    total = placed.agg(F.sum("n"))
    low, high = F.floor((total.scalar() - 1) / 2), F.floor(total.scalar() / 2)
    last = F.col("before_n") + F.col("n")
    return placed.agg(
        ((F.max(F.when((F.col("before_n") <= low) & (low < last), F.col("_v"))).cast("double")
          + F.max(F.when((F.col("before_n") <= high) & (high < last), F.col("_v"))).cast("double")) / 2).alias("median"))
