"""Mapping of the driver's test tables onto the listen-log data model.

F1  events as listens      user_id, item = props.k, timestamp = ts
F1w F1 with weights        listens = round(sum(value)) per (user, item)
F2  purchases as listens   customer buys part (orders x lineitem), date grain
F3  vectors                embeddings(vec_id, embedding)

Every frame is derived by Spark from the given tables, so the work of each
query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns of the driver's test tables that the fixtures
# read, with their stored types.  Declaring them skips schema inference (a
# footer-reading job per scan) and reads only these columns.
TABLE_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_COLUMNS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


# ---------------------------------------------------------------- F1 --------
def f1_item() -> F.Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def listens_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id"),
        f1_item().alias("recording_msid"),
        F.col("ts").alias("timestamp"),
    )


def tracks_f1(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """Track dimension of F1, derived from the item ids the log uses (``log``,
    where the caller has it as a table).

    Fixed rule of the fixture: mbid = id div 4 (as text) when id % 10 < 7,
    else null, so groups of up to four msids share one mbid.
    """
    ids = (listens_f1(spark, sf_dir) if log is None else log).select("recording_msid").distinct()
    mbid = F.when(F.col("recording_msid") % 10 < 7,
                  F.expr("recording_msid div 4").cast("string"))
    return ids.select(
        "recording_msid",
        mbid.alias("recording_mbid"),
        F.lit(None).cast("string").alias("artist_name"),
        F.col("recording_msid").cast("string").alias("track_name"),
    )


def tracks_f1_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track dimension of F1 without the msids whose id % 13 is 5 (fixed
    rule of the fixture): listens of those are unknown tracks."""
    return tracks_f1(spark, sf_dir).where(F.col("recording_msid") % 13 != 5)


def weighted_ratings_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heavy-tailed listen counts: round(sum(value)) per (user, item), summed
    exactly as decimal(12,2) so that every engine gets the same integers."""
    ev = _table(spark, sf_dir, "events")
    return (
        ev.groupBy("user_id", f1_item().alias("recording_msid"))
        .agg(F.round(F.sum(F.col("value").cast("decimal(12,2)")), 0).cast("bigint").alias("listens"))
    )


# ---------------------------------------------------------------- F2 --------
def listens_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    od = _table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        od.o_custkey.alias("user_id"),
        li.l_partkey.alias("recording_msid"),
        li.l_shipdate.alias("timestamp"),
    )


def tracks_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("recording_msid"),
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("recording_mbid"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_name").alias("track_name"),
    )


# ---------------------------------------------------------------- F3 --------
def vectors_f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )
