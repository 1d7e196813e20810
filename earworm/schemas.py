"""Declared schemas of the data model and column validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# One row = one listen.
INTERACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("recording_msid", T.LongType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
    ]
)

# Track dimension: many msids may share one (nullable) mbid.
TRACKS = T.StructType(
    [
        T.StructField("recording_msid", T.LongType(), True),
        T.StructField("recording_mbid", T.StringType(), True),
        T.StructField("artist_name", T.StringType(), True),
        T.StructField("track_name", T.StringType(), True),
    ]
)

# Listen counts per (user, item).
RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("recording_msid", T.LongType(), True),
        T.StructField("listens", T.LongType(), True),
    ]
)

# ALS factor tables (what ALSModel.userFactors / itemFactors hold).
FACTORS = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("features", T.ArrayType(T.FloatType()), True),
    ]
)


#: Id columns whose files may hold text as well as integers.
ID_COLUMNS = ("user_id", "recording_msid")


def with_id_types(schema: T.StructType, stored: T.StructType) -> T.StructType:
    """``schema`` with text ids where the stored table has them."""
    held = {f.name: f.dataType for f in stored.fields}
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in ID_COLUMNS and isinstance(held.get(f.name), T.StringType)
                      else f.dataType, f.nullable) for f in schema.fields])


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail early, with the missing names, instead of renaming by position."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
