"""Readers and writers."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from earworm.schemas import INTERACTIONS, RATINGS, TRACKS, require_columns, with_id_types


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", **options) -> DataFrame:
    """Columnar scan; with a schema, columns are selected by name and typed
    (user and item ids stay text where the file holds text).

    Filters and projections written later reach the Parquet scan
    (PushedFilters / ReadSchema), so callers never pre-select columns.
    """
    reader = spark.read.options(**options)
    if schema is not None and fmt != "parquet":
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    if schema is not None and fmt == "parquet":
        require_columns(df, *schema.fieldNames())
        schema = with_id_types(schema, df.schema)
        df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, INTERACTIONS)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, TRACKS)


def read_ratings(spark: SparkSession, path: str, fmt: str = "parquet",
                 columns: list[str] | None = None) -> DataFrame:
    """Ratings from Parquet, or from header-less CSV with declared column order.

    ``columns`` states the on-disk order of a header-less file (S7), e.g.
    ``["user_id", "listens", "recording_msid"]``; the result always has the
    RATINGS column order, so a positional mix-up cannot swap item and count.
    """
    if fmt == "csv":
        order = columns or RATINGS.fieldNames()
        by_name = {f.name: f for f in RATINGS.fields}
        schema = T.StructType([by_name[c] for c in order])
        df = spark.read.schema(schema).option("header", "false").csv(path)
        return df.select(*RATINGS.fieldNames())
    return read_table(spark, path, RATINGS)


def write_sorted(df: DataFrame, path: str, *keys, fmt: str = "parquet", partitions: int | None = None,
                 **options) -> None:
    """Sink in one global order (T3): rows are dealt into ranges of ``keys``
    and sorted inside each, so the files, by name, hold ascending ranges and no
    task sorts more than its range."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").options(**options).format(fmt).save(path))


LAYOUT = "keys array<string>, order array<string>, buckets int, ddl string"


def write_laid_out(df: DataFrame, path: str, keys: list[str], buckets: int, order: list[str] | None = None) -> None:
    """Parquet in ``buckets`` buckets of ``keys``, sorted inside each by ``keys``
    and ``order``, one file a bucket; its layout is kept beside it.

    Counts, top-k lists and truth lists by the key, and joins of two tables of
    the same buckets, then need no exchange.  The table is external: it stays
    where ``path`` says and any session can read it with ``read_laid_out``.
    """
    by = [*keys, *[c for c in order or [] if c not in keys]]
    name = _table_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *keys).sortWithinPartitions(*by).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*by).format("parquet").saveAsTable(name))
    df.sparkSession.createDataFrame([(keys, by, buckets, df.schema.toDDL())], LAYOUT).coalesce(1).write.mode(
        "overwrite").parquet(f"{path.rstrip('/')}-layout")


def read_laid_out(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_laid_out`` wrote, with its buckets known to the planner."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        row = spark.read.schema(LAYOUT).parquet(f"{path.rstrip('/')}-layout").first()
        keys, by = (", ".join(f"`{c}`" for c in columns) for columns in (row["keys"], row["order"]))
        spark.sql(f"CREATE TABLE {name} ({row.ddl}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({by}) "
                  f"INTO {row.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _table_name(path: str) -> str:
    return f"laid_out_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                compression: str = "snappy", partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, header: bool = True) -> None:
    """Sink.  ``sort_by`` sorts within partitions; see ``write_sorted`` for one order."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode).option("compression", compression if fmt != "csv" else "none")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", str(header).lower()).csv(path)
    else:
        writer.format(fmt).save(path)
