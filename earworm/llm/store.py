"""Reading ``documents`` and cutting lineage by tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earworm.session import table_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's shared checkpoint folder; an enclosing
    ``session.table_scope`` drops what is there at its end."""
    return table_path(spark, name)


def neutral(docs: DataFrame, *roles: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns named by their place, which no column that an
    operator adds can clash with, and the new names of ``roles``."""
    names = [f"column {i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), [names[docs.columns.index(r)] for r in roles]


def written(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    Unlike ``checkpoint()``, which computes a frame once to count it and once
    to write it, the frame is computed exactly once; any executor can read the
    result after another one is lost.  With ``outer`` the table outlives the
    innermost ``table_scope``.
    """
    spark = df.sparkSession
    path = table_path(spark, name, outer)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
