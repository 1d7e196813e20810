"""Named temp views over the fixture frames, for queries that read better as
SQL (S8).  The views are lazy plans; SQL over them is optimized by Catalyst
exactly like the DataFrame form."""

from __future__ import annotations

from pyspark.sql import SparkSession

from earworm.sources import testdata as td


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    frames = {
        "listens_f1": td.listens_f1(spark, sf_dir),
        "tracks_f1": td.tracks_f1(spark, sf_dir),
        "listens_f2": td.listens_f2(spark, sf_dir),
        "tracks_f2": td.tracks_f2(spark, sf_dir),
        "weighted_f1": td.weighted_ratings_f1(spark, sf_dir),
        "vectors_f3": td.vectors_f3(spark, sf_dir),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)
