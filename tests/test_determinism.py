"""Results do not depend on the partitioning (ties are broken explicitly,
ids are ranks, splits are hashes)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF01

KEYS = ["canonical_counts_f2", "user_top_k", "item_codes", "prepared_splits", "popularity_map",
        "popularity_average_top", "centered_ratings", "split_overlap", "mips_exact", "mips_exact_ties", "mips_lsh", "auc_popularity", "rating_profile_f1"]


def _rows(spark, key, partitions):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        return sorted(tuple(r) for r in entry_mod.queries()[key](spark, SF01).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("key", KEYS)
def test_same_result_under_two_partitionings(spark, key):
    assert _rows(spark, key, 3) == _rows(spark, key, 13)
