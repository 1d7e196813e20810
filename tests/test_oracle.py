"""Every registered query with an oracle equals its DuckDB SQL at sf0.01
(what the driver's correctness gate checks), and the entry point runs."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001, SF01
from oracle_harness import compare, duck

KEYS = sorted(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_oracle_key_is_registered():
    assert set(KEYS) <= set(entry_mod.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, entry_mod.queries()[key], entry_mod.oracle_sql()[key], SF01)
    assert res["cols"], (res["spark_cols"], res["oracle_cols"])
    assert res["rows"], (res["n_spark"], res["n_oracle"])
    assert res["values"]
    assert not res["types"], res["types"]


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["map_at_k", "ndcg_at_k", "precision_at_k", "recall_at_k", "n_users"]
    assert len(rows) == 1 and rows[0].n_users > 0


def test_queries_run_on_smoke_data(spark):
    """Every registered query, including the model ones, runs at sf0.001."""
    for key, fn in entry_mod.queries().items():
        assert fn(spark, SF001).count() >= 0, key
