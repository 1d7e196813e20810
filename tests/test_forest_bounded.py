"""Tree-forest and norm-bounded retrieval, fold-in."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from earworm.operators import bounded, foldin, forest, retrieve
from earworm.operators import factorize as fz
from earworm.plans.queries import canonical_counts_f1, canonical_counts_f2
from earworm.sources import testdata as td


def clustered(spark, n=6000, clusters=60, d=16, seed=5, lengths=True):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, d)) * 3
    x = centres[rng.integers(0, clusters, n)] + rng.standard_normal((n, d))
    if lengths:
        x *= np.exp(rng.normal(0, 0.5, n))[:, None]
    return spark.createDataFrame([(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)],
                                 "id bigint, features array<float>").repartition(6)


@pytest.fixture(scope="module")
def model(spark):
    idx = fz.index_ratings(canonical_counts_f2(spark, SF01))
    return idx, fz.fit_als(idx, rank=12, reg=0.1, max_iter=8, implicit=True)


def _pairs(df):
    return {(r.query_id, r.pos): (r.item_id, r.score) for r in df.collect()}


def test_forest_recall_and_share_on_clusters(spark):
    items = clustered(spark).cache()
    queries = items.where("id % 10 = 0")
    exact = retrieve.mips_exact(queries, items, 10).cache()
    found = forest.mips_forest(queries, items, 10)
    assert found.columns == ["query_id", "pos", "item_id", "score"]
    assert retrieve.retrieval_recall(found, exact).first().recall_at_k >= 0.9
    share = forest.forest_candidate_share(queries, items, 10).first()
    assert share.candidate_share <= 0.3 and share.n_queries == 600 and share.n_items == 6000
    few = forest.mips_forest(queries, items, 10, search_k=60)
    assert few.groupBy("query_id").count().where("count <> 10").count() == 0


def test_forest_recall_and_share_on_als_factors(spark, model):
    users, items = fz.factors(model[1])
    exact = retrieve.mips_exact(users, items, 10).cache()
    found = forest.mips_forest(users, items, 10, search_k=items.count() // 4)
    assert retrieve.retrieval_recall(found, exact).first().recall_at_k >= 0.9
    assert forest.forest_candidate_share(users, items, 10, search_k=items.count() // 4).first().candidate_share <= 0.3


def test_forest_of_few_equal_and_no_items(spark):
    few = clustered(spark, 5)
    assert _pairs(forest.mips_forest(few, few, 10)).keys() == _pairs(retrieve.mips_exact(few, few, 10)).keys()
    same = spark.range(3000).select("id", F.array(F.lit(1.0), F.lit(0.5)).cast("array<float>").alias("features"))
    got = forest.mips_forest(same.where("id < 3"), same, 10, search_k=3000)
    assert {(r.query_id, r.item_id) for r in got.collect()} == {(q, i) for q in range(3) for i in range(10)}
    none = few.where("id < 0")
    assert forest.mips_forest(none, few, 10).count() == 0 and forest.mips_forest(few, none, 10).count() == 0
    dirty = few.unionByName(spark.createDataFrame([(None, [1.0] * 16), (77, None)], few.schema))
    assert _pairs(forest.mips_forest(dirty, dirty, 3)).keys() == _pairs(forest.mips_forest(few, few, 3)).keys()


def test_forest_does_not_depend_on_partitions_and_is_kept(spark, scratch):
    items = clustered(spark, 3000)
    a, b = forest.grow_forest(items), forest.grow_forest(items.repartition(11))
    assert np.array_equal(a.normals, b.normals) and np.array_equal(a.offsets, b.offsets)
    forest.save_forest(a, spark, f"{scratch}/forest")
    c = forest.load_forest(spark, f"{scratch}/forest")
    assert np.array_equal(a.normals, c.normals) and c.depth == a.depth and c.n_items == 3000
    per_leaf = forest.postings(c, items).groupBy("_t", "_leaf").count()
    assert per_leaf.agg(F.sum("count")).first()[0] == 3000 * c.n_trees
    assert per_leaf.agg(F.max("count")).first()[0] < 10 * 64


def test_bounded_equals_exact(spark, model):
    items = clustered(spark).cache()
    users, factors = fz.factors(model[1])
    vec = td.vectors_f3(spark, SF01)
    for q, i, size in ((items.where("id % 7 = 0"), items, 300), (users, factors, 64), (vec, vec, 256)):
        want = _pairs(retrieve.mips_exact(q, i, 10))
        assert _pairs(bounded.mips_bounded(q, i, 10, block_items=size, block_queries=size)) == want


def test_bounded_scores_a_part_of_the_pairs(spark, model):
    users, factors = fz.factors(model[1])
    share = bounded.mips_bounded_share(users, factors, 10, block_items=32).first()
    assert 0 < share.scored_share < 0.7
    items = clustered(spark)
    row = bounded.mips_bounded_share(items.where("id % 7 = 0"), items, 10, block_items=128).first()
    assert row.scored_share < 0.8 and row.n_items == 6000


def test_bounded_ties_negatives_and_empty_sides(spark):
    items = spark.range(1000).select("id", F.array(F.lit(1.0), F.lit(0.1)).alias("features")).orderBy(F.rand(3))
    query = spark.createDataFrame([(7, [0.3, 0.7]), (8, [-0.3, -0.7]), (9, [0.0, 0.0])], "id long, features array<double>")
    got = _pairs(bounded.mips_bounded(query, items, 10, block_items=64))
    assert got == _pairs(retrieve.mips_exact(query, items, 10))
    mixed = items.withColumn("features", F.transform("features", lambda x: x * (F.col("id") % 5 - 2)))
    assert _pairs(bounded.mips_bounded(query, mixed, 10, block_items=64)) == _pairs(retrieve.mips_exact(query, mixed, 10))
    none = items.where("id < 0")
    assert bounded.mips_bounded(query, none, 10).count() == 0 and bounded.mips_bounded(none, items, 10).count() == 0
    assert bounded.mips_bounded_share(query, none, 10).first().scored_share is None


@pytest.mark.parametrize("params", [
    {"implicit": True, "alpha": 2.0}, {"implicit": False}, {"implicit": False, "nonnegative": True}])
def test_fold_in_gives_a_train_users_factor(spark, params):
    idx = fz.index_ratings(canonical_counts_f1(spark, SF01))
    model = fz.fit_als(idx, rank=8, reg=0.1, max_iter=6, **params)
    got = foldin.fold_in(idx.ratings, model.itemFactors, reg=0.1, user="_uidx", item="_iidx", **params)
    mine = {r.id: np.array(r.features) for r in got.collect()}
    theirs = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    assert mine.keys() == theirs.keys()
    scale = max(np.abs(v).max() for v in theirs.values())
    assert max(np.abs(mine[u] - theirs[u]).max() for u in theirs) < 1e-4 * max(1.0, scale)


def test_fold_in_of_hot_users_and_bad_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    y = rng.standard_normal((400, 5)).astype(np.float32)
    items = spark.createDataFrame([(f"i{i}", v.tolist()) for i, v in enumerate(y)], "id string, features array<float>")
    data = [("hot", f"i{i % 400}", float(rng.integers(1, 9))) for i in range(5000)]
    data += [(f"u{j}", f"i{int(i)}", 2.0) for j in range(50) for i in rng.integers(0, 400, 3)]
    bad = [(None, "i1", 1.0), ("u1", None, 1.0), ("u1", "unknown", 1.0), ("u1", "i1", None), ("only", "unknown", 1.0)]
    rows = spark.createDataFrame(data + bad, "user_id string, recording_msid string, listens double").repartition(7)
    monkeypatch.setattr(foldin, "USER_ROWS", 300)
    monkeypatch.setattr(foldin, "HELD", 25 * 40)
    got = {r.id: np.array(r.features) for r in foldin.fold_in(rows, items, reg=0.5).collect()}
    want = {}
    for user in {u for u, _, _ in data}:
        mine = [(int(i[1:]), r) for u, i, r in data if u == user]
        m = y[[i for i, _ in mine]].astype(np.float64)
        want[user] = np.linalg.solve(m.T @ m + 0.5 * len(mine) * np.eye(5), m.T @ np.array([r for _, r in mine]))
    assert got.keys() == want.keys()
    assert max(np.abs(got[u] - want[u]).max() for u in want) < 1e-4
    assert foldin.fold_in(rows, items.where("id = 'x'")).count() == 0
    assert foldin.fold_in(rows.limit(0), items).count() == 0
