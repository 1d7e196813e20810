"""ALS invariants and inner-product retrieval against brute force."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from earworm.operators import factorize as fz
from earworm.operators import ranking, ratings, retrieve, splits
from earworm.plans.queries import canonical_counts_f1
from earworm.sources import testdata as td


@pytest.fixture(scope="module")
def explicit(spark):
    counts = ratings.filter_min_listens(canonical_counts_f1(spark, SF01), 1)
    idx = fz.index_ratings(counts)
    train, val = splits.train_val(splits.split_users(idx.ratings, 0.7, holdin=0.6))
    model = fz.fit_als(replace(idx, ratings=train), rank=5, reg=0.1, max_iter=8, nonnegative=True)
    return idx, train, val, model


def test_nonnegative_factors_without_nan(explicit):
    _, _, _, model = explicit
    for f in fz.factors(model):
        vals = np.array([v for r in f.collect() for v in r.features])
        assert not np.isnan(vals).any() and (vals >= 0).all()


def test_rmse_beats_global_mean_on_train(explicit):
    _, train, _, model = explicit
    fit_rmse = ranking.rmse(model.transform(train)).first().rmse
    mean = train.agg(F.avg("listens")).first()[0]
    base = ranking.rmse(train.withColumn("prediction", F.lit(mean))).first().rmse
    assert fit_rmse < base


def test_recommend_k_rows_per_user_with_original_ids(explicit):
    idx, _, val, model = explicit
    recs = fz.recommend_users(model, idx, val.select("user_id"), 5)
    per_user = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("m"))
    assert per_user.where("n != 5 or m != 5").count() == 0
    known = idx.ratings.select("recording_msid").distinct()
    assert recs.join(known, "recording_msid", "left_anti").count() == 0


def test_score_pairs_drops_cold_start(explicit):
    idx, _, val, model = explicit
    pairs = val.select("user_id", "recording_msid", "listens")
    cold = pairs.limit(1).withColumn("recording_msid", F.lit(-1).cast("long"))
    scored = fz.score_pairs(model, idx, pairs.unionByName(cold))
    assert scored.count() == pairs.count()


def test_save_and_load_model(explicit, scratch):
    _, _, _, model = explicit
    fz.save_model(model, f"{scratch}/als")
    fz.save_factors(model, f"{scratch}/factors")
    loaded = fz.load_model(f"{scratch}/als")
    assert loaded.rank == model.rank
    assert loaded.itemFactors.count() == model.itemFactors.count()


def test_exact_recommendations_match_recommend_for_all(explicit):
    """mips_exact over the model's factors == ALS's own blocked top-k."""
    _, _, _, model = explicit
    users, items = fz.factors(model)
    ours = retrieve.mips_exact(users, items, 3)
    theirs = model.recommendForAllUsers(3).select(
        F.col("_uidx").alias("query_id"), F.posexplode("recommendations").alias("p", "r")
    ).select("query_id", F.col("r._iidx").cast("long").alias("item_id"), F.col("r.rating").alias("score"))
    a = {(r.query_id, r.item_id) for r in ours.collect()}
    b = {(r.query_id, r.item_id) for r in theirs.collect()}
    assert len(a & b) / len(b) > 0.98  # equal up to float ties


def _brute(vecs, k):
    ids = np.array([i for i, _ in vecs])
    m = np.array([v for _, v in vecs], dtype=np.float64)
    s = m @ m.T
    out = {}
    for qi, q in enumerate(ids):
        order = np.lexsort((ids, -s[qi]))[:k]
        out[int(q)] = [int(ids[j]) for j in order]
    return out


def _lists(result):
    got = {}
    for r in result.orderBy("query_id", "pos").collect():
        got.setdefault(r.query_id, []).append(r.item_id)
    return got


def test_mips_exact_equals_brute_force_and_blocking(spark):
    vec = td.vectors_f3(spark, SF01)
    want = _brute([(r.id, r.features) for r in vec.collect()], 10)
    for size in (2048, 97):  # one block / many blocks
        assert _lists(retrieve.mips_exact(vec, vec, 10, block_items=size, block_queries=size)) == want


def test_ties_go_to_the_smaller_id_whatever_their_number(spark):
    items = spark.range(1000).select("id", F.array(F.lit(1.0), F.lit(0.1)).alias("features")).orderBy(F.rand(3))
    query = spark.createDataFrame([(7, [0.3, 0.7])], "id long, features array<double>")
    for size in (2048, 64):
        assert _lists(retrieve.mips_exact(query, items, 10, block_items=size)) == {7: list(range(10))}
    text = items.select(F.concat(F.lit("i"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("id"), "features")
    got = _lists(retrieve.mips_exact(query, text, 3))
    assert got == {7: ["i0000", "i0001", "i0002"]}


def test_scaling_the_queries_changes_no_list(spark):
    vec = td.vectors_f3(spark, SF01)
    scaled = vec.select("id", F.transform("features", lambda x: x.cast("double") * 1000).alias("features"))
    assert _lists(retrieve.mips_exact(scaled, vec, 10)) == _lists(retrieve.mips_exact(vec, vec, 10))
    same = retrieve.mips_lsh(vec, vec, 10)
    big = retrieve.mips_lsh(scaled, vec, 10)
    assert big.groupBy("query_id").count().where("count = 10").count() == vec.count()
    pairs = same.select("query_id", "item_id").exceptAll(big.select("query_id", "item_id")).count()
    assert pairs <= 0.01 * 10 * vec.count()  # a projection on a bucket's edge may round away


def test_one_outlier_item_changes_no_other_class(spark):
    vec = td.vectors_f3(spark, SF01)
    outlier = spark.createDataFrame([(10**6, [1e6] * 64)], "id long, features array<float>")
    exact = retrieve.mips_exact(vec, vec.unionByName(outlier), 10)
    recall = retrieve.retrieval_recall(retrieve.mips_lsh(vec, vec.unionByName(outlier), 10), exact).first().recall_at_k
    assert recall > 0.8


def test_few_items_and_empty_sides(spark):
    vec = td.vectors_f3(spark, SF01)
    few = vec.where("id < 3")
    assert retrieve.mips_exact(few, few, 10).count() == 9
    assert retrieve.mips_lsh(few, few, 10).count() == 9
    none = vec.where("id < 0")
    assert retrieve.mips_exact(none, vec, 10).count() == 0 and retrieve.mips_exact(vec, none, 10).count() == 0


def test_block_scoring_memory_is_bounded():
    import tracemalloc

    rng = np.random.default_rng(5)
    q, x = rng.normal(size=(2048, 32)), rng.normal(size=(2048, 32))
    tracemalloc.start()
    got = retrieve.top_k_of_block(np.arange(2048), q, np.arange(2048), x, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 20480 and peak < 64 << 20


def test_mips_lsh_recall_and_blocking(spark):
    vec = td.vectors_f3(spark, SF01)
    exact = retrieve.mips_exact(vec, vec, 10)
    lists = {}
    for blocks in (2048, 16):  # small blocks: every bucket split in many groups
        approx = retrieve.mips_lsh(vec, vec, 10, block_items=blocks, block_queries=blocks)
        lists[blocks] = _lists(approx)
        assert set(map(len, lists[blocks].values())) == {10} and len(lists[blocks]) == vec.count()
        assert retrieve.retrieval_recall(approx, exact).first().recall_at_k > 0.85
    assert lists[2048] == lists[16]


def test_string_item_ids_take_the_dense_path(spark):
    counts = ratings.filter_min_listens(canonical_counts_f1(spark, SF01), 1).withColumn(
        "recording_msid", F.concat(F.lit("t"), F.col("recording_msid").cast("string")))
    idx = fz.index_ratings(counts)
    assert idx.users is not None and idx.items is not None
    codes = idx.items.agg(F.min("_iidx"), F.max("_iidx"), F.count(F.lit(1))).first()
    assert (codes[0], codes[1] + 1) == (0, codes[2])
    model = fz.fit_als(idx, rank=4, max_iter=3)
    recs = fz.recommend_users(model, idx, counts, 3)
    assert dict(recs.dtypes)["recording_msid"] == "string"
    assert recs.join(counts.select("recording_msid").distinct(), "recording_msid", "left_anti").count() == 0


def test_lsh_candidate_share_shrinks_with_sharper_buckets(spark):
    vec = td.vectors_f3(spark, SF01)
    wide = retrieve.lsh_candidate_share(vec, vec).first()
    sharp = retrieve.lsh_candidate_share(vec, vec, hashes_per_table=4).first()
    assert wide.n_queries == wide.n_items == vec.count()
    assert 0 < sharp.candidate_share < wide.candidate_share and sharp.candidate_share < 0.5


def test_bench_retrieval_reports_recall_and_times(spark):
    vec = td.vectors_f3(spark, SF01)
    res = retrieve.bench_retrieval(vec, vec, 10)
    assert 0.8 < res["recall_at_k"] <= 1.0 and res["exact_sec"] > 0 and res["lsh_sec"] > 0


def test_fits_agree_under_any_partitioning(spark):
    counts = canonical_counts_f1(spark, SF01)
    lists = []
    for n in (2, 8):
        idx = fz.index_ratings(counts.repartition(n))
        model = fz.fit_als(idx, rank=8, max_iter=5, implicit=True)
        lists.append({(r.user_id, r.pos): r.recording_msid for r in fz.recommend_users(model, idx, counts, 5).collect()})
    agree = sum(lists[0][key] == lists[1][key] for key in lists[0])
    assert lists[0].keys() == lists[1].keys() and agree >= 0.99 * len(lists[0])


@pytest.fixture(scope="module")
def results(spark):
    """The model queries, each run once at sf0.001."""
    from conftest import SF001
    from earworm.plans.models import MODEL_REGISTRY

    return {k: MODEL_REGISTRY[k](spark, SF001).collect() for k in MODEL_REGISTRY}


def test_recommendation_queries_give_full_ranked_lists(results):
    for key in ("als_implicit_f1", "als_implicit_recs"):
        lists = {}
        for r in results[key]:
            lists.setdefault(r.user_id, []).append((r.pos, r.recording_msid, r.score))
        sizes = set(map(len, lists.values()))
        assert len(sizes) == 1 and sizes.pop() <= 100
        for rows in lists.values():
            rows.sort()
            assert [p for p, _, _ in rows] == list(range(1, len(rows) + 1))
            assert len({i for _, i, _ in rows}) == len(rows)
            assert all(a[2] >= b[2] - 1e-6 for a, b in zip(rows, rows[1:]))


def test_metric_queries_give_shares(results):
    for key in ("als_implicit_map", "als_centred_implicit", "als_explicit_topk", "als_seen_precision"):
        (row,) = results[key]
        assert row.n_users > 0
        assert all(0 <= v <= 1 for k, v in row.asDict().items() if k != "n_users")
    assert results["als_centred_implicit"][0].map_at_k > 0
    (auc,) = results["relevance_auc"]
    assert 0 <= auc.n_relevant <= auc.n_pairs and (auc.auc is None or 0 <= auc.auc <= 1)
    (acc,) = results["hit_accuracy"]
    assert 0 <= acc.accuracy <= 1 and acc.n_pairs > 0
    (err,) = results["als_explicit_rmse"]
    assert err.rmse > 0 and err.n_scored > 0


def test_tuning_reports(results):
    assert len(results["als_tuned_grid"]) == 18
    for key in ("als_tuned", "als_tuned_grid", "als_holdout_tuned"):
        rows = results[key]
        assert sum(r.best for r in rows) == 1
        assert min(rows, key=lambda r: r.rmse).rmse == next(r for r in rows if r.best).rmse
        assert len({(r.rank, r.reg_param, r.max_iter) for r in rows}) == len(rows)


def test_factor_and_retrieval_queries(results):
    assert {r["rank"] for r in results["als_factors"]} == {20}
    assert len({r.id for r in results["als_factors"]}) == len(results["als_factors"])
    known = {r.id for r in results["als_factors"]}
    assert {r.item_id for r in results["mips_exact_als"]} <= known
    (recall,) = results["mips_lsh_recall"]
    assert recall.recall_at_k >= 0.85
    assert results["mips_lsh_candidates"][0].scored_pairs > 0


def test_model_beats_popularity_on_planted_tastes(spark):
    """Two groups of users with items of their own: the model finds them."""
    rows = [(u, 100 * (u % 2) + i, 1 + (u * i) % 3) for u in range(60) for i in range(20) if (u * 7 + i * 3) % 4]
    counts = spark.createDataFrame(rows, "user_id long, recording_msid long, listens long")
    idx = fz.index_ratings(counts)
    recs = fz.recommend_users(fz.fit_als(idx, rank=4, max_iter=8, implicit=True), idx, counts, 10)
    own = recs.where((F.col("recording_msid") >= 100) == (F.col("user_id") % 2 == 1)).count()
    assert own > 0.95 * recs.count()
