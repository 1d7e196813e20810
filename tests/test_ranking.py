"""Ranking metrics on the F4 toy cases, against fixed values and MLlib."""

import pytest
from pyspark.sql import Row

from earworm.operators import ranking

# predictions -> truth (fixed toy cases, FIXTURES F4)
CASES = [
    ([1, 2, 3, 4], [2, 4, 9]),
    ([5, 6], [6]),
    ([7], []),
    ([1, 2, 3], [3, 1, 2, 8, 9]),
]
# k -> (MAP@k, NDCG@k, precision@k, recall@k), fixed values from MLlib
EXPECTED = {
    2: (0.4375, 0.504446, 0.5, 0.433333),
    3: (0.416667, 0.481753, 0.416667, 0.483333),
    100: (0.358333, 0.462961, 0.015, 0.566667),
}


def _frames(spark, cases):
    preds = [Row(user_id=u, pos=i + 1, recording_msid=x) for u, (p, _) in enumerate(cases) for i, x in enumerate(p)]
    truth = [Row(user_id=u, recording_msid=x) for u, (_, t) in enumerate(cases) for x in t]
    users = spark.createDataFrame([Row(user_id=u) for u in range(len(cases))])
    p = spark.createDataFrame(preds)
    t = spark.createDataFrame(truth, "user_id long, recording_msid long")
    return p, t, users


@pytest.mark.parametrize("k", sorted(EXPECTED))
def test_toy_metrics_match_mllib_values(spark, k):
    p, t, users = _frames(spark, CASES)
    row = ranking.ranking_metrics(p, t, k, users=users).first()
    exp = EXPECTED[k]
    got = (row.map_at_k, row.ndcg_at_k, row.precision_at_k, row.recall_at_k)
    for g, e in zip(got, exp):
        assert g == pytest.approx(e, abs=1e-6)
    assert row.n_users == 4


def test_map_without_cutoff(spark):
    p, t, users = _frames(spark, CASES)
    assert ranking.ranking_metrics(p, t, None, users=users).first().map_at_k == pytest.approx(0.358333, abs=1e-6)


def test_swapped_arguments_reproduce_the_reference_defect(spark):
    swapped = [(t, p) for p, t in CASES]
    p, t, users = _frames(spark, swapped)
    row = ranking.ranking_metrics(p, t, 3, users=users).first()
    assert row.map_at_k == pytest.approx(0.541667, abs=1e-6)
    assert row.ndcg_at_k == pytest.approx(0.594627, abs=1e-6)


def test_agrees_with_mllib_live(spark):
    from pyspark.mllib.evaluation import RankingMetrics

    rdd = spark.sparkContext.parallelize([(p, t) for p, t in CASES])
    mm = RankingMetrics(rdd)
    p, t, users = _frames(spark, CASES)
    for k in (1, 2, 3, 5, 10):
        row = ranking.ranking_metrics(p, t, k, users=users).first()
        assert row.map_at_k == pytest.approx(mm.meanAveragePrecisionAt(k))
        assert row.ndcg_at_k == pytest.approx(mm.ndcgAt(k))
        assert row.precision_at_k == pytest.approx(mm.precisionAt(k))
        assert row.recall_at_k == pytest.approx(mm.recallAt(k))


def test_shared_list_equals_per_user_copies(spark):
    """A popularity list without a user column scores like the same list
    copied to every user (the reference's cross join)."""
    lst = [3, 1, 9, 2]
    shared = spark.createDataFrame([Row(pos=i + 1, recording_msid=x) for i, x in enumerate(lst)])
    copies = spark.createDataFrame(
        [Row(user_id=u, pos=i + 1, recording_msid=x) for u in range(4) for i, x in enumerate(lst)])
    _, t, _ = _frames(spark, CASES)
    a = ranking.ranking_metrics(shared, t, 3).first()
    b = ranking.ranking_metrics(copies, t, 3).first()
    assert a.asDict() == pytest.approx(b.asDict())


def test_user_top_k_ties_by_item(spark):
    df = spark.createDataFrame([(1, 5, 2), (1, 3, 2), (1, 4, 7), (2, 1, 1)],
                               "user_id long, recording_msid long, listens long")
    got = [(r.user_id, r.pos, r.recording_msid) for r in ranking.user_top_k(df, 2).orderBy("user_id", "pos").collect()]
    assert got == [(1, 1, 4), (1, 2, 3), (2, 1, 1)]


def test_rmse_drops_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, float("nan")), (2.0, 2.0)], "listens double, prediction double")
    row = ranking.rmse(df).first()
    assert row.n_scored == 2
    assert row.rmse == pytest.approx((0.5) ** 0.5)
