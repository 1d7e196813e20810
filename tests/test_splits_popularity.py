"""Splits, count filters, centring and popularity identities."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from earworm.operators import popularity, ratings, splits
from earworm.plans.queries import canonical_counts_f1
from earworm.sources import testdata as td


def test_split_partitions_input_and_is_partitioning_free(spark):
    counts = canonical_counts_f1(spark, SF01)
    a = splits.split_users(counts, 0.7, holdin=0.6)
    b = splits.split_users(counts.repartition(7), 0.7, holdin=0.6)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    train, val = splits.train_val(a)
    assert train.count() + val.count() == counts.count()
    assert train.join(val, ["user_id", "recording_msid"]).count() == 0
    assert train.unionByName(val).exceptAll(counts).count() == 0


def test_user_split_keeps_users_whole(spark):
    labelled = splits.split_users(canonical_counts_f1(spark, SF01), 0.6)
    per_user = labelled.groupBy("user_id").agg(F.count_distinct("split").alias("n"))
    assert per_user.where("n > 1").count() == 0
    share = labelled.where("split = 'train'").select("user_id").distinct().count() / \
        labelled.select("user_id").distinct().count()
    assert 0.45 < share < 0.75


def test_holdin_makes_validation_users_known(spark):
    labelled = splits.split_users(canonical_counts_f1(spark, SF01), 0.7, holdin=0.6)
    train, val = splits.train_val(labelled)
    row = splits.split_overlap(labelled).first()
    assert row.common_users == row.val_users > 0
    assert splits.restrict_to_seen(val, train).count() > 0


def test_average_identity_a3_equals_a4(spark):
    log = td.listens_f2(spark, SF01)
    a3 = popularity.item_average_listens(log).select("recording_msid", "avg_listens")
    a4 = popularity.average_two_level(ratings.count_listens(log))
    diff = a3.join(a4.withColumnRenamed("avg_listens", "b"), "recording_msid") \
        .where(F.abs(F.col("avg_listens") - F.col("b")) > 1e-12)
    assert diff.count() == 0 and a3.count() == a4.count()


def test_popularity_total_ties_and_positions(spark):
    log = spark.createDataFrame([(1, 5), (2, 5), (1, 3), (2, 3), (3, 9)], "user_id long, recording_msid long")
    top = [(r.pos, r.recording_msid, r.score) for r in popularity.popularity_total(log, 2).orderBy("pos").collect()]
    assert top == [(1, 3, 2), (2, 5, 2)]


def test_filters_and_centring(spark):
    r = spark.createDataFrame([(1, 1, 1), (1, 2, 9), (2, 1, 5), (2, 2, 2)], "user_id long, recording_msid long, listens long")
    assert ratings.filter_min_listens(r, 1).count() == 3
    # median 3.5, + 1 -> keep listens > 4.5
    assert sorted(x.listens for x in ratings.filter_above_median(r, 1).collect()) == [5, 9]
    c = {(x.user_id, x.recording_msid): x.listens_mean for x in ratings.center_ratings(r).collect()}
    # user means 5, 3.5; item means 3, 5.5: every centred value is negative
    assert c == {}
    c2 = ratings.center_ratings(r, keep_non_negative=False).collect()
    assert {(x.user_id, x.recording_msid): x.listens_mean for x in c2} == {
        (1, 1): -7, (1, 2): -2, (2, 1): -2, (2, 2): -7}  # half-even: -1.5 -> -2


def test_half_even_rounding(spark):
    from earworm.functions.exprs import round_half_even
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-1.5,)], "x double")
    assert [r.y for r in df.select(round_half_even("x").alias("y")).collect()] == \
        pytest.approx([0.0, 2.0, 2.0, -0.0, -2.0])


def test_exact_median_and_running_totals(spark):
    from earworm.operators.ordered import exact_median, running_totals

    for values, want in (([3], 3.0), ([1, 2], 1.5), ([5, 1, 1, 9], 3.0), ([2, 2, 2, 7, None], 2.0)):
        df = spark.createDataFrame([(v,) for v in values], "x long")
        assert exact_median(df, "x").first()[0] == want
    empty = spark.createDataFrame([], "x long")
    assert exact_median(empty, "x").first()[0] is None
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = {r.k: r.before_v for r in running_totals(rows, "k", "v").collect()}
    total = 0
    for k in range(1000):
        assert got[k] == total
        total += k % 7


def test_unit_hash_tells_null_keys_apart(spark):
    from earworm.functions.exprs import unit_hash

    df = spark.createDataFrame([(None, 5), (5, None), (None, None)], "a long, b long")
    got = [r.h for r in df.select(unit_hash("a", "b", salt="x").alias("h")).collect()]
    assert None not in got and len(set(got)) == 3


def test_profile_and_shape_need_no_expand_nor_one_task_median(spark):
    from earworm.plans import models, queries

    for build in (queries.rating_profile_f1, queries.above_median_f1w, models.als_matrix_shape):
        plan = build(spark, SF01)._jdf.queryExecution().toString()
        assert "Expand" not in plan and "median(" not in plan.lower().replace("median_listens", "")
