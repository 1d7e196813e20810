"""Resumable tuning, identity kept by batches, sketches, exact splits, laid-out tables."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from earworm.operators import delta, identity, ordered, popularity, ranking, ratings, sketches, splits, tuning
from earworm.operators import factorize as fz
from earworm.plans.queries import canonical_counts_f1
from earworm.sources import tables
from earworm.sources import testdata as td

GRID = {"rank": [4, 6], "reg": [0.05, 0.2], "max_iter": [3]}


@pytest.fixture(scope="module")
def indexed(spark):
    return fz.index_ratings(ratings.filter_min_listens(canonical_counts_f1(spark, SF01), 1))


def _report(report):
    return [(r.rank, r.reg_param, r.max_iter, round(r.rmse, 5), r.best) for r in report.collect()]


def test_report_is_the_same_for_any_partitions(spark, indexed, scratch):
    found = []
    for parts in (3, 13):
        idx = replace(indexed, ratings=indexed.ratings.repartition(parts))
        model, report = tuning.tune(idx, GRID, folds=3, nonnegative=True, ledger=f"{scratch}/{parts}")
        found.append(_report(report))
    assert found[0] == found[1] and sum(r[-1] for r in found[0]) == 1 and len(found[0]) == 4
    best = min(found[0], key=lambda r: r[3])
    assert best[-1] and model.rank == best[0]


def test_a_search_that_ended_early_goes_on(spark, indexed, scratch, monkeypatch):
    fits, real = [], tuning.fit_and_test

    def counted(*args):
        if len(fits) == 6 and not counted.lenient:
            raise RuntimeError("driver lost")
        fits.append(args[2:4])
        return real(*args)

    counted.lenient = False
    monkeypatch.setattr(tuning, "fit_and_test", counted)
    run = dict(grid=GRID, folds=3, nonnegative=True, ledger=scratch, parallelism=1, refit=False)
    with pytest.raises(RuntimeError):
        tuning.tune(indexed, **run)
    assert len(fits) == 6
    counted.lenient = True
    _, report = tuning.tune(indexed, **run)
    assert len(fits) == 12  # the first six were read from the ledger
    _, again = tuning.tune(indexed, **run)
    assert len(fits) == 12 and _report(again) == _report(report)
    _, other = tuning.tune(replace(indexed, ratings=indexed.ratings.where("listens > 2")), **run)
    assert len(fits) == 24  # other ratings, other ledger entries


def test_folds_and_holdout(spark, indexed):
    rows = tuning.with_folds(indexed.ratings, 5).groupBy("fold").count().collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4]
    held = tuning.with_holdout(indexed.ratings, 0.8)
    share = held.where("fold = 0").count() / held.count()
    assert 0.1 < share < 0.3
    with pytest.raises(ValueError):
        tuning.settings_of({"ranks": [1]})


LOG = "user_id bigint, recording_msid bigint, timestamp timestamp"
TRACKS = "recording_msid bigint, recording_mbid string"


def _log(seed=4, n=600):
    rng = random.Random(seed)
    import datetime

    base = datetime.datetime(2020, 1, 1)
    rows = [(rng.randint(1, 12), rng.randint(1, 40),
             None if rng.random() < 0.03 else base + datetime.timedelta(hours=rng.randint(0, 200))) for _ in range(n)]
    rows += rows[:80] + [(5, 100, base)] * 3 + [(None, 3, base)]
    tracks = [(i, None if i % 5 == 0 else f"m{i // 4}") for i in range(1, 39)]
    return rows, tracks


def _counts(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_state_of_batches_equals_the_rebuild(spark, scratch):
    rows, tracks = _log()
    rng = random.Random(1)
    dim = spark.createDataFrame(tracks, TRACKS)
    state = delta.IdentityState(spark, f"{scratch}/state")
    batches = [[] for _ in range(4)]
    for row in rows:
        batches[rng.randint(0, 3)].append(row)
    seen, labels = [], {}
    for i, batch in enumerate(batches):
        log = spark.createDataFrame(batch, LOG)
        changes = state.merge(log, dim, f"b{i}").collect()
        seen += batch
        whole = spark.createDataFrame(seen, LOG)
        assert _counts(state.counts()) == _counts(identity.canonical_listens(whole, dim))
        now = {r.recording_mbid: r.canonical for r in state.labels().collect()}
        moved = {m: (labels.get(m), c) for m, c in now.items() if labels.get(m) != c}
        assert {r.recording_mbid: (r.old_item, r.new_item) for r in changes} == moved
        counts = {(r.user_id, r.recording_msid): r.listens for r in state.counts().collect()}
        assert all(counts[r.user_id, r.new_item] == r.listens for r in changes)
        labels = now
    # a batch that runs again replaces its own part
    state.merge(spark.createDataFrame(batches[2], LOG), dim, "b2")
    assert _counts(state.counts()) == _counts(identity.canonical_listens(spark.createDataFrame(rows, LOG), dim))
    small = state.compact(f"{scratch}/compact")
    assert _counts(small.counts()) == _counts(state.counts()) and small.batches() == ["compacted"]
    small.merge(spark.createDataFrame(rows[:50], LOG), dim, "again")  # repeats add nothing to items with an mbid
    twice = spark.createDataFrame(rows + rows[:50], LOG)
    assert _counts(small.counts()) == _counts(identity.canonical_listens(twice, dim))


def test_batch_names_and_empty_batches(spark, scratch):
    state = delta.IdentityState(spark, f"{scratch}/state")
    with pytest.raises(ValueError):
        state.counts()
    with pytest.raises(ValueError):
        state.merge(spark.createDataFrame([], LOG), spark.createDataFrame([], TRACKS), "a/b")
    dim = spark.createDataFrame(_log()[1], TRACKS)
    assert state.merge(spark.createDataFrame([], LOG), dim, "none").count() == 0
    assert state.counts().count() == 0
    rows = _log()[0]
    state.merge(spark.createDataFrame(rows, LOG), dim, "all")
    assert _counts(state.counts()) == _counts(identity.canonical_listens(spark.createDataFrame(rows, LOG), dim))


def test_heavy_hitters_are_proven_or_counted(spark):
    rng = np.random.default_rng(2)
    skewed = np.minimum(rng.zipf(1.3, 60_000), 50_000).tolist()
    log = spark.createDataFrame([(int(i),) for i in skewed] + [(None,)] * 500, "recording_msid bigint").repartition(6)
    want = [tuple(r) for r in popularity.popularity_total(log.where("recording_msid is not null"), 10).collect()]
    for capacity, sure in ((100_000, True), (1000, True), (12, None)):
        got, proven = sketches.heavy_hitters(log, 10, capacity=capacity)
        assert [tuple(r) for r in got.collect()] == want
        assert sure is None or proven == sure
    flat = spark.range(20_000).select((F.col("id") % 10_000).alias("recording_msid"))  # every item twice
    got, proven = sketches.heavy_hitters(flat, 10, capacity=100)
    assert not proven and [r.recording_msid for r in got.collect()] == list(range(10))
    few, proven = sketches.heavy_hitters(log.where("recording_msid < 4"), 10)
    assert proven and few.count() == 3
    assert sketches.heavy_hitters(log.limit(0), 10)[0].count() == 0


def test_summaries_are_bounded(spark):
    flat = spark.range(0, 50_000, 1, 4).select(F.col("id").alias("recording_msid"))
    parts = sketches.task_summaries(flat, "recording_msid", 50)
    assert parts.count() <= 4 * 51 and parts.where("recording_msid is null").count() == 4


def test_sketches_of_many_users(spark):
    """Beyond the exact size: within four standard errors; any set of days."""
    rows = spark.range(120_000).select(F.col("id").alias("user_id"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("split"),
                                       (F.col("id") % 7).alias("day"))
    rows = rows.where("split = 'a' and user_id < 80000 or split = 'b' and user_id >= 40000")
    stored = sketches.user_sketches(rows, "day").cache()
    got = sketches.sketch_overlap(stored, ("a", "b", "c")).first()
    assert (got.a_rows, got.b_rows, got.c_rows, got.c_users, got.common_a_c) == (80_000, 80_000, 0, 0, 0)
    assert abs(got.a_users / 80_000 - 1) < 4 / 64 and abs(got.common_a_b / 40_000 - 1) < 4 * 2 / 64
    days = sketches.sketch_overlap(stored.where("day < 2"), ("a", "b")).first()
    assert abs(days.a_users / (80_000 * 2 / 7) - 1) < 4 / 64
    few = sketches.sketch_overlap(sketches.user_sketches(rows.where("user_id % 100 = 0"), "day"), ("a", "b")).first()
    assert (few.a_users, few.b_users, few.common_a_b) == (800, 800, 400)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 777])
def test_exact_split_takes_exactly_that_many(spark, n):
    users = spark.range(n).select((F.col("id") * 7).alias("user_id"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("x"))
    labelled = splits.split_exact(users, 0.7)
    per = {r.split: r.n for r in labelled.groupBy("split").agg(F.countDistinct("user_id").alias("n")).collect()}
    assert per.get("train", 0) == int(0.7 * n + 1e-9) and sum(per.values()) == n
    assert labelled.groupBy("user_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


def test_exact_split_of_pairs_null_keys_and_equal_hashes(spark, monkeypatch):
    pairs = spark.range(300).select(F.when(F.col("id") % 50 > 0, F.col("id") % 30).alias("user_id"),
                                    F.when(F.col("id") % 7 > 0, F.col("id")).alias("recording_msid"))
    n = pairs.distinct().count()
    got = splits.split_exact(pairs, 0.5, ("user_id", "recording_msid"))
    assert got.where("split = 'train'").select("user_id", "recording_msid").distinct().count() == n // 2
    monkeypatch.setattr(splits, "unit_hash", lambda *keys, salt="": F.lit(0.25))  # ties go by key
    got = splits.split_exact(pairs, 0.5, ("user_id",))
    train = sorted({r.user_id for r in got.where("split = 'train'").collect()}, key=lambda v: (v is not None, v))
    every = sorted({r.user_id for r in pairs.collect()}, key=lambda v: (v is not None, v))
    assert train == every[: len(every) // 2] and None in train


def _plan(df):
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_laid_out_tables_need_no_exchange(spark, scratch):
    counts = ratings.count_listens(td.listens_f2(spark, SF01))
    path = f"{scratch}/laid out"
    tables.write_laid_out(counts, path, ["user_id"], 8, ["recording_msid"])
    held = tables.read_laid_out(spark, path)
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, counts.collect()))
    top = ranking.user_top_k(held, 5)
    assert "Exchange" not in _plan(top)
    assert "Exchange" not in _plan(held.groupBy("user_id").agg(F.sum("listens")))
    other = f"{scratch}/other"
    tables.write_laid_out(counts.where("listens > 1"), other, ["user_id"], 8)
    joined = held.hint("merge").join(tables.read_laid_out(spark, other), "user_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # another session only has the files
    spark.sql(f"DROP TABLE {tables._table_name(path)}")
    again = tables.read_laid_out(spark, path)
    assert "Exchange" not in _plan(ranking.user_top_k(again, 5)) and again.count() == counts.count()
    tables.write_laid_out(counts.where("listens > 1"), path, ["user_id"], 4)
    assert tables.read_laid_out(spark, path).count() == counts.where("listens > 1").count()


def test_one_global_order(spark, scratch):
    counts = ratings.count_listens(td.listens_f1(spark, SF01))
    path = f"{scratch}/sorted"
    tables.write_sorted(counts, path, F.col("listens").desc(), "recording_msid", "user_id", partitions=6)
    import glob

    import pyarrow.parquet as pq
    files = sorted(glob.glob(f"{path}/part-*.parquet"))
    assert len(files) > 1
    rows = [tuple(r.values()) for f in files for r in pq.read_table(f).select(
        ["listens", "recording_msid", "user_id"]).to_pylist()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1], r[2])) and len(rows) == counts.count()


def test_median_by_sketch(spark, monkeypatch):
    rng = random.Random(3)
    cases = [[], [None], [5.0], [1.0, 2.0], [3.0, None, 1.0, 2.0], [1.0] * 1000 + [2.0] * 1000,
             [rng.lognormvariate(0, 3) for _ in range(5001)], [float(i) for i in range(20_000)], [-1e300, 0.0, 1e300]]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
        held = sorted(v for v in values if v is not None)
        want = float(np.median(held)) if held else None
        assert ordered.exact_median(df, "x").first()[0] == want
    monkeypatch.setattr(ordered, "MOST_VALUES", 3)  # a bracket of too many values: the histogram
    df = spark.createDataFrame([(float(i),) for i in range(20_000)], "x double")
    assert ordered.median_of(df, "x") == 9999.5
    monkeypatch.setattr(ordered, "SKETCH_ERROR", -0.2)  # a bracket that misses the middle
    assert ordered.median_of(df, "x") == 9999.5
    whole = spark.createDataFrame([(2**53 + i,) for i in range(3)], "x bigint")
    assert ordered.median_of(whole, "x") == float(2**53 + 1)


def test_what_the_fits_train_on_is_counted_once_a_search(spark, indexed, scratch, monkeypatch):
    """Every fit used to put its ratings in order and count them first."""
    given, counted = [], []
    monkeypatch.setattr(tuning, "train_sizes", lambda *a, f=tuning.train_sizes: counted.append(f(*a)) or counted[-1])
    fit = tuning.fit_als

    def seen(idx, sizes=None, **params):
        given.append((sizes, tuple(idx.ratings.agg(*fz.rating_sizes()).first())))
        return fit(idx, sizes=sizes, **params)

    monkeypatch.setattr(tuning, "fit_als", seen)
    tuning.tune(indexed, {"rank": [2, 3], "max_iter": [1]}, folds=2, ledger=f"{scratch}/ledger", refit=False)
    assert len(counted) == 1 and len(given) == 4
    assert all(sizes == own for sizes, own in given) and len({own for _, own in given}) == 2
