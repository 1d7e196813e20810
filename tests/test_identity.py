"""Identity resolution and surrogate ids."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import SF01
from earworm.operators import identity, ratings
from earworm.sources import testdata as td


def test_canonical_map_matches_window_rule(spark):
    """min_by over per-msid first listens == first_value over raw rows."""
    log, tracks = td.listens_f2(spark, SF01), td.tracks_f2(spark, SF01)
    ours = identity.canonical_map(log, tracks).where(F.col("recording_mbid").isNotNull())
    j = identity.attach_tracks(log, tracks).where(F.col("recording_mbid").isNotNull())
    w = Window.partitionBy("recording_mbid").orderBy("timestamp", "recording_msid")
    ref = j.select("recording_msid", F.first("recording_msid").over(w).alias("canonical_msid")).distinct()
    assert ours.select("recording_msid", "canonical_msid").exceptAll(ref).count() == 0
    assert ref.exceptAll(ours.select("recording_msid", "canonical_msid")).count() == 0


def test_canonicalize_is_idempotent(spark):
    log, tracks = td.listens_f1(spark, SF01), td.tracks_f1(spark, SF01)
    once = identity.canonicalize(log, tracks)
    twice = identity.canonicalize(once, tracks)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_canonical_counts_fixture_sizes(spark):
    """Measured fixture sizes at sf0.01 (FIXTURES): F1 5,125 pairs / 55 items,
    F2 48,386 pairs / 458 items."""
    for log, tracks, pairs, items in (
        (td.listens_f1(spark, SF01), td.tracks_f1(spark, SF01), 5125, 55),
        (td.listens_f2(spark, SF01), td.tracks_f2(spark, SF01), 48386, 458),
    ):
        counts = ratings.count_listens(identity.canonicalize(log, tracks))
        assert counts.count() == pairs
        assert counts.select("recording_msid").distinct().count() == items


def test_left_attach_keeps_unknown_tracks(spark):
    log = spark.createDataFrame([(1, 10, None), (2, 99, None)],
                                "user_id long, recording_msid long, timestamp timestamp_ntz")
    tracks = spark.createDataFrame([(10, "a", None, None)], "recording_msid long, recording_mbid string, "
                                                             "artist_name string, track_name string")
    assert identity.attach_tracks(log, tracks, "inner").count() == 1
    left = identity.attach_tracks(log, tracks, "left")
    assert left.count() == 2 and left.where("recording_mbid is null").count() == 1


def test_dense_ids_equal_dense_rank_under_any_partitioning(spark):
    vals = td.listens_f2(spark, SF01).select("recording_msid")
    ref = vals.distinct().select(
        "recording_msid", (F.dense_rank().over(Window.orderBy("recording_msid")) - 1).alias("id"))
    for n in (1, 3, 8, 13):
        got = identity.dense_ids(vals.repartition(n), "recording_msid", num_partitions=n)
        assert got.exceptAll(ref).count() == 0
        assert got.count() == ref.count()


def test_dense_ids_on_strings(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "k string")
    got = {r.k: r.id for r in identity.dense_ids(df, "k", num_partitions=2).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_encode_items_replaces_key(spark):
    counts = spark.createDataFrame([(1, 30, 2), (2, 10, 1)], "user_id long, recording_msid long, listens long")
    codes = identity.dense_ids(counts, "recording_msid", "codes")
    out = identity.encode_items(counts, codes, code_col="codes", replace=True)
    assert sorted((r.user_id, r.recording_msid) for r in out.collect()) == [(1, 1), (2, 0)]


def test_rows_repeated_more_often_than_an_array_holds(spark, monkeypatch):
    monkeypatch.setattr(identity, "REPEATS", 7)
    rows = spark.createDataFrame([(1, 1), (2, 6), (3, 7), (4, 8), (5, 50)], "id int, n bigint")
    got = {r.id: r["count"] for r in identity._repeated(rows, rows.n).groupBy("id").count().collect()}
    assert got == {1: 1, 2: 6, 3: 7, 4: 8, 5: 50}
