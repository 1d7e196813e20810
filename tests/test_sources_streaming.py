"""Readers, writers and the streaming listen counter."""

from pyspark.sql import functions as F

from conftest import SF01
from earworm.operators import ratings
from earworm.sources import tables
from earworm.sources import testdata as td
from earworm.streaming import listens


def test_csv_with_declared_column_order(spark, scratch):
    df = spark.createDataFrame([(1, 7, 30), (2, 1, 40)], "user_id long, listens long, recording_msid long")
    tables.write_table(df, f"{scratch}/r.csv", fmt="csv", header=False)
    back = tables.read_ratings(spark, f"{scratch}/r.csv", fmt="csv",
                               columns=["user_id", "listens", "recording_msid"])
    assert back.columns == ["user_id", "recording_msid", "listens"]
    assert sorted(tuple(r) for r in back.collect()) == [(1, 30, 7), (2, 40, 1)]


def test_parquet_roundtrip_with_schema(spark, scratch):
    counts = ratings.count_listens(td.listens_f1(spark, SF01))
    tables.write_table(counts, f"{scratch}/counts", sort_by=["user_id"])
    back = tables.read_ratings(spark, f"{scratch}/counts")
    assert back.exceptAll(counts).count() == 0 and back.count() == counts.count()


def test_missing_column_fails(spark, scratch):
    df = spark.createDataFrame([(1, 2)], "user_id long, other long")
    tables.write_table(df, f"{scratch}/bad")
    try:
        tables.read_ratings(spark, f"{scratch}/bad")
    except ValueError as exc:
        assert "recording_msid" in str(exc)
    else:
        raise AssertionError("expected a missing-column error")


def test_text_ids_are_read_as_text(spark, scratch):
    log = td.listens_f1(spark, SF01).withColumn("recording_msid", F.concat(F.lit("m"), F.col("recording_msid")))
    tables.write_table(log, f"{scratch}/log")
    back = tables.read_interactions(spark, f"{scratch}/log")
    assert back.dtypes == [("user_id", "bigint"), ("recording_msid", "string"), ("timestamp", "timestamp_ntz")]
    assert back.exceptAll(log).count() == 0 and back.count() == log.count()
    tracks = td.tracks_f1(spark, SF01)
    tables.write_table(tracks, f"{scratch}/tracks")
    assert tables.read_tracks(spark, f"{scratch}/tracks").exceptAll(tracks).count() == 0


def test_sorted_sink_orders_rows_within_files(spark, scratch):
    counts = ratings.count_listens(td.listens_f1(spark, SF01))
    tables.write_table(counts.coalesce(1), f"{scratch}/sorted", sort_by=["recording_msid", "user_id"])
    got = [(r.recording_msid, r.user_id) for r in spark.read.parquet(f"{scratch}/sorted").coalesce(1).collect()]
    assert got == sorted(got)


def test_replayed_batch_is_written_once(spark, scratch):
    log = td.listens_f1(spark, SF01)
    src, out = f"{scratch}/in", f"{scratch}/out"
    log.write.parquet(src)
    for run in ("a", "b"):  # the second query starts anew and replays batch 0
        q = listens.start_listen_counts(listens.read_listen_stream(spark, src), path=out,
                                        checkpoint_location=f"{scratch}/ck-{run}", trigger_once=True)
        q.awaitTermination()
    assert spark.read.parquet(out).drop("batch_id").exceptAll(ratings.count_listens(log)).count() == 0


def test_streaming_counts_equal_batch_counts(spark, scratch):
    log = td.listens_f1(spark, SF01)
    src = f"{scratch}/in"
    # two files arriving one after the other
    log.where(F.col("user_id") % 2 == 0).write.mode("append").parquet(src)
    stream = listens.read_listen_stream(spark, src)
    q = listens.start_listen_counts(stream, sink="memory", name="lc_test", checkpoint_location=f"{scratch}/ck")
    q.processAllAvailable()
    log.where(F.col("user_id") % 2 == 1).write.mode("append").parquet(src)
    q.processAllAvailable()
    got = spark.sql("select * from lc_test")
    want = ratings.count_listens(log)
    q.stop()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_streaming_counts_to_parquet_sink(spark, scratch):
    """Update-mode batches appended with their batch id; the latest batch per
    (user, item) is the running count."""
    from pyspark.sql.window import Window

    log = td.listens_f1(spark, SF01)
    src, out = f"{scratch}/in", f"{scratch}/out"
    log.where(F.col("user_id") % 2 == 0).write.mode("append").parquet(src)
    q = listens.start_listen_counts(listens.read_listen_stream(spark, src), path=out,
                                    checkpoint_location=f"{scratch}/ck")
    q.processAllAvailable()
    log.where(F.col("user_id") % 2 == 1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    batches = spark.read.parquet(out)
    w = Window.partitionBy("user_id", "recording_msid").orderBy(F.col("batch_id").desc())
    latest = batches.withColumn("r", F.row_number().over(w)).where("r = 1").select(
        "user_id", "recording_msid", "listens")
    want = ratings.count_listens(log)
    assert latest.exceptAll(want).count() == 0 and want.exceptAll(latest).count() == 0
