"""Checkpoint folder contract and partitioned split sinks."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from earworm.operators import splits
from earworm.plans.queries import canonical_counts_f1
from earworm.session import checkpoint_dir, cut_lineage, is_local, write_once
from earworm.sources import tables


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured  # set by the session (cluster config), or once for tests
    assert checkpoint_dir(spark) == configured  # never replaced once set


def test_cut_lineage_is_a_reliable_checkpoint(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Range" not in plan
    assert cut.count() == 100


def test_splits_written_once_and_read_with_partition_pruning(spark, scratch):
    labelled = splits.split_users(canonical_counts_f1(spark, SF01), 0.7, holdin=0.6)
    tables.write_table(labelled, f"{scratch}/splits", partition_by=["split"])
    back = spark.read.parquet(f"{scratch}/splits")
    train = back.where(F.col("split") == "train")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert train.count() == labelled.where("split = 'train'").count()
    assert back.count() == labelled.count()


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    assert [is_local(m) for m in ("local", "local[8]", "yarn", "spark://h:1", "local-cluster[2,1,512]")] == [
        True, True, False, False, False]


def test_write_once_computes_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table = write_once(spark.range(100).mapInArrow(touch, "id bigint"))
    assert table.count() == 100 and table.agg(F.sum("id")).first()[0] == 4950
    assert seen.value == 100


def test_a_scope_drops_its_tables(spark, scratch):
    from earworm.session import path_exists, table_path, table_scope

    kept = write_once(spark.range(5))
    with table_scope(spark):
        table = write_once(spark.range(10))
        inside = table.inputFiles()[0]
        with table_scope(spark):
            inner = write_once(table.where("id > 3"))
            path = table_path(spark, "result", outer=True)
            inner.write.parquet(path)
            gone = inner.inputFiles()[0]
        assert not path_exists(spark, gone) and path_exists(spark, path)
        spark.read.parquet(path).write.parquet(f"{scratch}/out")
    assert not path_exists(spark, inside) and not path_exists(spark, path)
    assert kept.count() == 5 and spark.read.parquet(f"{scratch}/out").count() == 6
    with pytest.raises(ZeroDivisionError):
        with table_scope(spark):
            gone = write_once(spark.range(3)).inputFiles()[0]
            1 / 0
    assert not path_exists(spark, gone)
