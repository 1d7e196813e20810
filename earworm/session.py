"""Session construction and the shared checkpoint folder.

On a cluster the session is supplied by the caller and ``spark.checkpoint.dir``
names a shared folder (HDFS / object store); every lineage cut in this library
goes there.  Only when nothing is configured (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this library wants.  AQE re-plans joins at runtime
# (sort-merge -> broadcast when a side turns out small, split skewed
# partitions), which is how unbounded sides are broadcast only after a size
# check.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of frames nothing refers to any more are removed by
    # Spark's context cleaner, so repeated jobs do not fill the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app: str = "earworm",
    extra: dict | None = None,
) -> SparkSession:
    """A session for local runs and tests (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "6g")
    )
    for key, value in {**SCALE_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    Where none is set, a local session (one machine, one JVM) gets a temporary
    one; on a cluster that folder would be another one on each machine, so a
    shared folder must be configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="earworm-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def table_state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(name, bytes, time of change) of the files of a table: another state,
    another tuple."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def is_local(master: str) -> bool:
    """Whether a master URL runs everything in one JVM."""
    return master == "local" or master.startswith("local[")


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the session's shared checkpoint folder.

    Used where a plan is read twice and must give the same rows both times
    (surrogate ids) or where an executor loss must not recompute a long
    lineage.  Never a local (executor-disk) checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    # The write job after the materializing count re-reads the shuffle output
    # of the last exchange, so only the final stage runs twice.
    return df.checkpoint(eager=eager)


def write_once(df):
    """``df`` as a Parquet table in the shared checkpoint folder, read back:
    computed exactly once, whatever reads it."""
    spark = df.sparkSession
    path = table_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SCOPES: list[list[str]] = []


def table_path(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A fresh path for a table below the checkpoint folder; the innermost
    ``table_scope`` (or, with ``outer``, the one around it) drops it."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    scopes = _SCOPES[:-1] if outer else _SCOPES
    if scopes:
        scopes[-1].append(path)
    return path


@contextmanager
def table_scope(spark: SparkSession):
    """Intermediate tables that are written inside are dropped at the end:

        with table_scope(spark):
            popularity(...).write.parquet(result)

    Frames that still read them are of no use afterwards, so the result is
    written (or collected) inside.  Without a scope tables stay, as a returned
    frame may be read at any time.  For one thread at a time.
    """
    mine: list[str] = []
    _SCOPES.append(mine)
    try:
        yield
    finally:
        _SCOPES.remove(mine)
        for path in mine:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
