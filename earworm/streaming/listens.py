"""Listen counts (A1) maintained incrementally with Structured Streaming.

The same aggregation as ``operators.ratings.count_listens``, on a stream of
listen files.  State is one running count per (user, item), kept in the
streaming state store; the query checkpoint lives under the session's shared
checkpoint folder, so a restarted or relocated driver resumes where it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earworm.schemas import INTERACTIONS
from earworm.session import checkpoint_dir


def read_listen_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of listens arriving in ``path`` (declared schema)."""
    reader = spark.readStream.schema(INTERACTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def stream_listen_counts(stream: DataFrame, user: str = "user_id", item: str = "recording_msid",
                         ts: str = "timestamp") -> DataFrame:
    """Running listens per (user, item); emitted in ``update`` mode."""
    return stream.groupBy(user, item).agg(F.count(ts).alias("listens"))


def start_listen_counts(stream: DataFrame, path: str | None = None, sink: str = "parquet",
                        name: str = "listen_counts", checkpoint_location: str | None = None,
                        trigger_once: bool = False) -> StreamingQuery:
    """Start the counting query.

    Each micro-batch's updated counts become the partition ``batch_id=<n>`` of
    ``path``; a batch that is replayed after a failure replaces its partition,
    so nothing is written twice, and a reader takes the latest batch per (user,
    item).  ``sink='memory'`` keeps all counts on the driver: for tests only.
    The state is as large as the rating matrix; name the RocksDB state store in
    the session's configuration for large logs (it is not changed here).
    """
    spark = stream.sparkSession
    location = checkpoint_location or f"{checkpoint_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    writer = stream_listen_counts(stream).writeStream.option("checkpointLocation", location)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    if sink == "memory":
        return writer.outputMode("complete").format("memory").queryName(name).start()
    if not path:
        raise ValueError("a path is needed")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return writer.outputMode("update").foreachBatch(write_batch).start()
