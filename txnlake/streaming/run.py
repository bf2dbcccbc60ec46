"""Starting streaming queries with settings fit for stateful work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txnlake.session import path_bytes, session_conf

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Bytes of Parquet whose rows share a state partition: 100 000 to 250 000 events, which ten windows copy.
PARTITION_BYTES = 2 << 20


def state_partitions(spark: SparkSession, path: str) -> int:
    """State partitions for a query that takes all files below a path at once: one per core at
    least, and more with the input, so that the memory of one task does not grow with it."""
    return max(spark.sparkContext.defaultParallelism, -(-path_bytes(spark, path) // PARTITION_BYTES))


def state_conf(spark: SparkSession, partitions: int | None = None) -> dict[str, str]:
    """State lives in RocksDB, backed up to the checkpoint folder.

    The number of state partitions is fixed by a query's first start; the default is one
    per core of the cluster. Sessions merge before the shuffle, so a hot key shrinks first.
    Write buffers are small, since every partition of an executor keeps its own.
    """
    n = partitions or spark.sparkContext.defaultParallelism
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
        # Counting state rows would cost a read per write.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def start(
    writer: DataStreamWriter,
    spark: SparkSession,
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a query; without ``every`` it takes what is there now and ends."""
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with session_conf(spark, state_conf(spark, partitions)):
        return writer.start()


def append_to(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    partitions: int | None = None,
    **options,
) -> StreamingQuery:
    """Append a stream to Parquet exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .options(**options)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, stream.sparkSession, every, partitions)


def for_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return start(writer, stream.sparkSession, every)
