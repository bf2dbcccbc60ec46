"""Change-feed sources for streams.

The Kafka reader needs the Kafka connector on the class path; file streams of the same
columns need nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.cdc import table_topic, topic_pattern

FEED_DDL = "topic string, offset bigint, timestamp timestamp, value string"


def kafka_options(
    brokers: str,
    table: str | None = None,
    flush_rows: int | None = None,
    flush_seconds: int | None = None,
    max_rows: int | None = None,
) -> dict[str, str]:
    """Options of a subscription from the earliest offset.

    Without ``table`` it takes all topics of the database, also those that appear later; a
    query that handles one table should read only its topic. A micro-batch runs once ``flush_rows`` are waiting or ``flush_seconds`` have passed.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "startingOffsets": "earliest",
        **({"subscribe": table_topic(table)} if table else {"subscribePattern": topic_pattern()}),
    }
    if flush_rows is not None:
        options["minOffsetsPerTrigger"] = str(flush_rows)
    if flush_seconds is not None:
        options["maxTriggerDelay"] = f"{flush_seconds}s"
    if max_rows is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    return options


def kafka_feed(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select("topic", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    )


def file_feed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder that change messages are dropped into as Parquet files."""
    reader = spark.readStream.schema(FEED_DDL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
