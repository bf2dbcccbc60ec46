"""Table reads, scratch tables and small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; further columns, whatever their names, never get in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(text: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """Rows of an Arrow batch from now on: texts may be long, so batches of them are short."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
