"""The raw lake: one Parquet dataset per table, partitioned by ingest day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = ["year", "month", "day"]
CODECS = ["snappy", "gzip", "zstd", "none"]


def with_day(rows: DataFrame, ingested_at: str = "_ingested_at") -> DataFrame:
    """Add zero-padded partition columns of the ingest day."""
    ts = F.col(ingested_at)
    return rows.select(
        *[c for c in rows.columns if c != ingested_at],
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    )


def balanced(rows: DataFrame, *by: str) -> DataFrame:
    """Gather rows by partition value before a write, so days do not scatter over files.

    A rebalance splits a value that outgrows the advisory size over several tasks.
    """
    return rows.hint("rebalance", *by)


def write_day_partitions(
    rows: DataFrame, path: str, compression: str = "snappy", mode: str = "append"
) -> None:
    """Write rows that carry ``_ingested_at`` (and maybe ``table_name``) below ``path``."""
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    by = [*(["table_name"] if "table_name" in rows.columns else []), *DAY]
    (
        balanced(with_day(rows), *by)
        .write.partitionBy(*by)
        .mode(mode)
        .option("compression", compression)
        .parquet(path)
    )


def in_days(first: date, last: date) -> Column:
    """Filter on the partition columns, so other days are never listed or read."""
    day = F.col("year").cast("int") * 10_000 + F.col("month").cast("int") * 100
    day = day + F.col("day").cast("int")
    key = lambda d: d.year * 10_000 + d.month * 100 + d.day
    return day.between(key(first), key(last))


def read_lake(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    lake = spark.read.parquet(path)
    if first or last:
        lake = lake.where(in_days(first or date.min, last or date.max))
    return lake


def revenue_by(lake: DataFrame, column: str = "channel") -> DataFrame:
    return lake.groupBy(column).agg(
        F.count(F.lit(1)).alias("txns"),
        F.round(F.sum(F.col("amount").cast("decimal(14,2)")), 2)
        .cast("decimal(24,2)")
        .alias("revenue"),
    )


def lake_stats(lake: DataFrame) -> DataFrame:
    """Rows and files per table."""
    return (
        lake.groupBy("table_name", F.input_file_name().alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("table_name")
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))
    )
