"""Materialising marts and reloading them into the serving store."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.schemas import SERVING_TYPES
from txnlake.session import publish_folder, published

BATCH_ROWS = 5_000


# Columns that readers filter or sort by; rows cluster on them within each file.
CLUSTER_BY = {
    "mart_daily_transaction_summary": "txn_date",
    "mart_merchant_performance": "gross_revenue",
    "mart_client_360": "total_spent",
    "mart_fraud_analysis": "initiated_at",
}


def write_mart(df: DataFrame, root: str, name: str) -> None:
    """Full rebuild of a mart as Parquet."""
    publish_folder(df.sortWithinPartitions(CLUSTER_BY[name]), f"{root}/{name}")


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return published(spark, f"{root}/{name}")


@dataclass(frozen=True)
class ParquetTarget:
    root: str

    def replace(self, df: DataFrame, name: str) -> None:
        publish_folder(df, f"{self.root}/{name}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return published(spark, f"{self.root}/{name}")


@dataclass(frozen=True)
class JdbcTarget:
    """A database: truncates the table in place, then inserts from parallel connections."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16

    def replace(self, df: DataFrame, name: str) -> None:
        (
            df.write.format("jdbc")
            .options(**dict(self.properties))
            .option("url", self.url)
            .option("dbtable", name)
            .option("truncate", True)
            .option("batchsize", BATCH_ROWS)
            .option("numPartitions", self.connections)
            .mode("overwrite")
            .save()
        )

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return (
            spark.read.format("jdbc")
            .options(**dict(self.properties))
            .option("url", self.url)
            .option("dbtable", name)
            .load()
        )


def clean_types(df: DataFrame, types: Mapping[str, str | None]) -> DataFrame:
    """NaN to NULL and text to its declared type; text that is none becomes NULL."""

    def clean(column: T.StructField) -> Column:
        value, kind = F.col(column.name), types.get(column.name)
        if isinstance(column.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        if isinstance(column.dataType, T.StringType) and kind is None and column.name in types:
            value = value.try_cast("timestamp_ntz")
        elif kind is not None:
            value = value.try_cast(kind)
        return value.alias(column.name)

    return df.select(*[clean(c) for c in df.schema])


def reload_mart(
    spark: SparkSession, root: str, name: str, target: ParquetTarget | JdbcTarget
) -> bool:
    """Truncate and reload one materialised mart; an empty one leaves the target as it is."""
    mart = read_mart(spark, root, name)
    if mart.isEmpty():
        return False
    cleaned = clean_types(mart, SERVING_TYPES[name])
    target.replace(cleaned.withColumn("loaded_at", F.current_timestamp()), name)
    return True


def reconcile(
    spark: SparkSession, root: str, target: ParquetTarget | JdbcTarget, names: list[str]
) -> DataFrame:
    """Row counts of each mart at source and target, whether they agree, and the total."""

    def counted(df: DataFrame, name: str, side: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("mart"), F.lit(side).alias("side"), "n"
        )

    counts = reduce(
        DataFrame.unionByName,
        [
            part
            for name in names
            for part in (
                counted(read_mart(spark, root, name), name, "source"),
                counted(target.read(spark, name), name, "target"),
            )
        ],
    )
    per_mart = counts.groupBy("mart").agg(
        F.sum(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
        F.sum(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"),
    )
    total = per_mart.agg(F.sum("source_rows"), F.sum("target_rows")).select(
        F.lit("TOTAL").alias("mart"),
        F.col("sum(source_rows)").alias("source_rows"),
        F.col("sum(target_rows)").alias("target_rows"),
    )
    return per_mart.unionByName(total).withColumn(
        "is_match", (F.col("source_rows") == F.col("target_rows")).cast("int")
    )


def insert_ignore(
    existing: DataFrame, new: DataFrame, key: list[str], first_by: str
) -> DataFrame:
    """The rows of ``new`` to append: keys not yet present, the first row of each."""
    rest = [c for c in new.columns if c not in key]
    first = (
        new.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), first_by).alias("_first"))
        .select(*key, "_first.*")
    )
    return first.join(existing.select(*key), key, "left_anti").select(*new.columns)
