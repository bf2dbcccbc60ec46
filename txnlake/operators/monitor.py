"""Health checks over recent time slices; each returns check, value, threshold and status.

``as_of`` is a parameter so that a run can be repeated; it defaults to the newest row.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import rate_pct
from txnlake.functions.temporal import epoch_seconds, since
from txnlake.schemas import WATERMARK_COLUMN, polled_tables
from txnlake.sources.tables import Tables, row_counts, values_table

# Thresholds.
MIN_ROWS = {"transactions": 100_000, "clients": 1_000, "fraud_alerts": 1_000}
INGEST_SLICE_SECONDS, MIN_INGESTED = 15 * 60, 5
FRAUD_SLICE_SECONDS, MAX_FRAUD_PCT = 60 * 60, 30
HIGH_RISK_SCORE, MAX_UNREVIEWED = 90, 50
MAX_AGE_SECONDS = 24 * 60 * 60


def newest(df: DataFrame, column: str) -> Column:
    return df.agg(F.max(column)).scalar()


def _as_of(df: DataFrame, column: str, as_of: datetime | None) -> Column:
    return newest(df, column) if as_of is None else F.lit(as_of)


def _status(bad: Column, word: str) -> Column:
    return F.when(bad, word).otherwise("OK").alias("status")


def min_row_counts(tables: Tables, minimums: Mapping[str, int] = MIN_ROWS) -> DataFrame:
    """``table_name, n_rows, min_rows, status``; too few rows is an error."""
    counts = row_counts({name: tables[name] for name in minimums})
    limits = values_table(
        counts.sparkSession, list(minimums.items()), "table_name string, min_rows bigint"
    )
    return counts.join(limits, "table_name").select(
        "table_name",
        "n_rows",
        "min_rows",
        _status(F.col("n_rows") < F.col("min_rows"), "ERROR"),
    )


def ingestion_rate(
    transactions: DataFrame,
    as_of: datetime | None = None,
    seconds: int = INGEST_SLICE_SECONDS,
    minimum: int = MIN_INGESTED,
) -> DataFrame:
    """Rows created in the last slice; one row even when there are none."""
    recent = transactions.where(
        since(F.col("created_at"), _as_of(transactions, "created_at", as_of), seconds)
    )
    return recent.agg(F.count(F.lit(1)).alias("n_recent")).select(
        "n_recent",
        F.lit(minimum).cast("bigint").alias("min_recent"),
        _status(F.col("n_recent") < minimum, "WARN"),
    )


def fraud_spike(
    transactions: DataFrame,
    as_of: datetime | None = None,
    seconds: int = FRAUD_SLICE_SECONDS,
    max_pct: int = MAX_FRAUD_PCT,
) -> DataFrame:
    """Share of flagged transactions in the last slice; NULL share when it is empty."""
    recent = transactions.where(
        since(F.col("initiated_at"), _as_of(transactions, "initiated_at", as_of), seconds)
    )
    return recent.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("is_flagged").cast("bigint")).alias("flagged"),
    ).select(
        "total",
        "flagged",
        rate_pct(F.col("flagged"), F.col("total")).alias("fraud_pct"),
        _status(rate_pct(F.col("flagged"), F.col("total")) > max_pct, "WARN"),
    )


def unreviewed_high_risk(
    alerts: DataFrame, score: int = HIGH_RISK_SCORE, maximum: int = MAX_UNREVIEWED
) -> DataFrame:
    waiting = alerts.where(F.col("is_confirmed").isNull() & (F.col("risk_score") >= score))
    return waiting.agg(F.count(F.lit(1)).alias("n_unreviewed")).select(
        "n_unreviewed",
        F.lit(maximum).cast("bigint").alias("max_unreviewed"),
        _status(F.col("n_unreviewed") > maximum, "WARN"),
    )


def freshness(
    tables: Tables, as_of: datetime | None = None, max_age_seconds: int = MAX_AGE_SECONDS
) -> DataFrame:
    """Age of the newest row per table; the default ``as_of`` is the newest of them all."""
    newest_rows = reduce(
        DataFrame.unionByName,
        [
            tables[name]
            .agg(F.max(WATERMARK_COLUMN).alias("newest"))
            .select(F.lit(name).alias("table_name"), "newest")
            for name in polled_tables()
            if name in tables
        ],
    )
    now = _as_of(newest_rows, "newest", as_of)
    age = epoch_seconds(now) - epoch_seconds(F.col("newest"))
    return newest_rows.select("table_name", "newest", age.alias("age_seconds")).withColumn(
        "status",
        F.when(F.coalesce(F.col("age_seconds") > max_age_seconds, F.lit(True)), "WARN").otherwise(
            "OK"
        ),
    )


def backlog(published: DataFrame, archived: DataFrame) -> DataFrame:
    """Messages published but not yet archived, per table."""
    count = lambda df, name: df.groupBy("table_name").agg(
        F.count(F.lit(1)).alias(name)
    )
    return (
        count(published, "n_published")
        .join(count(archived, "n_archived"), "table_name", "left")
        .fillna(0, subset=["n_archived"])
        .withColumn("n_backlog", F.col("n_published") - F.col("n_archived"))
    )


def summary(
    tables: Tables,
    as_of: datetime | None = None,
    minimums: Mapping[str, int] = MIN_ROWS,
) -> DataFrame:
    """All checks as ``check_name, value, threshold, status``."""
    kind = "decimal(18,2)"

    def line(df: DataFrame, name: Column, value: str, threshold: Column) -> DataFrame:
        return df.select(
            name.alias("check_name"),
            F.col(value).cast(kind).alias("value"),
            threshold.cast(kind).alias("threshold"),
            "status",
        )

    txns = tables["transactions"]
    parts = [
        line(
            min_row_counts(tables, minimums),
            F.concat(F.lit("row_count "), "table_name"),
            "n_rows",
            F.col("min_rows"),
        ),
        line(
            ingestion_rate(txns, as_of),
            F.lit("ingestion_rate"),
            "n_recent",
            F.col("min_recent"),
        ),
        line(
            fraud_spike(txns, as_of), F.lit("fraud_spike"), "fraud_pct", F.lit(MAX_FRAUD_PCT)
        ),
        line(
            unreviewed_high_risk(tables["fraud_alerts"]),
            F.lit("unreviewed_high_risk"),
            "n_unreviewed",
            F.col("max_unreviewed"),
        ),
        line(
            freshness(tables, as_of),
            F.concat(F.lit("freshness "), "table_name"),
            "age_seconds",
            F.lit(MAX_AGE_SECONDS),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
