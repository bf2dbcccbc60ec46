"""Reads that dashboards make of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_days(daily: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most recent summary rows."""
    return (
        daily.orderBy(F.desc("txn_date"), "status", "channel", "currency")
        .limit(k)
        .select("txn_date", "status", "channel", "currency", "txn_count", "gross_amount")
    )


def top_merchants(performance: DataFrame, k: int = 10) -> DataFrame:
    return (
        performance.orderBy(F.desc_nulls_last("gross_revenue"), "merchant_id")
        .limit(k)
        .select("merchant_id", "trade_name", "total_txns", "gross_revenue")
    )


def top_clients(clients: DataFrame, by: str = "total_spent", k: int = 10) -> DataFrame:
    """Top clients by ``total_spent`` or ``risk_score``."""
    return (
        clients.orderBy(F.desc(by), "client_id")
        .limit(k)
        .select("client_id", "full_name", "risk_score", "total_spent")
    )


def fraud_outcomes(analysis: DataFrame) -> DataFrame:
    return analysis.groupBy("alert_outcome").agg(
        F.count(F.lit(1)).alias("n_alerts"),
        F.sum("amount").cast("decimal(18,2)").alias("total_amount"),
        F.max("risk_score").alias("max_risk_score"),
        F.max("initiated_at").alias("last_initiated_at"),
    )


def fraud_alerts_for(
    analysis: DataFrame, outcome: str | None = None, min_risk: int | None = None, since=None
) -> DataFrame:
    """Alerts by outcome, by least risk score and by start of the time range."""
    if outcome is not None:
        analysis = analysis.where(F.col("alert_outcome") == outcome)
    if min_risk is not None:
        analysis = analysis.where(F.col("risk_score") >= min_risk)
    if since is not None:
        analysis = analysis.where(F.col("initiated_at") >= F.lit(since))
    return analysis
