"""Staging projections: typed, trimmed views over the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import money
from txnlake.sources.tables import Tables


def stg_transactions(transactions: DataFrame) -> DataFrame:
    flag = lambda name: F.col(name).cast("int").alias(name)
    return transactions.select(
        "txn_id",
        "reference",
        "client_id",
        "card_id",
        "pos_id",
        "merchant_id",
        "type_id",
        "status_id",
        money(F.col("amount")).alias("amount"),
        "currency",
        money(F.col("fee"), 10).alias("fee"),
        money(F.col("net_amount")).alias("net_amount"),
        "auth_code",
        "channel",
        "ip_address",
        "device_id",
        flag("is_recurring"),
        flag("is_international"),
        flag("is_flagged"),
        "failure_reason",
        "initiated_at",
        "processed_at",
        "settled_at",
        "created_at",
    )


def stg_clients(clients: DataFrame) -> DataFrame:
    """``full_name`` is NULL when either name is; national id and address stay behind."""
    return clients.select(
        "client_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "phone",
        "date_of_birth",
        "country_id",
        "city",
        "risk_score",
        F.col("is_active").cast("int").alias("is_active"),
        "registered_at",
    )


def stg_merchants(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id",
        "legal_name",
        "trade_name",
        "mcc",
        "country_id",
        "city",
        F.col("is_active").cast("int").alias("is_active"),
        "onboarded_at",
    )


def stg_fraud_alerts(fraud_alerts: DataFrame) -> DataFrame:
    return fraud_alerts.select(
        "alert_id",
        "txn_id",
        "rule_triggered",
        "risk_score",
        "is_confirmed",
        "reviewed_by",
        "reviewed_at",
        "created_at",
    )


def staging(tables: Tables) -> dict[str, DataFrame]:
    return {
        "stg_transactions": stg_transactions(tables["transactions"]),
        "stg_clients": stg_clients(tables["clients"]),
        "stg_merchants": stg_merchants(tables["merchants"]),
        "stg_fraud_alerts": stg_fraud_alerts(tables["fraud_alerts"]),
    }


def create_views(tables: Tables) -> None:
    """Register the staging views in the session catalogue."""
    for name, df in staging(tables).items():
        df.createOrReplaceTempView(name)
