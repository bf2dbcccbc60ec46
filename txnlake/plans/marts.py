"""The four marts, each one job from source tables to its served columns.

Stored marts carry no global order; readers sort what they show (see ``serve``).
Lookups are joined without hints: the planner broadcasts a side whose measured size is
under its threshold and falls back to a shuffled join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import mean_money, rate_pct
from txnlake.functions.risk import alert_outcome
from txnlake.operators.joins import left_join_nullable
from txnlake.plans import staging
from txnlake.schemas import SERVING_TYPES
from txnlake.sources.tables import Tables


def to_serving_types(df: DataFrame, mart: str) -> DataFrame:
    """Select a mart's columns in order, cast to the types it is served with."""
    return df.select(
        *[
            F.col(name) if kind is None else F.col(name).cast(kind).alias(name)
            for name, kind in SERVING_TYPES[mart].items()
        ]
    )


def daily_transaction_summary(tables: Tables) -> DataFrame:
    """Volume, revenue and fraud per day, status, channel and currency.

    An unknown status id stays in, under a NULL status.
    """
    txns = staging.stg_transactions(tables["transactions"])
    statuses = tables["transaction_statuses"].select("status_id", F.col("code").alias("status"))
    flagged, n = F.sum("is_flagged"), F.count(F.lit(1))
    daily = (
        txns.join(statuses, "status_id", "left")
        .groupBy(F.to_date("initiated_at").alias("txn_date"), "status", "channel", "currency")
        .agg(
            n.alias("txn_count"),
            F.sum("amount").alias("gross_amount"),
            F.sum("fee").alias("total_fees"),
            F.sum("net_amount").alias("net_amount"),
            flagged.alias("fraud_count"),
            rate_pct(flagged, n).alias("fraud_rate_pct"),
            mean_money(F.col("amount")).alias("avg_txn_amount"),
            F.max("amount").alias("max_txn_amount"),
        )
    )
    return to_serving_types(daily, "mart_daily_transaction_summary")


def merchant_performance(tables: Tables) -> DataFrame:
    """Approved revenue per merchant; merchants without any keep a zero count and NULLs.

    Transactions are reduced to one row per merchant before any dimension is joined.
    """
    approved = (
        staging.stg_transactions(tables["transactions"])
        .where(F.col("merchant_id").isNotNull())
        .join(
            tables["transaction_statuses"].where("code = 'APPROVED'").select("status_id"),
            "status_id",
        )
    )
    flagged, n = F.sum("is_flagged"), F.count(F.lit(1))
    by_merchant = approved.groupBy("merchant_id").agg(
        n.alias("approved_txns"),
        F.sum("amount").alias("gross_revenue"),
        F.sum("fee").alias("total_fees"),
        F.sum("net_amount").alias("net_revenue"),
        mean_money(F.col("amount")).alias("avg_txn_value"),
        flagged.alias("fraud_txns"),
        rate_pct(flagged, n).alias("fraud_rate_pct"),
        F.min("initiated_at").alias("first_txn_at"),
        F.max("initiated_at").alias("last_txn_at"),
    )
    return with_merchants(by_merchant, tables)


def with_merchants(by_merchant: DataFrame, tables: Tables) -> DataFrame:
    """The merchant mart from its totals per merchant."""
    categories = tables["merchant_categories"].select("mcc", F.col("description").alias("category"))
    countries = tables["countries"].select("country_id", F.col("name").alias("country"))
    mart = (
        staging.stg_merchants(tables["merchants"])
        .join(by_merchant, "merchant_id", "left")
        .join(categories, "mcc", "left")
        .join(countries, "country_id", "left")
        .withColumn("total_txns", F.coalesce("approved_txns", F.lit(0)))
    )
    return to_serving_types(mart, "mart_merchant_performance")


def client_360(tables: Tables) -> DataFrame:
    """Spend, risk, fraud and card counts per client; every client kept."""
    has_code = lambda code: F.count_if(F.col("code") == code)
    txn_stats = (
        staging.stg_transactions(tables["transactions"])
        .join(tables["transaction_statuses"].select("status_id", "code"), "status_id")
        .groupBy("client_id")
        .agg(
            F.count(F.lit(1)).alias("total_txns"),
            has_code("APPROVED").alias("approved_txns"),
            has_code("DECLINED").alias("declined_txns"),
            F.count_if(F.col("is_flagged") == 1).alias("fraud_txns"),
            F.sum("amount").alias("total_spent"),
            mean_money(F.col("amount")).alias("avg_txn_amount"),
            F.max("amount").alias("max_txn_amount"),
            F.max("initiated_at").alias("last_txn_at"),
        )
    )
    card_stats = (
        tables["payment_cards"].groupBy("client_id").agg(F.count(F.lit(1)).alias("card_count"))
    )
    return with_clients(txn_stats, card_stats, tables)


def with_clients(txn_stats: DataFrame, card_stats: DataFrame, tables: Tables) -> DataFrame:
    """The client mart from totals and card counts per client."""
    zero_filled = [
        "card_count",
        "total_txns",
        "approved_txns",
        "declined_txns",
        "fraud_txns",
        "total_spent",
        "avg_txn_amount",
        "max_txn_amount",
    ]
    mart = (
        staging.stg_clients(tables["clients"])
        .join(txn_stats, "client_id", "left")
        .join(card_stats, "client_id", "left")
        .fillna(0, subset=zero_filled)
    )
    return to_serving_types(mart, "mart_client_360")


def fraud_analysis(tables: Tables) -> DataFrame:
    """One row per alert with its transaction, client and merchant."""
    alerts = staging.stg_fraud_alerts(tables["fraud_alerts"]).drop("created_at")
    txns = staging.stg_transactions(tables["transactions"]).select(
        "txn_id",
        "reference",
        "client_id",
        "merchant_id",
        "amount",
        "currency",
        "channel",
        "is_international",
        "initiated_at",
    )
    clients = staging.stg_clients(tables["clients"]).select(
        "client_id",
        F.col("full_name").alias("client_name"),
        F.col("email").alias("client_email"),
        F.col("risk_score").alias("client_risk_score"),
    )
    merchants = staging.stg_merchants(tables["merchants"]).select(
        "merchant_id", F.col("trade_name").alias("merchant_name")
    )
    mart = (
        alerts.join(txns, "txn_id")
        .join(clients, "client_id")
        .transform(lambda df: left_join_nullable(df, merchants, "merchant_id", "alert_id"))
        .withColumn("alert_outcome", alert_outcome(F.col("is_confirmed")))
    )
    return to_serving_types(mart, "mart_fraud_analysis")


MARTS = {
    "mart_daily_transaction_summary": daily_transaction_summary,
    "mart_merchant_performance": merchant_performance,
    "mart_client_360": client_360,
    "mart_fraud_analysis": fraud_analysis,
}

MART_KEYS = {
    "mart_daily_transaction_summary": ["txn_date", "status", "channel", "currency"],
    "mart_merchant_performance": ["merchant_id"],
    "mart_client_360": ["client_id"],
    "mart_fraud_analysis": ["alert_id"],
}


#: The tables each mart is built from.
MART_SOURCES = {
    "mart_daily_transaction_summary": ["transactions", "transaction_statuses"],
    "mart_merchant_performance": [
        "merchants", "transactions", "transaction_statuses", "merchant_categories", "countries",
    ],
    "mart_client_360": ["clients", "transactions", "transaction_statuses", "payment_cards"],
    "mart_fraud_analysis": ["fraud_alerts", "transactions", "clients", "merchants"],
}


def build_marts(tables: Tables, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: MARTS[name](tables) for name in names or list(MARTS)}
