"""Settlement batches and refund reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import money

PENDING_DAYS = 2
PAYOUT_HOUR = 22


def settlement_batches(
    transactions: DataFrame, statuses: DataFrame, as_of: date | None = None
) -> DataFrame:
    """One payout row per merchant and day of approved transactions.

    A batch older than two days at ``as_of`` (default: the last transaction day) is
    settled at 22:00 of its day; younger ones are pending.
    """
    approved = transactions.where("merchant_id is not null").join(
        statuses.where("code = 'APPROVED'").select("status_id"), "status_id"
    )
    daily = approved.groupBy("merchant_id", F.to_date("initiated_at").alias("batch_date")).agg(
        F.count(F.lit(1)).alias("txn_count"),
        money(F.sum("amount"), 18).alias("gross_amount"),
        money(F.sum("fee"), 18).alias("total_fees"),
        money(F.sum(F.col("amount") - F.col("fee")), 18).alias("net_payout"),
    )
    if as_of is None:
        last_day = transactions.agg(F.max(F.to_date("initiated_at"))).scalar()
    else:
        last_day = F.lit(as_of)
    settled = F.datediff(last_day, F.col("batch_date")) > PENDING_DAYS
    return daily.select(
        (F.col("merchant_id") * 100_000 + F.unix_date("batch_date")).alias("batch_id"),
        "merchant_id",
        "batch_date",
        "txn_count",
        "gross_amount",
        "total_fees",
        "net_payout",
        F.lit("USD").alias("currency"),
        F.when(settled, "SETTLED").otherwise("PENDING").alias("status"),
        F.when(
            settled,
            F.col("batch_date").cast("timestamp_ntz") + F.expr(f"INTERVAL {PAYOUT_HOUR} HOURS"),
        ).alias("settled_at"),
        F.col("batch_date").cast("timestamp_ntz").alias("created_at"),
    )


def reconcile_refunds(refunds: DataFrame, transactions: DataFrame) -> DataFrame:
    """Each refund beside its transaction: partial, over-refunded, hours to resolve.

    A transaction refunded several times counts as over-refunded when the sum exceeds it.
    """
    per_txn = refunds.groupBy("original_txn_id").agg(F.sum("amount").alias("refunded_total"))
    originals = transactions.select(
        F.col("txn_id").alias("original_txn_id"),
        "merchant_id",
        F.col("amount").alias("original_amount"),
    )
    seconds = F.unix_seconds(F.col("resolved_at").cast("timestamp")) - F.unix_seconds(
        F.col("initiated_at").cast("timestamp")
    )
    return (
        refunds.join(originals, "original_txn_id")
        .join(per_txn, "original_txn_id")
        .select(
            "refund_id",
            "original_txn_id",
            "merchant_id",
            "amount",
            "original_amount",
            money(F.col("refunded_total"), 18).alias("refunded_total"),
            (F.col("amount") < F.col("original_amount")).cast("int").alias("is_partial"),
            (F.col("refunded_total") > F.col("original_amount")).cast("int").alias("is_over"),
            F.floor(seconds / 3600).cast("bigint").alias("hours_to_resolve"),
        )
    )
