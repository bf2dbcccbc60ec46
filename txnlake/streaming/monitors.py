"""Continuous monitors and detectors over event-time windows.

Append mode emits a window once the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.money import rate_pct
from txnlake.operators.cdc import delivery_identity
from txnlake.operators.monitor import MAX_FRAUD_PCT, MIN_INGESTED


def _bounds(window: str = "window") -> list[Column]:
    return [
        F.col(f"{window}.{edge}").cast("timestamp_ntz").alias(f"window_{edge}")
        for edge in ("start", "end")
    ]


def ingestion_rate(
    txns: DataFrame,
    delay: str = "10 minutes",
    width: str = "15 minutes",
    minimum: int = MIN_INGESTED,
) -> DataFrame:
    """Rows per window of ``created_at``, warned about when few."""
    n = F.count(F.lit(1))
    return (
        txns.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", width))
        .agg(n.alias("n_rows"))
        .select(
            *_bounds(),
            "n_rows",
            F.when(F.col("n_rows") < minimum, "WARN").otherwise("OK").alias("status"),
        )
    )


def fraud_rate(
    txns: DataFrame,
    delay: str = "10 minutes",
    width: str = "1 hour",
    slide: str = "15 minutes",
    max_pct: int = MAX_FRAUD_PCT,
) -> DataFrame:
    """Flagged share per sliding window of ``initiated_at``, which ``slide`` divides.

    Transactions are counted once, by slide; windows add up these counts.
    """
    by_slide = (
        txns.withWatermark("initiated_at", delay)
        .groupBy(F.window("initiated_at", slide))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.col("is_flagged").cast("bigint")).alias("flagged"),
        )
    )
    return (
        by_slide.groupBy(F.window(F.window_time("window"), width, slide))
        .agg(F.sum("total").alias("total"), F.sum("flagged").alias("flagged"))
        .withColumn("fraud_pct", rate_pct(F.col("flagged"), F.col("total")))
        .select(
            *_bounds(),
            "total",
            "flagged",
            "fraud_pct",
            F.when(F.col("fraud_pct") > max_pct, "WARN").otherwise("OK").alias("status"),
        )
    )


def velocity_windows(
    txns: DataFrame,
    minimum: int = 5,
    delay: str = "10 minutes",
    width: str = "10 minutes",
    slide: str = "1 minute",
) -> DataFrame:
    """Clients with many online transactions in a sliding window, which ``slide`` divides.

    A client's transactions are counted once, by slide; windows add up these counts, so what is
    copied into every window is a row per client and slide, however many transactions that are.
    """
    by_slide = (
        txns.where("channel = 'ONLINE'")
        .withWatermark("initiated_at", delay)
        .groupBy(F.window("initiated_at", slide), "client_id")
        .agg(F.count(F.lit(1)).alias("n_txns"))
    )
    return (
        by_slide.groupBy(F.window(F.window_time("window"), width, slide), "client_id")
        .agg(F.sum("n_txns").alias("n_txns"))
        .where(F.col("n_txns") >= minimum)
        .select("client_id", *_bounds(), "n_txns")
    )


def velocity_sessions(
    txns: DataFrame,
    minimum: int = 5,
    delay: str = "10 minutes",
    gap: str = "60 seconds",
    longest_seconds: int | None = None,
) -> DataFrame:
    """Runs of a client's online transactions with no gap as long as ``gap``.

    With ``longest_seconds`` runs are cut at its multiples, so that a client who never pauses is
    reported every so often, and its state does not grow without end.
    """
    stretch = F.lit(0)
    if longest_seconds:
        stretch = F.floor(F.unix_seconds("initiated_at") / longest_seconds)
    return (
        txns.where("channel = 'ONLINE'")
        .withColumn("_stretch", stretch)
        .withWatermark("initiated_at", delay)
        .groupBy(F.session_window("initiated_at", gap), "client_id", "_stretch")
        .agg(F.count(F.lit(1)).alias("n_txns"))
        .where(F.col("n_txns") >= minimum)
        .select("client_id", *_bounds("session_window"), "n_txns")
    )


def dedupe(changes: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Drop deliveries of a change that repeat within ``delay``: same key, source time,
    operation and row."""
    marked = changes.withColumn("_said", delivery_identity(changes, keys))
    once = marked.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(
        [*keys, "ts_ms", "_said"]
    )
    return once.drop("_said")
