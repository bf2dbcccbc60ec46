"""Ranking, paging and sampling without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1_000_000


def rank_descending(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Competition rank of every row by a non-negative bigint ``key``, highest first, NULLs last.

    Equal keys share a rank, so rows first collapse to counts per distinct key. Counts are
    then summed over two levels of fixed key ranges; running totals within a range of at
    most a million distinct keys, within a million ranges, and over the top ranges add up
    to the number of rows ahead. No window holds more rows than that, whatever the skew.
    """
    key = F.coalesce(key, F.lit(-1))
    low, top = F.floor(F.col("_key") / RANGE), F.floor(F.col("_low") / RANGE)
    per_key = (
        df.groupBy(key.alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_low", low.cast("bigint"))
    )
    per_low = (
        per_key.groupBy("_low").agg(F.sum("_n").alias("_n")).withColumn("_top", top.cast("bigint"))
    )
    per_top = per_low.groupBy("_top").agg(F.sum("_n").alias("_n"))

    def ahead(within: list[str], by: str) -> Column:
        window = (
            Window.partitionBy(*within)
            .orderBy(F.desc(by))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    tops = per_top.select("_top", ahead([], "_top").alias("_a"))
    lows = per_low.withColumn("_b", ahead(["_top"], "_low")).join(tops, "_top")
    keys = (
        per_key.withColumn("_c", ahead(["_low"], "_key"))
        .join(lows.select("_low", "_a", "_b"), "_low")
        .select("_key", (F.col("_a") + F.col("_b") + F.col("_c") + 1).alias(name))
    )
    return df.withColumn("_key", key).join(keys, "_key").drop("_key")


def rank_by_risk(alerts: DataFrame) -> DataFrame:
    """``risk_rank`` by risk score, then amount, both descending.

    Score (a byte) and amount (twelve digits and two cents) pack into one bigint.
    """
    cents = (F.col("amount") * 100).cast("bigint")
    packed = F.col("risk_score").cast("bigint") * F.lit(10**14) + cents
    return rank_descending(alerts, packed, "risk_rank")


def page_by_key(df: DataFrame, key: str, size: int, offset: int) -> DataFrame:
    """One page of ``df`` in key order."""
    return df.orderBy(key).offset(offset).limit(size)


def page_after(df: DataFrame, key: str, size: int, last: int | None) -> DataFrame:
    """The page that follows key ``last``; the filter reaches the scan, so depth is free."""
    rest = df if last is None else df.where(F.col(key) > F.lit(last))
    return rest.orderBy(key).limit(size)


def sample_exact(
    df: DataFrame, key: str, size: Column, seed: int = 42, bucket_digits: int = 4
) -> DataFrame:
    """Exactly ``size`` rows (a scalar), chosen by a seeded hash order of a unique key.

    A histogram of hash prefixes (at most 16**bucket_digits rows) finds the prefixes that
    hold the sample; rows are ordered only inside those, and only there shuffled.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary")))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, bucket_digits))
    running = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        hashed.groupBy("_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_b", (size - F.coalesce(F.sum("_n").over(running), F.lit(0))).alias("_take"))
        .where("_take > 0")
    )
    within = Window.partitionBy("_b").orderBy("_h", key)
    return (
        hashed.join(buckets, "_b")
        .withColumn("_rn", F.row_number().over(within))
        .where("_rn <= _take")
        .select(*df.columns)
    )


def sample_approved(
    transactions: DataFrame, statuses: DataFrame, percent: int = 5, seed: int = 42
) -> DataFrame:
    """Approved transactions numbering ``percent`` of all transactions."""
    approved = transactions.join(
        statuses.where("code = 'APPROVED'").select("status_id"), "status_id"
    )
    size = transactions.agg(
        F.floor(F.count(F.lit(1)) * percent / 100).cast("bigint")
    ).scalar()
    return sample_exact(approved, "txn_id", size, seed)
