"""Joins the marts and detectors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SALTS = 4096


def spread_nulls(key: Column, row_id: Column) -> Column:
    """``key`` for the preserved side of an outer join, with NULLs spread out.

    Ids are never negative, so a NULL turned into one of many negative values still
    matches nothing, but no longer lands with all other NULLs in a single partition.
    """
    return F.coalesce(key, -1 - F.pmod(F.xxhash64(row_id), F.lit(NULL_SALTS)))


def left_join_nullable(left: DataFrame, right: DataFrame, key: str, row_id: str) -> DataFrame:
    """LEFT JOIN on a nullable id; ``right`` is unique and never NULL on ``key``."""
    salted = right.withColumnRenamed(key, "_key")
    return left.join(
        salted, spread_nulls(F.col(key), F.col(row_id)) == F.col("_key"), "left"
    ).drop("_key")


def with_status(transactions: DataFrame, statuses: DataFrame) -> DataFrame:
    """Transactions that have a known status, with its code."""
    return transactions.join(
        statuses.select("status_id", F.col("code").alias("status_code")), "status_id"
    )


def approved_per_merchant(
    merchants: DataFrame, transactions: DataFrame, statuses: DataFrame
) -> DataFrame:
    """Approved count and amount per merchant, merchants without any included."""
    approved = (
        with_status(transactions, statuses)
        .where("status_code = 'APPROVED' and merchant_id is not null")
        .groupBy("merchant_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("approved_amount"))
    )
    return merchants.join(approved, "merchant_id", "left").select(
        "merchant_id",
        "legal_name",
        F.coalesce("n", F.lit(0)).alias("approved_txns"),
        "approved_amount",
    )


def resolve_merchant(transactions: DataFrame, pos_terminals: DataFrame) -> DataFrame:
    """The terminal's merchant where a terminal is set, else the transaction's own."""
    terminals = pos_terminals.select("pos_id", F.col("merchant_id").alias("pos_merchant_id"))
    joined = left_join_nullable(transactions, terminals, "pos_id", "txn_id")
    return joined.withColumn(
        "resolved_merchant_id", F.coalesce("pos_merchant_id", "merchant_id")
    ).drop("pos_merchant_id")


def match_card_network(cards: DataFrame, networks: DataFrame) -> DataFrame:
    """Cards left-joined to the networks whose prefix pattern their number matches.

    The networks reach the cards as one array, a scalar subquery of the plan, so that no card
    is shuffled, whatever the number of networks.
    """
    listed = networks.agg(F.collect_list(F.struct("network_id", "name", "prefix_regex"))).scalar()
    matches = F.filter("_n", lambda n: F.regexp_like(F.col("masked_pan"), n["prefix_regex"]))
    return cards.withColumn("_n", listed).withColumn("_m", F.explode_outer(matches)).select(
        *cards.columns,
        F.col("_m.network_id").alias("matched_network_id"),
        F.col("_m.name").alias("matched_network"),
    )
