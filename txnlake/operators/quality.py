"""Data-quality checks that return rows: one per check, with its violations.

Row checks on a table run as conditional counts of a single pass. Key and reference checks
first reduce each table to pages of keys (``key_pages``), and read rows again only where a page
shows a violation.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import fixed_values as fixed
from txnlake.operators import key_pages
from txnlake.schemas import FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS, ForeignKey
from txnlake.session import written
from txnlake.sources.tables import Tables, values_table


@dataclass(frozen=True)
class RowCheck:
    """``violation`` is SQL that is true on a bad row; NULL counts as good."""

    table: str
    name: str
    violation: str


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck(table, f"{table}.{column} not_null", f"{column} IS NULL")


def accepted_values(table: str, column: str, values: list[str]) -> RowCheck:
    listed = ", ".join(f"'{v}'" for v in values)
    return RowCheck(table, f"{table}.{column} accepted_values", f"{column} NOT IN ({listed})")


def in_range(table: str, column: str, low: int, high: int) -> RowCheck:
    return RowCheck(
        table, f"{table}.{column} range", f"{column} NOT BETWEEN {low} AND {high}"
    )


MART_NOT_NULL = [
    not_null("mart_daily_transaction_summary", "txn_count"),
    not_null("mart_merchant_performance", "merchant_id"),
    not_null("mart_client_360", "client_id"),
    not_null("mart_fraud_analysis", "alert_id"),
]
MART_UNIQUE = [
    ("mart_merchant_performance", ("merchant_id",)),
    ("mart_client_360", ("client_id",)),
    ("mart_fraud_analysis", ("alert_id",)),
]
ACCEPTED = [
    accepted_values("transactions", "channel", fixed.CHANNELS),
    accepted_values("settlement_batches", "status", fixed.BATCH_STATUSES),
    accepted_values("mart_fraud_analysis", "alert_outcome", fixed.ALERT_OUTCOMES),
]
RANGES = [
    in_range("clients", "risk_score", 1, 100),
    in_range("mart_client_360", "risk_score", 1, 100),
]
SOURCE_KEYS = [*((t, (pk,)) for t, pk in PRIMARY_KEYS.items()), *UNIQUE_KEYS]


def row_checks(tables: Tables, checks: list[RowCheck]) -> DataFrame:
    """``check_name, n_rows, n_violations``; one pass per table however many checks."""
    by_table: dict[str, list[RowCheck]] = defaultdict(list)
    for check in checks:
        by_table[check.table].append(check)

    def one(table: str, group: list[RowCheck]) -> DataFrame:
        counts = tables[table].agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.expr(c.violation)).alias(f"v{i}") for i, c in enumerate(group)],
        )
        results = F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"v{i}").alias("n"))
                for i, c in enumerate(group)
            ]
        )
        return counts.select("n_rows", F.explode(results).alias("r")).select(
            "r.check_name", "n_rows", F.col("r.n").alias("n_violations")
        )

    return reduce(DataFrame.unionByName, [one(t, g) for t, g in by_table.items()])


def key_name(table: str, columns: tuple[str, ...]) -> str:
    return f"{table}.{'+'.join(columns)} unique"


def unique_keys(
    tables: Tables, keys: list[tuple[str, tuple[str, ...]]], pages: DataFrame | None = None
) -> DataFrame:
    """``check_name, n_duplicate_keys, n_excess_rows`` per key; NULL keys never collide.

    ``pages`` may hold pages of the same keys that were kept per ingest day; they are merged
    and the tables are read only where a page shows more rows than keys.
    """
    spark = next(iter(tables.values())).sparkSession
    merged = key_pages.key_pages(tables, keys) if pages is None else key_pages.merge_pages(pages)
    suspects = written(
        merged.where(F.col("n") > key_pages.bits_in("bits")).select("check", "slot"), "suspect_keys"
    )
    counts = _no_counts(spark, "keys bigint, rows bigint")
    if checks := _checks(suspects):
        counts = key_pages.repeated_keys(tables, keys, suspects, checks)
    names = [(i, key_name(t, c)) for i, (t, c) in enumerate(keys)]
    return _with_names(spark, names, counts).select(
        "check_name",
        F.coalesce("keys", F.lit(0)).alias("n_duplicate_keys"),
        F.coalesce("rows", F.lit(0)).alias("n_excess_rows"),
    )


def _checks(suspects: DataFrame) -> set[int]:
    """Numbers of the checks with suspects: at most as many as there are checks."""
    return {r["check"] for r in suspects.select("check").distinct().collect()}


def _no_counts(spark: SparkSession, columns: str) -> DataFrame:
    return spark.createDataFrame([], f"check int, {columns}")


def _with_names(spark: SparkSession, names: list[tuple[int, str]], counts: DataFrame) -> DataFrame:
    return values_table(spark, names, "check int, check_name string").join(counts, "check", "left")


def referential(tables: Tables, foreign_keys: list[ForeignKey] = FOREIGN_KEYS) -> DataFrame:
    """``check_name, n_orphan_keys, n_orphan_rows`` per foreign key.

    Pages of used keys meet pages of the parent's keys; the bits that the parent lacks are the
    orphans. Children are read again only where there are some. NULL references are allowed.
    """
    spark = next(iter(tables.values())).sparkSession
    parents = sorted({fk.parent for fk in foreign_keys})
    parent_keys = [(p, (f"cast({PRIMARY_KEYS[p]} as bigint)",)) for p in parents]
    child_keys = [(fk.child, (f"cast({fk.column} as bigint)",)) for fk in foreign_keys]
    parent_of = F.element_at(
        F.array(*[F.lit(parents.index(fk.parent)) for fk in foreign_keys]), F.col("check") + 1
    )
    used = key_pages.key_pages(tables, child_keys).withColumn("parent", parent_of)
    known = key_pages.key_pages(tables, parent_keys).select(
        F.col("check").alias("parent"), "slot", F.col("bits").alias("known")
    )
    lacking = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
    orphans = written(
        used.join(known, ["parent", "slot"], "left")
        .select("check", "slot", lacking.alias("bits"))
        .where("bits <> 0"),
        "orphan_keys",
    )
    counts = _no_counts(spark, "keys bigint, rows bigint")
    if checks := _checks(orphans):
        n_keys = orphans.groupBy("check").agg(F.sum(key_pages.bits_in("bits")).alias("keys"))
        counts = n_keys.join(key_pages.rows_in_pages(tables, child_keys, orphans, checks), "check")
    names = [(i, fk.name) for i, fk in enumerate(foreign_keys)]
    return _with_names(spark, names, counts).select(
        "check_name",
        F.coalesce("keys", F.lit(0)).alias("n_orphan_keys"),
        F.coalesce("rows", F.lit(0)).alias("n_orphan_rows"),
    )
