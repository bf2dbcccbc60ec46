"""Keys as pages of 64 bits: exact sets that tasks, days and tables can merge.

A whole-number key ``k`` is bit ``k & 63`` of page ``k >> 6``. Pages merge by OR and their row
counts by sum, so a page of up to 64 keys crosses the shuffle as one narrow row per task. A key
that is no whole number, or has several columns, becomes a page of one bit under its 64-bit hash.
A page with more rows than bits is the only place where a key can repeat: those suspects, and
no others, are looked at exactly.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.sources.tables import Tables

WHOLE = {"tinyint", "smallint", "int", "bigint"}
Key = tuple[str, tuple[str, ...]]


def page(key: Column) -> tuple[Column, Column]:
    """The page and the bit in it of a whole-number key, negative ones included."""
    return F.shiftright(key, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(63).cast("int"))


def bits_in(pages: str) -> Column:
    return F.bit_count(F.col(pages)).cast("bigint")


def merge_pages(pages: DataFrame) -> DataFrame:
    """One row per (check, slot): pages of several tasks, files or days as one."""
    return pages.groupBy("check", "slot").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def _all_present(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])


def _keyed(rows: DataFrame, keys: list[tuple[int, tuple[str, ...]]]) -> DataFrame:
    """Each row once per numbered key, with ``_check, _slot, _bit`` beside its own columns."""
    entries = []
    for number, columns in keys:
        parts = [F.expr(c) for c in columns]
        if len(parts) == 1 and rows.select(parts[0].alias("k")).dtypes[0][1] in WHOLE:
            slot, bit = page(parts[0].cast("bigint"))
        else:
            slot, bit = F.xxhash64(*parts), F.lit(1).cast("bigint")
        entries.append(
            F.struct(
                F.lit(number).alias("_check"),
                F.when(_all_present(parts), slot).alias("_slot"),
                bit.alias("_bit"),
            )
        )
    exploded = rows.select("*", F.explode(F.array(*entries)).alias("_k"))
    return exploded.select(*rows.columns, "_k._check", "_k._slot", "_k._bit").where("_slot IS NOT NULL")


def _by_table(keys: list[Key]) -> dict[str, list[tuple[int, tuple[str, ...]]]]:
    numbered: dict[str, list[tuple[int, tuple[str, ...]]]] = defaultdict(list)
    for number, (table, columns) in enumerate(keys):
        numbered[table].append((number, columns))
    return numbered


def key_pages(tables: Tables, keys: list[Key], *by: str) -> DataFrame:
    """``check, slot, bits, n`` of all keys, numbered by place in ``keys``; NULL keys are left out.

    Each table is scanned once for all its keys. ``by`` names columns that all tables have,
    such as an ingest day: pages are then kept apart by them, to be merged when asked for.
    """
    found = [
        _keyed(tables[table], group).select(
            *by, F.col("_check").alias("check"), F.col("_slot").alias("slot"), F.col("_bit").alias("bit")
        )
        for table, group in _by_table(keys).items()
    ]
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy(*by, "check", "slot")
        .agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
    )


def repeated_keys(tables: Tables, keys: list[Key], suspects: DataFrame, checks: set[int]) -> DataFrame:
    """``check, keys, rows``: repeated keys within suspect pages (check, slot), compared by value.

    Only tables of the given checks are read again, and only rows of suspect pages leave the scan.
    """

    def one(table: str, group: list[tuple[int, tuple[str, ...]]]) -> DataFrame:
        wanted = suspects.select(F.col("check").alias("_check"), F.col("slot").alias("_slot"))
        rows = _keyed(tables[table], group).join(wanted, ["_check", "_slot"], "left_semi")
        text = None
        for number, columns in group:
            parts = [F.expr(c).cast("string") for c in columns]
            value = parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))
            here = F.col("_check") == number
            text = F.when(here, value) if text is None else text.when(here, value)
        return rows.select(F.col("_check").alias("check"), text.alias("key"))

    again = {t: [k for k in g if k[0] in checks] for t, g in _by_table(keys).items()}
    return (
        reduce(DataFrame.unionByName, [one(t, g) for t, g in again.items() if g])
        .groupBy("check", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy("check")
        .agg(F.count(F.lit(1)).alias("keys"), F.sum(F.col("n") - 1).alias("rows"))
    )


def rows_in_pages(tables: Tables, keys: list[Key], marked: DataFrame, checks: set[int]) -> DataFrame:
    """``check, rows``: rows whose whole-number key is one of the marked bits (check, slot, bits)."""
    wanted = marked.select(F.col("check").alias("_check"), F.col("slot").alias("_slot"), F.col("bits").alias("_bits"))
    again = {t: [k for k in g if k[0] in checks] for t, g in _by_table(keys).items()}
    found = [
        _keyed(tables[t], g).select("_check", "_slot", "_bit")
        .join(wanted, ["_check", "_slot"])
        .where(F.col("_bit").bitwiseAND(F.col("_bits")) != 0)
        .select(F.col("_check").alias("check"))
        for t, g in again.items() if g
    ]
    return reduce(DataFrame.unionByName, found).groupBy("check").agg(F.count(F.lit(1)).alias("rows"))
