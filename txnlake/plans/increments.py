"""Marts kept by increments: changes are folded into stored groups, nothing is rebuilt.

A change carries the row before and after it. Rows that go are taken off the sums and counts of
their group, rows that come are added. A maximum or minimum survives unless a row that held it
goes and none as far out comes; only groups that lost theirs are computed again from current
rows. Every batch stores the new rows of the groups it touched under its own id, computed from
what earlier batches stored, so a batch that is replayed overwrites itself and counts once.

Joined attributes that are not part of a group (names, categories) are joined when a mart is
read. Codes of the status lookup are part of groups: when that lookup changes, rebuild.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.functions.money import mean_of, rate_pct
from txnlake.plans import marts, staging
from txnlake.plans.rebuild import at_once
from txnlake.schemas import TABLE_SCHEMAS
from txnlake.session import path_exists, remove_folder, subfolders, written
from txnlake.sources.tables import Tables

FOLD_EVERY = 20
_SUM = "decimal(30,2)"


@dataclass(frozen=True)
class Kept:
    """Groups that are kept: rows of ``source`` as ``project`` makes them of the columns ``reads``, by ``keys``."""

    name: str
    source: str
    reads: list[str]
    keys: list[str]
    project: Callable[[DataFrame, Tables], DataFrame]
    sums: list[str] = field(default_factory=list)
    #: Stored name: (function, column).
    extremes: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        summed = [c for m in self.sums for c in (f"sum_{m}", f"n_{m}")]
        return [*self.keys, "n", *summed, *self.extremes]


def _staged(txns: DataFrame) -> DataFrame:
    """Staged transactions of the columns at hand; the others are NULL."""
    kinds = TABLE_SCHEMAS["transactions"]
    absent = {f.name: F.lit(None).cast(f.dataType) for f in T.StructType.fromDDL(kinds) if f.name not in txns.columns}
    return staging.stg_transactions(txns.withColumns(absent))


def _daily_rows(txns: DataFrame, tables: Tables) -> DataFrame:
    statuses = tables["transaction_statuses"].select("status_id", F.col("code").alias("status"))
    return (
        _staged(txns)
        .join(statuses, "status_id", "left")
        .withColumn("txn_date", F.to_date("initiated_at"))
    )


def _approved_rows(txns: DataFrame, tables: Tables) -> DataFrame:
    approved = tables["transaction_statuses"].where("code = 'APPROVED'").select("status_id")
    return _staged(txns).where("merchant_id IS NOT NULL").join(approved, "status_id")


def _client_rows(txns: DataFrame, tables: Tables) -> DataFrame:
    codes = tables["transaction_statuses"].select("status_id", "code")
    is_ = lambda condition: F.coalesce(condition, F.lit(False)).cast("int")
    return (
        _staged(txns)
        .join(codes, "status_id")
        .withColumn("approved", is_(F.col("code") == "APPROVED"))
        .withColumn("declined", is_(F.col("code") == "DECLINED"))
        .withColumn("flagged", is_(F.col("is_flagged") == 1))
    )


DAILY = Kept(
    "daily", "transactions",
    ["status_id", "channel", "currency", "initiated_at", "amount", "fee", "net_amount", "is_flagged"],
    marts.MART_KEYS["mart_daily_transaction_summary"], _daily_rows,
    ["amount", "fee", "net_amount", "is_flagged"], {"max_amount": ("max", "amount")},
)
MERCHANT = Kept(
    "merchant", "transactions",
    ["merchant_id", "status_id", "initiated_at", "amount", "fee", "net_amount", "is_flagged"],
    ["merchant_id"], _approved_rows,
    ["amount", "fee", "net_amount", "is_flagged"],
    {"first_at": ("min", "initiated_at"), "last_at": ("max", "initiated_at")},
)
CLIENT = Kept(
    "client", "transactions", ["client_id", "status_id", "initiated_at", "amount", "is_flagged"],
    ["client_id"], _client_rows, ["amount", "approved", "declined", "flagged"],
    {"max_amount": ("max", "amount"), "last_at": ("max", "initiated_at")},
)
CARDS = Kept("cards", "payment_cards", ["client_id"], ["client_id"], lambda cards, tables: cards)
_GROUPS = {
    "mart_daily_transaction_summary": [DAILY],
    "mart_merchant_performance": [MERCHANT],
    "mart_client_360": [CLIENT, CARDS],
}
_ALERT_SOURCES = {"fraud_alerts": "alert_id", "transactions": "txn_id", "clients": "client_id", "merchants": "merchant_id"}


def columns_read(names: Iterable[str] = marts.MARTS) -> dict[str, list[str]]:
    """The columns of changes that the named marts need, by table: a feed may leave out all others."""
    names, needed = list(names), {}
    for kept in (k for name in names for k in _GROUPS.get(name, [])):
        needed.setdefault(kept.source, set()).update(kept.reads)
    if "mart_fraud_analysis" in names:
        for table, key in _ALERT_SOURCES.items():
            needed.setdefault(table, set()).add(key)
    return {table: sorted(columns) for table, columns in needed.items()}


def net_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One (before, after) per key of changes (keys, before, after, ts_ms, offset): the row before the first
    and after the last, where they differ. Combines before the shuffle, so busy keys shrink."""
    version = F.struct("ts_ms", "offset")
    first_and_last = changes.groupBy(*keys).agg(
        F.min_by(F.struct("before"), version).alias("first"),
        F.max_by(F.struct("after"), version).alias("last"),
    )
    net = first_and_last.select(F.col("first.before").alias("before"), F.col("last.after").alias("after"))
    return net.where(~F.col("before").eqNullSafe(F.col("after")))


def _image(image: str, columns: list[str]) -> Column:
    fields = F.struct(*[F.col(f"{image}.{c}").alias(c) for c in columns])
    return F.when(F.col(image).isNotNull(), fields).alias(image)


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _only(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the given groups, NULL keys included."""
    return df.alias("l").join(groups.alias("r"), _same(keys, "l", "r"), "left_semi")


class GroupStore:
    """Rows of groups by the batch that last touched them: the newest of each counts.

    Batches lie below ``batches/batch_id=...``; from time to time those that can no longer be
    replayed are folded into a base, announced once it is complete, and removed one fold later.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys

    def read(self, before: int | None = None) -> DataFrame | None:
        """The groups after all batches, or after those before one; None if there was none."""
        base = self._base(before)
        parts = []
        if path_exists(self.spark, f"{self.root}/batches"):
            batches = self.spark.read.parquet(f"{self.root}/batches")
            batches = batches.where(F.col("batch_id") > (-1 if base is None else base))
            parts.append(batches if before is None else batches.where(F.col("batch_id") < before))
        if base is not None:
            folded = self.spark.read.parquet(f"{self.root}/bases/upto={base}")
            parts.append(folded.withColumn("batch_id", F.lit(base)))
        if not parts:
            return None
        every = reduce(DataFrame.unionByName, parts)
        rest = [c for c in every.columns if c not in (*self.keys, "batch_id")]
        newest = every.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
        return newest.select(*self.keys, "_row.*")

    def write(self, groups: DataFrame, batch_id: int) -> None:
        groups.write.mode("overwrite").parquet(f"{self.root}/batches/batch_id={batch_id}")
        if batch_id and batch_id % FOLD_EVERY == 0:
            self.fold(batch_id - 1)

    def fold(self, upto: int) -> None:
        """Fold what came up to a batch into a base; run again, it changes nothing."""
        before = self._base(upto + 1)
        if before == upto:
            return
        self.read(upto + 1).write.mode("overwrite").parquet(f"{self.root}/bases/upto={upto}")
        done = self.spark.createDataFrame([(upto,)], "upto bigint").coalesce(1)
        done.write.mode("append").parquet(f"{self.root}/folds")
        if before is not None:
            self._retire(before)

    def _retire(self, base: int) -> None:
        """Remove the batches a base of the past holds, and the bases before it: readers that
        started before the newest fold still find theirs."""
        for folder, upto in (("batches", base), ("bases", base - 1)):
            for number, path in subfolders(self.spark, f"{self.root}/{folder}").items():
                if number <= upto:
                    remove_folder(self.spark, path)

    def _base(self, before: int | None) -> int | None:
        if not path_exists(self.spark, f"{self.root}/folds"):
            return None
        folds = self.spark.read.schema("upto bigint").parquet(f"{self.root}/folds")
        if before is not None:
            folds = folds.where(F.col("upto") < before)
        return folds.agg(F.max("upto")).first()[0]


class MartIncrements:
    """The four marts below ``root``, kept up to date batch by batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def apply(
        self, batch_id: int, changes: Mapping[str, DataFrame], current: Tables, names: Iterable[str] = marts.MARTS
    ) -> None:
        """Fold a batch: per table its net (before, after) rows, and the tables after them.

        Batches come in order and one at a time, as a stream hands them out; the same batch may
        come again. Only the named marts are kept.
        """
        names = set(names)
        kept = [k for mart, group in _GROUPS.items() if mart in names for k in group]
        needed = columns_read(names)
        # Only the columns that groups read are computed and stored.
        net = {
            t: written(changes[t].select(*[_image(i, needed[t]) for i in ("before", "after")]), f"net-{t}")
            for t in changes
            if t in needed
        }
        jobs = {k.name: partial(self._fold, k, batch_id, net[k.source], current) for k in kept if k.source in net}
        if "mart_fraud_analysis" in names:
            jobs["alerts"] = partial(self._fold_alerts, batch_id, net, current)
        if jobs:
            at_once(lambda name: jobs[name](), jobs, self.spark)

    def view(self, mart: str, tables: Tables) -> DataFrame:
        """A mart as a rebuild from ``tables`` would give it."""
        return _VIEWS[mart](self, tables)

    def groups(self, kept: Kept) -> DataFrame:
        return self._store(kept).read().where("n > 0")

    def _store(self, kept: Kept) -> GroupStore:
        return GroupStore(self.spark, f"{self.root}/{kept.name}", kept.keys)

    def _fold(self, kept: Kept, batch_id: int, net: DataFrame, current: Tables) -> None:
        keys, store = kept.keys, self._store(kept)

        def side(image: str, sign: int) -> DataFrame:
            rows = kept.project(net.where(F.col(image).isNotNull()).select(f"{image}.*"), current)
            needed = {*keys, *kept.sums, *(column for _, column in kept.extremes.values())}
            return rows.select(*sorted(needed), F.lit(sign).alias("_sign"))

        sign = F.col("_sign")
        add = [F.sum(sign).cast("bigint").alias("n")]
        for m in kept.sums:
            add.append(F.sum(F.col(m).cast("decimal(20,2)") * sign).cast(_SUM).alias(f"sum_{m}"))
            add.append(F.sum(F.when(F.col(m).isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"n_{m}"))
        for name, (best, column) in kept.extremes.items():
            pick = getattr(F, best)
            add.append(pick(F.when(sign > 0, F.col(column))).alias(f"come_{name}"))
            add.append(pick(F.when(sign < 0, F.col(column))).alias(f"gone_{name}"))
        touched = written(side("before", -1).unionByName(side("after", 1)).groupBy(*keys).agg(*add), "touched")

        both = touched.withColumns({name: F.lit(None).cast(touched.schema[f"come_{name}"].dataType) for name in kept.extremes})
        if (stored := store.read(batch_id)) is not None:
            both = both.unionByName(_only(stored, touched.select(*keys), keys), allowMissingColumns=True)
        total = [F.sum("n").alias("n")]
        for m in kept.sums:
            total += [F.sum(f"sum_{m}").cast(_SUM).alias(f"sum_{m}"), F.sum(f"n_{m}").alias(f"n_{m}")]
        for name, (best, _) in kept.extremes.items():
            total += [getattr(F, best)(c).alias(c) for c in (name, f"come_{name}", f"gone_{name}")]
        merged = both.groupBy(*keys).agg(*total)
        lost = F.lit(False)
        for name, (best, _) in kept.extremes.items():
            held, come, gone = (F.col(c) for c in (name, f"come_{name}", f"gone_{name}"))
            further = (come >= gone) if best == "max" else (come <= gone)
            same = held == gone
            lost = lost | F.coalesce(same & ~F.coalesce(further, F.lit(False)), F.lit(False))
        merged = merged.withColumn("_lost", lost & (F.col("n") > 0))
        if kept.extremes:
            merged = written(merged, "merged")
            groups = merged.where("_lost").select(*keys)
            rows = kept.project(current[kept.source].select(*kept.reads), current)
            # Current rows are read only where some group lost a value.
            rows = rows.limit(0) if groups.isEmpty() else _only(rows, groups, keys)
            held = [getattr(F, best)(column).alias(f"now_{name}") for name, (best, column) in kept.extremes.items()]
            again = rows.groupBy(*keys).agg(*held)
            merged = merged.alias("m").join(again.alias("a"), _same(keys, "m", "a"), "left")
            outer = {"max": F.greatest, "min": F.least}
            for name, (best, _) in kept.extremes.items():
                kept_on = outer[best](F.col(f"m.{name}"), F.col(f"m.come_{name}"))
                now = F.when(F.col("m._lost"), F.col(f"a.now_{name}")).when(F.col("m.n") > 0, kept_on)
                merged = merged.withColumn(f"_{name}", now)
            merged = merged.select("m.*", *[f"_{name}" for name in kept.extremes]).drop(*kept.extremes)
            merged = merged.withColumnsRenamed({f"_{name}": name for name in kept.extremes})
        store.write(merged.select(*kept.columns), batch_id)

    def _alert_store(self) -> GroupStore:
        return GroupStore(self.spark, f"{self.root}/alerts", ["alert_id"])

    def _fold_alerts(self, batch_id: int, changes: Mapping[str, DataFrame], current: Tables) -> None:
        """Rows of alerts that changed, or whose transaction, client or merchant did."""
        ids = lambda table, key: (
            changes[table].select(F.coalesce(f"after.{key}", f"before.{key}").alias(key)) if table in changes else None
        )
        alerts, txns = current["fraud_alerts"].select("alert_id", "txn_id"), current["transactions"]
        moved = [ids("transactions", "txn_id")]
        for table, key in (("clients", "client_id"), ("merchants", "merchant_id")):
            if (of := ids(table, key)) is not None:
                moved.append(txns.join(of, key, "left_semi").select("txn_id"))
        found = [ids("fraud_alerts", "alert_id")]
        found += [alerts.join(m, "txn_id", "left_semi").select("alert_id") for m in moved if m is not None]
        found = [f for f in found if f is not None]
        if not found:
            return
        touched = written(reduce(DataFrame.unionByName, found).distinct(), "touched-alerts")
        only = {**{t: current[t] for t in ("transactions", "clients", "merchants")}}
        only["fraud_alerts"] = current["fraud_alerts"].join(touched, "alert_id", "left_semi")
        rows = written(marts.fraud_analysis(only).withColumn("gone", F.lit(False)), "alerts")
        gone = touched.join(rows.select("alert_id"), "alert_id", "left_anti").withColumn("gone", F.lit(True))
        self._alert_store().write(rows.unionByName(gone, allowMissingColumns=True), batch_id)


def _sum(column: str) -> Column:
    """A kept sum; NULL where no row of the group has a value, as SUM gives it."""
    return F.when(F.col(f"n_{column}") > 0, F.col(f"sum_{column}"))


def _daily_view(kept: MartIncrements, tables: Tables) -> DataFrame:
    flagged = _sum("is_flagged").cast("bigint")
    daily = kept.groups(DAILY).select(
        *DAILY.keys,
        F.col("n").alias("txn_count"),
        _sum("amount").alias("gross_amount"),
        _sum("fee").alias("total_fees"),
        _sum("net_amount").alias("net_amount"),
        flagged.alias("fraud_count"),
        rate_pct(flagged, F.col("n")).alias("fraud_rate_pct"),
        mean_of(F.col("sum_amount"), F.col("n_amount")).alias("avg_txn_amount"),
        F.col("max_amount").alias("max_txn_amount"),
    )
    return marts.to_serving_types(daily, "mart_daily_transaction_summary")


def _merchant_view(kept: MartIncrements, tables: Tables) -> DataFrame:
    flagged = _sum("is_flagged").cast("bigint")
    by_merchant = kept.groups(MERCHANT).select(
        "merchant_id",
        F.col("n").alias("approved_txns"),
        _sum("amount").alias("gross_revenue"),
        _sum("fee").alias("total_fees"),
        _sum("net_amount").alias("net_revenue"),
        mean_of(F.col("sum_amount"), F.col("n_amount")).alias("avg_txn_value"),
        flagged.alias("fraud_txns"),
        rate_pct(flagged, F.col("n")).alias("fraud_rate_pct"),
        F.col("first_at").alias("first_txn_at"),
        F.col("last_at").alias("last_txn_at"),
    )
    return marts.with_merchants(by_merchant, tables)


def _client_view(kept: MartIncrements, tables: Tables) -> DataFrame:
    whole = lambda column: F.col(f"sum_{column}").cast("bigint")
    stats = kept.groups(CLIENT).select(
        "client_id",
        F.col("n").alias("total_txns"),
        whole("approved").alias("approved_txns"),
        whole("declined").alias("declined_txns"),
        whole("flagged").alias("fraud_txns"),
        _sum("amount").alias("total_spent"),
        mean_of(F.col("sum_amount"), F.col("n_amount")).alias("avg_txn_amount"),
        F.col("max_amount").alias("max_txn_amount"),
        F.col("last_at").alias("last_txn_at"),
    )
    cards = kept.groups(CARDS).select("client_id", F.col("n").alias("card_count"))
    return marts.with_clients(stats, cards, tables)


def _fraud_view(kept: MartIncrements, tables: Tables) -> DataFrame:
    return kept._alert_store().read().where("NOT gone").drop("gone")


_VIEWS = {
    "mart_daily_transaction_summary": _daily_view,
    "mart_merchant_performance": _merchant_view,
    "mart_client_360": _client_view,
    "mart_fraud_analysis": _fraud_view,
}
