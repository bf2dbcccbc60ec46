"""Detectors for the six fraud patterns, alert building and alert roll-ups.

Detectors read ``txn_id, client_id, initiated_at, amount`` and, where a pattern needs
them, ``channel, currency, is_international, device_id``. Times count in whole seconds,
the resolution of the source's time columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake import fixed_values as fixed
from txnlake.functions.money import mean_scaled, rate_pct
from txnlake.functions.risk import capped_score, risk_band, rule_candidates
from txnlake.functions.temporal import epoch_seconds
from txnlake.sources.tables import values_table

DAY_SECONDS = 24 * 60 * 60
WINDOWS_PER_SLICE = 8
#: The longest window that is counted second by second in one pass: a slice and what it looks back
#: on hold at most nine times as many rows of a client, whatever the data. Longer windows go by buckets.
PASS_SECONDS = DAY_SECONDS
#: Buckets of a long window, at most.
BUCKETS = 60


@dataclass(frozen=True)
class Thresholds:
    velocity_txns: int = 5
    velocity_seconds: int = 10 * 60
    testing_txns: int = 10
    testing_amount: str = "1.99"
    testing_seconds: int = 15 * 60
    high_amount: int = 3000
    night_txns: int = 2
    night_hours: tuple[int, int] = (1, 4)
    spree_txns: int = 3
    spree_seconds: int = 150 * 60
    takeover_amount: int = 500
    home_currency: str = "USD"
    labels: Mapping[str, list[str]] = field(default_factory=lambda: fixed.PATTERN_RULES)


def trailing_counts(
    txns: DataFrame, seconds: int, minimum: int = 1, distinct: str | None = None
) -> DataFrame:
    """Per client and second, the transactions of the last ``seconds`` up to it.

    Returns ``client_id, _sec, n_in_window`` (and, with ``distinct``, that column and how
    many different values of it as ``n_distinct``) where there are at least ``minimum``.

    Transactions first collapse to counts per second, so no window holds more than one row
    per second and value. A client's time is cut into slices of a few windows, and rows the
    next slice looks back on are repeated there: a client with most of the data spreads
    over many tasks. Slices with fewer than ``minimum`` transactions in all, mostly nearly
    all of them, drop out right after the shuffle. Within a slice every count is added at its second and taken off when
    its window has passed; the running total is the trailing count, in one pass. A value
    likewise appears with its first row in a while and vanishes a window after its last.

    Windows longer than ``PASS_SECONDS`` are counted by buckets instead, see ``_by_buckets``.
    """
    value = [distinct] if distinct else []
    per_second = txns.groupBy(
        "client_id", epoch_seconds(F.col("initiated_at")).alias("_sec"), *value
    ).agg(F.count(F.lit(1)).alias("_n"))
    if seconds > PASS_SECONDS:
        return _by_buckets(per_second, seconds, minimum, distinct)
    length = WINDOWS_PER_SLICE * seconds
    own = F.floor(F.col("_sec") / length)
    needed_later = F.col("_sec") >= (own + 1) * length - seconds
    sliced = (
        per_second.withColumn(
            "_slice", F.explode(F.when(needed_later, F.array(own, own + 1)).otherwise(F.array(own)))
        )
        .withColumn("_total", F.sum("_n").over(Window.partitionBy("client_id", "_slice")))
        .where(F.col("_total") >= minimum)
        .drop("_total")
    )
    appears = vanishes = F.lit(0)
    if distinct:
        by_value = Window.partitionBy("client_id", "_slice").orderBy(distinct, "_sec")
        same = lambda side: F.when(
            side(distinct).over(by_value) == F.col(distinct), side("_sec").over(by_value)
        )
        sliced = sliced.select("*", same(F.lag).alias("_before"), same(F.lead).alias("_after"))
        far = lambda gap: F.coalesce((gap > seconds).cast("int"), F.lit(1))
        appears = far(F.col("_sec") - F.col("_before"))
        vanishes = far(F.col("_after") - F.col("_sec"))

    def change(at, n, values, arrives):
        return F.struct(
            at.alias("_at"), n.alias("_dn"), values.alias("_dv"), F.lit(arrives).alias("_arrives")
        )

    changes = F.array(
        change(F.col("_sec"), F.col("_n"), appears, True),
        change(F.col("_sec") + seconds + 1, -F.col("_n"), -vanishes, False),
    )
    running = Window.partitionBy("client_id", "_slice").orderBy("_at")
    counted = (
        sliced.select("client_id", "_sec", *value, "_slice", F.inline(changes))
        .where(F.col("_at") < (F.col("_slice") + 1) * length)
        .withColumn("n_in_window", F.sum("_dn").over(running))
    )
    if distinct:
        counted = counted.withColumn("n_distinct", F.sum("_dv").over(running).cast("int"))
    hits = F.col("_arrives") & (F.col("_slice") == own) & (F.col("n_in_window") >= minimum)
    return counted.where(hits).drop(
        "_slice", "_at", "_dn", "_dv", "_arrives"
    )


def _by_buckets(
    per_second: DataFrame, seconds: int, minimum: int, distinct: str | None
) -> DataFrame:
    """``trailing_counts`` for long windows, at two levels.

    A window is a whole number of buckets. Totals of buckets give the trailing total of the full
    buckets in front of each one, over slices of a few windows of buckets; a bucket whose trailing
    total and own total stay under ``minimum`` drops out. Every second of the others then adds what
    its own bucket holds up to it, and takes off what the oldest bucket holds before the window: a
    running count within single buckets, in which the window's start is marked by a row of its
    own. So no group holds more than a bucket of seconds or a slice of buckets. Different
    values are those of the full buckets, those that came by then in the own bucket and those
    last seen late enough in the oldest; there should be few, as a bucket lists them.
    """
    value = [distinct] if distinct else []
    k = next(n for n in range(BUCKETS, 0, -1) if seconds % n == 0)
    rows = per_second.withColumn("_bucket", F.floor(F.col("_sec") / (seconds // k)))
    totals = rows.groupBy("client_id", "_bucket", *value).agg(
        F.sum("_n").alias("_n"), F.min("_sec").alias("_first"), F.max("_sec").alias("_last")
    )
    if distinct:
        seen = F.collect_list(F.struct(F.col(distinct).alias("v"), "_first", "_last"))
        totals = totals.groupBy("client_id", "_bucket").agg(F.sum("_n").alias("_n"), seen.alias("_seen"))
    length = WINDOWS_PER_SLICE * k
    own = F.floor(F.col("_bucket") / length)
    needed_later = F.col("_bucket") >= (own + 1) * length - k
    sliced = totals.withColumn(
        "_slice", F.explode(F.when(needed_later, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    w = Window.partitionBy("client_id", "_slice").orderBy("_bucket")
    found = {"_before": F.coalesce(F.sum("_n").over(w.rangeBetween(-k, -1)), F.lit(0))}
    if distinct:
        full = w.rangeBetween(1 - k, -1)
        found["_full"] = F.flatten(F.collect_list("_seen").over(full)) if k > 1 else F.array()
        found["_oldest"] = F.first("_seen").over(w.rangeBetween(-k, -k))
    busy = (
        sliced.withColumns(found)
        .where((F.col("_slice") == own) & (F.col("_before") + F.col("_n") >= minimum))
        .drop("_slice", "_n")
    )
    in_bucket = rows.groupBy("client_id", "_bucket", "_sec").agg(F.sum("_n").alias("_n")) if distinct else rows
    starts = in_bucket.drop("_n").join(busy, ["client_id", "_bucket"])
    kept = ["client_id", "_sec", "_before"]
    if distinct:
        none = F.slice("_seen", 1, 0)
        values = F.concat(
            F.coalesce("_full", none) if k > 1 else none,
            F.filter("_seen", lambda s: s["_first"] <= F.col("_sec")),
            F.filter(F.coalesce("_oldest", none), lambda s: s["_last"] >= F.col("_sec") - seconds),
        )
        starts = starts.withColumn("n_distinct", F.size(F.array_distinct(F.transform(values, lambda s: s["v"]))))
        kept.append("n_distinct")
    starts = starts.select(
        *kept,
        (F.col("_bucket") - k).alias("_bucket"),
        (F.col("_sec") - seconds).alias("_at"),
        F.lit(0).cast("bigint").alias("_n"),
        F.lit(True).alias("_start"),
    )
    points = in_bucket.withColumns({"_at": F.col("_sec"), "_start": F.lit(False)})
    # At one second, a window's start comes before the rows, which belong to the window.
    upto = Window.partitionBy("client_id", "_bucket").orderBy("_at", F.desc("_start"))
    counted = points.unionByName(starts, allowMissingColumns=True).withColumn(
        "_upto", F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    at_start = lambda c: F.max(F.when(F.col("_start"), F.col(c)))
    parts = [F.max(F.when(~F.col("_start"), F.col("_upto"))).alias("_own"), at_start("_upto").alias("_gone")]
    parts += [at_start(c).alias(c) for c in kept[2:]]
    n = F.col("_before") + F.col("_own") - F.col("_gone")
    return (
        counted.groupBy("client_id", "_sec")
        .agg(*parts)
        .withColumn("n_in_window", n)
        .where(F.col("n_in_window") >= minimum)
        .drop("_before", "_own", "_gone")
    )


def _burst(
    txns: DataFrame, seconds: int, minimum: int, distinct: str | None = None
) -> DataFrame:
    """Transactions with at least ``minimum`` of the client's in their trailing window."""
    hits = trailing_counts(txns, seconds, minimum, distinct)
    on = ["client_id", "_sec", *([distinct] if distinct in hits.columns else [])]
    return txns.withColumn("_sec", epoch_seconds(F.col("initiated_at"))).join(hits, on).drop("_sec")


def velocity(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Many online transactions of a client within minutes."""
    online = txns.where("channel = 'ONLINE'").select(
        "txn_id", "client_id", "initiated_at", "amount"
    )
    return _burst(online, t.velocity_seconds, t.velocity_txns)


def card_testing(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Many tiny online amounts in quick succession."""
    tiny = txns.where("channel = 'ONLINE'").where(
        F.col("amount") <= F.lit(t.testing_amount).cast("decimal(14,2)")
    )
    return _burst(
        tiny.select("txn_id", "client_id", "initiated_at", "amount"),
        t.testing_seconds,
        t.testing_txns,
    )


def high_value(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """A single large foreign transaction, online or mobile."""
    return txns.where(
        (F.col("amount") > t.high_amount)
        & F.col("channel").isin("ONLINE", "MOBILE")
        & (F.col("is_international") == 1)
        & (F.col("currency") != t.home_currency)
    ).select("txn_id", "client_id", "initiated_at", "amount", "channel", "currency")


def night_owl(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Clients with several online or mobile transactions in the night hours of one date."""
    first, last = t.night_hours
    return (
        _at_night(txns, t)
        .groupBy("client_id", F.to_date("initiated_at").alias("txn_date"))
        .agg(
            F.count(F.lit(1)).alias("n_night"),
            F.min("initiated_at").alias("first_at"),
            F.max("initiated_at").alias("last_at"),
        )
        .where(F.col("n_night") >= t.night_txns)
    )


def _at_night(txns: DataFrame, t: Thresholds) -> DataFrame:
    first, last = t.night_hours
    return txns.where(
        F.hour("initiated_at").between(first, last) & F.col("channel").isin("ONLINE", "MOBILE")
    )


def international_spree(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Rapid foreign online transactions of a client, with the number of currencies."""
    foreign = txns.where(
        (F.col("channel") == "ONLINE")
        & (F.col("is_international") == 1)
        & (F.col("currency") != t.home_currency)
    ).select("txn_id", "client_id", "initiated_at", "amount", "currency")
    return _burst(foreign, t.spree_seconds, t.spree_txns, distinct="currency")


def account_takeover(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """A known client's first transaction from a device, large, online and foreign.

    First uses per client and device, and from them each client's start, are aggregates
    that combine before the shuffle; no client's history is ever gathered. Candidates meet
    them on the time as well, which spreads the rows of a busy device.
    """
    first_use = txns.groupBy("client_id", "device_id").agg(
        F.min("initiated_at").alias("initiated_at")
    )
    client_start = first_use.groupBy("client_id").agg(
        F.min("initiated_at").alias("client_first_at")
    )
    return (
        txns.where(
            (F.col("amount") >= t.takeover_amount)
            & (F.col("channel") == "ONLINE")
            & (F.col("currency") != t.home_currency)
        )
        .select("txn_id", "client_id", "device_id", "initiated_at", "amount", "currency")
        .join(first_use, ["client_id", "device_id", "initiated_at"])
        .join(client_start, "client_id")
        .where("initiated_at > client_first_at")
        .drop("client_first_at")
    )


def detections(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """``pattern, txn_id, client_id, amount`` over all six patterns."""
    night = _at_night(txns, t).withColumn("txn_date", F.to_date("initiated_at"))
    by_pattern = {
        "velocity_burst": velocity(txns, t),
        "card_testing": card_testing(txns, t),
        "high_value_fraud": high_value(txns, t),
        "night_owl": night.join(
            night_owl(txns, t).select("client_id", "txn_date"), ["client_id", "txn_date"]
        ),
        "international_spree": international_spree(txns, t),
        "account_takeover": account_takeover(txns, t),
    }
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("pattern"), "txn_id", "client_id", "amount")
            for name, df in by_pattern.items()
        ],
    )


def build_alerts(txns: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Alert rows: every rule label of every pattern a transaction shows."""
    labels = values_table(
        txns.sparkSession,
        [(p, rule) for p, rules in t.labels.items() for rule in rules],
        "pattern string, rule_triggered string",
    )
    return (
        detections(txns, t)
        .join(labels, "pattern")
        .select(
            "txn_id",
            "client_id",
            "pattern",
            "rule_triggered",
            capped_score(risk_band(F.col("amount"))).alias("risk_score"),
        )
    )


def candidates(txns: DataFrame) -> DataFrame:
    """The rule labels each flagged transaction may carry, one row per label."""
    rules = rule_candidates(F.col("amount"), F.col("channel"), F.col("is_international"))
    return txns.where("is_flagged = 1").select("txn_id", F.explode(rules).alias("rule"))


def rule_summary(alerts: DataFrame) -> DataFrame:
    """Alerts, reviews, confirmed share of reviews and mean score per rule."""
    confirmed, reviewed = F.sum("is_confirmed"), F.count("is_confirmed")
    return alerts.groupBy("rule_triggered").agg(
        F.count(F.lit(1)).alias("n_alerts"),
        reviewed.alias("n_reviewed"),
        F.coalesce(confirmed, F.lit(0)).alias("n_confirmed"),
        rate_pct(confirmed, reviewed).alias("confirmed_pct"),
        mean_scaled(F.col("risk_score"), 6).alias("avg_risk_score"),
    )


def pos_activity(terminals: DataFrame, txns: DataFrame) -> DataFrame:
    """Transactions per terminal; idle terminals count zero."""
    activity = (
        txns.where("pos_id IS NOT NULL")
        .groupBy("pos_id")
        .agg(
            F.count(F.lit(1)).alias("n_txns"),
            F.sum("amount").cast("decimal(18,2)").alias("total_amount"),
            F.max("initiated_at").alias("last_txn_at"),
        )
    )
    return (
        terminals.select("pos_id", "merchant_id")
        .join(activity, "pos_id", "left")
        .fillna(0, subset=["n_txns"])
    )


def default_card(cards: DataFrame) -> DataFrame:
    """Each client's first card."""
    return (
        cards.groupBy("client_id")
        .agg(
            F.count(F.lit(1)).alias("n_cards"),
            F.min_by(F.struct("card_id", "masked_pan"), "card_id").alias("card"),
        )
        .select("client_id", "n_cards", "card.card_id", "card.masked_pan")
    )
