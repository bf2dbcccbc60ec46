"""Detectors against brute force, with hot clients and slice borders."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnlake.operators import fraud, settlement
from txnlake.sources.tables import lookup_tables

TXN = (
    "txn_id long, client_id long, initiated_at timestamp_ntz, amount decimal(14,2), "
    "channel string, currency string, is_international int, device_id string, is_flagged int"
)
START = datetime(2024, 1, 1)


def build(spark, rows):
    filled = [
        (i, client, at, Decimal(amount), channel, currency, intl, device, 1)
        for i, (client, at, amount, channel, currency, intl, device) in enumerate(rows)
    ]
    return spark.createDataFrame(filled, TXN)


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(7)
    rows = []
    for _ in range(1500):
        # Client 0 holds a third of the rows and is busy around slice borders.
        client = 0 if rng.random() < 0.34 else rng.randrange(1, 40)
        border = rng.randrange(0, 4) * 8 * 600
        offset = rng.randrange(-900, 900) if rng.random() < 0.6 else rng.randrange(0, 20_000)
        at = START + timedelta(seconds=max(0, border + offset))
        rows.append(
            (client, at, f"{rng.randrange(1, 4000)}.00", rng.choice(["ONLINE", "POS", "MOBILE"]),
             rng.choice(["USD", "EUR", "GBP", "AED"]), rng.randrange(2),
             rng.choice(["d1", "d2", "d3", None]))
        )
    return rows


def trailing(rows, seconds, keep):
    kept = [(i, r) for i, r in enumerate(rows) if keep(r)]
    for i, r in kept:
        window = [
            x for _, x in kept
            if x[0] == r[0] and 0 <= (r[1] - x[1]).total_seconds() <= seconds
        ]
        yield i, window


def test_velocity_matches_brute_force(spark, random_rows):
    online = lambda r: r[3] == "ONLINE"
    expected = {
        i: len(w) for i, w in trailing(random_rows, 600, online) if len(w) >= 5
    }
    got = {
        r["txn_id"]: r["n_in_window"] for r in fraud.velocity(build(spark, random_rows)).collect()
    }
    assert expected and got == expected


def test_card_testing_counts_only_tiny_amounts(spark):
    rows = [
        (1, START + timedelta(seconds=30 * i), "1.99" if i != 4 else "2.00", "ONLINE", "USD", 0, "d")
        for i in range(12)
    ]
    got = [r["n_in_window"] for r in fraud.card_testing(build(spark, rows)).orderBy("txn_id").collect()]
    assert got == [10, 11]


def test_spree_counts_currencies_like_brute_force(spark, random_rows):
    foreign = lambda r: r[3] == "ONLINE" and r[5] == 1 and r[4] != "USD"
    t = fraud.Thresholds(spree_seconds=600)
    expected = {
        i: (len(w), len({x[4] for x in w}))
        for i, w in trailing(random_rows, 600, foreign)
        if len(w) >= 3
    }
    got = {
        r["txn_id"]: (r["n_in_window"], r["n_distinct"])
        for r in fraud.international_spree(build(spark, random_rows), t).collect()
    }
    assert expected and got == expected


@pytest.mark.parametrize("seconds", [600, 601, 3600, 90])
def test_long_windows_by_buckets_equal_one_pass(spark, random_rows, monkeypatch, seconds):
    txns = build(spark, random_rows)
    hits = lambda **of: {
        (r["client_id"], r["_sec"], r["n_in_window"], r["n_distinct"] if of else 0)
        for r in fraud.trailing_counts(txns, seconds, 2, **of).collect()
    }
    one_pass = hits(), hits(distinct="currency")
    monkeypatch.setattr(fraud, "PASS_SECONDS", 0)
    assert (hits(), hits(distinct="currency")) == one_pass
    assert all(one_pass)


def test_long_windows_hold_no_slice_of_windows(spark):
    """A client with a transaction every minute of ten years, windows of 180 days."""
    txns = spark.range(0, 200_000).selectExpr(
        "id as txn_id", "0L as client_id",
        "timestamp_ntz'2014-01-01' + make_dt_interval(0, 0, id * 26, 0) as initiated_at",
    )
    counts = fraud.trailing_counts(txns, 180 * fraud.DAY_SECONDS)
    got = counts.agg(F.max("n_in_window"), F.min("n_in_window"), F.count("*")).first()
    assert tuple(got) == (180 * 24 * 60 // 26 + 1, 1, 200_000)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("_slice" in w or "_bucket" in w for w in windows)


def test_takeover_matches_brute_force(spark, random_rows):
    expected = set()
    for i, r in enumerate(random_rows):
        mine = [x for x in random_rows if x[0] == r[0]]
        first_use = r[6] is not None and r[1] == min(x[1] for x in mine if x[6] == r[6])
        known = min(x[1] for x in mine) < r[1]
        if first_use and known and float(r[2]) >= 500 and r[3] == "ONLINE" and r[4] != "USD":
            expected.add(i)
    rows = fraud.account_takeover(build(spark, random_rows)).collect()
    assert {r["txn_id"] for r in rows} == expected and len(rows) == len(expected)


def test_hot_client_spreads_over_slices(spark):
    txns = spark.range(0, 4000).selectExpr(
        "id as txn_id", "0L as client_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 60) as initiated_at",
    )
    counts = fraud.trailing_counts(txns, 600)
    assert counts.agg(F.max("n_in_window"), F.count("*")).collect()[0] == (11, 4000)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "_slice" in plan


def test_night_owl_hours(spark):
    day = datetime(2024, 3, 5)
    rows = [
        (1, day.replace(hour=1), "5.00", "ONLINE", "USD", 0, "d"),
        (1, day.replace(hour=4, minute=59), "5.00", "MOBILE", "USD", 0, "d"),
        (1, day.replace(hour=3), "5.00", "POS", "USD", 0, "d"),
        (2, day.replace(hour=0, minute=59), "5.00", "ONLINE", "USD", 0, "d"),
        (2, day.replace(hour=5), "5.00", "ONLINE", "USD", 0, "d"),
    ]
    got = fraud.night_owl(build(spark, rows)).collect()
    assert [(r["client_id"], r["n_night"]) for r in got] == [(1, 2)]


def test_alerts_carry_every_label_of_a_pattern(spark):
    rows = [(1, START + timedelta(hours=12), "3500.00", "MOBILE", "EUR", 1, "d")]
    got = fraud.build_alerts(build(spark, rows)).collect()
    assert {r["rule_triggered"] for r in got} == {
        "HIGH_AMOUNT", "RISK_SCORE_BREACH", "LARGE_TXN_ONLINE",
    }
    assert {r["risk_score"] for r in got} == {90}


def test_rule_candidates_are_distinct(spark):
    rows = [(1, START, "3500.00", "ONLINE", "EUR", 1, "d"), (1, START, "5.00", "POS", "USD", 0, "d")]
    got = fraud.candidates(build(spark, rows)).groupBy("txn_id").count().orderBy("txn_id").collect()
    assert [r["count"] for r in got] == [14, 6]  # VELOCITY_CHECK is in two lists


def test_settlement_age_and_refund_sums(spark):
    rows = [
        (i, 1, 1, datetime(2024, 1, d), Decimal("100.00"), Decimal("2.00"))
        for i, d in enumerate([1, 1, 8, 10])
    ]
    txns = spark.createDataFrame(
        rows,
        "txn_id long, merchant_id long, status_id int, initiated_at timestamp_ntz, "
        "amount decimal(14,2), fee decimal(10,2)",
    )
    batches = settlement.settlement_batches(txns, lookup_tables(spark)["transaction_statuses"])
    got = batches.orderBy("batch_date").collect()
    assert [(r["txn_count"], r["status"]) for r in got] == [
        (2, "SETTLED"), (1, "PENDING"), (1, "PENDING"),
    ]
    assert got[0]["net_payout"] == Decimal("196.00")
    assert got[0]["settled_at"] == datetime(2024, 1, 1, 22) and got[1]["settled_at"] is None

    at = datetime(2024, 1, 1)
    refunds = spark.createDataFrame(
        [(1, 0, Decimal("60.00"), at, at + timedelta(hours=5)),
         (2, 0, Decimal("60.00"), at, None), (3, 2, Decimal("100.00"), at, at)],
        "refund_id long, original_txn_id long, amount decimal(14,2), initiated_at timestamp_ntz, "
        "resolved_at timestamp_ntz",
    )
    out = {r["refund_id"]: r for r in settlement.reconcile_refunds(refunds, txns).collect()}
    assert (out[1]["is_partial"], out[1]["is_over"], out[1]["hours_to_resolve"]) == (1, 1, 5)
    assert out[2]["hours_to_resolve"] is None
    assert (out[3]["is_partial"], out[3]["is_over"]) == (0, 0)
