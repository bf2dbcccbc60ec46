from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnlake.operators import key_pages, monitor, quality
from txnlake.schemas import ForeignKey


@pytest.fixture(scope="module")
def planted(spark):
    return {
        "clients": spark.createDataFrame(
            [(1, "A@x.com", 50, "n1"), (2, "a@X.com", 0, None), (2, "b@x.com", 101, None),
             (None, None, None, "n2")],
            "client_id long, email string, risk_score int, national_id string",
        ),
        "settlement_batches": spark.createDataFrame(
            [(1, 1, "2024-01-01", "PENDING"), (2, 1, "2024-01-01", "LOST"),
             (3, 1, "2024-01-02", None), (4, 9, "2024-01-01", "FAILED"), (5, None, "2024-01-01", "X")],
            "batch_id long, merchant_id long, batch_date string, status string",
        ),
        "merchants": spark.createDataFrame([(1,), (2,)], "merchant_id long"),
    }


def by_name(df):
    return {r["check_name"]: tuple(r)[1:] for r in df.collect()}


def test_row_checks_count_planted_violations(planted):
    checks = [
        quality.not_null("clients", "client_id"),
        quality.in_range("clients", "risk_score", 1, 100),
        quality.accepted_values("settlement_batches", "status", ["PENDING", "FAILED"]),
    ]
    assert by_name(quality.row_checks(planted, checks)) == {
        "clients.client_id not_null": (4, 1),
        "clients.risk_score range": (4, 2),
        "settlement_batches.status accepted_values": (5, 2),
    }


def test_unique_keys_ignore_nulls_and_case_of_email(planted):
    keys = [
        ("clients", ("client_id",)),
        ("clients", ("lower(email)",)),
        ("clients", ("national_id",)),
        ("settlement_batches", ("merchant_id", "batch_date")),
        ("merchants", ("merchant_id",)),
    ]
    assert by_name(quality.unique_keys(planted, keys)) == {
        "clients.client_id unique": (1, 1),
        "clients.lower(email) unique": (1, 1),
        "clients.national_id unique": (0, 0),
        "settlement_batches.merchant_id+batch_date unique": (1, 1),
        "merchants.merchant_id unique": (0, 0),
    }


def test_composite_keys_do_not_run_together(spark):
    tables = {"t": spark.createDataFrame([("a,b", "c"), ("a", "b,c")], "x string, y string")}
    assert by_name(quality.unique_keys(tables, [("t", ("x", "y"))])) == {"t.x+y unique": (0, 0)}


def test_referential_counts_orphan_rows(planted):
    fks = [ForeignKey("settlement_batches", "merchant_id", "merchants")]
    assert by_name(quality.referential(planted, fks)) == {"settlement_batches.merchant_id": (1, 1)}


def test_a_table_is_scanned_once_for_all_its_references(tables):
    from txnlake.schemas import FOREIGN_KEYS

    only = [fk for fk in FOREIGN_KEYS if fk.child == "payment_cards"]
    given = {t: tables[t] for t in ("payment_cards", "clients", "card_networks")}
    assert set(by_name(quality.referential(given, only)).values()) == {(0, 0)}


AS_OF = datetime(2024, 1, 1, 12)


@pytest.fixture(scope="module")
def recent(spark):
    rows = [
        (i, AS_OF - timedelta(minutes=m), AS_OF - timedelta(minutes=m), f)
        for i, (m, f) in enumerate([(0, 1), (14, 0), (15, 1), (16, 0), (59, 1), (61, 1)])
    ]
    return spark.createDataFrame(
        rows, "txn_id long, created_at timestamp_ntz, initiated_at timestamp_ntz, is_flagged int"
    )


def test_ingestion_rate_slice_includes_its_start(recent):
    assert monitor.ingestion_rate(recent).collect()[0].asDict() == {
        "n_recent": 3, "min_recent": 5, "status": "WARN",
    }


def test_fraud_spike_and_its_empty_slice(recent):
    row = monitor.fraud_spike(recent).collect()[0]
    assert (row["total"], row["flagged"], float(row["fraud_pct"]), row["status"]) == (
        5, 3, 60.0, "WARN",
    )
    empty = monitor.fraud_spike(recent, as_of=datetime(2030, 1, 1)).collect()[0]
    assert (empty["total"], empty["fraud_pct"], empty["status"]) == (0, None, "OK")


def test_row_counts_unreviewed_and_freshness(spark, recent):
    counts = monitor.min_row_counts({"transactions": recent}, {"transactions": 7}).collect()[0]
    assert (counts["n_rows"], counts["status"]) == (6, "ERROR")
    alerts = spark.range(60).selectExpr("90 as risk_score", "cast(null as int) as is_confirmed")
    assert monitor.unreviewed_high_risk(alerts).collect()[0]["status"] == "WARN"
    fresh = monitor.freshness(
        {"transactions": recent, "clients": recent.where("txn_id = 5"),
         "refunds": recent.where("false")},
        max_age_seconds=3600,
    )
    assert {r["table_name"]: (r["age_seconds"], r["status"]) for r in fresh.collect()} == {
        "transactions": (0, "OK"), "clients": (3660, "WARN"), "refunds": (None, "WARN"),
    }


def test_backlog_counts_tables_with_nothing_archived(spark):
    published = spark.createDataFrame([("a",), ("a",), ("b",)], "table_name string")
    out = monitor.backlog(published, published.where("table_name = 'a'").limit(1))
    assert {r["table_name"]: r["n_backlog"] for r in out.collect()} == {"a": 1, "b": 1}


@pytest.fixture(scope="module")
def many(spark):
    """A hot repeated key, keys on both sides of zero, sparse keys, texts, and orphans of each kind."""
    rows = [(k, f"r{k}", k % 50 if k % 97 else None) for k in range(-300, 300)]
    rows += [(7, "hot", 3)] * 400 + [(10**15 + k * 1000, None, 60 + k) for k in range(70)]
    rows += [(-300, "r-300", 10**12), (-300, "r-300", 10**12), (None, "r1", -1)]
    ddl = "txn_id long, reference string, client_id long"
    return {
        "transactions": spark.createDataFrame(rows, ddl).repartition(5),
        "clients": spark.createDataFrame([(k,) for k in range(64)], "client_id int"),
    }, rows


KEYS = [
    ("transactions", ("txn_id",)),
    ("transactions", ("reference",)),
    ("transactions", ("txn_id", "reference")),
    ("clients", ("client_id",)),
]


def test_pages_find_repeats_as_counting_does(many):
    tables, rows = many
    want = {}
    for (table, columns), key in zip(KEYS, [lambda r: r[0], lambda r: r[1], lambda r: r[:2], None], strict=True):
        if key is None:
            values = list(range(64))
        else:
            values = [key(r) for r in rows]
            values = [v for v in values if v is not None and not (isinstance(v, tuple) and None in v)]
        n = {v: values.count(v) for v in set(values)}
        repeated = [c for c in n.values() if c > 1]
        want[quality.key_name(table, columns)] = (len(repeated), sum(repeated) - len(repeated))
    assert by_name(quality.unique_keys(tables, KEYS)) == want
    assert want["transactions.txn_id unique"] == (2, 402)


def test_pages_by_day_merge_to_the_pages_of_all(many):
    tables, _ = many
    dated = {t: df.withColumn("day", F.pmod(F.xxhash64(*df.columns), F.lit(3))) for t, df in tables.items()}
    pages = key_pages.key_pages(dated, KEYS, "day")
    merged = {tuple(r) for r in key_pages.merge_pages(pages).select("check", "slot", "bits", "n").collect()}
    whole = {tuple(r) for r in key_pages.key_pages(tables, KEYS).select("check", "slot", "bits", "n").collect()}
    assert merged == whole
    assert by_name(quality.unique_keys(tables, KEYS, pages)) == by_name(quality.unique_keys(tables, KEYS))
    # A dense key of 600 values takes a tenth of a row per value.
    assert sum(1 for r in whole if r[0] == 0 and abs(r[1]) < 10) == 10


def test_pages_find_orphans_as_sets_do(many):
    tables, rows = many
    used = [r[2] for r in rows if r[2] is not None]
    lost = [c for c in used if not 0 <= c < 64]
    got = by_name(quality.referential(tables, [ForeignKey("transactions", "client_id", "clients")]))
    assert got == {"transactions.client_id": (len(set(lost)), len(lost))}
    assert len(set(lost)) > 60


def test_only_suspects_are_read_again(spark, many):
    clean = {"clients": many[0]["clients"], "transactions": many[0]["transactions"].where("client_id BETWEEN 0 AND 59")}
    plan = quality.referential(clean, [ForeignKey("transactions", "client_id", "clients")])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "txn_id" not in text and "client_id" not in text.replace("transactions.client_id", "")


def test_empty_tables_have_no_repeats_and_no_orphans(spark):
    empty = {
        "transactions": spark.createDataFrame([], "txn_id long, reference string, client_id long"),
        "clients": spark.createDataFrame([], "client_id long"),
    }
    assert set(by_name(quality.unique_keys(empty, KEYS)).values()) == {(0, 0)}
    assert by_name(quality.referential(empty, [ForeignKey("transactions", "client_id", "clients")])) == {
        "transactions.client_id": (0, 0)
    }
