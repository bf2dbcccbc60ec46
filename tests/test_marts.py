from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnlake.plans import marts, rebuild, serve, staging
from txnlake.schemas import SERVING_TYPES
from txnlake.sources import serving
from txnlake.sources.tables import lookup_tables

TXN = (
    "txn_id bigint, reference string, client_id bigint, card_id bigint, pos_id bigint, "
    "merchant_id bigint, type_id int, status_id int, amount decimal(14,2), currency string, "
    "fee decimal(10,2), net_amount decimal(14,2), auth_code string, channel string, "
    "ip_address string, device_id string, is_recurring int, is_international int, "
    "is_flagged int, failure_reason string, initiated_at timestamp_ntz, "
    "processed_at timestamp_ntz, settled_at date, created_at timestamp_ntz"
)


def txn(txn_id, client_id=1, merchant_id=1, status_id=1, amount="10.00", flagged=0, at=None):
    at = at or datetime(2024, 1, 1, 12)
    money = Decimal(amount)
    return (
        txn_id, f"r{txn_id}", client_id, None, None, merchant_id, 1, status_id, money, "USD",
        Decimal("1.00"), money - 1, None, "ONLINE", None, None, 0, 0, flagged, None, at, at,
        None, at,
    )


@pytest.fixture(scope="module")
def small(spark):
    at = datetime(2024, 1, 1)
    rows = [
        txn(1, amount="10.00", flagged=1),
        txn(2, amount="10.01"),
        txn(3, merchant_id=2, status_id=2, amount="99.00"),
        txn(4, merchant_id=None, amount="5.00"),
        txn(5, status_id=99, amount="7.00"),
    ]
    return {
        **lookup_tables(spark),
        "countries": spark.createDataFrame(
            [(1, "US", "United States", "USD", at)],
            "country_id int, code string, name string, currency string, created_at timestamp_ntz",
        ),
        "transactions": spark.createDataFrame(rows, TXN),
        "merchants": spark.createDataFrame(
            [(1, "A", None, 5411, 1, "X", 1, at), (2, "B", "B Ltd", 9999, None, "Y", 1, at)],
            "merchant_id bigint, legal_name string, trade_name string, mcc int, country_id int, "
            "city string, is_active int, onboarded_at timestamp_ntz",
        ),
        "clients": spark.createDataFrame(
            [(1, "Ann", "Lee"), (2, "Bo", None)],
            "client_id bigint, first_name string, last_name string",
        ).selectExpr(
            "*", "'e@x' as email", "'' as phone", "date'2000-01-01' as date_of_birth",
            "1 as country_id", "'c' as city", "5 as risk_score", "1 as is_active",
            "timestamp_ntz'2020-01-01' as registered_at",
        ),
        "payment_cards": spark.createDataFrame([(10, 1), (11, 1)], "card_id long, client_id long"),
        "fraud_alerts": spark.createDataFrame(
            [(1, 1, 1), (2, 1, 0), (3, 4, None)], "alert_id long, txn_id long, is_confirmed int"
        ).selectExpr(
            "*", "'R' as rule_triggered", "70 as risk_score", "'x' as reviewed_by",
            "timestamp_ntz'2024-01-02' as reviewed_at", "timestamp_ntz'2024-01-01' as created_at",
        ),
    }


def test_daily_summary_keeps_unknown_status_and_rounds_half_up(small):
    rows = {r["status"]: r for r in marts.daily_transaction_summary(small).collect()}
    assert set(rows) == {"APPROVED", "DECLINED", None}
    approved = rows["APPROVED"]
    assert approved["txn_date"] == date(2024, 1, 1)
    assert (approved["txn_count"], approved["fraud_count"]) == (3, 1)
    assert approved["fraud_rate_pct"] == Decimal("33.33")
    assert approved["avg_txn_amount"] == Decimal("8.34")  # 25.01 / 3
    assert approved["max_txn_amount"] == Decimal("10.01")


def test_merchant_without_approved_rows_keeps_zero_and_nulls(small):
    rows = {r["merchant_id"]: r for r in marts.merchant_performance(small).collect()}
    assert rows[1]["total_txns"] == 2 and rows[1]["avg_txn_value"] == Decimal("10.01")
    assert rows[1]["fraud_rate_pct"] == Decimal("50.00")
    idle = rows[2].asDict()
    assert idle["total_txns"] == 0
    for column in ("gross_revenue", "avg_txn_value", "fraud_txns", "fraud_rate_pct", "category",
                   "country", "first_txn_at", "last_txn_at"):
        assert idle[column] is None


def test_client_360_zero_fills_and_skips_unknown_status(small):
    rows = {r["client_id"]: r for r in marts.client_360(small).collect()}
    assert (rows[1]["total_txns"], rows[1]["approved_txns"], rows[1]["declined_txns"]) == (4, 3, 1)
    assert (rows[1]["card_count"], rows[1]["fraud_txns"]) == (2, 1)
    assert rows[2]["full_name"] is None
    assert rows[2]["total_txns"] == 0 and rows[2]["total_spent"] == Decimal("0.00")
    assert rows[2]["last_txn_at"] is None


def test_fraud_analysis_outcomes_and_missing_merchant(small):
    rows = {r["alert_id"]: r for r in marts.fraud_analysis(small).collect()}
    assert [rows[i]["alert_outcome"] for i in (1, 2, 3)] == [
        "Confirmed Fraud", "False Positive", "Pending Review",
    ]
    assert rows[3]["merchant_name"] is None and rows[1]["client_name"] == "Ann Lee"


def test_marts_have_serving_columns_and_types(small):
    for name, build in marts.MARTS.items():
        schema = build(small).schema
        assert schema.names == list(SERVING_TYPES[name])
        for field in schema:
            kind = SERVING_TYPES[name][field.name]
            assert kind is None or field.dataType.simpleString() == kind, (name, field)


def test_staging_views(spark, small):
    staging.create_views(small)
    assert spark.table("stg_transactions").count() == 5
    assert "national_id" not in spark.table("stg_clients").columns


def test_rebuild_writes_checks_and_loads(spark, small, folder):
    not_null, unique = rebuild.rebuild(small, f"{folder}/marts")
    assert [r["n_violations"] for r in not_null.collect()] == [0] * 4
    assert [r["n_duplicate_keys"] for r in unique.collect()] == [0] * 3
    target = serving.ParquetTarget(f"{folder}/serving")
    assert all(rebuild.load_marts(spark, f"{folder}/marts", target).values())
    report = serving.reconcile(spark, f"{folder}/marts", target, list(marts.MARTS)).collect()
    assert len(report) == 5 and all(r["is_match"] == 1 for r in report)
    assert "loaded_at" in target.read(spark, "mart_client_360").columns


def test_empty_mart_leaves_the_target(spark, small, folder):
    target = serving.ParquetTarget(f"{folder}/serving")
    rebuild.write_marts(small, folder, ["mart_client_360"])
    assert serving.reload_mart(spark, folder, "mart_client_360", target)
    none = {**small, "clients": small["clients"].limit(0)}
    rebuild.write_marts(none, folder, ["mart_client_360"])
    assert not serving.reload_mart(spark, folder, "mart_client_360", target)
    assert target.read(spark, "mart_client_360").count() == 2


def test_serving_filters(small):
    analysis = marts.fraud_analysis(small)
    assert serve.fraud_alerts_for(analysis, outcome="Pending Review").count() == 1
    assert serve.fraud_alerts_for(analysis, min_risk=71).count() == 0
    assert serve.fraud_alerts_for(analysis, since=datetime(2024, 1, 1)).count() == 3


def test_daily_summary_of_stand_in_reads_orders_only(tables):
    plan = marts.daily_transaction_summary(tables)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan


def test_filter_and_columns_reach_the_scan(tables):
    df = tables["transactions"].where(F.col("txn_id") > 100).select("txn_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
