import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txnlake.operators import cdc
from txnlake.sources import ingest
from txnlake.sources.tables import values_table
from txnlake.streaming.feeds import FEED_DDL, kafka_options

ROW = "id bigint, name string, amount decimal(14,2), extra struct<a: int>"
AT = datetime(2024, 1, 1)


def message(i, value, topic="cdc.payment_gateway.clients"):
    return (topic, i, AT, None if value is None else json.dumps(value))


@pytest.fixture
def feed(spark):
    rows = [
        message(0, {"id": 1, "name": "a", "amount": 1.5, "extra": {"a": 1}}),
        message(1, {"id": 1, "name": "b", "__op": "u", "__source_ts_ms": 10}),
        message(2, {"id": 2, "name": "c", "__op": "c", "__source_ts_ms": 10}),
        message(3, {"id": 2, "name": "c", "__op": "d", "__source_ts_ms": 20}),
        message(4, None),
        message(5, {"id": 3, "__op": "u", "__deleted": "true", "__source_ts_ms": 5}),
        message(6, {"id": 4, "name": "x", "__op": "c", "__source_ts_ms": 7}),
        message(7, {"id": 4, "name": "y", "__op": "u", "__source_ts_ms": 7}),
        message(8, {"ddl": "x"}, "debezium.schema-history"),
        message(9, {"id": 9}, "cdcXpayment_gateway.clients"),
    ]
    return spark.createDataFrame(rows, FEED_DDL)


def test_decode_applies_defaults_and_both_delete_marks(feed):
    rows = {r["offset"]: r for r in cdc.decoded(feed, ROW).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 5, 6, 7]
    assert rows[0]["op"] == "r" and not rows[0]["is_delete"]
    assert rows[0]["row"]["amount"] == Decimal("1.50")
    assert rows[3]["is_delete"] and rows[5]["is_delete"] and rows[5]["op"] == "u"
    assert {r["table_name"] for r in rows.values()} == {"clients"}


def test_a_broken_message_fails_rather_than_turning_into_nulls(spark):
    broken = spark.createDataFrame(
        [("cdc.payment_gateway.clients", 0, AT, "{not json")], FEED_DDL
    )
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        cdc.decoded(broken, ROW).collect()


def test_deletes_are_skipped_or_flagged_on_every_row(feed):
    changes = cdc.decoded(feed, ROW)
    assert cdc.handle_deletes(changes).count() == 5
    kept = {r["offset"]: r["_deleted"] for r in cdc.handle_deletes(changes, skip=False).collect()}
    assert kept == {0: False, 1: False, 2: False, 3: True, 5: True, 6: False, 7: False}


def test_lake_rows_are_plain_and_annotated(feed):
    rows = cdc.lake_rows(feed, ROW, ingest=F.lit(AT))
    assert not [c for c in rows.columns if c.startswith("__")]
    first = rows.where("offset = 0").collect()[0]
    assert first["amount"] == 1.5 and first["extra"] == '{"a":1}'
    assert (first["_cdc_op"], first["_cdc_ts_ms"]) == ("r", None)
    assert first["_cdc_ingest"] == "2024-01-01T00:00:00.000000"


def test_counts(feed):
    changes = cdc.decoded(feed, ROW)
    assert cdc.op_counts(changes).collect()[0].asDict() == {
        "table_name": "clients", "r": 1, "c": 2, "u": 3, "d": 1,
    }
    stats = {r["reason"]: r["n_messages"] for r in cdc.skip_stats(feed).collect()}
    assert stats == {"kept": 5, "delete": 2, "tombstone": 1}
    assert cdc.pending_by_table(changes, since_offset=5).collect()[0]["n_pending"] == 2


def test_current_state_takes_the_last_change_and_breaks_ties_by_offset(feed):
    changes = cdc.decoded(feed, ROW).select(
        "row.*", "table_name", "offset", "op", F.coalesce("ts_ms", F.lit(0)).alias("ts_ms"),
        "is_delete",
    )
    state = {r["id"]: r["name"] for r in cdc.current_state(changes, ["table_name", "id"]).collect()}
    assert state == {1: "b", 4: "y"}


def test_one_key_with_most_changes_shuffles_as_few_rows(spark):
    changes = spark.range(0, 30_000, 1, 6).selectExpr(
        "case when id % 3 = 0 then id else 0 end as pk", "id as ts_ms", "id as offset",
        "false as is_delete",
    )
    state = cdc.current_state(changes, ["pk"])
    assert state.where("pk = 0").collect()[0]["offset"] == 29_999
    assert state.count() == 10_000
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_dedupe_keeps_distinct_times(spark):
    rows = [(1, 10, 0), (1, 10, 1), (1, 11, 2), (2, 10, 3)]
    changes = spark.createDataFrame(rows, "pk long, ts_ms long, offset long")
    assert cdc.dedupe(changes, ["pk"]).count() == 3


def test_dedupe_keeps_all_changes_of_one_millisecond(spark):
    rows = [(1, 10, 0, "c", "a"), (1, 10, 1, "u", "b"), (1, 10, 2, "d", "b"), (1, 10, 3, "u", "b")]
    changes = spark.createDataFrame(
        rows, "pk long, ts_ms long, offset long, op string, name string"
    )
    assert [r["op"] for r in cdc.dedupe(changes, ["pk"]).orderBy("offset").collect()] == ["c", "u", "d"]


def test_broken_messages_are_told_apart(spark):
    topic = cdc.table_topic("clients")
    values = ['{"id": 1}', '{"id": ', "5", None, '{"id": 2, "__deleted": "true"}']
    feed = spark.createDataFrame(
        [(topic, i, v) for i, v in enumerate(values)], "topic string, offset long, value string"
    ).withColumn("timestamp", F.current_timestamp())
    stats = {r["reason"]: r["n_messages"] for r in cdc.skip_stats(feed).collect()}
    assert stats == {"kept": 1, "broken": 2, "tombstone": 1, "delete": 1}
    assert {r["offset"] for r in cdc.dead_letters(feed).collect()} == {1, 2}
    good = cdc.decoded(cdc.without_dead_letters(feed), "id long").collect()
    assert [r["row"]["id"] for r in good] == [1, 2]


def test_unwrap_keeps_the_last_image_of_a_delete(spark):
    image = {"id": 7, "name": "n", "amount": 2.25, "extra": None}
    source = {"ts_ms": 5, "table": "clients"}
    rows = [
        message(0, {"before": None, "after": image, "op": "c", "source": source}),
        message(1, {"before": image, "after": None, "op": "d", "source": source}),
        message(2, None),
    ]
    envelopes = spark.createDataFrame(rows, FEED_DDL)
    flat = cdc.unwrap_messages(envelopes, ROW)
    values = [r["value"] for r in flat.orderBy("offset").collect()]
    assert values[2] is None
    assert json.loads(values[0])["__deleted"] == "false"
    deleted = json.loads(values[1])
    assert deleted["id"] == 7 and deleted["__deleted"] == "true" and deleted["__op"] == "d"
    direct = cdc.unwrap(cdc.route(envelopes), ROW).orderBy("offset").collect()
    republished = cdc.decode(cdc.route(flat), ROW).orderBy("offset").collect()
    assert direct == republished and [r["is_delete"] for r in direct] == [False, True]


def test_envelope_text(spark):
    rows = spark.createDataFrame(
        [(1, Decimal("2.50"), AT, None)], "id long, amount decimal(14,2), at timestamp, note string"
    )
    sent = json.loads(cdc.envelope(rows, "clients", "c", F.lit(AT)).collect()[0]["value"])
    assert sent["_meta"] == {"table": "clients", "op": "c", "ts_ms": 1704067200000}
    assert sent["payload"] == {
        "id": 1, "amount": 2.5, "at": "2024-01-01T00:00:00.000000", "note": None,
    }


def test_messages_are_parsed_once(feed):
    kept = cdc.handle_deletes(cdc.decoded(feed, ROW))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_topic_pattern_escapes_dots():
    assert cdc.topic_pattern() == r"^cdc\.payment_gateway\..+"
    options = kafka_options("b:9092", flush_rows=100, flush_seconds=10)
    assert options["subscribePattern"] == cdc.topic_pattern()
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("100", "10s")
    assert options["startingOffsets"] == "earliest"
    one = kafka_options("b:9092", table="clients")
    assert one["subscribe"] == "cdc.payment_gateway.clients" and "subscribePattern" not in one


def test_poll_is_strict_and_keeps_the_mark_when_nothing_is_new(spark):
    rows = [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3))]
    tables = {"clients": spark.createDataFrame(rows, "client_id long, created_at timestamp_ntz")}
    mark = datetime(2024, 1, 2)
    assert [r["pk"] for r in ingest.poll_all(tables, mark).collect()] == [3]
    assert ingest.new_high_water(tables, mark).collect()[0]["high_water"] == datetime(2024, 1, 3)
    later = datetime(2024, 2, 1)
    kept = ingest.new_high_water(tables, later).collect()[0]
    assert (kept["n_rows"], kept["high_water"]) == (0, later)


def test_pending_tables_follow_the_latest_mark(spark):
    state = values_table(
        spark,
        [("clients", "completed", 1), ("refunds", "completed", 2), ("refunds", "reset", 3),
         ("merchants", "reset", 4), ("merchants", "completed", 5), ("clients", "started", 6)],
        "table_name string, status string, offset bigint",
    )
    pending = {r[0] for r in ingest.pending_tables(ingest.table_list(spark), state).collect()}
    assert "clients" not in pending and "merchants" not in pending
    assert "refunds" in pending and len(pending) == 11
