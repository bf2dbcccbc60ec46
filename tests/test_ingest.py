import json
from datetime import datetime, timedelta

import pytest

from txnlake.sources import ingest

DDL = "client_id long, name string, created_at timestamp_ntz"


def clients(spark, *rows):
    return {"clients": spark.createDataFrame([(i, n, datetime(2024, 1, d)) for i, n, d in rows], DDL)}


def test_full_load_resumes_after_completed_tables(spark, folder):
    tables = {
        **clients(spark, (1, "a", 1), (2, "b", 2)),
        "card_networks": spark.createDataFrame([(1, "Visa", "^4")], "network_id int, name string, prefix_regex string"),
    }
    assert sorted(ingest.full_load(tables, folder)) == ["card_networks", "clients"]
    assert ingest.full_load(tables, folder) == []
    ingest.set_state(spark, folder, "clients", "reset")
    assert ingest.full_load(tables, folder) == ["clients"]
    state = ingest.load_state(spark, folder).orderBy("offset").collect()
    assert [(r["offset"], r["status"]) for r in state] == [
        (0, "completed"), (1, "completed"), (2, "reset"), (3, "completed"),
    ]
    assert {r["table_name"]: r["n_rows"] for r in state if r["n_rows"]} == {
        "clients": 2, "card_networks": 1,
    }
    texts = [json.loads(r["value"]) for r in spark.read.parquet(f"{folder}/snapshot/clients").collect()]
    assert {t["_meta"]["op"] for t in texts} == {"r"}
    assert sorted(t["payload"]["name"] for t in texts) == ["a", "b"]


def test_poll_cycles_lose_and_repeat_nothing(spark, folder):
    sent = []

    def publish(messages):
        sent.extend(json.loads(r["value"])["payload"]["client_id"] for r in messages.collect())

    start = datetime(2024, 1, 1)
    run = lambda cycle, *rows: ingest.poll_cycle(
        clients(spark, *rows), folder, cycle, start, publish
    )
    rows = [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    assert run(0, *rows) == {"clients": datetime(2024, 1, 3)}
    assert sorted(sent) == [2, 3]
    assert run(1, *rows) == {"clients": datetime(2024, 1, 3)}
    assert sorted(sent) == [2, 3]
    assert run(2, *rows, (4, "d", 9)) == {"clients": datetime(2024, 1, 9)}
    assert sorted(sent) == [2, 3, 4]
    # A repeated cycle sees the marks before it.
    assert run(2, *rows, (4, "d", 9)) == {"clients": datetime(2024, 1, 9)}
    assert spark.read.parquet(f"{folder}/polled").count() == 3


def test_rows_committed_late_arrive_once(spark, folder):
    sent = []

    def publish(messages):
        sent.extend(json.loads(r["value"])["payload"]["client_id"] for r in messages.collect())

    start, rows = datetime(2024, 1, 1), [(1, "a", 1), (2, "b", 2), (3, "c", 9)]
    run = lambda cycle: ingest.poll_cycle(
        clients(spark, *rows), folder, cycle, start, publish, timedelta(days=3)
    )
    assert run(0) == {"clients": datetime(2024, 1, 9)} and sorted(sent) == [2, 3]
    # With the mark's own time, within the span, and before it.
    rows += [(4, "d", 9), (5, "e", 7), (6, "f", 3)]
    for _ in range(2):  # a repeated cycle sends the same
        sent.clear()
        assert run(1) == {"clients": datetime(2024, 1, 9)} and sorted(sent) == [4, 5]
    sent.clear()
    assert run(2) == {"clients": datetime(2024, 1, 9)} and sent == []
    rows.append((7, "g", 20))
    assert run(3) == {"clients": datetime(2024, 1, 20)} and sent == [7]
    # What is remembered spans the overlap alone.
    kept = {n: spark.read.parquet(f"{folder}/sent/cycle={n}").count() for n in (1, 3)}
    assert kept == {1: 3, 3: 1}


def test_marks_per_table(spark):
    tables = clients(spark, (1, "a", 1), (2, "b", 2))
    got = ingest.new_high_water(tables, {"clients": datetime(2024, 1, 1)}).collect()[0]
    assert (got["n_rows"], got["high_water"]) == (1, datetime(2024, 1, 2))
    with pytest.raises(KeyError):
        ingest.poll_all(tables, {})
