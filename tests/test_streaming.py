"""Streams over several micro-batches, with restarts from their checkpoints."""

import json
import os
import random
import subprocess
import sys
import tempfile
import time
from datetime import datetime, timedelta

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from txnlake.catalog import queries
from txnlake.operators import cdc
from txnlake.sources import lake
from txnlake.streaming import feeds, lake_sink, monitors, refresh, run, state

ROW = "pk bigint, name string"
START = datetime(2024, 1, 1)


class Feed:
    """A folder that receives change messages as files, one per ``add``."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.offset = spark, f"{folder}/feed", 0

    def add(self, *changes, at=START):
        rows = []
        for pk, op, name in changes:
            value = json.dumps({"pk": pk, "name": name, "__op": op, "__source_ts_ms": self.offset})
            rows.append(("cdc.payment_gateway.clients", self.offset, at, value))
            self.offset += 1
        self.spark.createDataFrame(rows, feeds.FEED_DDL).coalesce(1).write.mode("append").parquet(
            self.path
        )

    def stream(self):
        return feeds.file_feed(self.spark, self.path, files_per_batch=1)


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, folder)


def flat(feed):
    return cdc.decoded(feed.stream(), ROW).select(
        "table_name", "row.*", "ts_ms", "offset", "op", "is_delete", "timestamp"
    )


def test_state_over_batches_restart_and_compaction(spark, feed, folder):
    keys = ["table_name", "pk"]

    def sync():
        query = state.start_state_sink(flat(feed), keys, f"{folder}/state", f"{folder}/cp")
        query.awaitTermination()

    def names():
        return {r["pk"]: r["name"] for r in state.read_state(spark, f"{folder}/state", keys).collect()}

    feed.add((1, "c", "a"), (2, "c", "b"), (1, "u", "a2"))
    sync()
    assert names() == {1: "a2", 2: "b"}
    feed.add((2, "d", "b"), (3, "c", "c"))
    feed.add((3, "u", "c2"))
    sync()
    assert names() == {1: "a2", 3: "c2"}
    # A replay of a batch overwrites what it wrote.
    root = f"{folder}/state"
    again = spark.read.parquet(f"{root}/batches").where("batch_id = 1").drop("batch_id")
    again = spark.createDataFrame(again.collect(), again.schema)
    for _ in range(2):
        state._store(again, root, 1)
    assert spark.read.parquet(f"{root}/batches").where("batch_id = 1").count() == again.count()
    state.fold(spark, root, keys, upto=2)
    assert names() == {1: "a2", 3: "c2"}
    assert state.stored_changes(spark, root).count() == 3


def test_no_key_is_lost_when_a_folded_batch_is_stored_again(spark, folder):
    def batch(*rows):
        ddl = "pk long, name string, ts_ms long, offset long, op string, is_delete boolean"
        return spark.createDataFrame([(k, n, t, t, "c", False) for k, n, t in rows], ddl)

    root, last = f"{folder}/state", batch((3, "c", 3))
    state._store(batch((1, "a", 1), (2, "b", 2)), root, 0)
    state._store(last, root, 1)
    state.fold(spark, root, ["pk"], 1)
    state._store(last, root, 1)
    # A base that was written but never announced does not count.
    batch((9, "z", 9)).write.parquet(f"{root}/bases/upto=7")
    assert {r["pk"] for r in state.read_state(spark, root, ["pk"]).collect()} == {1, 2, 3}
    state._store(batch((2, "b2", 5)), root, 2)
    found = {r["pk"]: r["name"] for r in state.read_state(spark, root, ["pk"]).collect()}
    assert found == {1: "a", 2: "b2", 3: "c"}


def test_the_stream_folds_its_own_batches(spark, feed, folder):
    keys, root = ["table_name", "pk"], f"{folder}/state"
    for i in range(5):
        feed.add((i, "c", f"n{i}"), (0, "u", f"z{i}"))
        state.start_state_sink(
            flat(feed), keys, root, f"{folder}/cp", fold_every=2
        ).awaitTermination()
    assert state._newest_base(spark, root) == 3
    found = {r["pk"]: r["name"] for r in state.read_state(spark, root, keys).collect()}
    assert found == {0: "z4", 1: "n1", 2: "n2", 3: "n3", 4: "n4"}


def test_stream_state_equals_batch_state(spark, feed, folder):
    for i in range(4):
        feed.add(*[((i * 7 + j) % 11, "cud"[(i + j) % 3], f"n{i}{j}") for j in range(9)])
    keys = ["table_name", "pk"]
    state.start_state_sink(flat(feed), keys, f"{folder}/s", f"{folder}/c").awaitTermination()
    batch = cdc.decoded(spark.read.schema(feeds.FEED_DDL).parquet(feed.path), ROW).select(
        "table_name", "row.*", "ts_ms", "offset", "op", "is_delete"
    )
    rows = lambda df: sorted(map(tuple, df.select("pk", "name", "offset").collect()))
    assert rows(state.read_state(spark, f"{folder}/s", keys)) == rows(cdc.current_state(batch, keys))


def test_lake_sink_goes_on_after_a_restart_without_repeats(spark, feed, folder):
    def sync():
        lake_sink.start_lake_sink(
            feed.stream(), "clients", ROW, f"{folder}/raw", f"{folder}/cp",
            ingest=F.col("timestamp"), compression="gzip",
        ).awaitTermination()
        return lake.read_lake(spark, f"{folder}/raw/clients")

    feed.add((1, "c", "a"), (2, "d", "b"))
    assert sync().count() == 1
    assert sync().count() == 1
    feed.add((3, "c", "c"), at=START + timedelta(days=1))
    rows = sync().orderBy("pk").collect()
    assert [(r["pk"], r["_cdc_op"], r["day"]) for r in rows] == [(1, "c", 1), (3, "c", 2)]


def test_refresh_by_rows_and_by_time_survives_restarts(spark, feed, folder):
    fired = []
    rule = refresh.RefreshRule(rows=4, seconds=100)

    def sync():
        trigger = refresh.RefreshTrigger(
            spark, f"{folder}/log", fired.append, rule,
            clock=lambda b: b.agg(F.max("timestamp")).collect()[0][0],
        )
        trigger.start(flat(feed), f"{folder}/cp").awaitTermination()
        return trigger

    feed.add((1, "c", "a"), at=START)
    sync()
    feed.add((2, "c", "a"), (3, "d", "a"), (4, "u", "a"), at=START + timedelta(seconds=10))
    sync()
    assert fired == ["rows"]
    feed.add((1, "u", "b"), at=START + timedelta(seconds=60))
    sync()
    feed.add((1, "u", "c"), at=START + timedelta(seconds=110))
    trigger = sync()
    assert fired == ["rows", "time"]
    log = trigger.decisions().orderBy("batch_id").collect()
    assert [(r["pending"], r["reason"]) for r in log] == [
        (1, "none"), (4, "rows"), (1, "none"), (2, "time"),
    ]
    trigger.final_pass(4)
    assert fired == ["rows", "time"]
    feed.add((1, "u", "d"), at=START + timedelta(seconds=120))
    sync().final_pass(5)
    assert fired[-1] == "shutdown"


def test_refresh_fires_by_time_while_nothing_arrives(spark, feed, folder):
    fired = []
    trigger = refresh.RefreshTrigger(
        spark, f"{folder}/log", fired.append, refresh.RefreshRule(rows=100, seconds=2)
    )
    feed.add((1, "c", "a"), (2, "c", "a"))
    query = trigger.start(flat(feed), f"{folder}/cp", every="1 second")
    try:
        until = time.time() + 60
        while not fired and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert fired[:1] == ["time"]


def test_timers_fire_while_nothing_arrives_for_each_mart_alone(spark, feed, folder):
    fired = []
    feed.add((1, "c", "a"))  # too few; silence follows
    marts = {"of_clients": ["clients", "merchants"], "of_cards": ["payment_cards"]}
    query = refresh.start_refreshes(
        flat(feed), lambda mart, reason: fired.append((mart, reason)), f"{folder}/log", f"{folder}/cp",
        "1 second", refresh.RefreshRule(rows=5, seconds=5), marts,
    )

    def logged():
        if not os.path.isdir(f"{folder}/log"):
            return []
        return spark.read.schema(refresh.DECISION_DDL).parquet(f"{folder}/log").orderBy("decided_at").collect()

    def wait(n):
        until = time.time() + 90
        while len(logged()) < n and time.time() < until:
            time.sleep(0.3)

    try:
        wait(1)
        feed.add(*[(i, "u", "b") for i in range(6)])
        wait(2)
    finally:
        query.stop()
    assert fired == [("of_clients", "time"), ("of_clients", "rows")]
    log = logged()
    assert [(r["n_events"], r["pending"], r["reason"]) for r in log] == [(0, 1, "time"), (6, 6, "rows")]
    assert log[0]["elapsed_seconds"] >= 5


def walked(seconds, rule, tick_seconds):
    """Decisions tick by tick."""
    ticks = [(int(START.timestamp()) + s) // tick_seconds for s in seconds]
    pending, since, out = 0, min(ticks) * tick_seconds, []
    for tick in range(min(ticks), max(ticks) + 1):
        n, end = ticks.count(tick), (tick + 1) * tick_seconds
        pending += n
        reason = rule.reason(pending, end - since)
        out.append((tick * tick_seconds, n, pending, end - since, reason))
        if reason != "none":
            pending, since = 0, end
    return out


@pytest.mark.parametrize("segment", [1, 16, 65_536])
@pytest.mark.parametrize("rule", [(2, 5), (8, 60), (50, 200)])
def test_decisions_equal_a_walk(spark, rule, segment):
    rng, at, seconds = random.Random(rule[0]), 0, []
    for _ in range(60):
        at += rng.choice([0, 0, 1, 7, rng.randrange(40), rng.randrange(700)])
        seconds.append(at)
    rule = refresh.RefreshRule(*rule)
    changes = spark.createDataFrame(
        [(START + timedelta(seconds=s),) for s in seconds], "timestamp timestamp"
    )
    rows = refresh.refresh_decisions(changes, rule, 10, segment).collect()
    second = lambda r: int((r["tick_start"] - START).total_seconds() + START.timestamp())
    got = [(second(r), r["n_events"], r["pending"], r["elapsed_seconds"], r["reason"]) for r in rows]
    assert sorted(got) == walked(seconds, rule, 10)


def test_no_changes_no_decisions(spark):
    none = spark.createDataFrame([], "timestamp timestamp")
    assert refresh.refresh_decisions(none).count() == 0


def test_refresh_decisions_count_empty_ticks(spark):
    seconds = [0, 1, 2, 35, 95]
    changes = spark.createDataFrame(
        [(START + timedelta(seconds=s),) for s in seconds], "timestamp timestamp"
    )
    rule = refresh.RefreshRule(rows=3, seconds=60)
    got = refresh.refresh_decisions(changes, rule, 10).orderBy("tick_start").collect()
    assert [(r["n_events"], r["pending"], r["reason"]) for r in got] == [
        (3, 3, "rows"), (0, 0, "none"), (0, 0, "none"), (1, 1, "none"), (0, 1, "none"),
        (0, 1, "none"), (0, 1, "time"), (0, 0, "none"), (0, 0, "none"), (1, 1, "none"),
    ]


def test_decisions_follow_the_rule_and_pickle_without_the_package(spark):
    rule = refresh.RefreshRule(rows=3, seconds=60)
    events = [0, 5, 12, 14, 15, 90, 91, 300, 301, 302, 303, 500]
    changes = spark.createDataFrame(
        [(START + timedelta(seconds=s),) for s in events], "timestamp timestamp"
    )
    for row in refresh.refresh_decisions(changes, rule, 10).collect():
        assert row["reason"] == rule.reason(row["pending"], row["elapsed_seconds"])
    script = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('rows', e.queries()['refresh_trigger'](spark, sys.argv[2]).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", script, root, SF_DIR],
        cwd=tempfile.gettempdir(), env=env, capture_output=True, text=True, timeout=180,
    )
    assert "rows " in done.stdout, done.stderr[-2000:]


def test_dedupe_across_batches(spark, feed, folder):
    feed.add((1, "c", "a"))
    feed.offset = 0  # the same delivery again
    feed.add((1, "c", "a"))
    feed.add((1, "u", "b"))
    out = monitors.dedupe(flat(feed), ["table_name", "pk"])
    run.append_to(out, f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_a_client_that_never_pauses_is_reported(spark, feed, folder):
    for minute in range(0, 100, 10):
        at = START + timedelta(minutes=minute)
        feed.add(*[(i, "c", "x") for i in range(3)], at=at)
    txns = flat(feed).selectExpr("timestamp as initiated_at", "'ONLINE' as channel", "0L as client_id")
    out = monitors.velocity_sessions(txns, minimum=2, gap="20 minutes", longest_seconds=1800)
    run.append_to(out, f"{folder}/out", f"{folder}/cp").awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").orderBy("window_start").collect()
    assert [(r["window_start"].hour * 60 + r["window_start"].minute, r["n_txns"]) for r in rows] == [(0, 9), (30, 9)]


def test_rows_are_counted_before_windows_copy_them(spark, feed, folder):
    for minute in (0, 1, 2, 3, 30, 60):
        feed.add(*[(i, "c", "x") for i in range(50)], at=START + timedelta(minutes=minute))
    txns = flat(feed).selectExpr("timestamp as initiated_at", "'ONLINE' as channel", "0L as client_id")
    out = monitors.velocity_windows(txns, minimum=100)
    query = run.append_to(out, f"{folder}/out", f"{folder}/cp")
    query.awaitTermination()
    rows = {r["window_start"]: r["n_txns"] for r in spark.read.parquet(f"{folder}/out").collect()}
    minutes = lambda start: [m for m in (0, 1, 2, 3, 30) if start <= m < start + 10]
    want = {START + timedelta(minutes=m): 50 * len(minutes(m)) for m in range(-9, 41) if len(minutes(m)) > 1}
    assert rows == want


def test_late_rows_are_dropped_and_open_windows_wait(spark, feed, folder):
    for minute in (0, 30, 40, 1, 60):  # the fourth is late by then
        feed.add((minute, "c", "x"), at=START + timedelta(minutes=minute))
    txns = flat(feed).withColumn("created_at", F.col("timestamp"))
    out = monitors.ingestion_rate(txns)
    run.append_to(out, f"{folder}/out", f"{folder}/cp").awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").orderBy("window_start").collect()
    assert [(r["window_start"].minute, r["n_rows"]) for r in rows] == [(0, 1), (30, 2)]
    assert {r["status"] for r in rows} == {"WARN"}


def test_state_partitions_grow_with_the_input(spark, folder, monkeypatch):
    spark.range(0, 50_000, 1, 2).selectExpr("uuid() AS u").write.parquet(f"{folder}/in")
    size = sum(os.path.getsize(f"{folder}/in/{n}") for n in os.listdir(f"{folder}/in"))
    assert run.state_partitions(spark, f"{folder}/in") == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(run, "PARTITION_BYTES", 100_000)
    assert run.state_partitions(spark, f"{folder}/in") == pytest.approx(size / 100_000, abs=2)
    monkeypatch.setattr(run, "PARTITION_BYTES", 4_000)
    want = run.state_partitions(spark, f"{SF_DIR}/events.parquet")
    assert want > spark.sparkContext.defaultParallelism
    began = []
    monkeypatch.setattr(run, "state_conf", lambda s, n=None, f=run.state_conf: began.append(n) or f(s, n))
    queries()["stream_fraud_velocity"](spark, SF_DIR)
    assert began == [want]
