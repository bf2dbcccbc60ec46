"""State in buckets against the changes folded at once."""

import random
import re

import pytest

from txnlake.operators import cdc
from txnlake.session import session_conf, subfolders
from txnlake.streaming import keyed_state

DDL = "table_name string, pk bigint, name string, ts_ms bigint, offset bigint, op string, is_delete boolean"
KEYS = ["table_name", "pk"]


def changes(spark, rng, n, first):
    rows = []
    for offset in range(first, first + n):
        op = rng.choice("cuud")
        rows.append((rng.choice("ab"), rng.randrange(12), f"n{offset}", rng.randrange(50), offset, op, op == "d"))
    return spark.createDataFrame(rows, DDL)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("table_name", "pk", "name", "ts_ms", "offset", "op").collect())


@pytest.fixture
def state(spark, folder):
    return keyed_state.KeyedState(spark, f"{folder}/state", KEYS, buckets=3)


def test_batches_folds_and_replays(spark, state):
    rng, log = random.Random(2), None
    for batch in range(9):
        new = changes(spark, rng, 15, batch * 15)
        # A batch also brings some changes again that an earlier one held.
        new = new if log is None else new.unionByName(log.where(f"offset % 9 = {batch}"))
        log = new if log is None else log.unionByName(new)
        log = spark.createDataFrame(log.collect(), DDL)
        for _ in range(1 + (batch % 4 == 2)):
            state.store(new, batch)
        if batch in (2, 4, 6):
            state.fold(batch - 1)
            state.fold(batch - 1)
    again = keyed_state.KeyedState(spark, state.root, KEYS, buckets=50)
    assert again.buckets == 3
    assert rows_of(again.read()) == rows_of(cdc.current_state(log.dropDuplicates(), KEYS))
    assert rows_of(again.newest(8)) == rows_of(cdc.latest_changes(log.dropDuplicates(), KEYS))
    kept = lambda name: sorted(subfolders(spark, f"{state.root}/{name}"))
    assert kept("rows/kind=base") == kept("folds") == [3, 5]
    assert kept("rows/kind=batch") == [4, 5, 6, 7, 8]


def test_no_shuffle_and_no_sorted_rows(spark, state):
    rng = random.Random(1)
    for batch in range(4):
        state.store(changes(spark, rng, 20, batch * 20), batch)
    state.fold(1)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = state.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert not [line for line in plan.splitlines() if "Aggregate" in line and re.search(r"\bname#", line)]


def test_a_base_that_was_not_announced_does_not_count(spark, state):
    rng = random.Random(4)
    state.store(changes(spark, rng, 10, 0), 0)
    before = rows_of(state.read())
    state._write(changes(spark, rng, 10, 90), "base", 7)
    assert rows_of(state.read()) == before


def test_changes_without_a_key_are_left_out(spark, state):
    rows = [("a", None, "x", 1, 1, "c", False), ("a", 1, "y", 1, 2, "c", False)]
    state.store(spark.createDataFrame(rows, DDL), 0)
    assert [r["name"] for r in state.read().collect()] == ["y"]


def test_folders_stay_bounded(spark, state):
    rng, most = random.Random(5), 0
    for batch in range(12):
        state.store(changes(spark, rng, 4, batch * 4), batch)
        if batch and batch % 2 == 0:
            state.fold(batch - 1)
        most = max(most, len(subfolders(spark, f"{state.root}/rows/kind=batch")))
    assert most <= 5
