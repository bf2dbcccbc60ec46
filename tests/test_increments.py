"""Marts kept by increments against marts built anew."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.plans import increments, marts
from txnlake.sources import stand_in

KEYS = {"transactions": "txn_id", "payment_cards": "card_id", "fraud_alerts": "alert_id", "clients": "client_id"}


def random_rows(tables, rng, batches):
    """Versions of small tables: rows come, change, move between groups and go."""
    some = {t: [r.asDict() for r in tables[t].orderBy(k).limit(30).collect()] for t, k in KEYS.items()}
    ids = [r["txn_id"] for r in some["transactions"]]
    now = {t: {} for t in KEYS}
    for _ in range(batches):
        for table, key in KEYS.items():
            for row in some[table]:
                if rng.random() < 0.4:
                    continue
                if rng.random() < 0.25:
                    now[table].pop(row[key], None)
                    continue
                row = dict(row)
                if table == "transactions":
                    row["amount"] = rng.choice([None, row["amount"], row["fee"], row["fee"] * 2])
                    row["status_id"] = rng.choice([1, 1, 2, 99])
                    row["channel"], row["currency"] = rng.choice(["POS", "ATM"]), rng.choice(["USD", None])
                    row["initiated_at"] = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(48))
                    row["merchant_id"] = rng.choice([None, 1, 2])
                    row["client_id"] = rng.choice([1, 2, 3])
                    row["is_flagged"] = rng.choice([0, 1, None])
                elif table == "fraud_alerts":
                    row["txn_id"], row["is_confirmed"] = rng.choice(ids), rng.choice([0, 1, None])
                elif table == "payment_cards":
                    row["client_id"] = rng.choice([1, 2, 3])
                else:
                    row["email"] = rng.choice(["a", "b"])
                now[table][row[key]] = row
        yield {t: {k: dict(r) for k, r in rows.items()} for t, rows in now.items()}


def rows_of(df):
    return Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_any_changes_equal_a_rebuild(spark, tables, folder, monkeypatch):
    monkeypatch.setattr(increments, "FOLD_EVERY", 1)
    rng, kept = random.Random(1), increments.MartIncrements(spark, folder)
    before = {t: {} for t in KEYS}
    for batch, after in enumerate(random_rows(tables, rng, 4)):
        changes, now = {}, {name: tables[name] for name in tables}
        for table, key in KEYS.items():
            kind = T.StructType([T.StructField(f.name, f.dataType) for f in tables[table].schema])
            row = lambda r, kind=kind: None if r is None else tuple(r[f] for f in kind.names)
            every = sorted({*before[table], *after[table]})
            images = [(row(before[table].get(k)), row(after[table].get(k))) for k in every]
            ddl = f"before {kind.simpleString()}, after {kind.simpleString()}"
            changes[table] = spark.createDataFrame([i for i in images if i[0] != i[1]], ddl)
            now[table] = spark.createDataFrame([row(r) for r in after[table].values()], kind)
        for _ in range(1 + (batch == 2)):  # one batch comes twice
            kept.apply(batch, changes, now)
        before = after
    for name, build in marts.MARTS.items():
        got, want = kept.view(name, now), build(now)
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want), name
    # Batches that bases of the past hold are gone.
    assert len(os.listdir(f"{folder}/daily/bases")) <= 2 + 2  # with checksum files
    left = [n for n in os.listdir(f"{folder}/daily/batches") if n.startswith("batch_id=")]
    assert sorted(left) == ["batch_id=2", "batch_id=3"]


def test_net_changes_of_busy_keys(spark):
    row = lambda pk, n: (pk, n)
    log = [
        (1, None, row(1, 5), 10, 0), (1, row(1, 5), row(1, 9), 10, 1), (1, row(1, 9), row(1, 7), 11, 2),
        (2, None, row(2, 1), 10, 3), (2, row(2, 1), None, 12, 4), (3, row(3, 1), row(3, 2), 10, 5),
        (3, row(3, 2), row(3, 1), 11, 6), (4, row(4, 4), None, 10, 7), (4, row(4, 4), None, 10, 7),
    ]
    image = "struct<pk: bigint, n: int>"
    df = spark.createDataFrame(log, f"pk bigint, before {image}, after {image}, ts_ms bigint, offset bigint")
    net = increments.net_changes(df, ["pk"]).select(F.to_json("before").alias("b"), F.to_json("after").alias("a"))
    assert sorted((r.b or "", r.a or "") for r in net.collect()) == [
        ("", '{"pk":1,"n":7}'), ('{"pk":4,"n":4}', ""),
    ]


def test_only_columns_that_groups_read_are_stored(spark, tables, folder, monkeypatch):
    stored = {}

    def written(df, name, write=increments.written):
        stored[name] = write(df, name)
        return stored[name]

    monkeypatch.setattr(increments, "written", written)
    kept, now = increments.MartIncrements(spark, folder), stand_in.changed_tables(tables, 0)
    kept.apply(0, stand_in.batch_changes(tables, 0), now, ["mart_client_360"])
    want = ["amount", "client_id", "initiated_at", "is_flagged", "status_id"]
    assert stored["net-transactions"].select("after.*").columns == want


def test_narrow_changes_are_the_rows_that_differ(spark, tables):
    for batch in (0, 1, 2):
        narrow = stand_in.batch_changes(tables, batch, increments.columns_read())
        for table, key in KEYS.items():
            there = [stand_in.changed_tables(tables, b)[table] for b in (batch - 1, batch) if b >= 0]
            was, now = there if batch else (there[0].limit(0), there[0])
            gone, come = (a.exceptAll(b).select(key) for a, b in ((was, now), (now, was)))
            want = {r[0] for r in gone.union(come).collect()}
            assert narrow[table].count() == len(want), (batch, table)
