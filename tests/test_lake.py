from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from txnlake.operators import joins
from txnlake.sources import lake, serving
from txnlake.sources.tables import lookup_tables, row_counts


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(100).selectExpr(
        "if(id % 2 = 0, 'clients', 'refunds') as table_name", "id",
        "if(id % 3 = 0, 'POS', 'ATM') as channel", "cast(id as decimal(14,2)) as amount",
        "timestamp'2024-01-09 00:00:00' + make_dt_interval(cast(id % 4 as int)) as _ingested_at",
    )


def test_day_partitions_are_padded_and_pruned(spark, rows, folder):
    lake.write_day_partitions(rows, folder)
    paths = {r[0] for r in spark.read.parquet(folder).select(F.input_file_name()).collect()}
    assert any("/table_name=clients/year=2024/month=01/day=09/" in p for p in paths)
    some = lake.read_lake(spark, folder, date(2024, 1, 10), date(2024, 1, 11))
    assert some.count() == 50
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(((" in plan


def test_appends_add_up_and_stats_count_files(spark, rows, folder):
    lake.write_day_partitions(rows, folder)
    lake.write_day_partitions(rows, folder, compression="zstd")
    stats = {r["table_name"]: r.asDict() for r in lake.lake_stats(lake.read_lake(spark, folder)).collect()}
    assert {t: s["n_rows"] for t, s in stats.items()} == {"clients": 100, "refunds": 100}
    # Even ids fall on two of the four days; one file per day and write.
    assert stats["clients"]["n_files"] == 4


def test_revenue(rows):
    got = {r["channel"]: (r["txns"], float(r["revenue"])) for r in lake.revenue_by(rows).collect()}
    assert got == {"POS": (34, 1683.0), "ATM": (66, 3267.0)}


def test_unknown_codec_is_refused(rows, folder):
    with pytest.raises(ValueError):
        lake.write_day_partitions(rows, folder, compression="rar")


def test_insert_ignore_keeps_existing_and_first_new(spark):
    ddl = "batch_id long, merchant_id long, batch_date string, n int"
    existing = spark.createDataFrame([(1, 1, "d1", 10)], ddl)
    new = spark.createDataFrame([(5, 1, "d1", 0), (7, 1, "d2", 2), (6, 1, "d2", 1)], ddl)
    added = serving.insert_ignore(existing, new, ["merchant_id", "batch_date"], "batch_id")
    assert [tuple(r) for r in added.collect()] == [(6, 1, "d2", 1)]


def test_clean_types(spark):
    dirty = spark.createDataFrame(
        [("1", "2024-01-01 10:00:00", float("nan"), "x"), ("?", "soon", 2.5, None)],
        "total_txns string, last_txn_at string, max_txn_amount double, full_name string",
    )
    from txnlake.schemas import SERVING_TYPES

    clean = serving.clean_types(dirty, SERVING_TYPES["mart_client_360"])
    assert dict(clean.dtypes) == {
        "total_txns": "bigint", "last_txn_at": "timestamp_ntz",
        "max_txn_amount": "decimal(14,2)", "full_name": "string",
    }
    first, second = clean.collect()
    assert (first["total_txns"], first["max_txn_amount"]) == (1, None)
    assert first["last_txn_at"] == datetime(2024, 1, 1, 10)
    assert (second["total_txns"], second["last_txn_at"], float(second["max_txn_amount"])) == (
        None, None, 2.5,
    )


def test_null_keys_spread_and_match_nothing(spark):
    left = spark.range(1000).selectExpr("id as txn_id", "if(id % 2 = 0, null, id % 5) as pos_id",
                                        "-1L as merchant_id")
    terminals = spark.createDataFrame([(1, 11), (3, 33)], "pos_id long, merchant_id long")
    out = joins.resolve_merchant(left, terminals)
    assert out.count() == 1000
    assert {r[0] for r in out.where("pos_id is null").select("resolved_merchant_id").distinct().collect()} == {-1}
    assert {r[0] for r in out.where("pos_id = 3").select("resolved_merchant_id").distinct().collect()} == {33}


def test_card_networks(spark):
    cards = spark.createDataFrame(
        [(1, "4111 **"), (2, "5500 **"), (3, "3714 **"), (4, "6511 **"), (5, "6041 **")],
        "card_id long, masked_pan string",
    )
    out = joins.match_card_network(cards, lookup_tables(spark)["card_networks"])
    assert {r["card_id"]: r["matched_network"] for r in out.collect()} == {
        1: "Visa", 2: "Mastercard", 3: "Amex", 4: "Discover", 5: None,
    }


def test_lookups_have_their_rows(spark):
    counts = {r["table_name"]: r["n_rows"] for r in row_counts(lookup_tables(spark)).collect()}
    assert counts == {
        "transaction_types": 7, "transaction_statuses": 7, "card_networks": 4,
        "merchant_categories": 15,
    }


def test_three_hundred_networks(spark):
    networks = spark.range(300).selectExpr(
        "cast(id as int) as network_id", "concat('n', id) as name",
        "concat('^', lpad(cast(id as string), 4, '0')) as prefix_regex",
    )
    cards = spark.range(400).selectExpr("id as card_id", "lpad(cast(id as string), 4, '0') as masked_pan")
    out = {r["card_id"]: r["matched_network_id"] for r in joins.match_card_network(cards, networks).collect()}
    assert out == {i: i if i < 300 else None for i in range(400)}
