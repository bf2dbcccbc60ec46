"""The 13 tables and the change feed, computed from the given test tables.

Every column is a fixed formula of the input row, so a SQL engine reading the same
Parquet files can compute the same tables. ``k`` is the order key, ``q`` is ``k`` div 20.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import fixed_values as fixed
from txnlake.operators.settlement import settlement_batches
from txnlake.sources.tables import LazyTables, lookup_tables, stream_parquet

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _sql_array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _pick(values: list[str], index: str) -> str:
    return f"element_at({_sql_array(values)}, cast({index} as int) + 1)"


def _pick_decimal(values: list[str], kind: str, index: str) -> str:
    literals = ", ".join(f"cast({v} as {kind})" for v in values)
    return f"element_at(array({literals}), cast({index} as int) + 1)"


def _uuid(seed: str) -> str:
    digest = f"md5({seed})"
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat_ws('-', " + ", ".join(f"substr({digest}, {a}, {n})" for a, n in parts) + ")"


def _after(ts: str, seconds: str) -> str:
    return f"{ts} + make_dt_interval(0, 0, 0, {seconds})"


def countries(nation: DataFrame) -> DataFrame:
    codes = [c for c, _, _ in fixed.COUNTRIES]
    currencies = [c for _, _, c in fixed.COUNTRIES]
    return nation.selectExpr(
        "n_nationkey as country_id",
        f"{_pick(codes, 'n_nationkey % 10')} as code",
        "n_name as name",
        f"{_pick(currencies, 'n_nationkey % 10')} as currency",
        "timestamp_ntz'1992-01-01 00:00:00' as created_at",
    )


def merchants(supplier: DataFrame) -> DataFrame:
    mccs = [str(m) for m, _ in fixed.MERCHANT_CATEGORIES]
    return supplier.selectExpr(
        "s_suppkey as merchant_id",
        "s_name as legal_name",
        "case when s_suppkey % 10 <> 9 then s_name || ' Ltd' end as trade_name",
        f"cast({_pick(mccs, 's_suppkey % 15')} as int) as mcc",
        "'TAX-' || s_suppkey as tax_id",
        "s_nationkey as country_id",
        "'City ' || (s_suppkey % 50) as city",
        "s_suppkey || ' Market Street' as address",
        "lpad(cast(s_suppkey % 100000 as string), 5, '0') as zip_code",
        "'shop' || s_suppkey || '@example.com' as email",
        "cast(null as string) as phone",
        "cast(s_suppkey % 20 <> 0 as int) as is_active",
        f"{_after(EPOCH.replace('1970', '1992'), 's_suppkey % 365 * 86400')} as onboarded_at",
        f"{_after(EPOCH.replace('1970', '1992'), 's_suppkey % 365 * 86400')} as created_at",
    )


def pos_terminals(supplier: DataFrame) -> DataFrame:
    return supplier.withColumn("i", F.expr("explode(sequence(0, 4))")).selectExpr(
        "s_suppkey * 5 + i as pos_id",
        "'POS-' || (s_suppkey * 5 + i) as serial_number",
        "s_suppkey as merchant_id",
        "'Model ' || i as model",
        "'v' || (1 + i % 3) as firmware_version",
        "'Counter ' || i as location_label",
        "cast((s_suppkey * 5 + i) % 33 <> 0 as int) as is_active",
        "timestamp_ntz'1993-01-01 00:00:00' as installed_at",
        "cast(null as timestamp_ntz) as last_seen_at",
        "timestamp_ntz'1993-01-01 00:00:00' as created_at",
    )


def clients(customer: DataFrame) -> DataFrame:
    first, last = "split(c_name, '#')[0]", "split(c_name, '#')[1]"
    registered = _after(EPOCH.replace("1970", "1990"), "c_custkey % 700 * 86400")
    return customer.selectExpr(
        "c_custkey as client_id",
        f"{first} as first_name",
        f"{last} as last_name",
        f"lower({first}) || {last} || '@example.com' as email",
        "cast(null as string) as phone",
        "date_add(date'1950-01-01', cast(c_custkey % 18000 as int)) as date_of_birth",
        "'N' || c_custkey as national_id",
        "c_nationkey as country_id",
        "'City ' || (c_custkey % 80) as city",
        "c_custkey || ' High Street' as address",
        "lpad(cast(c_custkey % 100000 as string), 5, '0') as zip_code",
        "cast(1 + c_custkey % 100 as int) as risk_score",
        "cast(c_custkey % 25 <> 0 as int) as is_active",
        f"{registered} as registered_at",
        f"{registered} as created_at",
    )


def payment_cards(customer: DataFrame) -> DataFrame:
    """None to four cards per client; the fifth number range matches no network."""
    heads = ["4111", "5105", "3714", "6011", "6041"]
    cards = customer.where("c_custkey % 5 > 0").withColumn(
        "i", F.expr("explode(sequence(0, cast(c_custkey % 5 as int) - 1))")
    )
    return cards.selectExpr(
        "c_custkey * 10 + i as card_id",
        "c_custkey as client_id",
        "cast(least(4, 1 + (c_custkey + i) % 5) as int) as network_id",
        f"{_pick(heads, '(c_custkey + i) % 5')} || ' **** **** ' || "
        "lpad(cast(c_custkey % 10000 as string), 4, '0') as masked_pan",
        _uuid("'card' || (c_custkey * 10 + i)") + " as card_token",
        "c_name as holder_name",
        "cast(1 + c_custkey % 12 as int) as expiry_month",
        "cast(2025 + i as int) as expiry_year",
        "cast(i = 0 as int) as is_default",
        "1 as is_active",
        _after("timestamp_ntz'1991-06-01 00:00:00'", "i * 86400") + " as issued_at",
        _after("timestamp_ntz'1991-06-01 00:00:00'", "i * 86400") + " as created_at",
    )


def transactions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One transaction per order; its merchant is the order's lowest supplier key.

    When no merchant column is asked for, the planner drops the join with lineitem.
    """
    supplier = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("supplier")
    )
    base = (
        orders.where("o_custkey % 50 <> 49")
        .join(supplier, "o_orderkey", "left")
        .selectExpr(
            "o_orderkey as k",
            "o_custkey",
            "case when supplier % 25 <> 24 then supplier end as merchant_id",
            "cast(round(cast(o_totalprice as decimal(14,2)) * cast(0.01 as decimal(3,2)), 2) "
            "as decimal(14,2)) as amount",
            _after("o_orderdate", "o_orderkey * 7919 % 86400") + " as initiated_at",
            """cast(case o_orderstatus when 'F' then 1 when 'P' then 6
                    else element_at(array(1, 2, 3, 5), cast(1 + o_orderkey % 4 as int))
                    end as int) as status_id""",
            """case substr(o_orderpriority, 1, 1) when '1' then 'POS' when '2' then 'ONLINE'
                    when '3' then 'ATM' when '4' then 'MOBILE' else 'IVR' end as channel""",
            """element_at(array('USD', 'EUR', 'GBP', 'EGP', 'SAR', 'AED', 'CAD', 'AUD'),
                    cast(1 + (o_custkey + o_orderkey) % 8 as int)) as currency""",
        )
        .selectExpr(
            "*",
            f"cast(round(amount * {_pick_decimal(fixed.FEE_RATES, 'decimal(4,3)', 'k % 4')} + "
            f"{_pick_decimal(fixed.FEE_FLATS, 'decimal(3,2)', 'k % 3')}, 2) "
            "as decimal(10,2)) as fee",
        )
    )
    return base.selectExpr(
        "k + 1 as txn_id",
        _uuid("'txn' || k") + " as reference",
        "o_custkey as client_id",
        "case when o_custkey % 5 > 0 then o_custkey * 10 end as card_id",
        "case when k % 10 < 7 then merchant_id * 5 + cast(floor(k / 10) as bigint) % 5 end "
        "as pos_id",
        "merchant_id",
        "cast(1 + k % 7 as int) as type_id",
        "status_id",
        "amount",
        "currency",
        "fee",
        "cast(amount - fee as decimal(14,2)) as net_amount",
        "case when status_id = 1 then upper(substr(md5('auth' || k), 1, 6)) end as auth_code",
        "channel",
        "case when channel in ('ONLINE', 'MOBILE') then '10.0.' || (k % 256) || '.' || "
        "(k % 250) end as ip_address",
        "'dev-' || (o_custkey * 3 + k % 3) as device_id",
        "cast(k % 12 = 0 as int) as is_recurring",
        "cast(currency <> 'USD' and k % 10 < 3 as int) as is_international",
        "cast(k % 5 = 0 as int) as is_flagged",
        "case status_id when 2 then 'issuer declined' when 5 then 'no route' end "
        "as failure_reason",
        "initiated_at",
        _after("initiated_at", "2 + k % 5") + " as processed_at",
        "case when status_id = 6 then date_add(to_date(initiated_at), cast(2 + k % 2 as int)) "
        "end as settled_at",
        "initiated_at as created_at",
    )


def fraud_alerts(txns: DataFrame) -> DataFrame:
    """One to three alerts per flagged transaction; seven in ten are reviewed."""
    alerts = (
        txns.where("is_flagged = 1")
        .selectExpr("txn_id", "txn_id - 1 as k", "amount", "initiated_at")
        .selectExpr("*", "cast(floor(k / 5) as bigint) as f")
        .withColumn("i", F.expr("explode(sequence(0, cast(f % 3 as int)))"))
    )
    band = "case when amount < 1000 then 60 when amount < 3000 then 75 else 90 end"
    return alerts.selectExpr(
        "k * 3 + i as alert_id",
        "txn_id",
        f"{_pick(fixed.GENERIC_RULES, '(k + i) % 6')} as rule_triggered",
        f"cast(least(100, {band} + (k * 7 + i) % 10) as int) as risk_score",
        "case when f % 10 < 7 then cast(f % 5 < 2 as int) end as is_confirmed",
        "case when f % 10 < 7 then 'analyst-' || (k % 20) end as reviewed_by",
        f"case when f % 10 < 7 then {_after('initiated_at', '86400')} end as reviewed_at",
        _after("initiated_at", "60") + " as created_at",
    )


def refunds(txns: DataFrame) -> DataFrame:
    """Refunds of approved transactions: full, half, or (planted) above the original."""
    return (
        txns.where("status_id = 1 and (txn_id - 1) % 20 = 1")
        .selectExpr(
            "txn_id",
            "txn_id - 1 as k",
            "cast(floor((txn_id - 1) / 20) as bigint) as q",
            "amount as original",
            _after("initiated_at", "432000") + " as initiated_at",
        )
        .selectExpr(
            "k as refund_id",
            "txn_id as original_txn_id",
            _uuid("'refund' || k") + " as reference",
            """cast(case when q % 10 < 3 then round(original * cast(0.5 as decimal(2,1)), 2)
                         when q % 50 = 7 then round(original * cast(1.1 as decimal(2,1)), 2)
                         else original end as decimal(14,2)) as amount""",
            "'customer request' as reason",
            "1 as status_id",
            "initiated_at",
            _after("initiated_at", "(5 + k % 48) * 3600") + " as resolved_at",
            "initiated_at as created_at",
        )
    )


def load_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """All 13 tables over ``<sf_dir>/*.parquet``."""

    def given(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    lookups = lookup_tables(spark)
    tables = LazyTables(
        {
            "countries": lambda: countries(given("nation")),
            **{name: partial(lookups.__getitem__, name) for name in lookups},
            "merchants": lambda: merchants(given("supplier")),
            "pos_terminals": lambda: pos_terminals(given("supplier")),
            "clients": lambda: clients(given("customer")),
            "payment_cards": lambda: payment_cards(given("customer")),
            "transactions": lambda: transactions(given("orders"), given("lineitem")),
            "fraud_alerts": lambda: fraud_alerts(tables["transactions"]),
            "refunds": lambda: refunds(tables["transactions"]),
            "settlement_batches": lambda: settlement_batches(
                tables["transactions"], tables["transaction_statuses"]
            ),
        }
    )
    return tables


# --- The change feed, from events ------------------------------------------------

FEED_TABLES = ["transactions", "clients", "fraud_alerts"]
FEED_ROW = (
    "pk bigint, user_id bigint, event_type string, amount decimal(14,2), props struct<k: int>"
)


def events_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    return stream_parquet(spark, path, spark.read.parquet(path).schema, **options)


def _feed_columns(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        f"""case when event_id % 101 = 0 then 'debezium.schema-history'
                 else '{fixed.TOPIC_PREFIX}.{fixed.DATABASE}.' ||
                      {_pick(FEED_TABLES, "event_id % 3")} end as topic""",
        "event_id % 97 = 0 as tombstone",
        f"{_pick(FEED_TABLES, 'event_id % 3')} as source_table",
        """case event_type when 'signup' then 'r' when 'purchase' then 'c'
                           when 'error' then 'd' else 'u' end as op""",
        "ts",
        f"timestampdiff(MILLISECOND, {EPOCH}, ts) as ts_ms",
        """named_struct('pk', user_id * 20 + event_id % 20, 'user_id', user_id,
                        'event_type', event_type, 'amount', cast(value as decimal(14,2)),
                        'props', from_json(props, 'k int')) as row""",
    )


def change_feed(events: DataFrame) -> DataFrame:
    """Unwrapped change messages with the columns of a Kafka source.

    Some snapshot rows leave out ``__op`` and even offsets leave out ``__deleted``, so
    readers must apply the defaults. Works on a batch or a streaming ``events``.
    """
    return _feed_columns(events).selectExpr(
        "topic",
        "event_id as offset",
        "cast(ts as timestamp) as timestamp",
        # The generator keeps filters on the text above it, so it is built once.
        """explode(array(case when not tombstone then to_json(named_struct(
               'pk', row.pk, 'user_id', row.user_id, 'event_type', row.event_type,
               'amount', row.amount, 'props', row.props,
               '__op', case when op <> 'r' or event_id % 2 = 1 then op end,
               '__source_ts_ms', ts_ms,
               '__table', source_table,
               '__deleted', case when op = 'd' then 'true'
                                 when event_id % 2 = 1 then 'false' end)) end)) as value""",
    )


def change_envelopes(events: DataFrame) -> DataFrame:
    """The same changes before unwrapping: ``before``/``after`` images, ``op``, ``source``."""
    return _feed_columns(events).selectExpr(
        "topic",
        "event_id as offset",
        "cast(ts as timestamp) as timestamp",
        """explode(array(case when not tombstone then to_json(named_struct(
               'before', case when op in ('u', 'd') then row end,
               'after', case when op <> 'd' then row end,
               'op', op,
               'source', named_struct('ts_ms', ts_ms, 'table', source_table))) end)) as value""",
    )


def events_as_transactions(events: DataFrame) -> DataFrame:
    """Events with the column names the fraud detectors and monitors read."""
    return events.selectExpr(
        "event_id as txn_id",
        "user_id as client_id",
        "ts as initiated_at",
        "ts as created_at",
        "cast(value as decimal(14,2)) as amount",
        "'ONLINE' as channel",
        "cast(event_id % 5 = 0 as int) as is_flagged",
    )


#: What three batches of changes do to tables: rows that are there after each, and new values.
#: The first batch is the snapshot.
_BATCHES = {
    "transactions": (
        ["txn_id % 4 <> 0", "txn_id % 7 <> 3", "txn_id % 7 <> 3 AND txn_id % 11 <> 2"],
        [
            {},
            {
                "amount": "IF(txn_id % 5 = 1, CAST(amount + 100 AS DECIMAL(14,2)), amount)",
                "net_amount": "IF(txn_id % 5 = 1, CAST(net_amount + 100 AS DECIMAL(14,2)), net_amount)",
                "status_id": "IF(txn_id % 6 = 1, CAST(1 + txn_id % 7 AS INT), status_id)",
            },
            {
                "amount": "IF(txn_id % 9 = 1, CAST(fee AS DECIMAL(14,2)), IF(txn_id % 5 = 1, "
                "CAST(amount + 100 AS DECIMAL(14,2)), amount))",
                "net_amount": "IF(txn_id % 9 = 1, CAST(0 AS DECIMAL(14,2)), IF(txn_id % 5 = 1, "
                "CAST(net_amount + 100 AS DECIMAL(14,2)), net_amount))",
                "status_id": "IF(txn_id % 6 = 1, CAST(1 + txn_id % 7 AS INT), status_id)",
                "currency": "IF(txn_id % 10 = 6, 'USD', currency)",
                "initiated_at": "IF(txn_id % 13 = 5, initiated_at + INTERVAL 1 DAY, initiated_at)",
            },
        ],
    ),
    "payment_cards": (["card_id % 3 <> 0", "true", "card_id % 5 <> 0"], [{}, {}, {}]),
    "fraud_alerts": (
        ["alert_id % 2 = 0", "alert_id % 11 <> 5", "alert_id % 11 <> 5"],
        [{}, {}, {"is_confirmed": "IF(alert_id % 13 = 2, 1, is_confirmed)"}],
    ),
    "clients": (
        ["true", "true", "true"],
        [{}, *[{"email": "IF(client_id % 17 = 3, 'moved@example.com', email)"}] * 2],
    ),
}


def _after_batch(table: str, batch: int, columns: list[str]) -> tuple[str, str]:
    """The condition for a row to be there after a batch, and the row as a struct."""
    there, values = (part[batch] for part in _BATCHES[table])
    fields = ", ".join(f"'{c}', {values.get(c, c)}" for c in columns)
    return there, f"named_struct({fields})"


def changed_tables(tables: LazyTables, batch: int) -> LazyTables:
    """The tables after a batch of changes."""

    def after(table: str) -> DataFrame:
        df = tables[table]
        if table not in _BATCHES:
            return df
        there, row = _after_batch(table, batch, df.columns)
        return df.where(there).selectExpr(f"{row} AS row").select("row.*")

    return LazyTables({name: partial(after, name) for name in tables})


def batch_changes(tables: LazyTables, batch: int, columns: Mapping[str, list[str]] | None = None) -> LazyTables:
    """Rows before and after a batch, of all rows it changes; of some tables and columns, if named."""

    def changes(table: str) -> DataFrame:
        df = tables[table]
        kept = columns[table] if columns else df.columns
        there, row = _after_batch(table, batch, kept)
        was, old = _after_batch(table, batch - 1, kept) if batch else ("false", row)
        # Rows differ where they come or go, or in a column that one of both batches sets.
        values = _BATCHES[table][1]
        changed = {**(values[batch - 1] if batch else {}), **values[batch]}
        differ = [f"NOT ({values[batch - 1].get(c, c)} <=> {values[batch].get(c, c)})" for c in changed] if batch else []
        moved = " OR ".join([f"coalesce({was}, false) <> coalesce({there}, false)", *[f"(({was}) AND ({there}) AND {d})" for d in differ]])
        images = df.where(moved)
        return images.selectExpr(f"IF({was}, {old}, NULL) AS before", f"IF({there}, {row}, NULL) AS after")

    return LazyTables({table: partial(changes, table) for table in _BATCHES if not columns or table in columns})
