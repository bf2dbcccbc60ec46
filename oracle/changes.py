"""Oracles for the change stream and ingest."""

from oracle.tables import using
from txnlake.schemas import PRIMARY_KEYS

ALL = list(PRIMARY_KEYS)
POLLED = [
    "countries", "merchants", "pos_terminals", "clients", "payment_cards", "transactions",
    "fraud_alerts", "refunds", "settlement_batches",
]
MARK = "TIMESTAMP '1998-01-01'"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def oracles() -> dict[str, str]:
    return {
        "scan_sources": using(
            *ALL,
            sql=_union(
                [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ALL]
            ),
        ),
        "snapshot_load": using(
            *ALL,
            sql=_union(
                [
                    f"SELECT '{t}' AS table_name, CAST({pk} AS BIGINT) AS pk, 'r' AS op FROM {t}"
                    for t, pk in PRIMARY_KEYS.items()
                ]
            ),
        ),
        "incremental_poll": using(
            *POLLED,
            sql=_union(
                [
                    f"SELECT '{t}' AS table_name, CAST({PRIMARY_KEYS[t]} AS BIGINT) AS pk, "
                    f"'c' AS op, created_at FROM {t} WHERE created_at > {MARK}"
                    for t in POLLED
                ]
            ),
        ),
        "incremental_poll_overlap": using(
            *POLLED,
            sql=_union(
                [
                    f"""SELECT CAST(cycle AS INTEGER) AS cycle, '{t}' AS table_name, pk FROM (
                        SELECT CAST(late AS INTEGER) AS cycle, pk, created_at, CASE WHEN late THEN greatest(
                                   max(created_at) FILTER (NOT late) OVER () - INTERVAL 30 DAY, {MARK})
                               ELSE {MARK} END AS since
                        FROM (SELECT CAST({PRIMARY_KEYS[t]} AS BIGINT) AS pk, created_at,
                                     {PRIMARY_KEYS[t]} % 10 = 3 AS late FROM {t}
                              WHERE created_at > {MARK}))
                    WHERE created_at > since"""
                    for t in POLLED
                ]
            ),
        ),
        "incremental_high_water": using(
            *POLLED,
            sql=_union(
                [
                    f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
                    f"coalesce(max(created_at), {MARK}) AS high_water "
                    f"FROM {t} WHERE created_at > {MARK}"
                    for t in POLLED
                ]
            ),
        ),
        "snapshot_pending_tables": using(
            "merchants",
            sql=f"""SELECT table_name FROM (SELECT unnest({ALL}) AS table_name)
                WHERE table_name NOT IN (
                    SELECT table_name FROM (
                        SELECT {ALL}[merchant_id % {len(ALL)} + 1] AS table_name,
                               arg_max(CASE WHEN merchant_id % 3 = 2 THEN 'reset'
                                       ELSE 'completed' END, merchant_id) AS status
                        FROM merchants GROUP BY 1)
                    WHERE status = 'completed')""",
        ),
        "envelope_encode": using(
            "transactions",
            sql="""SELECT 'transactions' AS table_name, 'r' AS op, txn_id, amount, channel,
                          merchant_id,
                          strftime(initiated_at, '%Y-%m-%dT%H:%M:%S.%f') AS initiated_at,
                          strftime(settled_at, '%Y-%m-%d') AS settled_at
                   FROM transactions""",
        ),
        "cdc_topic_filter": using(
            "feed",
            sql="SELECT off, topic FROM feed WHERE starts_with(topic, 'cdc.payment_gateway.')",
        ),
        "cdc_route": using(
            "feed",
            sql="""SELECT off, topic, table_name FROM feed
                   WHERE starts_with(topic, 'cdc.payment_gateway.')""",
        ),
        "cdc_decode": using(
            "changes",
            sql="""SELECT table_name, pk, user_id, event_type, amount, ts_ms, off, op,
                          op = 'd' AS is_delete, k FROM changes""",
        ),
        "cdc_unwrap": using(
            "changes",
            sql="""SELECT table_name, pk, user_id, event_type, amount, ts_ms, off, op,
                          op = 'd' AS is_delete FROM changes""",
        ),
        "cdc_temporal_decode": """
            SELECT event_id, CAST(ts AS DATE) AS from_days,
                   date_trunc('millisecond', ts) AS from_ms, ts AS from_us, ts AS from_iso
            FROM events""",
        "cdc_skip_stats": using(
            "feed",
            sql="""SELECT table_name, CASE WHEN tombstone THEN 'tombstone' WHEN op = 'd'
                          THEN 'delete' ELSE 'kept' END AS reason, count(*) AS n_messages
                   FROM feed WHERE topic LIKE 'cdc.%' GROUP BY 1, 2""",
        ),
        "cdc_skip_deletes": using(
            "changes", sql="SELECT off, table_name, op FROM changes WHERE op <> 'd'"
        ),
        "cdc_keep_deletes": using(
            "changes",
            sql="SELECT off, table_name, op, CAST(op = 'd' AS INTEGER) AS _deleted FROM changes",
        ),
        "cdc_metadata": using(
            "changes",
            sql="""SELECT table_name, off, pk, user_id, event_type, amount, op AS _cdc_op,
                          ts_ms AS _cdc_ts_ms FROM changes WHERE op <> 'd'""",
        ),
        "cdc_normalise": using(
            "changes",
            sql="""SELECT off, pk, CAST(amount AS DOUBLE) AS amount,
                          '{"k":' || k || '}' AS props FROM changes""",
        ),
        "cdc_op_counts": using(
            "changes",
            sql="""SELECT table_name, count(*) FILTER (op = 'r') AS r,
                          count(*) FILTER (op = 'c') AS c, count(*) FILTER (op = 'u') AS u,
                          count(*) FILTER (op = 'd') AS d FROM changes GROUP BY 1""",
        ),
        "cdc_pending_by_table": using(
            "changes",
            sql="SELECT table_name, count(*) AS n_pending FROM changes GROUP BY 1",
        ),
        "cdc_current_state": using("changes", sql=CURRENT_STATE),
        "cdc_dedupe": using("changes", sql=DEDUPED),
        "cdc_dead_letters": using(
            "changes", sql="SELECT off, table_name FROM changes WHERE off % 50 = 0"
        ),
    }


DEDUPED = """
    SELECT table_name, pk, ts_ms, off, op FROM changes
    UNION ALL
    SELECT table_name, pk, ts_ms, off, 'd' FROM changes WHERE off % 10 = 5 AND op <> 'd'"""

CURRENT_STATE = """
    SELECT table_name, pk, user_id, event_type, amount, op, ts_ms, off
    FROM changes
    QUALIFY row_number() OVER (PARTITION BY table_name, pk ORDER BY ts_ms DESC, off DESC) = 1
        AND op <> 'd'"""
