"""Oracles for quality checks and monitoring."""

from oracle.marts import M1, M1_TABLES, M2, M2_TABLES, M3, M3_TABLES, M4, M4_TABLES
from oracle.tables import pct, using
from txnlake.schemas import FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS

MARTS = f"""mart_daily_transaction_summary AS ({M1}),
    mart_merchant_performance AS ({M2}), mart_client_360 AS ({M3}),
    mart_fraud_analysis AS ({M4})"""
MART_TABLES = list(dict.fromkeys([*M1_TABLES, *M2_TABLES, *M3_TABLES, *M4_TABLES]))
ALL = list(PRIMARY_KEYS)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _bad_rows(table: str, name: str, violation: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, count(*) AS n_rows, "
        f"count(*) FILTER ({violation}) AS n_violations FROM {table}"
    )


def _repeats(table: str, columns: tuple[str, ...]) -> str:
    some = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT '{table}.{'+'.join(columns)} unique' AS check_name, "
        "count(*) AS n_duplicate_keys, coalesce(CAST(sum(n - 1) AS BIGINT), 0) AS n_excess_rows "
        f"FROM (SELECT count(*) AS n FROM {table} WHERE {some} "
        f"GROUP BY {', '.join(columns)} HAVING count(*) > 1)"
    )


def _orphans(child: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{child}.{column}' AS check_name, count(DISTINCT {column}) AS n_orphan_keys, "
        f"count(*) AS n_orphan_rows FROM {child} WHERE {column} IS NOT NULL AND {column} "
        f"NOT IN (SELECT {PRIMARY_KEYS[parent]} FROM {parent})"
    )


MIN_ROWS = {"transactions": 10_000, "clients": 1_000, "fraud_alerts": 1_000}

ROW_COUNTS = _union(
    [
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS BIGINT) AS min_rows, "
        f"CASE WHEN count(*) < {n} THEN 'ERROR' ELSE 'OK' END AS status FROM {t}"
        for t, n in MIN_ROWS.items()
    ]
)


def _ingest(source: str, ts: str) -> str:
    return f"""SELECT count(*) AS n_recent, CAST(5 AS BIGINT) AS min_recent,
        CASE WHEN count(*) < 5 THEN 'WARN' ELSE 'OK' END AS status
        FROM {source} WHERE {ts} >= (SELECT max({ts}) FROM {source}) - INTERVAL 15 MINUTE"""


def _spike(source: str, ts: str, flag: str) -> str:
    share = pct(f"sum({flag})", "count(*)")
    return f"""SELECT count(*) AS total, CAST(sum({flag}) AS BIGINT) AS flagged,
        {share} AS fraud_pct, CASE WHEN {share} > 30 THEN 'WARN' ELSE 'OK' END AS status
        FROM {source} WHERE {ts} >= (SELECT max({ts}) FROM {source}) - INTERVAL 1 HOUR"""


UNREVIEWED = """SELECT count(*) AS n_unreviewed, CAST(50 AS BIGINT) AS max_unreviewed,
    CASE WHEN count(*) > 50 THEN 'WARN' ELSE 'OK' END AS status
    FROM fraud_alerts WHERE is_confirmed IS NULL AND risk_score >= 90"""

POLLED = [
    "countries", "merchants", "pos_terminals", "clients", "payment_cards", "transactions",
    "fraud_alerts", "refunds", "settlement_batches",
]
_NEWEST = _union(
    [f"SELECT '{t}' AS table_name, max(created_at) AS newest FROM {t}" for t in POLLED]
)
FRESHNESS = f"""
    SELECT table_name, newest,
           CAST(floor(epoch(max(newest) OVER ())) - floor(epoch(newest)) AS BIGINT)
               AS age_seconds,
           CASE WHEN floor(epoch(max(newest) OVER ())) - floor(epoch(newest)) > 86400
                THEN 'WARN' ELSE 'OK' END AS status
    FROM ({_NEWEST})"""


def oracles() -> dict[str, str]:
    def lines(sql: str, name: str, value: str, threshold: str) -> str:
        return (
            f"SELECT {name} AS check_name, CAST({value} AS DECIMAL(18,2)) AS value, "
            f"CAST({threshold} AS DECIMAL(18,2)) AS threshold, status FROM ({sql})"
        )

    summary = _union(
        [
            lines(ROW_COUNTS, "'row_count ' || table_name", "n_rows", "min_rows"),
            lines(_ingest("transactions", "created_at"), "'ingestion_rate'", "n_recent", "5"),
            lines(
                _spike("transactions", "initiated_at", "is_flagged"),
                "'fraud_spike'",
                "fraud_pct",
                "30",
            ),
            lines(UNREVIEWED, "'unreviewed_high_risk'", "n_unreviewed", "50"),
            lines(FRESHNESS, "'freshness ' || table_name", "age_seconds", "86400"),
        ]
    )
    return {
        "dq_not_null": using(
            *MART_TABLES,
            sql=f"WITH {MARTS} "
            + _union(
                [
                    _bad_rows(m, f"{m}.{c} not_null", f"{c} IS NULL")
                    for m, c in [
                        ("mart_daily_transaction_summary", "txn_count"),
                        ("mart_merchant_performance", "merchant_id"),
                        ("mart_client_360", "client_id"),
                        ("mart_fraud_analysis", "alert_id"),
                    ]
                ]
            ),
        ),
        "dq_unique": using(
            *MART_TABLES,
            sql=f"WITH {MARTS} "
            + _union(
                [
                    _repeats("mart_merchant_performance", ("merchant_id",)),
                    _repeats("mart_client_360", ("client_id",)),
                    _repeats("mart_fraud_analysis", ("alert_id",)),
                ]
            ),
        ),
        "dq_unique_keys": using(
            *ALL,
            sql=_union(
                [_repeats(t, (pk,)) for t, pk in PRIMARY_KEYS.items()]
                + [_repeats(t, columns) for t, columns in UNIQUE_KEYS]
            ),
        ),
        "dq_unique_by_day": using(
            "transactions",
            "refunds",
            sql=_union(
                [_repeats(t, (PRIMARY_KEYS[t],)) for t in ("transactions", "refunds")]
                + [_repeats(t, ("reference",)) for t in ("transactions", "refunds")]
            ),
        ),
        "dq_referential": using(
            *ALL, sql=_union([_orphans(fk.child, fk.column, fk.parent) for fk in FOREIGN_KEYS])
        ),
        "dq_accepted_values": using(
            *MART_TABLES,
            "settlement_batches",
            sql=f"WITH {MARTS} "
            + _union(
                [
                    _bad_rows(
                        "transactions",
                        "transactions.channel accepted_values",
                        "channel NOT IN ('POS','ONLINE','ATM','MOBILE','IVR')",
                    ),
                    _bad_rows(
                        "settlement_batches",
                        "settlement_batches.status accepted_values",
                        "status NOT IN ('PENDING','PROCESSING','SETTLED','FAILED')",
                    ),
                    _bad_rows(
                        "mart_fraud_analysis",
                        "mart_fraud_analysis.alert_outcome accepted_values",
                        "alert_outcome NOT IN "
                        "('Confirmed Fraud','False Positive','Pending Review')",
                    ),
                ]
            ),
        ),
        "dq_range": using(
            *MART_TABLES,
            sql=f"WITH {MARTS} "
            + _union(
                [
                    _bad_rows(
                        t, f"{t}.risk_score range", "risk_score NOT BETWEEN 1 AND 100"
                    )
                    for t in ("clients", "mart_client_360")
                ]
            ),
        ),
        "monitor_row_counts": using("clients", "fraud_alerts", sql=ROW_COUNTS),
        "monitor_ingestion_rate": _ingest("events", "ts"),
        "monitor_fraud_spike": _spike("events", "ts", "CAST(event_id % 5 = 0 AS INTEGER)"),
        "monitor_unreviewed_high_risk": using("fraud_alerts", sql=UNREVIEWED),
        "monitor_freshness": using(*POLLED, sql=FRESHNESS),
        "monitor_summary": using(*POLLED, sql=summary),
        "monitor_backlog": using(
            "changes",
            sql="""SELECT table_name, count(*) AS n_published,
                          count(*) FILTER (ts <= last_ts - INTERVAL 1 DAY) AS n_archived,
                          count(*) - count(*) FILTER (ts <= last_ts - INTERVAL 1 DAY) AS n_backlog
                   FROM changes, (SELECT max(ts) AS last_ts FROM changes) GROUP BY 1""",
        ),
    }
