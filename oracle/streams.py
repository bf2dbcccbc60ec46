"""Oracles for the lake, mart loading and streaming queries."""

from oracle.changes import CURRENT_STATE, DEDUPED
from oracle.marts import M1, M1_TABLES, M2, M2_TABLES, M3, M3_TABLES, M4, M4_TABLES
from oracle.tables import pct, using

# A stream in append mode has emitted the windows that ended by its final watermark.
CLOSED = "epoch_ms((SELECT max(epoch_us(ts)) FROM events) // 1000) - INTERVAL 10 MINUTE"

_LOADED = " UNION ALL ".join(
    f"SELECT '{name}' AS mart, count(*) AS source_rows, count(*) AS target_rows, 1 AS is_match "
    f"FROM ({sql})"
    for name, sql in [
        ("mart_daily_transaction_summary", M1),
        ("mart_merchant_performance", M2),
        ("mart_client_360", M3),
        ("mart_fraud_analysis", M4),
    ]
)

BY_DAY_AND_OP = """SELECT table_name, CAST(year(ts) AS INTEGER) AS year,
                          CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
                          op AS _cdc_op, count(*) AS n_rows,
                          CAST(sum(amount) AS DECIMAL(24,2)) AS amount
                   FROM changes WHERE op <> 'd' GROUP BY 1, 2, 3, 4, 5"""


def oracles() -> dict[str, str]:
    share = pct("sum(f)", "count(*)")
    return {
        "lake_sink": using("changes", sql=BY_DAY_AND_OP),
        "lake_compacted": using("changes", sql=BY_DAY_AND_OP),
        "lake_sink_codec": using(
            "changes",
            sql="""SELECT codec, table_name, count(*) AS n_rows
                   FROM changes, (VALUES ('snappy'), ('gzip'), ('zstd'), ('none')) c(codec)
                   WHERE op <> 'd' GROUP BY 1, 2""",
        ),
        "lake_channel_revenue": using(
            "transactions",
            sql="""SELECT channel, count(*) AS txns,
                          CAST(sum(amount) AS DECIMAL(24,2)) AS revenue
                   FROM transactions GROUP BY 1""",
        ),
        "mart_reload": using(*M3_TABLES, sql=M3),
        "load_reconcile": using(
            *dict.fromkeys([*M1_TABLES, *M2_TABLES, *M3_TABLES, *M4_TABLES]),
            sql=f"""WITH l AS ({_LOADED})
                SELECT * FROM l UNION ALL
                SELECT 'TOTAL', CAST(sum(source_rows) AS BIGINT), CAST(sum(target_rows) AS BIGINT),
                       1 FROM l""",
        ),
        "mart_type_clean": using(
            *M3_TABLES,
            sql=f"""SELECT client_id, risk_score, last_txn_at, nullif(total_txns, 0) AS total_txns,
                           nullif(max_txn_amount, 0) AS max_txn_amount FROM ({M3})""",
        ),
        "insert_ignore": using(
            "settlement_batches",
            sql="""SELECT batch_id, merchant_id, batch_date,
                          CASE WHEN merchant_id % 2 = 1 THEN 0 ELSE txn_count END AS txn_count
                   FROM settlement_batches""",
        ),
        "refresh_trigger": using(
            "changes",
            sql="""WITH RECURSIVE t AS (
                     SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS tick, count(*) AS n
                     FROM changes GROUP BY 1),
                   ends AS (SELECT min(tick) AS a, max(tick) AS b FROM t),
                   series AS (
                     SELECT s.tick, coalesce(t.n, 0) AS n
                     FROM (SELECT unnest(generate_series(a, b)) AS tick FROM ends) s
                     LEFT JOIN t ON t.tick = s.tick),
                   walk(tick, n, pending, elapsed, since) AS (
                     SELECT a - 1, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
                            a * 3600 FROM ends
                     UNION ALL
                     SELECT s.tick, s.n,
                            CASE WHEN w.fired THEN 0 ELSE w.pending END + s.n,
                            (s.tick + 1) * 3600
                                - CASE WHEN w.fired THEN (w.tick + 1) * 3600 ELSE w.since END,
                            CASE WHEN w.fired THEN (w.tick + 1) * 3600 ELSE w.since END
                     FROM (SELECT *, pending >= 80 OR (elapsed >= 21600 AND pending > 0) AS fired
                           FROM walk) w
                     JOIN series s ON s.tick = w.tick + 1)
                SELECT epoch_ms(tick * 3600000) AS tick_start, n AS n_events, pending,
                       elapsed AS elapsed_seconds,
                       CASE WHEN pending >= 80 THEN 'rows'
                            WHEN elapsed >= 21600 AND pending > 0 THEN 'time'
                            ELSE 'none' END AS reason
                FROM walk WHERE tick >= (SELECT a FROM ends)""",
        ),
        "cdc_current_state_stream": using("changes", sql=CURRENT_STATE),
        "cdc_current_state_buckets": using("changes", sql=CURRENT_STATE),
        "cdc_dedupe_stream": using("changes", sql=DEDUPED),
        "stream_ingestion_rate": f"""
            SELECT time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01') AS window_start,
                   time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01')
                       + INTERVAL 15 MINUTE AS window_end,
                   count(*) AS n_rows,
                   CASE WHEN count(*) < 5 THEN 'WARN' ELSE 'OK' END AS status
            FROM events GROUP BY 1, 2
            HAVING window_end <= {CLOSED}""",
        "stream_fraud_rate": f"""
            SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS total,
                   CAST(sum(f) AS BIGINT) AS flagged, {share} AS fraud_pct,
                   CASE WHEN {share} > 30 THEN 'WARN' ELSE 'OK' END AS status
            FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01')
                             - to_minutes(15 * i) AS s,
                         CAST(event_id % 5 = 0 AS INTEGER) AS f
                  FROM events, range(4) r(i))
            GROUP BY 1, 2 HAVING window_end <= {CLOSED}""",
        "stream_fraud_velocity": f"""
            SELECT client_id, s AS window_start, s + INTERVAL 10 MINUTE AS window_end,
                   count(*) AS n_txns
            FROM (SELECT user_id AS client_id,
                         date_trunc('minute', ts) - to_minutes(i) AS s
                  FROM events, range(10) r(i))
            GROUP BY 1, 2, 3 HAVING count(*) >= 2 AND window_end <= {CLOSED}""",
        "stream_fraud_sessions": f"""
            SELECT client_id, min(ts) AS window_start, max(ts) + INTERVAL 600 SECOND AS window_end,
                   count(*) AS n_txns
            FROM (SELECT user_id AS client_id, ts, sum(CAST(new AS INTEGER)) OVER w AS run
                  FROM (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (
                                   PARTITION BY user_id ORDER BY ts) >= INTERVAL 600 SECOND, true)
                                   AS new
                        FROM events)
                  WINDOW w AS (PARTITION BY user_id ORDER BY ts
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
            GROUP BY client_id, run
            HAVING count(*) >= 2 AND window_end <= {CLOSED}""",
    }
