"""Oracles for staging, joins, marts and serving reads."""

import re

from oracle.tables import avg_cents, pct, using

M1 = f"""
    SELECT CAST(t.initiated_at AS DATE) AS txn_date, s.code AS status, t.channel, t.currency,
           count(*) AS txn_count, CAST(sum(t.amount) AS DECIMAL(18,2)) AS gross_amount,
           CAST(sum(t.fee) AS DECIMAL(18,2)) AS total_fees,
           CAST(sum(t.net_amount) AS DECIMAL(18,2)) AS net_amount,
           CAST(sum(t.is_flagged) AS BIGINT) AS fraud_count,
           {pct("sum(t.is_flagged)", "count(*)")} AS fraud_rate_pct,
           {avg_cents("sum(t.amount)", "count(t.amount)")} AS avg_txn_amount,
           max(t.amount) AS max_txn_amount
    FROM transactions t LEFT JOIN transaction_statuses s ON t.status_id = s.status_id
    GROUP BY 1, 2, 3, 4"""

M2 = f"""
    SELECT m.merchant_id, m.trade_name, m.legal_name, mc.description AS category,
           c.name AS country, count(a.txn_id) AS total_txns,
           CAST(sum(a.amount) AS DECIMAL(18,2)) AS gross_revenue,
           CAST(sum(a.fee) AS DECIMAL(18,2)) AS total_fees,
           CAST(sum(a.net_amount) AS DECIMAL(18,2)) AS net_revenue,
           CASE WHEN count(a.amount) > 0 THEN
                {avg_cents("sum(a.amount)", "greatest(count(a.amount), 1)")} END AS avg_txn_value,
           CAST(sum(a.is_flagged) AS BIGINT) AS fraud_txns,
           {pct("sum(a.is_flagged)", "count(*)")} AS fraud_rate_pct,
           min(a.initiated_at) AS first_txn_at, max(a.initiated_at) AS last_txn_at
    FROM merchants m
    LEFT JOIN (SELECT t.* FROM transactions t JOIN transaction_statuses s
               ON t.status_id = s.status_id WHERE s.code = 'APPROVED') a
           ON m.merchant_id = a.merchant_id
    LEFT JOIN merchant_categories mc ON m.mcc = mc.mcc
    LEFT JOIN countries c ON m.country_id = c.country_id
    GROUP BY 1, 2, 3, 4, 5"""

M3 = f"""
    SELECT cl.client_id, cl.first_name || ' ' || cl.last_name AS full_name, cl.email,
           CAST(cl.country_id AS SMALLINT) AS country_id,
           CAST(cl.risk_score AS SMALLINT) AS risk_score, cl.registered_at,
           CAST(coalesce(cs.card_count, 0) AS INTEGER) AS card_count,
           coalesce(ts.total_txns, 0) AS total_txns,
           coalesce(ts.approved_txns, 0) AS approved_txns,
           coalesce(ts.declined_txns, 0) AS declined_txns,
           coalesce(ts.fraud_txns, 0) AS fraud_txns,
           CAST(coalesce(ts.total_spent, 0) AS DECIMAL(18,2)) AS total_spent,
           CAST(coalesce(ts.avg_txn_amount, 0) AS DECIMAL(14,2)) AS avg_txn_amount,
           CAST(coalesce(ts.max_txn_amount, 0) AS DECIMAL(14,2)) AS max_txn_amount,
           ts.last_txn_at
    FROM clients cl
    LEFT JOIN (
        SELECT t.client_id, count(*) AS total_txns,
               count(*) FILTER (s.code = 'APPROVED') AS approved_txns,
               count(*) FILTER (s.code = 'DECLINED') AS declined_txns,
               count(*) FILTER (t.is_flagged = 1) AS fraud_txns,
               sum(t.amount) AS total_spent,
               {avg_cents("sum(t.amount)", "count(t.amount)")} AS avg_txn_amount,
               max(t.amount) AS max_txn_amount, max(t.initiated_at) AS last_txn_at
        FROM transactions t JOIN transaction_statuses s ON t.status_id = s.status_id
        GROUP BY 1) ts ON cl.client_id = ts.client_id
    LEFT JOIN (SELECT client_id, count(*) AS card_count FROM payment_cards GROUP BY 1) cs
           ON cl.client_id = cs.client_id"""

M4 = """
    SELECT fa.alert_id, fa.rule_triggered, CAST(fa.risk_score AS SMALLINT) AS risk_score,
           CAST(fa.is_confirmed AS SMALLINT) AS is_confirmed, fa.reviewed_by, fa.reviewed_at,
           t.txn_id, t.reference, t.amount, t.currency, t.channel,
           CAST(t.is_international AS SMALLINT) AS is_international, t.initiated_at,
           cl.first_name || ' ' || cl.last_name AS client_name, cl.email AS client_email,
           CAST(cl.risk_score AS SMALLINT) AS client_risk_score, m.trade_name AS merchant_name,
           CASE WHEN fa.is_confirmed = 1 THEN 'Confirmed Fraud'
                WHEN fa.is_confirmed = 0 THEN 'False Positive'
                ELSE 'Pending Review' END AS alert_outcome
    FROM fraud_alerts fa
    JOIN transactions t ON fa.txn_id = t.txn_id
    JOIN clients cl ON t.client_id = cl.client_id
    LEFT JOIN merchants m ON t.merchant_id = m.merchant_id"""

M1_TABLES = ["transactions", "transaction_statuses"]
M2_TABLES = [*M1_TABLES, "merchants", "merchant_categories", "countries"]
M3_TABLES = [*M1_TABLES, "clients", "payment_cards"]
M4_TABLES = ["fraud_alerts", "clients", "merchants"]


# The tables after the batches of changes.
CHANGED = """
    changed_transactions AS (
        SELECT * REPLACE (
            CAST(CASE WHEN txn_id % 9 = 1 THEN fee WHEN txn_id % 5 = 1 THEN amount + 100 ELSE amount END
                 AS DECIMAL(14,2)) AS amount,
            CAST(CASE WHEN txn_id % 9 = 1 THEN 0 WHEN txn_id % 5 = 1 THEN net_amount + 100
                 ELSE net_amount END AS DECIMAL(14,2)) AS net_amount,
            CASE WHEN txn_id % 6 = 1 THEN CAST(1 + txn_id % 7 AS INTEGER) ELSE status_id END AS status_id,
            CASE WHEN txn_id % 10 = 6 THEN 'USD' ELSE currency END AS currency,
            CASE WHEN txn_id % 13 = 5 THEN initiated_at + INTERVAL 1 DAY ELSE initiated_at END
                AS initiated_at)
        FROM transactions WHERE txn_id % 7 <> 3 AND txn_id % 11 <> 2),
    changed_payment_cards AS (SELECT * FROM payment_cards WHERE card_id % 5 <> 0),
    changed_fraud_alerts AS (
        SELECT * REPLACE (CASE WHEN alert_id % 13 = 2 THEN 1 ELSE is_confirmed END AS is_confirmed)
        FROM fraud_alerts WHERE alert_id % 11 <> 5),
    changed_clients AS (
        SELECT * REPLACE (CASE WHEN client_id % 17 = 3 THEN 'moved@example.com' ELSE email END AS email)
        FROM clients)"""


def changed(sql: str) -> str:
    """A mart's SQL over the tables after all changes."""
    for table in ("transactions", "payment_cards", "fraud_alerts", "clients"):
        sql = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 changed_{table}", sql)
    tables = ["transactions", "transaction_statuses", "payment_cards", "fraud_alerts", "clients"]
    return using(*tables, "merchants", "merchant_categories", "countries", sql=f"WITH {CHANGED} {sql}")


def oracles() -> dict[str, str]:
    return {
        "mart_daily_transaction_summary_increments": changed(M1),
        "mart_merchant_performance_increments": changed(M2),
        "mart_client_360_increments": changed(M3),
        "mart_fraud_analysis_increments": changed(M4),
        "mart_daily_transaction_summary": using(*M1_TABLES, sql=M1),
        "mart_merchant_performance": using(*M2_TABLES, sql=M2),
        "mart_client_360": using(*M3_TABLES, sql=M3),
        "mart_fraud_analysis": using(*M4_TABLES, sql=M4),
        "stg_transactions": using("transactions", sql="SELECT * FROM transactions"),
        "stg_clients": using(
            "clients",
            sql="""SELECT client_id, first_name, last_name,
                          first_name || ' ' || last_name AS full_name, email, phone,
                          date_of_birth, country_id, city, risk_score, is_active, registered_at
                   FROM clients""",
        ),
        "stg_merchants": using(
            "merchants",
            sql="""SELECT merchant_id, legal_name, trade_name, mcc, country_id, city, is_active,
                          onboarded_at FROM merchants""",
        ),
        "stg_fraud_alerts": using("fraud_alerts", sql="SELECT * FROM fraud_alerts"),
        "join_inner_status": using(
            *M1_TABLES,
            sql="""SELECT t.txn_id, t.amount, s.code AS status_code
                   FROM transactions t JOIN transaction_statuses s USING (status_id)""",
        ),
        "join_left_keep_unmatched": using(
            *M1_TABLES,
            "merchants",
            sql="""SELECT m.merchant_id, m.legal_name, count(a.txn_id) AS approved_txns,
                          CAST(sum(a.amount) AS DECIMAL(24,2)) AS approved_amount
                   FROM merchants m LEFT JOIN (
                       SELECT t.* FROM transactions t JOIN transaction_statuses s
                       USING (status_id) WHERE s.code = 'APPROVED') a
                   ON m.merchant_id = a.merchant_id GROUP BY 1, 2""",
        ),
        "resolve_merchant": using(
            "transactions",
            "pos_terminals",
            sql="""SELECT t.txn_id, t.pos_id, t.merchant_id,
                          coalesce(p.merchant_id, t.merchant_id) AS resolved_merchant_id
                   FROM transactions t LEFT JOIN pos_terminals p ON t.pos_id = p.pos_id""",
        ),
        "card_network_match": using(
            "payment_cards",
            "card_networks",
            sql="""SELECT c.card_id, c.masked_pan, n.network_id AS matched_network_id,
                          n.name AS matched_network
                   FROM payment_cards c LEFT JOIN card_networks n
                   ON regexp_matches(c.masked_pan, n.prefix_regex)""",
        ),
        "serve_recent_days": using(
            *M1_TABLES,
            sql=f"""WITH m AS ({M1})
                SELECT txn_date, status, channel, currency, txn_count, gross_amount FROM m
                ORDER BY txn_date DESC, status, channel, currency LIMIT 5""",
        ),
        "serve_top_merchants": using(
            *M2_TABLES,
            sql=f"""WITH m AS ({M2})
                SELECT merchant_id, trade_name, total_txns, gross_revenue FROM m
                ORDER BY gross_revenue DESC NULLS LAST, merchant_id LIMIT 10""",
        ),
        "serve_top_clients": using(
            *M3_TABLES,
            sql=f"""WITH m AS ({M3})
                SELECT client_id, full_name, risk_score, total_spent FROM m
                ORDER BY total_spent DESC, client_id LIMIT 10""",
        ),
        "serve_risky_clients": using(
            *M3_TABLES,
            sql=f"""WITH m AS ({M3})
                SELECT client_id, full_name, risk_score, total_spent FROM m
                ORDER BY risk_score DESC, client_id LIMIT 10""",
        ),
        "serve_fraud_outcomes": using(
            *M4_TABLES,
            sql=f"""WITH m AS ({M4})
                SELECT alert_outcome, count(*) AS n_alerts,
                       CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount,
                       max(risk_score) AS max_risk_score,
                       max(initiated_at) AS last_initiated_at
                FROM m GROUP BY 1""",
        ),
        "order_fraud_by_risk": using(
            "fraud_alerts",
            sql="""SELECT fa.alert_id, fa.risk_score, t.amount,
                          rank() OVER (ORDER BY fa.risk_score DESC, t.amount DESC) AS risk_rank
                   FROM fraud_alerts fa JOIN transactions t ON fa.txn_id = t.txn_id""",
        ),
        "page_by_key": using(
            "transactions",
            sql="""SELECT txn_id, client_id, amount, initiated_at FROM transactions
                   ORDER BY txn_id LIMIT 500 OFFSET 1000""",
        ),
        "page_after_key": using(
            "transactions",
            sql="""SELECT txn_id, client_id, amount, initiated_at FROM transactions
                   WHERE txn_id > 700 ORDER BY txn_id LIMIT 500""",
        ),
        "serve_alerts_by_outcome": using(
            *M4_TABLES,
            sql=f"""WITH m AS ({M4})
                SELECT alert_id, txn_id, risk_score, amount, initiated_at FROM m
                WHERE alert_outcome = 'Confirmed Fraud' AND risk_score >= 70
                    AND initiated_at >= TIMESTAMP '1995-01-01'""",
        ),
        "sample_approved": using(
            "transactions",
            sql="""SELECT txn_id, amount FROM (
                     SELECT txn_id, amount,
                            row_number() OVER (ORDER BY md5('42:' || txn_id), txn_id) AS rn
                     FROM transactions WHERE status_id = 1)
                   WHERE rn <= (SELECT count(*) * 5 // 100 FROM transactions)""",
        ),
        "net_amount": using("transactions", sql="SELECT txn_id, amount, fee, net_amount FROM transactions"),
        "fee_compute": using(
            "transactions",
            sql="SELECT txn_id, amount, fee AS computed_fee FROM transactions",
        ),
        "risk_band": using(
            "transactions",
            sql="""SELECT txn_id, amount, CAST(CASE WHEN amount < 1000 THEN 60
                     WHEN amount < 3000 THEN 75 ELSE 90 END AS INTEGER) AS risk_band,
                     CAST(least(100, CASE WHEN amount < 1000 THEN 60 WHEN amount < 3000 THEN 75
                     ELSE 90 END + txn_id % 16) AS INTEGER) AS capped_score
                   FROM transactions""",
        ),
        "json_field": """
            SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    }
