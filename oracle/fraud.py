"""Oracles for detectors, alert building, settlement and refunds."""

from oracle.tables import pct, using
from txnlake import fixed_values as fixed

DAY = 86_400


def _trailing(source: str, seconds: int, extra: str = "") -> str:
    return f"""SELECT *, CAST(count(*) OVER w AS BIGINT) AS n_in_window {extra}
        FROM (SELECT *, CAST(floor(epoch(initiated_at)) AS BIGINT) AS sec FROM {source})
        WINDOW w AS (PARTITION BY client_id ORDER BY sec
                     RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"""


EVENTS = """(SELECT event_id AS txn_id, user_id AS client_id, ts AS initiated_at,
             CAST(value AS DECIMAL(14,2)) AS amount FROM events)"""

HIGH_VALUE = """SELECT txn_id, client_id, initiated_at, amount, channel, currency
    FROM transactions WHERE amount > 3000 AND channel IN ('ONLINE','MOBILE')
    AND is_international = 1 AND currency <> 'USD'"""



def _spree(seconds: int, minimum: int) -> str:
    trailing = _trailing(
        "(SELECT * FROM transactions WHERE channel = 'ONLINE' AND is_international = 1 "
        "AND currency <> 'USD')",
        seconds,
        ", CAST(len(list_distinct(list(currency) OVER w)) AS INTEGER) AS n_distinct",
    )
    return f"""SELECT txn_id, client_id, initiated_at, amount, currency, n_in_window, n_distinct
        FROM ({trailing}) WHERE n_in_window >= {minimum}"""


SPREE = _spree(180 * DAY, 2)

TAKEOVER = """SELECT txn_id, client_id, device_id, initiated_at, amount, currency
    FROM (SELECT *,
                 min(initiated_at) OVER (PARTITION BY client_id, device_id) AS first_at,
                 min(initiated_at) OVER (PARTITION BY client_id) AS client_first_at
          FROM transactions)
    WHERE initiated_at = first_at AND initiated_at > client_first_at AND amount >= 500
      AND channel = 'ONLINE' AND currency <> 'USD'"""


def oracles() -> dict[str, str]:
    def rules(*parts: list[str]) -> str:
        return "[" + ", ".join(f"'{r}'" for p in parts for r in p) + "]"

    labels = ", ".join(
        f"('{p}', '{r}')" for p, group in fixed.PATTERN_RULES.items() for r in group
    )

    def alerts(velocity: tuple, testing: tuple, spree: tuple, nights: int) -> str:
        """Alerts at (seconds, transactions) and, for testing, the largest amount."""
        online = "(SELECT * FROM transactions WHERE channel = 'ONLINE')"
        tiny = f"(SELECT * FROM transactions WHERE channel = 'ONLINE' AND amount <= {testing[2]})"
        detections = f"""
            SELECT 'velocity_burst' AS pattern, txn_id, client_id, amount
            FROM ({_trailing(online, velocity[0])}) WHERE n_in_window >= {velocity[1]}
            UNION ALL SELECT 'card_testing', txn_id, client_id, amount
            FROM ({_trailing(tiny, testing[0])}) WHERE n_in_window >= {testing[1]}
            UNION ALL SELECT 'high_value_fraud', txn_id, client_id, amount FROM ({HIGH_VALUE})
            UNION ALL SELECT 'night_owl', txn_id, client_id, amount FROM (
                SELECT *, count(*) OVER (PARTITION BY client_id, CAST(initiated_at AS DATE)) AS n_night
                FROM transactions
                WHERE channel IN ('ONLINE','MOBILE') AND hour(initiated_at) BETWEEN 1 AND 4)
            WHERE n_night >= {nights}
            UNION ALL SELECT 'international_spree', txn_id, client_id, amount FROM ({_spree(*spree)})
            UNION ALL SELECT 'account_takeover', txn_id, client_id, amount FROM ({TAKEOVER})"""
        return using(
            "transactions",
            sql=f"""SELECT txn_id, client_id, d.pattern, rule_triggered,
                           CAST(least(100, CASE WHEN amount < 1000 THEN 60
                                WHEN amount < 3000 THEN 75 ELSE 90 END) AS INTEGER) AS risk_score
                    FROM ({detections}) d
                    JOIN (VALUES {labels}) l(pattern, rule_triggered) ON l.pattern = d.pattern""",
        )

    return {
        "fraud_velocity": f"""SELECT txn_id, client_id, initiated_at, amount, n_in_window
            FROM ({_trailing(EVENTS, 600)}) WHERE n_in_window >= 2""",
        "fraud_card_testing": f"""SELECT txn_id, client_id, initiated_at, amount, n_in_window
            FROM ({_trailing(f"(SELECT * FROM {EVENTS} WHERE amount <= 1.99)", DAY)})
            WHERE n_in_window >= 2""",
        "fraud_high_value": using("transactions", sql=HIGH_VALUE),
        "fraud_night_owl": """
            SELECT user_id AS client_id, CAST(ts AS DATE) AS txn_date, count(*) AS n_night,
                   min(ts) AS first_at, max(ts) AS last_at
            FROM events WHERE hour(ts) BETWEEN 1 AND 4 GROUP BY 1, 2 HAVING count(*) >= 2""",
        "fraud_intl_spree": using("transactions", sql=SPREE),
        "fraud_account_takeover": using("transactions", sql=TAKEOVER),
        "fraud_alerts_build": alerts((30 * DAY, 2), (180 * DAY, 2, "100.00"), (180 * DAY, 2), 1),
        "fraud_alerts_documented": alerts((600, 5), (900, 10, "1.99"), (9000, 3), 2),
        "rule_candidates": using(
            "transactions",
            sql=f"""SELECT txn_id, unnest(list_distinct(list_concat(
                        {rules(fixed.GENERIC_RULES)},
                        CASE WHEN amount > 3000 THEN {rules(fixed.HIGH_AMOUNT_RULES)}
                             ELSE [] END,
                        CASE WHEN channel IN ('ONLINE','MOBILE')
                             THEN {rules(fixed.ONLINE_RULES)} ELSE [] END,
                        CASE WHEN is_international = 1
                             THEN {rules(fixed.INTERNATIONAL_RULES)} ELSE [] END))) AS rule
                    FROM transactions WHERE is_flagged = 1""",
        ),
        "fraud_rule_summary": using(
            "fraud_alerts",
            sql=f"""SELECT rule_triggered, count(*) AS n_alerts,
                           count(is_confirmed) AS n_reviewed,
                           CAST(coalesce(sum(is_confirmed), 0) AS BIGINT) AS n_confirmed,
                           CASE WHEN count(is_confirmed) > 0 THEN
                                {pct("sum(is_confirmed)", "greatest(count(is_confirmed), 1)")}
                           END AS confirmed_pct,
                           CAST(((200 * CAST(sum(risk_score) AS BIGINT) + count(*))
                                // (2 * count(*))) * CAST(0.01 AS DECIMAL(3,2))
                                AS DECIMAL(6,2)) AS avg_risk_score
                    FROM fraud_alerts GROUP BY 1""",
        ),
        "pos_activity": using(
            "pos_terminals",
            "transactions",
            sql="""SELECT p.pos_id, p.merchant_id, count(t.txn_id) AS n_txns,
                          CAST(sum(t.amount) AS DECIMAL(18,2)) AS total_amount,
                          max(t.initiated_at) AS last_txn_at
                   FROM pos_terminals p LEFT JOIN transactions t ON p.pos_id = t.pos_id
                   GROUP BY 1, 2""",
        ),
        "default_card": using(
            "payment_cards",
            sql="""SELECT client_id, n_cards, card_id, masked_pan FROM (
                     SELECT *, count(*) OVER (PARTITION BY client_id) AS n_cards,
                            row_number() OVER (PARTITION BY client_id ORDER BY card_id) AS rn
                     FROM payment_cards) WHERE rn = 1""",
        ),
        "settlement_batches": using("settlement_batches", sql="SELECT * FROM settlement_batches"),
        "refund_reconcile": using(
            "refunds",
            "transactions",
            sql="""SELECT r.refund_id, r.original_txn_id, t.merchant_id, r.amount,
                          t.amount AS original_amount,
                          CAST(sum(r.amount) OVER (PARTITION BY r.original_txn_id)
                               AS DECIMAL(18,2)) AS refunded_total,
                          CAST(r.amount < t.amount AS INTEGER) AS is_partial,
                          CAST(sum(r.amount) OVER (PARTITION BY r.original_txn_id) > t.amount
                               AS INTEGER) AS is_over,
                          CAST(date_diff('hour', r.initiated_at, r.resolved_at) AS BIGINT)
                               AS hours_to_resolve
                   FROM refunds r JOIN transactions t ON r.original_txn_id = t.txn_id""",
        ),
    }
