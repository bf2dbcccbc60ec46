"""The 13 source tables, their keys, and the column types marts are served with."""

from __future__ import annotations

from dataclasses import dataclass


# DDL per table; readers pass it to Spark as it is.
TABLE_SCHEMAS: dict[str, str] = {
    "countries": (
        "country_id int, code string, name string, currency string, created_at timestamp"
    ),
    "transaction_types": ("type_id int, code string, label string, is_debit int"),
    "transaction_statuses": ("status_id int, code string, label string"),
    "card_networks": ("network_id int, name string, prefix_regex string"),
    "merchant_categories": ("mcc int, description string"),
    "merchants": (
        "merchant_id bigint, legal_name string, trade_name string, mcc int, tax_id string, "
        "country_id int, city string, address string, zip_code string, email string, "
        "phone string, is_active int, onboarded_at timestamp, created_at timestamp"
    ),
    "pos_terminals": (
        "pos_id bigint, serial_number string, merchant_id bigint, model string, "
        "firmware_version string, location_label string, is_active int, "
        "installed_at timestamp, last_seen_at timestamp, created_at timestamp"
    ),
    "clients": (
        "client_id bigint, first_name string, last_name string, email string, phone string, "
        "date_of_birth date, national_id string, country_id int, city string, address string, "
        "zip_code string, risk_score int, is_active int, registered_at timestamp, "
        "created_at timestamp"
    ),
    "payment_cards": (
        "card_id bigint, client_id bigint, network_id int, masked_pan string, "
        "card_token string, holder_name string, expiry_month int, expiry_year int, "
        "is_default int, is_active int, issued_at timestamp, created_at timestamp"
    ),
    "transactions": (
        "txn_id bigint, reference string, client_id bigint, card_id bigint, pos_id bigint, "
        "merchant_id bigint, type_id int, status_id int, amount decimal(14,2), "
        "currency string, fee decimal(10,2), net_amount decimal(14,2), auth_code string, "
        "channel string, ip_address string, device_id string, is_recurring int, "
        "is_international int, is_flagged int, failure_reason string, "
        "initiated_at timestamp, processed_at timestamp, settled_at date, "
        "created_at timestamp"
    ),
    "refunds": (
        "refund_id bigint, original_txn_id bigint, reference string, amount decimal(14,2), "
        "reason string, status_id int, initiated_at timestamp, resolved_at timestamp, "
        "created_at timestamp"
    ),
    "fraud_alerts": (
        "alert_id bigint, txn_id bigint, rule_triggered string, risk_score int, "
        "is_confirmed int, reviewed_by string, reviewed_at timestamp, created_at timestamp"
    ),
    "settlement_batches": (
        "batch_id bigint, merchant_id bigint, batch_date date, txn_count bigint, "
        "gross_amount decimal(18,2), total_fees decimal(18,2), net_payout decimal(18,2), "
        "currency string, status string, settled_at timestamp, created_at timestamp"
    ),
}

PRIMARY_KEYS = {
    "countries": "country_id",
    "transaction_types": "type_id",
    "transaction_statuses": "status_id",
    "card_networks": "network_id",
    "merchant_categories": "mcc",
    "merchants": "merchant_id",
    "pos_terminals": "pos_id",
    "clients": "client_id",
    "payment_cards": "card_id",
    "transactions": "txn_id",
    "fraud_alerts": "alert_id",
    "refunds": "refund_id",
    "settlement_batches": "batch_id",
}

WATERMARK_COLUMN = "created_at"


def polled_tables() -> list[str]:
    """Tables an incremental read can follow: those that carry the watermark column."""
    return [t for t in PRIMARY_KEYS if f"{WATERMARK_COLUMN} " in TABLE_SCHEMAS[t]]


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


FOREIGN_KEYS = [
    ForeignKey("merchants", "country_id", "countries"),
    ForeignKey("merchants", "mcc", "merchant_categories"),
    ForeignKey("pos_terminals", "merchant_id", "merchants"),
    ForeignKey("clients", "country_id", "countries"),
    ForeignKey("payment_cards", "client_id", "clients"),
    ForeignKey("payment_cards", "network_id", "card_networks"),
    ForeignKey("transactions", "client_id", "clients"),
    ForeignKey("transactions", "card_id", "payment_cards"),
    ForeignKey("transactions", "pos_id", "pos_terminals"),
    ForeignKey("transactions", "merchant_id", "merchants"),
    ForeignKey("transactions", "type_id", "transaction_types"),
    ForeignKey("transactions", "status_id", "transaction_statuses"),
    ForeignKey("refunds", "original_txn_id", "transactions"),
    ForeignKey("refunds", "status_id", "transaction_statuses"),
    ForeignKey("fraud_alerts", "txn_id", "transactions"),
    ForeignKey("settlement_batches", "merchant_id", "merchants"),
]

# Unique keys besides the primary keys. E-mail compares without case.
UNIQUE_KEYS: list[tuple[str, tuple[str, ...]]] = [
    ("countries", ("code",)),
    ("transaction_types", ("code",)),
    ("transaction_statuses", ("code",)),
    ("card_networks", ("name",)),
    ("merchants", ("tax_id",)),
    ("pos_terminals", ("serial_number",)),
    ("clients", ("lower(email)",)),
    ("clients", ("national_id",)),
    ("payment_cards", ("card_token",)),
    ("transactions", ("reference",)),
    ("refunds", ("reference",)),
    ("settlement_batches", ("merchant_id", "batch_date")),
]

# Column types of the served marts; marts are cast to these before any write. Entity ids
# and fee totals are wider than a small serving table needs: a 32-bit id or a twelve-digit
# total would overflow on large tables with one very busy merchant. ``None`` keeps a
# timestamp in whichever flavour (with or without zone) it was read.
SERVING_TYPES: dict[str, dict[str, str | None]] = {
    "mart_daily_transaction_summary": {
        "txn_date": "date",
        "status": "string",
        "channel": "string",
        "currency": "string",
        "txn_count": "bigint",
        "gross_amount": "decimal(18,2)",
        "total_fees": "decimal(18,2)",
        "net_amount": "decimal(18,2)",
        "fraud_count": "bigint",
        "fraud_rate_pct": "decimal(6,2)",
        "avg_txn_amount": "decimal(14,2)",
        "max_txn_amount": "decimal(14,2)",
    },
    "mart_merchant_performance": {
        "merchant_id": "bigint",
        "trade_name": "string",
        "legal_name": "string",
        "category": "string",
        "country": "string",
        "total_txns": "bigint",
        "gross_revenue": "decimal(18,2)",
        "total_fees": "decimal(18,2)",
        "net_revenue": "decimal(18,2)",
        "avg_txn_value": "decimal(14,2)",
        "fraud_txns": "bigint",
        "fraud_rate_pct": "decimal(6,2)",
        "first_txn_at": None,
        "last_txn_at": None,
    },
    "mart_client_360": {
        "client_id": "bigint",
        "full_name": "string",
        "email": "string",
        "country_id": "smallint",
        "risk_score": "smallint",
        "registered_at": None,
        "card_count": "int",
        "total_txns": "bigint",
        "approved_txns": "bigint",
        "declined_txns": "bigint",
        "fraud_txns": "bigint",
        "total_spent": "decimal(18,2)",
        "avg_txn_amount": "decimal(14,2)",
        "max_txn_amount": "decimal(14,2)",
        "last_txn_at": None,
    },
    "mart_fraud_analysis": {
        "alert_id": "bigint",
        "rule_triggered": "string",
        "risk_score": "smallint",
        "is_confirmed": "smallint",
        "reviewed_by": "string",
        "reviewed_at": None,
        "txn_id": "bigint",
        "reference": "string",
        "amount": "decimal(14,2)",
        "currency": "string",
        "channel": "string",
        "is_international": "smallint",
        "initiated_at": None,
        "client_name": "string",
        "client_email": "string",
        "client_risk_score": "smallint",
        "merchant_name": "string",
        "alert_outcome": "string",
    },
}
