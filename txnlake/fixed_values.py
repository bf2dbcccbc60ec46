"""Values that results depend on: lookup rows, code lists, thresholds, formats."""

# --- Fixed values: lookup table rows; ids count from 1 in this order -----------

COUNTRIES = [
    ("US", "United States", "USD"),
    ("GB", "United Kingdom", "GBP"),
    ("DE", "Germany", "EUR"),
    ("FR", "France", "EUR"),
    ("EG", "Egypt", "EGP"),
    ("SA", "Saudi Arabia", "SAR"),
    ("AE", "UAE", "AED"),
    ("CA", "Canada", "CAD"),
    ("AU", "Australia", "AUD"),
    ("NG", "Nigeria", "NGN"),
]

TRANSACTION_TYPES = [
    ("PURCHASE", "Card Purchase", 1),
    ("REFUND", "Refund", 0),
    ("WITHDRAWAL", "ATM Withdrawal", 1),
    ("TRANSFER", "P2P Transfer", 1),
    ("TOP_UP", "Wallet Top-Up", 0),
    ("PAYMENT", "Bill Payment", 1),
    ("REVERSAL", "Transaction Reversal", 0),
]

TRANSACTION_STATUSES = [
    ("APPROVED", "Approved"),
    ("DECLINED", "Declined"),
    ("PENDING", "Pending"),
    ("REVERSED", "Reversed"),
    ("FAILED", "Failed"),
    ("SETTLED", "Settled"),
    ("CHARGEBACK", "Chargeback"),
]

CARD_NETWORKS = [
    ("Visa", "^4"),
    ("Mastercard", "^5[1-5]"),
    ("Amex", "^3[47]"),
    ("Discover", "^6(?:011|5)"),
]

MERCHANT_CATEGORIES = [
    (5411, "Grocery Stores"),
    (5812, "Restaurants"),
    (5541, "Gas Stations"),
    (5912, "Drug Stores"),
    (5732, "Electronics Stores"),
    (5651, "Clothing Stores"),
    (7011, "Hotels"),
    (4111, "Transportation"),
    (5999, "Misc Retail"),
    (5045, "Computers & Peripherals"),
    (5400, "Supermarkets"),
    (7841, "Video Rental"),
    (5621, "Women Clothing"),
    (5311, "Department Stores"),
    (5691, "Men Clothing"),
]

# --- Fixed values: accepted codes ----------------------------------------------

CHANNELS = ["POS", "ONLINE", "ATM", "MOBILE", "IVR"]
BATCH_STATUSES = ["PENDING", "PROCESSING", "SETTLED", "FAILED"]
CONFIRMED, FALSE_POSITIVE, PENDING_REVIEW = (
    "Confirmed Fraud",
    "False Positive",
    "Pending Review",
)
ALERT_OUTCOMES = [CONFIRMED, FALSE_POSITIVE, PENDING_REVIEW]

# --- Fixed values: fraud rules -------------------------------------------------

GENERIC_RULES = [
    "VELOCITY_CHECK",
    "BIN_MISMATCH",
    "MULTIPLE_DECLINES",
    "DUPLICATE_TXN",
    "BLACKLIST_HIT",
    "PATTERN_MATCH",
]
HIGH_AMOUNT_RULES = ["HIGH_AMOUNT", "VELOCITY_CHECK", "RISK_SCORE_BREACH"]
ONLINE_RULES = ["NEW_DEVICE", "IP_MISMATCH", "BROWSER_FINGERPRINT"]
INTERNATIONAL_RULES = ["COUNTRY_BLOCK", "CROSS_BORDER", "CURRENCY_MISMATCH"]

PATTERN_RULES = {
    "velocity_burst": ["VELOCITY_CHECK", "RAPID_SUCCESSION", "SAME_MERCHANT_REPEAT"],
    "card_testing": ["CARD_TESTING", "MICRO_AMOUNT", "BIN_MISMATCH"],
    "high_value_fraud": ["HIGH_AMOUNT", "RISK_SCORE_BREACH", "LARGE_TXN_ONLINE"],
    "night_owl": ["NIGHT_TRANSACTION", "OFF_HOURS", "UNUSUAL_LOCATION"],
    "international_spree": ["CROSS_BORDER", "CURRENCY_MISMATCH", "COUNTRY_BLOCK"],
    "account_takeover": ["NEW_DEVICE", "IP_MISMATCH", "BROWSER_FINGERPRINT"],
}

# --- Fixed values: fees --------------------------------------------------------

FEE_RATES = ["0.015", "0.020", "0.025", "0.030"]
FEE_FLATS = ["0.10", "0.25", "0.50"]

# --- Fixed values: change feed and lake names ----------------------------------

TOPIC_PREFIX = "cdc"
DATABASE = "payment_gateway"
CHANGE_OPS = ["r", "c", "u", "d"]
