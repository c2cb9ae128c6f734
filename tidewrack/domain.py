"""Fixed values that results depend on. Stated once, used everywhere."""

# Layers and published datasets
LAYERS = ("raw", "bronze", "silver", "gold", "quarantine")
GOLD_DATASETS = (
    "daily_revenue",
    "customer_activity",
    "country_performance",
    "fraud_summary",
    "merchant_statistics",
    "system_performance",
)
TABLE_ALIASES = {"gold_transactions": "gold_country_performance"}

# Accepted currencies and their fixed rate to GBP
CURRENCIES = ("GBP", "EUR", "USD", "JPY")
FX_TO_GBP = {"GBP": "1.0000", "EUR": "0.8500", "USD": "0.7800", "JPY": "0.0052"}

# Known countries; any other code is "Unknown" and counts as unusual
COUNTRY_NAMES = {
    "GB": "United Kingdom",
    "IE": "Ireland",
    "FR": "France",
    "DE": "Germany",
    "US": "United States",
    "NL": "Netherlands",
    "ES": "Spain",
    "IT": "Italy",
    "SE": "Sweden",
    "NO": "Norway",
}
UNKNOWN_COUNTRY_NAME = "Unknown"

MERCHANT_CATEGORIES = (
    "electronics",
    "groceries",
    "travel",
    "fuel",
    "restaurants",
    "healthcare",
    "entertainment",
)
DEVICES = ("mobile", "web", "pos", "atm", "iot")

# Fraud flag and default risk
FRAUD_RISK = "0.800"
FRAUD_COUNTRY = "XX"
DEFAULT_RISK = "0.050"

# Quality rules
REQUIRED_FIELDS = ("event_id", "event_type", "timestamp")
FINANCIAL_REQUIRED_FIELDS = ("customer_id", "amount", "currency")
NON_FINANCIAL_DATASETS = ("logs", "iot")
FUTURE_TOLERANCE_SECONDS = 60
PUBLISH_GATE_SCORE = 95
WARN_SCORE = 97

# Masking policies
PII_COLUMNS = ("email", "phone", "ip_address", "address", "customer_name")
MASKED_COLUMNS = ("email",)
HASHED_COLUMNS = ("phone", "ip_address")
TOKENISED_COLUMNS = ("customer_name", "address")
PII_POLICIES = ("administrator", "analyst", "restricted")

# Defaults for missing grouping keys in gold
UNKNOWN_KEY = "unknown"
UNKNOWN_COUNTRY = "UN"

# Alarm, lateness and retention
LAG_ALARM_MS = 60_000
ALARM_POINTS = 3
ALARM_BREACHES = 2
LATE_AFTER_HOURS = 2
DEDUP_HORIZON = "18 hours"
RAW_RETENTION_DAYS = {"dev": 14, "stage": 30, "prod": 90}
QUARANTINE_RETENTION_CAP_DAYS = 30
