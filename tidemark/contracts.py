"""Table contracts, value domains, thresholds and weights, in one place."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must stay exactly as they are for results to agree ----------

DEVICE_TYPES = ("mobile", "desktop", "tablet")
GEOS = ("USA", "UK", "IND", "CA")
EVENT_TYPES = ("landing", "scroll", "apply_click")
EMPLOYMENT_STATUSES = ("salaried", "self-employed", "unemployed")
APPLICATION_STATUSES = ("submitted", "approved", "rejected", "rejected - under age")
TXN_STATUSES = ("success", "failed", "reversed")

FRESHNESS_DAYS = 1              # visits older than this many midnights are stale
AGE_RANGE = (0, 100)
INTEREST_RATE_RANGE = (5.0, 35.0)
ADULT_AGE = 18
LIMIT_TO_INCOME_CAP = 1.5       # a requested limit above 1.5 x income is impossible
AMOUNT_TO_LIMIT_CAP = 1.5       # a transaction above 1.5 x limit is impossible

APP_ANOMALY_RATIO = 0.6         # requested limit / income
TXN_ANOMALY_RATIO = 0.75        # amount / approved limit
WATERMARK_DELAY = "2 hours"

FRESH_HOURS = 1                 # lag with a full freshness score
STALE_HOURS = 6                 # lag with a zero freshness score
DAILY_TXN_TARGET = 10000        # transactions a day for a full completeness score

AGE_BANDS = (
    (18, 25, "1. Youth (18-25)"),
    (26, 35, "2. Young Adult (26-35)"),
    (36, 55, "3. Adult (36-55)"),
)
LAST_AGE_BAND = "4. Senior (56+)"
MINOR_AGE_BAND = "0. Under 18"  # only in the strict form
NO_AGE_BAND = "Unknown"

# Parts of the score of one day, and of the daily trend.
TODAY_WEIGHTS = {"checks": 0.4, "freshness": 0.3, "risk": 0.3}
TREND_WEIGHTS = {"validity": 0.4, "quality": 0.3, "freshness": 0.2, "completeness": 0.1}
RISK_PER_ANOMALY = 0.5

# Headings of report columns.
DAY_LABEL = "date_label"
DAY_HEADING = "Time (Daily)"
TODAY_SCORE = "overall_data_trust_score_composite_pct"
NULL_RATE = "Null_Rate"
VISITOR_RATE = "Visitor_to_App_Rate"
APPROVAL_RATE = "App_to_Approval_Rate"
AGE_HEADING = "Applicant Age Group"
SHARE_HEADING = "Percent of Total (%)"
VISITS_HEADING = "Actual Visitor Count"
MARKER_HEADING = "ML_Anomaly_Marker"
TXN_ANOMALY_HEADING = "Daily Transaction Anomaly Count"
VIOLATION_DAY = "Violation_Date"
DUPLICATES = "Total_Duplicate_Records_Count"

# SQL names of the pipeline's tables, with their quality tier and a remark.
VIEWS = {
    "bronze_visitor_events": ("bronze_visitor_events", "bronze", "Visits as landed."),
    "bronze_applications": ("bronze_applications", "bronze", "Applications as landed."),
    "bronze_accounts": ("bronze_accounts", "bronze", "Accounts as landed."),
    "bronze_transactions": ("bronze_transactions", "bronze", "Transactions as landed."),
    "silver_visitor_events_clean": ("silver_visitor_events", "silver", "Visits that pass the technical rules."),
    "silver_applications_clean": ("silver_applications", "silver", "Applications that pass the technical rules."),
    "silver_accounts_clean": ("silver_accounts", "silver", "Accounts that pass the technical rules."),
    "silver_transactions_clean": ("silver_transactions", "silver", "Transactions that pass the technical rules."),
    "gold_applications_validated": ("gold_applications", "gold", "Applications that pass the business rules, with features."),
    "gold_accounts_validated": ("gold_accounts", "gold", "Accounts of approved, validated applications."),
    "gold_transaction_features": ("gold_transaction_features", "gold", "Transactions within the limit of their account."),
    "gold_daily_metrics": ("gold_daily_metrics", "gold", "Key figures per day."),
    "gold_app_ml_anomaly_agg": ("gold_app_ml_anomaly_agg", "gold", "Flagged applications per day."),
    "gold_txn_ml_anomaly_agg": ("gold_txn_ml_anomaly_agg", "gold", "Flagged transactions per day."),
    "quality_log": ("quality_log", "gold", "Rows checked and failed per day, table and rule."),
}

# --- Input contracts -----------------------------------------------------------------

_EVENT_TIME = {"accounts": "account_open_timestamp"}

_TEXT, _WHOLE, _REAL, _MOMENT = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

_COLUMNS = {
    "visitor_events": {
        "visitor_id": _TEXT, "event_type": _TEXT, "campaign_id": _TEXT, "device_type": _TEXT,
        "geo": _TEXT, "timestamp": _MOMENT, "session_duration": _REAL,
    },
    "applications": {
        "app_id": _TEXT, "visitor_id": _TEXT, "applicant_age": _WHOLE, "annual_income": _REAL,
        "employment_status": _TEXT, "req_credit_limit": _WHOLE, "timestamp": _MOMENT,
        "application_status": _TEXT,
    },
    "accounts": {
        "account_id": _TEXT, "app_id": _TEXT, "approved_limit": _WHOLE, "interest_rate": _REAL,
        "account_open_timestamp": _MOMENT, "account_status": _TEXT,
    },
    "transactions": {
        "txn_id": _TEXT, "account_id": _TEXT, "amount": _REAL, "merchant_cat_code": _TEXT,
        "location": _TEXT, "state": _TEXT, "merchant_city": _TEXT, "timestamp": _MOMENT,
    },
}

ENTITIES = tuple(_COLUMNS)


def event_time(entity: str) -> str:
    """Name of the column that dates a row of ``entity``."""
    return _EVENT_TIME.get(entity, "timestamp")


def contract(entity: str) -> T.StructType:
    """Pinned schema of a landed ``entity``, without partition and ingest columns."""
    return T.StructType([T.StructField(name, kind) for name, kind in _COLUMNS[entity].items()])
