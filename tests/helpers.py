"""Small builders shared by the tests."""

from datetime import datetime


def ts(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples; None sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


VISITS = "visitor_id string, event_type string, campaign_id string, device_type string, geo string, timestamp timestamp, session_duration double, _load_timestamp timestamp"
APPS = "app_id string, visitor_id string, applicant_age bigint, annual_income double, employment_status string, req_credit_limit bigint, timestamp timestamp, application_status string, _load_timestamp timestamp"
ACCOUNTS = "account_id string, app_id string, approved_limit bigint, interest_rate double, account_open_timestamp timestamp, account_status string, _load_timestamp timestamp"
TXNS = "txn_id string, account_id string, amount double, merchant_cat_code string, location string, state string, merchant_city string, timestamp timestamp, _load_timestamp timestamp"

_DEFAULTS = {
    "visits": dict(visitor_id="v", event_type="landing", campaign_id="C1", device_type="mobile", geo="UK",
                   timestamp=ts("2024-01-30 11:00:00"), session_duration=1.0, _load_timestamp=ts("2024-01-30 12:00:00")),
    "apps": dict(app_id="a", visitor_id="v", applicant_age=30, annual_income=1000.0, employment_status="salaried",
                 req_credit_limit=100, timestamp=ts("2024-01-30 11:00:00"), application_status="approved",
                 _load_timestamp=ts("2024-01-30 12:00:00")),
    "accounts": dict(account_id="c", app_id="a", approved_limit=100, interest_rate=20.0,
                     account_open_timestamp=ts("2024-01-30 11:00:00"), account_status="active",
                     _load_timestamp=ts("2024-01-30 12:00:00")),
    "txns": dict(txn_id="t", account_id="c", amount=10.0, merchant_cat_code="5411", location="UK", state="NA",
                 merchant_city="x", timestamp=ts("2024-01-30 11:00:00"), _load_timestamp=ts("2024-01-30 12:00:00")),
}
SCHEMAS = {"visits": VISITS, "apps": APPS, "accounts": ACCOUNTS, "txns": TXNS}


def table(spark, kind, *changes):
    """One row per dict of changes to a row that passes every rule."""
    names = [part.split()[0] for part in SCHEMAS[kind].split(", ")]
    data = [tuple({**_DEFAULTS[kind], **change}[n] for n in names) for change in changes]
    return spark.createDataFrame(data, SCHEMAS[kind])


METRICS = (
    "date date, total_visits bigint, applications_count bigint, approvals_count bigint, total_transactions bigint, "
    "avg_txn_amount double, conversion_rate double, approval_rate double, detected_tdq_bdq_anomalies_count bigint, "
    "ml_anomalies_count bigint, apply_clicks bigint, avg_freshness_lag_hours double, schema_compliance_pct double, "
    "campaign_id_null_pct double"
)
_DAY = dict(date=ts("2024-01-30 00:00:00").date(), total_visits=100, applications_count=10, approvals_count=5,
            total_transactions=5000, avg_txn_amount=1.0, conversion_rate=0.1, approval_rate=0.5,
            detected_tdq_bdq_anomalies_count=0, ml_anomalies_count=0, apply_clicks=1, avg_freshness_lag_hours=1.0,
            schema_compliance_pct=100.0, campaign_id_null_pct=0.0)


def metrics(spark, *changes):
    names = [part.split()[0] for part in METRICS.split(", ")]
    return spark.createDataFrame([tuple({**_DAY, **c}[n] for n in names) for c in changes], METRICS)
