"""The thresholds of a run reach the daily metrics as they reach the anomaly tables."""

import pytest

from helpers import ts
from tidemark.operators.anomalies import app_anomalies_daily, txn_anomalies_daily
from tidemark.plans.metrics import gold_daily_metrics


@pytest.mark.parametrize("app, txn", [(0.6, 0.75), (0.2, 0.9), (0.59, 0.1)])
def test_metrics_agree_with_anomaly_tables(spark, app, txn):
    day = ts("2024-01-30 10:00:00")
    visits = spark.createDataFrame([("v", "landing", day)] * 9, "visitor_id string, event_type string, timestamp timestamp")
    apps = spark.createDataFrame(
        [(str(i), "approved", r, day) for i, r in enumerate((0.1, 0.2, 0.59, 0.6, 0.61, None))],
        "app_id string, application_status string, req_income_ratio double, timestamp timestamp")
    txns = spark.createDataFrame(
        [(str(i), 1.0, r, day) for i, r in enumerate((0.1, 0.74, 0.75, 0.76, 0.95, None))],
        "txn_id string, amount double, txn_limit_ratio double, timestamp timestamp")
    quality = spark.createDataFrame(
        [(day.date(), 0, 1.0, 1, 1, 0, 1)],
        "date date, failed_checks int, lag_hours double, compliant_rows int, bronze_rows int, campaign_nulls int, campaign_rows int")
    metrics = gold_daily_metrics(visits, apps, txns, [quality], app, txn).first()
    daily = app_anomalies_daily(apps, app).first()[1] + txn_anomalies_daily(txns, txn).first()[1]
    assert metrics["ml_anomalies_count"] == daily
