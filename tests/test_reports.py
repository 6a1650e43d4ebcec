"""Report queries on small metric tables."""

from datetime import date

import pytest
from helpers import metrics, rows, table, ts

from tidemark.plans import reports, silver

AS_OF = "2024-01-30 12:00:00"
DAY = date(2024, 1, 30)


@pytest.mark.parametrize("change,score", [
    ({"avg_freshness_lag_hours": 1.0}, 100.0),
    ({"avg_freshness_lag_hours": 3.5}, 85.0),
    ({"avg_freshness_lag_hours": 6.0}, 70.0),
    ({"avg_freshness_lag_hours": 6.01}, 70.0),
    ({"detected_tdq_bdq_anomalies_count": 5}, 80.0),
    ({"detected_tdq_bdq_anomalies_count": 50}, 60.0),   # failure rate is capped at 100%
    ({"ml_anomalies_count": 300}, 55.0),                # risk has no floor: -50
])
def test_trust_score_today(spark, change, score):
    out = rows(reports.trust_score_today(metrics(spark, change), AS_OF))
    assert out == [("2024-01-30", pytest.approx(score))]


def test_trust_score_today_floor_and_day(spark):
    df = metrics(spark, {"ml_anomalies_count": 300}, {"date": date(2024, 1, 29)}, {"applications_count": 0})
    assert [r[1] for r in rows(reports.trust_score_today(df, AS_OF, risk_floor=0))] == [pytest.approx(70.0)]


@pytest.mark.parametrize("flagged,seconds,label,signed", [
    ("2024-01-30 11:59:01", 59, "0 min ago", 59),
    ("2024-01-30 11:00:01", 3599, "59 min ago", 3599),
    ("2024-01-30 11:00:00", 3600, "1 hr ago", 3600),
    ("2024-01-29 12:00:01", 86399, "23 hr ago", 86399),
    ("2024-01-29 12:00:00", 86400, "1 days ago", 86400),
    ("2024-01-30 14:00:00", 7200, "2 hr ago", -7200),   # a future time shows as past
    (None, None, None, None),
])
def test_time_since_last_anomaly(spark, flagged, seconds, label, signed):
    apps = spark.createDataFrame([(ts("2024-01-01 00:00:00"), 0.7 if flagged else 0.6)], "timestamp timestamp, req_income_ratio double")
    txns = spark.createDataFrame([(ts(flagged or "2024-01-02 00:00:00"), 0.8 if flagged else 0.75)], "timestamp timestamp, txn_limit_ratio double")
    assert rows(reports.time_since_last_anomaly(apps, txns, AS_OF)) == [(seconds, label, signed)]


def test_trust_score_trend(spark):
    df = metrics(
        spark,
        {"date": date(2024, 1, 1), "total_visits": 0, "applications_count": 0, "total_transactions": 0},
        {"date": date(2024, 1, 2), "avg_freshness_lag_hours": 7.0, "total_transactions": 10000, "detected_tdq_bdq_anomalies_count": 1011},
        {"date": date(2024, 1, 3), "avg_freshness_lag_hours": 3.0, "total_transactions": 20000, "schema_compliance_pct": 50.0},
    )
    out = {r["date"].day: r for r in reports.trust_score_trend(df).collect()}
    assert out[1].quality_score_pct is None and out[1].final_data_trust_score is None
    assert [float(x) for x in out[2][3:]] == [90.0, 0.0, 100.0, 77.0]
    assert [float(x) for x in out[3][3:]] == [100.0, 50.0, 100.0, 70.0]
    assert dict(reports.trust_score_trend(df).dtypes)["final_data_trust_score"] == "decimal(5,2)"
    assert [r["date"].day for r in reports.trust_score_trend(df).collect()] == [3, 2, 1]


def test_values_that_do_not_fit_become_null(spark):
    df = metrics(spark, {"detected_tdq_bdq_anomalies_count": 10**9})
    assert reports.trust_score_trend(df).first().quality_score_pct is None


def test_plain_trends(spark):
    df = metrics(spark, {"date": date(2024, 1, 2)}, {"date": date(2024, 1, 1), "ml_anomalies_count": 2, "campaign_id_null_pct": 25.0, "conversion_rate": 0.0})
    assert [tuple(r) for r in reports.freshness_trend(df).collect()] == [("2024-01-02", 1.0), ("2024-01-01", 1.0)]
    assert [tuple(r) for r in reports.null_rate_trend(df).collect()] == [("2024-01-02", 0.0), ("2024-01-01", 25.0)]
    assert [tuple(r) for r in reports.conversion_trend(df).collect()] == [("2024-01-01", 0.0, 50.0), ("2024-01-02", 10.0, 50.0)]
    marks = reports.visits_with_anomaly_marker(df)
    assert marks.columns == ["date_label", "Actual Visitor Count", "ML_Anomaly_Marker"]
    assert [tuple(r) for r in marks.collect()] == [("2024-01-01", 100, 100), ("2024-01-02", 100, None)]
    daily = spark.createDataFrame([(date(2024, 1, 1), 3), (date(2024, 1, 2), 4)], "date date, txn_anomalies_count bigint")
    assert [tuple(r) for r in reports.txn_anomaly_trend(daily).collect()] == [("2024-01-02", 4), ("2024-01-01", 3)]


def test_age_mix(spark):
    ages = (17, 18, 25, 26, 35, 36, 55, 56)
    apps = silver.silver_applications(table(
        spark, "apps", *({"app_id": str(a), "applicant_age": a} for a in ages), {"timestamp": ts("2024-01-29 00:00:00")}))
    df = metrics(spark, {"applications_count": 7})     # 2024-01-29 is missing, so is its share
    loose = {r[1]: float(r[2]) for r in reports.age_mix_trend(apps, df).collect()}
    assert loose == {"1. Youth (18-25)": 28.57, "2. Young Adult (26-35)": 28.57, "3. Adult (36-55)": 28.57, "4. Senior (56+)": 28.57}
    strict = reports.age_mix_trend(apps, df, strict=True, denominator="silver")
    assert strict.columns == ["Time (Daily)", "Applicant Age Group", "Percent of Total (%)"]
    by_day = {(r[0], r[1]): float(r[2]) for r in strict.collect()}
    assert by_day[("2024-01-30", "0. Under 18")] == 12.5 and by_day[("2024-01-29", "2. Young Adult (26-35)")] == 100.0
    order = [(r[0], float(r[2])) for r in strict.collect()]
    assert order == sorted(order, reverse=True)


def test_lineage(spark):
    apps = table(spark, "apps", {}, {"timestamp": ts("2024-01-29 00:00:00")})
    visits, txns = table(spark, "visits", *[{}] * 200), table(spark, "txns", {})
    out = reports.lineage_completeness(apps, visits, txns, metrics(spark, {"total_transactions": 1}))
    assert out.columns == ["date_label", "total_bronze_input", "total_gold_output", "total_records_dropped"]
    assert rows(out) == [("2024-01-30", 202, 111, 91)]


def test_duplicates(spark):
    two_days = [{"app_id": "d", "timestamp": ts("2024-01-28 00:00:00")}, {"app_id": "d", "timestamp": ts("2024-01-29 00:00:00")}]
    apps = table(spark, "apps", {"app_id": "once"}, *[{"app_id": "twice"}] * 2, *[{"app_id": "thrice"}] * 3, *two_days)
    out = reports.duplicate_app_ids(silver.silver_applications(apps))
    assert out.columns == ["Violation_Date", "Total_Duplicate_Records_Count"]
    assert rows(out) == [("2024-01-30", 3)]


def test_reports_in_sql_over_views(spark, tmp_path):
    from tidemark.sources.tables import TableStore

    store = TableStore(spark, str(tmp_path))
    store.write(metrics(spark, {"conversion_rate": 0.25}), "gold_daily_metrics")
    store.register_views(["gold_daily_metrics"])
    chosen = "SELECT date, conversion_rate * 100 AS rate FROM gold_daily_metrics WHERE date {} DATE '2024-01-30'"
    assert rows(spark.sql(chosen.format("="))) == [(DAY, 25.0)] and rows(spark.sql(chosen.format(">"))) == []
