"""Known counts of the sample mapping, taken on every tenth order and on events alone."""

import os

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from tidemark.operators.anomalies import app_anomalies_daily, txn_anomalies_daily
from tidemark.operators.quality import quality_log, violations_by_rule
from tidemark.plans import gold, reports, silver
from tidemark.plans.metrics import gold_daily_metrics
from tidemark.sources import sample

EXPECTED = {
    "sf0.001": dict(
        visits=1000, apps=155, accounts=106, txns=6000, stale=937, event_type=400, device=40, geo=226, age=3, employment=5,
        limit=3, rate=7, minor=22, impossible=7, silver_visits=436, fresh_visits=30, silver_apps=149, gold_apps=120,
        silver_accounts=97, gold_accounts=39, bounded=328, gold_txns=342, flagged_apps=6, flagged_txns=52, duplicates=4,
        days=32, first=(8, 2, 2, 59863.03)),
    "sf0.01": dict(
        visits=10000, apps=1541, accounts=978, txns=60000, stale=9326, event_type=4031, device=400, geo=1988, age=17, employment=38,
        limit=15, rate=43, minor=199, impossible=79, silver_visits=4600, fresh_visits=321, silver_apps=1488, gold_apps=1220,
        silver_accounts=921, gold_accounts=375, bounded=2589, gold_txns=3127, flagged_apps=54, flagged_txns=604, duplicates=40,
        days=32, first=(177, 24, 31, 45158.67)),
    "sf0.1": dict(
        visits=100000, apps=15406, accounts=9943, txns=600000, stale=93301, event_type=40112, device=4000, geo=20139, age=160,
        employment=376, limit=202, rate=467, minor=1983, impossible=783, silver_visits=45852, fresh_visits=3063, silver_apps=14875,
        gold_apps=12215, silver_accounts=9282, gold_accounts=3747, bounded=26053, gold_txns=31536, flagged_apps=532,
        flagged_txns=5587, duplicates=392, days=32, first=(1532, 235, 278, 48679.85)),
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_counts(spark, sf):
    path = f"{TESTDATA}/{sf}"
    if not os.path.isdir(path):
        pytest.skip("sample tables are not here")
    orders = sample.load(spark, path, "orders").filter("o_orderkey % 10 = 0")
    visits = sample.visits_from_events(sample.load(spark, path, "events"))
    apps, accounts = sample.applications(orders), sample.accounts(orders)
    txns = sample.transactions(sample.load(spark, path, "lineitem"))

    silver_visits = silver.silver_visitor_events(visits, sample.AS_OF, sample.REPLAY_DAYS)
    silver_apps, silver_accounts = silver.silver_applications(apps), silver.silver_accounts(accounts)
    gold_apps = gold.gold_applications(silver_apps)
    silver_txns = silver.silver_transactions(txns)
    gold_txns = gold.gold_transaction_features(silver_txns, silver_accounts)
    uncapped = gold.gold_transaction_features(silver_txns, silver_accounts, cap=float("inf"), bound_days=10000)
    logs = [quality_log(visits, silver.visitor_rules(sample.AS_OF), "v"), quality_log(apps, silver.APPLICATION_RULES, "a"),
            quality_log(accounts, silver.ACCOUNT_RULES, "c", "account_open_timestamp"), quality_log(silver_apps, gold.BUSINESS_RULES, "g")]
    failed = {r["rule"]: r["failed_rows"] for log in logs for r in violations_by_rule(log).collect()}
    metrics = gold_daily_metrics(silver_visits, gold_apps, gold_txns)
    first = metrics.filter("date = DATE '2024-01-01'").first()

    got = dict(
        visits=visits.count(), apps=apps.count(), accounts=accounts.count(), txns=txns.count(),
        stale=failed["tdq_freshness_check"], event_type=failed["tdq_valid_event_type"], device=failed["tdq_valid_device"],
        geo=failed["tdq_valid_geo"], age=failed["tdq_age_numeric_range"], employment=failed["tdq_valid_employment"],
        limit=failed["tdq_limit_positive"], rate=failed["tdq_interest_rate_range"], minor=failed["bdq_age_rule"],
        impossible=failed["bdq_limit_range"], silver_visits=silver_visits.count(),
        fresh_visits=silver.silver_visitor_events(visits, sample.AS_OF).count(), silver_apps=silver_apps.count(),
        gold_apps=gold_apps.count(), silver_accounts=silver_accounts.count(),
        gold_accounts=gold.gold_accounts(silver_accounts, gold_apps).count(), bounded=uncapped.count(), gold_txns=gold_txns.count(),
        flagged_apps=app_anomalies_daily(gold_apps).agg(F.sum("app_anomalies_count")).first()[0],
        flagged_txns=txn_anomalies_daily(gold_txns).agg(F.sum("txn_anomalies_count")).first()[0],
        duplicates=reports.duplicate_app_ids(silver_apps).agg(F.sum("Total_Duplicate_Records_Count")).first()[0],
        days=metrics.count(),
        first=(first.total_visits, first.applications_count, first.total_transactions, round(first.avg_txn_amount, 2)))
    assert got == EXPECTED[sf]
