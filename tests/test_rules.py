"""Every rule with a passing, a failing and a NULL row, and both bounds of ranges."""

from datetime import timedelta

import pytest
from helpers import metrics, rows, table, ts
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.operators.anomalies import FLAG, flag_above
from tidemark.operators.quality import quality_facts, quality_log, rejected_daily, violations_by_rule
from tidemark.operators.rules import FAILED, Rule, apply_rules, check, mark_failures, one_of, stop_on_failure
from tidemark.plans import gold, silver
from tidemark.plans.metrics import METRIC_RULES

AS_OF = "2024-01-30 12:00:00"

RULES = {r.name: r for r in [*silver.visitor_rules(AS_OF), *silver.APPLICATION_RULES, *silver.ACCOUNT_RULES,
                             *silver.TRANSACTION_RULES, *gold.BUSINESS_RULES]}
MIDNIGHT = ts("2024-01-29 00:00:00")

CASES = [
    ("visits", "tdq_id_not_null", [("a", True), ("", True), (None, False)], "visitor_id"),
    ("visits", "tdq_freshness_check", [
        (ts("2024-01-30 11:00:00"), True), (ts("2024-01-27 12:00:00"), False), (None, False),
        (MIDNIGHT, False), (MIDNIGHT + timedelta(microseconds=1), True)], "timestamp"),
    ("visits", "tdq_valid_event_type", [
        ("landing", True), ("scroll", True), ("apply_click", True), ("view_pricing", False), ("Landing", False),
        (None, False)], "event_type"),
    ("visits", "tdq_valid_device", [*((d, True) for d in C.DEVICE_TYPES), ("kiosk", False), ("Mobile", False), (None, False)], "device_type"),
    ("visits", "tdq_valid_geo", [*((g, True) for g in C.GEOS), ("FR", False), ("usa", False), (None, False)], "geo"),
    ("apps", "tdq_app_id_not_null", [("a", True), ("", True), (None, False)], "app_id"),
    ("apps", "tdq_age_numeric_range", [(30, True), (0, True), (100, True), (101, False), (-1, False), (None, False)], "applicant_age"),
    ("apps", "tdq_income_positive", [(1.0, True), (0.0, False), (-1.0, False), (None, False)], "annual_income"),
    ("apps", "tdq_valid_employment", [*((e, True) for e in C.EMPLOYMENT_STATUSES), ("retired", False), ("Salaried", False), (None, False)], "employment_status"),
    ("apps", "tdq_valid_app_status", [*((s, True) for s in C.APPLICATION_STATUSES), ("open", False), ("Approved", False), (None, False)], "application_status"),
    ("accounts", "tdq_account_id_not_null", [("a", True), ("", True), (None, False)], "account_id"),
    ("accounts", "tdq_limit_positive", [(1, True), (0, False), (-1, False), (None, False)], "approved_limit"),
    ("accounts", "tdq_interest_rate_range", [(20.0, True), (5.0, True), (35.0, True), (4.99, False), (35.01, False), (None, False)], "interest_rate"),
    ("txns", "tdq_txn_id_not_null", [("a", True), ("", True), (None, False)], "txn_id"),
    ("txns", "tdq_amount_positive", [(1.0, True), (0.0, False), (-1.0, False), (None, False)], "amount"),
    ("apps", "bdq_age_rule", [(18, True), (17, False), (None, False)], "applicant_age"),
    ("apps", "bdq_limit_range", [(1000, True), (1500, True), (1600, False), (None, False)], "req_credit_limit"),
]


@pytest.mark.parametrize("kind,rule,cases,column", CASES, ids=[c[1] for c in CASES])
def test_rule(spark, kind, rule, cases, column):
    df = table(spark, kind, *({column: value} for value, _ in cases))
    key = F.col(column).cast("string")
    kept = {r[0] for r in df.filter(RULES[rule].passes).select(key).collect()}
    by_filter = {r[0] for r in df.filter(RULES[rule].predicate).select(key).collect()}
    expected = {r[0] for r in spark.createDataFrame([(v,) for v, ok in cases if ok], df.select(column).schema).select(key).collect()}
    assert kept == by_filter == expected


def test_default_rows_pass_every_table(spark):
    assert silver.silver_visitor_events(table(spark, "visits", {}), AS_OF).count() == 1
    assert gold.gold_applications(silver.silver_applications(table(spark, "apps", {}))).count() == 1
    assert silver.silver_accounts(table(spark, "accounts", {})).count() == 1
    assert silver.silver_transactions(table(spark, "txns", {})).count() == 1


def test_freshness_in_hours(spark):
    df = table(spark, "visits", {"timestamp": ts("2024-01-30 05:00:00")}, {"timestamp": ts("2024-01-30 07:00:00")})
    assert silver.silver_visitor_events(df, AS_OF).count() == 2
    assert silver.silver_visitor_events(df, AS_OF, hours=6).count() == 1


def test_status_rule_is_skipped_without_its_column(spark):
    df = table(spark, "txns", {})
    log = rows(quality_log(df, silver.TRANSACTION_RULES, "t"), "rule", "status", "checked_rows", "failed_rows")
    assert ("tdq_valid_txn_status", "skipped", 0, 0) in log and len(log) == 3
    with_status = df.crossJoin(spark.createDataFrame([("success",), ("other",), (None,)], "status string"))
    assert rows(silver.silver_transactions(with_status, keep_all=True), "status") == [("success",)]


def test_clean_rejected_and_log(spark):
    df = table(spark, "apps", {"app_id": "ok"}, {"app_id": "one", "applicant_age": None},
               {"app_id": "two", "applicant_age": 101, "annual_income": 0.0}, {"app_id": "undated", "annual_income": -1.0, "timestamp": None})
    for collect in (True, False):
        result = apply_rules(df, silver.APPLICATION_RULES, "apps", collect_rejects=collect)
        assert rows(result.clean, "app_id") == [("ok",)]
        assert result.clean.columns == df.columns
        assert rows(result.rejected, "app_id", FAILED) == [
            ("one", ["tdq_age_numeric_range"]),
            ("two", ["tdq_age_numeric_range", "tdq_income_positive"]),
            ("undated", ["tdq_income_positive"]),
        ]
    day = ts("2024-01-30 00:00:00").date()
    log = result.log
    assert rows(log.filter("rule = 'tdq_income_positive'"), "date", "checked_rows", "failed_rows") == [(None, 1, 1), (day, 3, 1)]
    assert log.count() == 10
    totals = dict((r["rule"], r["failed_rows"]) for r in violations_by_rule(log).collect())
    assert totals == {"tdq_app_id_not_null": 0, "tdq_age_numeric_range": 2, "tdq_income_positive": 2,
                      "tdq_valid_employment": 0, "tdq_valid_app_status": 0}
    assert rows(rejected_daily(log)) == [(day, 3)]


def test_log_from_marks_equals_log_from_rules(spark):
    df = table(spark, "apps", {}, {"applicant_age": None}, {"applicant_age": 101, "annual_income": 0.0}, {"timestamp": None, "annual_income": None})
    rules = [*silver.APPLICATION_RULES, check("odd", "applicant_age % 2 = 1", "applicant_age", action="warn")]
    marked = mark_failures(df, rules)
    assert rows(quality_log(marked, rules, "t")) == rows(quality_log(df, rules, "t"))
    facts = [rows(quality_facts(d, rules, timeliness=True, null_share_of="visitor_id")) for d in (df, marked)]
    assert facts[0] == facts[1]


def test_warn_rules_only_count(spark):
    warn = [check("always_odd", "1 = 2", action="warn")]
    result = apply_rules(table(spark, "apps", {}), warn, "apps")
    assert (result.clean.count(), result.rejected.count()) == (1, 0)
    assert rows(result.log, "rule", "action", "failed_rows") == [("always_odd", "warn", 1)]
    assert rejected_daily(result.log).count() == 0


def test_one_value_list_and_quotes(spark):
    df = spark.createDataFrame([("it's",), ("b",)], "x string")
    assert df.filter(one_of("r", "x", ["it's"]).predicate).count() == 1


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Rule("r", "1 = 1", (), action="ignore")


def test_no_rules_mark_nothing(spark):
    assert rows(mark_failures(table(spark, "apps", {}), []), FAILED) == [([],)]


@pytest.mark.parametrize("change,fails", [
    ({"conversion_rate": 0.2}, None), ({"conversion_rate": 0.0}, None), ({"conversion_rate": 1.0}, None),
    ({"conversion_rate": 1.1}, "bdq_conversion_rate_range"), ({"conversion_rate": None}, "bdq_conversion_rate_range"),
    ({"total_visits": -1}, "tdq_non_negative_metrics"), ({"total_visits": None}, "tdq_non_negative_metrics"),
])
def test_fail_rules_stop_the_job(spark, change, fails):
    guarded = stop_on_failure(metrics(spark, change), METRIC_RULES)
    if fails is None:
        assert guarded.count() == 1
    else:
        with pytest.raises(Exception, match=fails):
            guarded.count()


def test_flags_are_strict_and_null_safe(spark):
    df = spark.createDataFrame([(0.6,), (0.61,), (None,)], "r double")
    assert rows(flag_above(df, "r", 0.6), "r", FLAG) == [(None, 0), (0.6, 0), (0.61, 1)]
