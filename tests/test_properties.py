"""Properties that hold for any rows."""

from datetime import datetime, timedelta

from helpers import APPS, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.quality import quality_facts, quality_log
from tidemark.operators.rules import FAILED, apply_rules, keep_passing
from tidemark.plans import gold, reports, silver

moments = st.one_of(st.none(), st.integers(0, 4 * 1440).map(lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)))
apps = st.lists(
    st.tuples(
        st.sampled_from([None, "a", "b", "c", "d"]),
        st.sampled_from([None, "v1", "v2"]),
        st.one_of(st.none(), st.integers(-5, 110)),
        st.sampled_from([None, -1.0, 0.0, 100.0, 1000.0]),
        st.sampled_from([None, "salaried", "retired"]),
        st.sampled_from([None, 10, 150, 1500]),
        moments,
        st.sampled_from([None, "approved", "rejected", "open"]),
        moments,
    ),
    min_size=1,
    max_size=60,
)
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@few
@given(data=apps)
def test_every_row_is_clean_or_rejected(spark, data):
    df = spark.createDataFrame(data, APPS)
    result = apply_rules(df, silver.APPLICATION_RULES, "apps")
    clean, rejected = result.clean.count(), result.rejected
    assert clean + rejected.count() == len(data)
    log = result.log.agg(F.sum("failed_rows"), F.sum("checked_rows")).first()
    assert log[0] == (rejected.agg(F.sum(F.size(FAILED))).first()[0] or 0) >= rejected.count()
    assert log[1] == len(data) * len(silver.APPLICATION_RULES)
    assert keep_passing(df, silver.APPLICATION_RULES).count() == clean
    assert keep_passing(df, silver.APPLICATION_RULES[::-1]).count() == clean
    facts = quality_facts(df, silver.APPLICATION_RULES, timeliness=True).agg(F.sum("compliant_rows"), F.sum("failed_checks")).first()
    assert facts == (clean, log[0])


@few
@given(data=apps)
def test_duplicates_against_brute_force(spark, data):
    df = silver.silver_applications(spark.createDataFrame(data, APPS))
    seen, surplus = set(), {}
    for r in df.collect():
        day = r.timestamp and r.timestamp.date().isoformat()
        if (day, r.app_id) in seen:
            surplus[day] = surplus.get(day, 0) + 1
        seen.add((day, r.app_id))
    assert dict(rows(reports.duplicate_app_ids(df))) == surplus


@few
@given(data=apps)
def test_ratio_never_raises_and_gold_is_part_of_silver(spark, data):
    bronze = spark.createDataFrame(data, APPS)
    kept = gold.gold_applications(silver.silver_applications(bronze))
    assert kept.filter("applicant_age < 18 OR req_credit_limit > 1.5 * annual_income OR req_income_ratio IS NULL").count() == 0
    assert gold.with_income_ratio(bronze).count() == len(data)
    log = quality_log(silver.silver_applications(bronze), gold.BUSINESS_RULES, "g")
    assert all(r.failed_rows <= r.checked_rows for r in log.collect())
