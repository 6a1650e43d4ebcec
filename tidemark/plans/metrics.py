"""The daily metrics table: one row per day from any number of fact streams.

Each input contributes narrow rows ``(date, figures...)``. Their union is summed per day
in one aggregate: one exchange that carries one row per task and day, where a join of
separately aggregated inputs would need an exchange for each input and each outer join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark import contracts as C
from tidemark.operators.quality import quality_facts
from tidemark.operators.rules import Rule, check, stop_on_failure
from tidemark.plans.gold import BUSINESS_RULES

METRIC_RULES = [
    check(
        "tdq_non_negative_metrics",
        "total_visits >= 0 AND applications_count >= 0",
        "total_visits",
        "applications_count",
        action="fail",
    ),
    check("bdq_conversion_rate_range", "conversion_rate BETWEEN 0 AND 1", "conversion_rate", action="fail"),
]


def _flag(condition: str, name: str) -> str:
    return f"int(coalesce({condition}, false)) AS {name}"


def visit_facts(silver_visits: DataFrame) -> DataFrame:
    return silver_visits.selectExpr(
        "to_date(timestamp) AS date",
        _flag("visitor_id IS NOT NULL", "visits"),
        _flag("event_type = 'apply_click'", "apply_clicks"),
        "1 AS core",
    )


def application_facts(gold_apps: DataFrame, threshold: float = C.APP_ANOMALY_RATIO) -> DataFrame:
    return gold_apps.selectExpr(
        "to_date(timestamp) AS date",
        _flag("app_id IS NOT NULL", "applications"),
        _flag("application_status = 'approved'", "approvals"),
        _flag(f"req_income_ratio > {threshold}D", "ml_anomalies"),
        "1 AS core",
    )


def transaction_facts(gold_txn: DataFrame, threshold: float = C.TXN_ANOMALY_RATIO) -> DataFrame:
    return gold_txn.selectExpr(
        "to_date(timestamp) AS date",
        _flag("txn_id IS NOT NULL", "transactions"),
        "amount AS txn_amount",
        _flag(f"txn_limit_ratio > {threshold}D", "ml_anomalies"),
        "1 AS core",
    )


@dataclass(frozen=True)
class Bronze:
    """All rows of the four inputs, raw or marked, for figures that also see rejected rows."""

    visitor_events: DataFrame
    applications: DataFrame
    accounts: DataFrame
    transactions: DataFrame


_VISIT_COUNTS = (
    _flag("{clean} AND visitor_id IS NOT NULL", "visits"),
    _flag("{clean} AND event_type = 'apply_click'", "apply_clicks"),
    "IF({clean}, 1, NULL) AS core",
)


def _application_counts(ratio: str, threshold: float) -> tuple[str, ...]:
    return (
        _flag("{clean} AND app_id IS NOT NULL", "applications"),
        _flag("{clean} AND application_status = 'approved'", "approvals"),
        _flag(f"{{clean}} AND {ratio} > {threshold}D", "ml_anomalies"),
        "IF({clean}, 1, NULL) AS core",
    )


def one_pass_facts(
    bronze: Bronze, rules: Mapping[str, Sequence[Rule]], business: DataFrame | None = None, app_threshold: float = C.APP_ANOMALY_RATIO
) -> list[DataFrame]:
    """Key figures and quality figures of visits and applications, quality figures of the rest: each table is read once.

    ``business`` are marked rows of gold_applications where such are stored; else the business
    rules are applied to the applications that pass the technical ones, in the same pass.
    """
    technical = {"timeliness": True}
    if business is None:
        technical |= {"then": BUSINESS_RULES, "also": _application_counts("try_divide(req_credit_limit, annual_income)", app_threshold)}
    facts = [
        quality_facts(bronze.visitor_events, rules["visitor_events"], timeliness=True, null_share_of="campaign_id", also=_VISIT_COUNTS),
        quality_facts(bronze.applications, rules["applications"], **technical),
        quality_facts(bronze.accounts, rules["accounts"], event_time=C.event_time("accounts")),
        quality_facts(bronze.transactions, rules["transactions"], timeliness=True),
    ]
    if business is not None:
        facts.append(quality_facts(business, BUSINESS_RULES, technical=False, also=_application_counts("req_income_ratio", app_threshold)))
    return facts


def bronze_facts(bronze: Bronze, business_input: DataFrame, rules: Mapping[str, Sequence[Rule]]) -> list[DataFrame]:
    """Compliance, timeliness, null share and failed checks, one scan per table.

    Lag is averaged over accepted visits, applications and transactions; failed checks
    cover the technical ``rules`` of all four tables and the business rules, which see the
    silver applications (``business_input``, raw or marked).
    """
    return [
        quality_facts(bronze.visitor_events, rules["visitor_events"], timeliness=True, null_share_of="campaign_id"),
        quality_facts(bronze.applications, rules["applications"], timeliness=True),
        quality_facts(bronze.accounts, rules["accounts"], event_time=C.event_time("accounts")),
        quality_facts(bronze.transactions, rules["transactions"], timeliness=True),
        quality_facts(business_input, BUSINESS_RULES, technical=False),
    ]


_BASE_SUMS = {
    "core": "max(core)",
    "total_visits": "coalesce(sum(visits), 0L)",
    "applications_count": "coalesce(sum(applications), 0L)",
    "approvals_count": "coalesce(sum(approvals), 0L)",
    "total_transactions": "coalesce(sum(transactions), 0L)",
    "avg_txn_amount": "coalesce(avg(txn_amount), 0D)",
}
_FULL_SUMS = {
    "detected_tdq_bdq_anomalies_count": "coalesce(sum(failed_checks), 0L)",
    "ml_anomalies_count": "coalesce(sum(ml_anomalies), 0L)",
    "apply_clicks": "coalesce(sum(apply_clicks), 0L)",
    "avg_freshness_lag_hours": "avg(lag_hours)",
    "schema_compliance_pct": "try_divide(100D * sum(compliant_rows), sum(bronze_rows))",
    "campaign_id_null_pct": "try_divide(100D * sum(campaign_nulls), sum(campaign_rows))",
}
_COLUMNS = (
    "date",
    "total_visits",
    "applications_count",
    "approvals_count",
    "total_transactions",
    "avg_txn_amount",
    "coalesce(try_divide(applications_count, total_visits), 0D) AS conversion_rate",
    "coalesce(try_divide(approvals_count, applications_count), 0D) AS approval_rate",
)
_BASE_COLUMNS = ("0L AS detected_tdq_bdq_anomalies_count", "0L AS ml_anomalies_count")
_FULL_COLUMNS = tuple(_FULL_SUMS)


def gold_daily_metrics(
    visits: DataFrame,
    apps: DataFrame,
    txns: DataFrame,
    quality: list[DataFrame] | None = None,
    app_threshold: float = C.APP_ANOMALY_RATIO,
    txn_threshold: float = C.TXN_ANOMALY_RATIO,
) -> DataFrame:
    """KPIs per day that has a visit, an application or a transaction.

    Without ``quality`` both anomaly counts are zero placeholders (the *base* form); with
    ``quality`` (see ``bronze_facts``) they are computed and the lag, compliance and null
    share columns are added (the *full* form). Rows without an event day belong to no
    day; the quality log counts them.
    """
    facts = [visit_facts(visits), application_facts(apps, app_threshold), transaction_facts(txns, txn_threshold), *(quality or [])]
    return _daily(facts, quality is not None)


def daily_metrics_in_one_pass(
    bronze: Bronze,
    txns: DataFrame,
    rules: Mapping[str, Sequence[Rule]],
    business: DataFrame | None = None,
    app_threshold: float = C.APP_ANOMALY_RATIO,
    txn_threshold: float = C.TXN_ANOMALY_RATIO,
) -> DataFrame:
    """The full form of ``gold_daily_metrics`` from raw or marked rows, each table read once (see ``one_pass_facts``)."""
    return _daily([*one_pass_facts(bronze, rules, business, app_threshold), transaction_facts(txns, txn_threshold)], True)


def _daily(facts: list[DataFrame], full: bool) -> DataFrame:
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts).filter("date IS NOT NULL")
    sums = {**_BASE_SUMS, **_FULL_SUMS} if full else _BASE_SUMS
    rest = _FULL_COLUMNS if full else _BASE_COLUMNS
    daily = merged.groupBy("date").agg(*[F.expr(f"{sql} AS {name}") for name, sql in sums.items()])
    shown = daily.filter("core = 1").selectExpr(*_COLUMNS, *rest)
    return stop_on_failure(shown, METRIC_RULES, ("date", "conversion_rate"))
