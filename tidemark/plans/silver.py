"""Silver tables: bronze rows that pass every technical rule."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tidemark import contracts as C
from tidemark.functions.scalars import Moment
from tidemark.operators.rules import (
    FAILED,
    Rule,
    check,
    keep_passing,
    mark_failures,
    one_of,
    positive,
    present,
    within,
)


def _freshness_bound(as_of: Moment, days: int, hours: float | None) -> str:
    """SQL literal of the moment a visit must be strictly later than.

    By default that is a midnight, ``days`` before the day of ``as_of``; with ``hours``
    it is that many hours before ``as_of`` itself.
    """
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if hours is not None:
        return f"TIMESTAMP_NTZ '{as_of - timedelta(hours=hours)}'"
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    return f"DATE '{date.isoformat(day - timedelta(days=days))}'"


def visitor_rules(
    as_of: Moment,
    days: int = C.FRESHNESS_DAYS,
    hours: float | None = None,
    event_types: Sequence[str] = C.EVENT_TYPES,
) -> list[Rule]:
    return [
        present("tdq_id_not_null", "visitor_id"),
        check("tdq_freshness_check", f"timestamp > {_freshness_bound(as_of, days, hours)}", "timestamp"),
        one_of("tdq_valid_event_type", "event_type", event_types),
        one_of("tdq_valid_device", "device_type", C.DEVICE_TYPES),
        one_of("tdq_valid_geo", "geo", C.GEOS),
    ]


APPLICATION_RULES = [
    present("tdq_app_id_not_null", "app_id"),
    within("tdq_age_numeric_range", "applicant_age", C.AGE_RANGE),
    positive("tdq_income_positive", "annual_income"),
    one_of("tdq_valid_employment", "employment_status", C.EMPLOYMENT_STATUSES),
    one_of("tdq_valid_app_status", "application_status", C.APPLICATION_STATUSES),
]

ACCOUNT_RULES = [
    present("tdq_account_id_not_null", "account_id"),
    positive("tdq_limit_positive", "approved_limit"),
    within("tdq_interest_rate_range", "interest_rate", C.INTEREST_RATE_RANGE),
]

TRANSACTION_RULES = [
    present("tdq_txn_id_not_null", "txn_id"),
    positive("tdq_amount_positive", "amount"),
    one_of("tdq_valid_txn_status", "status", C.TXN_STATUSES, optional=True),
]


def technical_rules(entity: str, as_of: Moment, days: int = C.FRESHNESS_DAYS, hours: float | None = None) -> list[Rule]:
    if entity == "visitor_events":
        return visitor_rules(as_of, days, hours)
    return {"applications": APPLICATION_RULES, "accounts": ACCOUNT_RULES, "transactions": TRANSACTION_RULES}[entity]


def stamped(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("tdq_processed_at", F.col("_load_timestamp"))


def trimmed(bronze_transactions: DataFrame, *also: str) -> DataFrame:
    """The columns later tables use, with a placeholder status the feed does not carry."""
    return bronze_transactions.select(
        "txn_id",
        "account_id",
        "amount",
        "timestamp",
        "location",
        F.lit("unknown").alias("transaction_status"),
        F.col("_load_timestamp").alias("tdq_processed_at"),
        *also,
    )


def silver_visitor_events(bronze: DataFrame, as_of: Moment, days: int = C.FRESHNESS_DAYS, hours: float | None = None) -> DataFrame:
    return stamped(keep_passing(bronze, visitor_rules(as_of, days, hours)))


def silver_applications(bronze: DataFrame) -> DataFrame:
    return stamped(keep_passing(bronze, APPLICATION_RULES))


def silver_accounts(bronze: DataFrame) -> DataFrame:
    return stamped(keep_passing(bronze, ACCOUNT_RULES))


def silver_transactions(bronze: DataFrame, keep_all: bool = False) -> DataFrame:
    clean = keep_passing(bronze, TRANSACTION_RULES)
    return stamped(clean) if keep_all else trimmed(clean)


def checked(entity: str, bronze: DataFrame, rules: Sequence[Rule], keep_all: bool = False) -> DataFrame:
    """Every bronze row in the silver layout, with the names of the rules it failed."""
    marked = mark_failures(bronze, rules)
    if entity == "transactions" and not keep_all:
        return trimmed(marked, FAILED, *[c for c in ("date", "status") if c in bronze.columns])
    return stamped(marked)
