"""Gold tables: business rules, features, and the joins along the funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark import contracts as C
from tidemark.functions import ratio
from tidemark.operators.joins import inner_join
from tidemark.operators.rules import check, keep_passing

BUSINESS_RULES = [
    check("bdq_age_rule", f"applicant_age >= {C.ADULT_AGE}", "applicant_age"),
    check(
        "bdq_limit_range",
        f"req_credit_limit <= annual_income * {C.LIMIT_TO_INCOME_CAP}D",
        "req_credit_limit",
        "annual_income",
    ),
]


def with_income_ratio(silver_applications: DataFrame) -> DataFrame:
    return silver_applications.withColumn("req_income_ratio", ratio(F.col("req_credit_limit"), F.col("annual_income")))


def gold_applications(silver_applications: DataFrame) -> DataFrame:
    return with_income_ratio(keep_passing(silver_applications, BUSINESS_RULES))


def gold_accounts(silver_accounts: DataFrame, gold_apps: DataFrame, keep_all: bool = False, salts: int = 1) -> DataFrame:
    """Accounts whose application is in the validated set and approved.

    In a stream it is a step of ``streaming.delta``, so an account may come before its application.
    """
    approved = gold_apps.filter("application_status = 'approved'").select(
        "app_id", "applicant_age", "annual_income", "req_credit_limit"
    )
    joined = inner_join(silver_accounts, approved, "app_id", salts, "account_id")
    if keep_all:
        return joined.select(*silver_accounts.columns, "applicant_age", "annual_income", "req_credit_limit")
    return joined.select(
        "account_id",
        "app_id",
        "approved_limit",
        "interest_rate",
        "account_open_timestamp",
        "applicant_age",
        "annual_income",
    )


def gold_transaction_features(
    silver_txn: DataFrame,
    silver_accounts: DataFrame,
    cap: float = C.AMOUNT_TO_LIMIT_CAP,
    keep_all: bool = False,
    bound_days: int | None = None,
    salts: int = 1,
    hot: Sequence | None = None,
) -> DataFrame:
    """Transactions with the limit of their account, below the amount cap.

    ``bound_days`` keeps only transactions from account opening to that many days after. In a
    stream this is a step of ``streaming.delta``, which needs no such bound and no state.
    """
    accounts = silver_accounts.select("account_id", "approved_limit", "account_open_timestamp")
    if bound_days is None:
        accounts = accounts.drop("account_open_timestamp")
    joined = inner_join(silver_txn, accounts, "account_id", salts, "txn_id", hot)
    if bound_days is not None:
        joined = joined.filter(
            f"timestamp BETWEEN account_open_timestamp AND account_open_timestamp + INTERVAL {int(bound_days)} DAYS"
        )
    kept = silver_txn.columns if keep_all else ["txn_id", "account_id", "amount", "timestamp", "location"]
    return joined.filter(F.col("amount") <= F.col("approved_limit") * F.lit(float(cap))).select(
        *kept, "approved_limit", ratio(F.col("amount"), F.col("approved_limit")).alias("txn_limit_ratio")
    )
