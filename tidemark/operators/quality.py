"""Quality counts: what each rule saw, per table and event day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import event_day, hours_between
from tidemark.operators.rules import FAILED, Rule, all_pass, split_applicable


def _broken(df: DataFrame, rule: Rule) -> str:
    """SQL: does a row break ``rule``? Read from its marks where it has them, else evaluated.

    Marks tell what was decided when the row came in, also after a moving bound such as
    freshness has moved on, and need one column where rules need many.
    """
    if FAILED in df.columns and rule.action == "drop":
        return f"array_contains({FAILED}, '{rule.name}')"
    return f"NOT {rule.sql}"


def quality_log(df: DataFrame, rules: Sequence[Rule], table: str, event_time: str = "timestamp") -> DataFrame:
    """One row per day and rule: rows checked, rows failed. Zeros are kept.

    ``df`` is raw, or marked by ``mark_failures``. One aggregate computes every rule's count side by side, so no row is multiplied and
    the exchange carries one row per task and day. Rows without an event day are logged
    under a NULL date.
    """
    run, skipped = split_applicable(df, rules)
    counts = [F.expr(f"count_if({_broken(df, r)}) AS {r.name}") for r in run]
    daily = df.groupBy(event_day(event_time).alias("date")).agg(F.count(F.lit(1)).alias("checked_rows"), *counts)

    def entry(rule: Rule, status: str, checked: str, failed: str) -> str:
        return (
            f"named_struct('rule', '{rule.name}', 'action', '{rule.action}', 'status', '{status}', "
            f"'checked_rows', {checked}, 'failed_rows', {failed})"
        )

    entries = [entry(r, "checked", "checked_rows", r.name) for r in run]
    entries += [entry(r, "skipped", "0L", "0L") for r in skipped]
    return daily.selectExpr("date", f"'{table}' AS table_name", f"inline(array({', '.join(entries)}))")


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, logs)


def violations_by_rule(log: DataFrame) -> DataFrame:
    """Failed rows of every rule over all days, zeros included."""
    return log.groupBy("table_name", "rule").agg(F.sum("failed_rows").alias("failed_rows"))


def rejected_daily(log: DataFrame) -> DataFrame:
    """Failed checks per day over all *drop* rules. A row that breaks two rules counts twice."""
    return (
        log.filter("action = 'drop' AND failed_rows > 0 AND date IS NOT NULL")
        .groupBy("date")
        .agg(F.sum("failed_rows").alias("tdq_bdq_anomalies_count"))
    )


def quality_facts(
    df: DataFrame,
    rules: Sequence[Rule],
    event_time: str = "timestamp",
    timeliness: bool = False,
    null_share_of: str | None = None,
    technical: bool = True,
    then: Sequence[Rule] = (),
    also: Sequence[str] = (),
) -> DataFrame:
    """Per row, raw or marked: how many rules it broke and what it adds to the day's figures.

    A narrow projection meant to be unioned with other facts and summed per day once
    (``plans.metrics``). ``technical=False`` adds to the count of failed checks only. ``then`` are
    rules that see the rows which pass ``rules``. ``also`` are further SQL columns, in which
    ``{clean}`` stands for "passes all of them", so that one scan serves figures of either kind.
    """
    if FAILED in df.columns:
        broken, clean = f"size({FAILED})", f"size({FAILED}) = 0"
    else:
        run, _ = split_applicable(df, rules)
        broken = " + ".join(f"int({_broken(df, r)})" for r in run if r.action == "drop") or "0"
        clean = all_pass(run)
    later = " + ".join(f"int(NOT {r.sql})" for r in then)
    failed = f"{broken} + IF({clean}, {later}, 0)" if then else broken
    columns = [f"to_date({event_time}) AS date", f"{failed} AS failed_checks"]
    if technical:
        columns += ["1 AS bronze_rows", f"int({clean}) AS compliant_rows"]
        if timeliness:
            loaded = "tdq_processed_at" if "tdq_processed_at" in df.columns else "_load_timestamp"
            columns.append(f"IF({clean}, {hours_between(event_time, loaded)}, NULL) AS lag_hours")
    if null_share_of:
        columns += ["1 AS campaign_rows", f"int({null_share_of} IS NULL) AS campaign_nulls"]
    passed = f"({clean}) AND {all_pass(then)}" if then else f"({clean})"
    columns += [sql.format(clean=passed) for sql in also]
    return df.selectExpr(*columns)
