"""Row rules: named SQL predicates with an action, evaluated together.

A predicate that is NULL counts as not passed, as in ``WHERE``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

FAILED = "_failed_rules"


@dataclass(frozen=True)
class Rule:
    """``action``: *drop* the row, *fail* the job, or only *warn* in the log.

    ``optional`` rules are skipped, and logged as skipped, where ``columns`` are missing.
    """

    name: str
    predicate: str
    columns: tuple[str, ...]
    action: str = "drop"
    optional: bool = False

    def __post_init__(self):
        if self.action not in ("drop", "fail", "warn"):
            raise ValueError(f"rule {self.name}: unknown action {self.action!r}")

    @property
    def sql(self) -> str:
        """The predicate as SQL that is never NULL."""
        return f"coalesce({self.predicate}, false)"

    @property
    def passes(self) -> Column:
        return F.expr(self.sql)

    def applies_to(self, df: DataFrame) -> bool:
        return not self.optional or set(self.columns) <= set(df.columns)


# --- Predicate builders --------------------------------------------------------------


def _quoted(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def present(name: str, column: str, **kw) -> Rule:
    return Rule(name, f"{column} IS NOT NULL", (column,), **kw)


def one_of(name: str, column: str, values: Iterable[object], **kw) -> Rule:
    return Rule(name, f"{column} IN ({', '.join(map(_quoted, values))})", (column,), **kw)


def positive(name: str, column: str, **kw) -> Rule:
    return Rule(name, f"{column} > 0", (column,), **kw)


def within(name: str, column: str, bounds: Sequence[object], **kw) -> Rule:
    low, high = bounds
    return Rule(name, f"{column} BETWEEN {low} AND {high}", (column,), **kw)


def check(name: str, predicate: str, *columns: str, **kw) -> Rule:
    return Rule(name, predicate, columns, **kw)


# --- Application ---------------------------------------------------------------------


def split_applicable(df: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Rules to run on ``df`` and rules to log as skipped."""
    run = [r for r in rules if r.applies_to(df)]
    return run, [r for r in rules if r not in run]


def all_pass(rules: Sequence[Rule]) -> str:
    """SQL: does a row pass every *drop* rule?"""
    return " AND ".join(r.sql for r in rules if r.action == "drop") or "true"


def keep_passing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every *drop* rule.

    The plain conjunction of predicates: Catalyst pushes its parts into the parquet scan,
    which it cannot do through an array of failed names.
    """
    run, _ = split_applicable(df, rules)
    plain = " AND ".join(f"({r.predicate})" for r in run if r.action == "drop")
    return df.filter(plain) if plain else df


def mark_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of the failed *drop* rules as an array column, in rule order."""
    run, _ = split_applicable(df, rules)
    names = ", ".join(f"IF({r.sql}, NULL, '{r.name}')" for r in run if r.action == "drop")
    failed = F.expr(f"array_compact(array({names}))" if names else "CAST(array() AS array<string>)")
    return df.withColumn(FAILED, failed)


def stop_on_failure(df: DataFrame, rules: Sequence[Rule], show: Sequence[str] = ()) -> DataFrame:
    """Abort the job at the first row that breaks a *fail* rule, naming rule and row."""
    run, _ = split_applicable(df, rules)
    for rule in run:
        if rule.action == "fail":
            shown = F.to_json(F.struct(*(show or rule.columns)))
            message = F.concat(F.lit(f"rule {rule.name} failed: {rule.predicate}; row "), shown)
            df = df.filter(F.when(rule.passes, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return df


@dataclass(frozen=True)
class RuleResult:
    clean: DataFrame
    rejected: DataFrame
    log: DataFrame


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    table: str,
    event_time: str = "timestamp",
    collect_rejects: bool = True,
) -> RuleResult:
    """Clean rows, rejected rows with the names of the rules they broke, and a daily log.

    The three are lazy and independent. ``collect_rejects=False`` makes ``clean`` a pure
    filter that reaches the scan; otherwise clean and rejected share one marked input,
    the form to use when both are written in one pass (see ``sources.tables``).
    """
    from tidemark.operators.quality import quality_log

    guarded = stop_on_failure(df, rules)
    marked = mark_failures(guarded, rules)
    if collect_rejects:
        clean = marked.filter(F.size(FAILED) == 0).drop(FAILED)
    else:
        clean = keep_passing(guarded, rules)
    return RuleResult(clean, marked.filter(F.size(FAILED) > 0), quality_log(df, rules, table, event_time))
