"""Small column helpers. All stay inside Catalyst; none is a UDF."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

Moment = str | date | datetime


def _text(moment: Moment) -> str:
    return moment.isoformat(sep=" ") if isinstance(moment, datetime) else str(moment)


def at(moment: Moment, kind: str = "timestamp") -> Column:
    """A literal point in time, read in the session zone.

    Going through text keeps the Python process's own time zone out of it.
    """
    return F.lit(_text(moment)).cast(kind)


def event_day(column: str | Column) -> Column:
    return F.to_date(F.col(column) if isinstance(column, str) else column)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, on a zero denominator."""
    return F.try_divide(numerator, denominator)


def hours_between(start: str, end: str) -> str:
    """SQL: signed hours between two columns, to the microsecond."""
    return f"(unix_micros(timestamp({end})) - unix_micros(timestamp({start}))) / 3.6e9D"


def elapsed_label(seconds: Column) -> Column:
    """``n min ago`` below an hour, ``n hr ago`` below a day, ``n days ago`` from there."""
    def count(unit: int, word: str) -> Column:
        return F.concat((seconds / F.lit(unit)).cast("int"), F.lit(f" {word} ago"))

    return (
        F.when(seconds < 3600, count(60, "min"))
        .when(seconds < 86400, count(3600, "hr"))
        .otherwise(count(86400, "days"))
    )
