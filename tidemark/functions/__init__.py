"""Column expressions shared by rules, plans and reports."""

from tidemark.functions.scalars import (
    at,
    elapsed_label,
    event_day,
    hours_between,
    ratio,
)

__all__ = ["at", "elapsed_label", "event_day", "hours_between", "ratio"]
