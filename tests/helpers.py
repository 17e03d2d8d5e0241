"""Small helpers for comparing results."""

from __future__ import annotations


def tuples(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def bag(df) -> list[tuple]:
    """Rows as a sorted list; NULLs sort before values."""
    return sorted(tuples(df), key=lambda row: [(value is not None, str(value)) for value in row])


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
