"""Time parsing and arithmetic that never fails on bad text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weatherlake.constants import DAYS_PER_YEAR, HISTORY_YEARS


def parse_time(column: str | Column, pattern: str | None = None) -> Column:
    """Timestamp from ISO text (or text in ``pattern``); NULL where it does not parse."""
    value = F.col(column) if isinstance(column, str) else column
    if pattern is None:
        return F.try_to_timestamp(value)
    return F.try_to_timestamp(value, F.lit(pattern))


def local_to_utc(time: str | Column, zone: str | Column) -> Column:
    """Shift a local wall-clock time to UTC using the row's own zone name."""
    return F.to_utc_timestamp(time, F.col(zone) if isinstance(zone, str) else zone)


def minutes_between(start: str, end: str) -> Column:
    """Difference of the two times in whole seconds, expressed in minutes."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return seconds.cast("double") / 60


def history_start(end: Column | None = None, years: int = HISTORY_YEARS) -> Column:
    """First day of a history period; every year counts 365 days."""
    return F.date_sub(F.current_date() if end is None else end, years * DAYS_PER_YEAR)


def in_history_period(
    date: str | Column, end: Column | None = None, years: int = HISTORY_YEARS
) -> Column:
    value = F.col(date) if isinstance(date, str) else date
    last = F.current_date() if end is None else end
    return value.between(history_start(end, years), last)
