"""Alert level expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weatherlake.constants import (
    HEAT_BOUNDS,
    HIGH_WIND,
    LEVEL_0,
    LEVEL_1,
    LEVEL_2,
    UNKNOWN_LEVEL,
    WIND_BOUNDS,
)


def alert_level(
    measure: str | Column,
    bounds: tuple[float, float],
    closed: str = "both",
    null_level: str = UNKNOWN_LEVEL,
) -> Column:
    """Level of ``measure`` against two bounds.

    ``closed="both"`` puts the upper bound itself in level 1, ``closed="left"`` in level 2.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    value = F.col(measure) if isinstance(measure, str) else measure
    low, high = bounds
    in_middle = value <= high if closed == "both" else value < high
    return (
        F.when(value.isNull(), F.lit(null_level))
        .when(value < low, F.lit(LEVEL_0))
        .when(in_middle, F.lit(LEVEL_1))
        .otherwise(F.lit(LEVEL_2))
    )


def wind_level(measure: str | Column = "windspeed", **kwargs) -> Column:
    return alert_level(measure, WIND_BOUNDS, **kwargs)


def heat_level(measure: str | Column = "temperature", **kwargs) -> Column:
    return alert_level(measure, HEAT_BOUNDS, **kwargs)


def fahrenheit(measure: str | Column = "temperature") -> Column:
    value = F.col(measure) if isinstance(measure, str) else measure
    return value * 9 / 5 + 32


def is_high_wind(measure: str | Column = "windspeed") -> Column:
    """Strictly above the limit; a missing wind counts as calm."""
    value = F.col(measure) if isinstance(measure, str) else measure
    return F.coalesce(value, F.lit(0.0)) > HIGH_WIND


def is_alert(wind: str = "wind_alert_level", heat: str = "heat_alert_level") -> Column:
    """Any level other than level 0, ``unknown`` included; a missing level is level 0."""
    return (or_default(wind, LEVEL_0) != LEVEL_0) | (or_default(heat, LEVEL_0) != LEVEL_0)


def or_default(column: str | Column, default) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value, F.lit(default))
