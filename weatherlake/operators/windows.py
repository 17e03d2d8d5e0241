"""Event-time window aggregates.

The batch and the streaming form share the measures.  The batch form first folds readings
into panes as long as the slide, then assigns panes (not readings) to their overlapping
windows, so a reading is expanded once instead of once per window.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.constants import LEVEL_1, LEVEL_2, SLIDING_STEP, SLIDING_WINDOW, TUMBLING_WINDOW
from weatherlake.functions.times import local_to_utc, parse_time

# Names, levels counted and column order of the published aggregates.
PLACE = ("latitude", "longitude")
AVERAGED = ("temperature", "windspeed", "humidity")
BOUNDED = ("temperature", "windspeed")
LEVEL_COUNTERS = {
    "wind_level1_count": ("wind_alert_level", LEVEL_1),
    "wind_level2_count": ("wind_alert_level", LEVEL_2),
    "heat_level1_count": ("heat_alert_level", LEVEL_1),
    "heat_level2_count": ("heat_alert_level", LEVEL_2),
}
COUNTERS = (*LEVEL_COUNTERS, "total_measurements", "weather_reports")
AGGREGATE_COLUMNS = (
    "window_start", "window_end", "latitude", "longitude",
    "avg_temperature", "min_temperature", "max_temperature",
    "avg_windspeed", "min_windspeed", "max_windspeed",
    "wind_level1_count", "wind_level2_count", "heat_level1_count", "heat_level2_count",
    "total_wind_alerts", "total_heat_alerts", "total_measurements", "avg_humidity", "weather_reports",
)


def with_event_timestamp(readings: DataFrame, time: str = "event_time", zone: str | None = None) -> DataFrame:
    """Add ``event_timestamp``: text is parsed safely, timestamps pass through.

    Producers write local wall-clock times.  They are taken as they are unless ``zone``
    names the column with the reading's time zone, which shifts them to UTC.
    """
    is_text = readings.schema[time].dataType.typeName() == "string"
    parsed = parse_time(time) if is_text else F.col(time)
    return readings.withColumn("event_timestamp", local_to_utc(parsed, zone) if zone else parsed)


def _reading_counters() -> list[Column]:
    counters = [
        F.count_if(F.col(column) == level).alias(name) for name, (column, level) in LEVEL_COUNTERS.items()
    ]
    return [*counters, F.count("*").alias("total_measurements"), F.count("weathercode").alias("weather_reports")]


def _bounds(of_panes: bool = False) -> list[Column]:
    return [
        side(f"{name}_{measure}" if of_panes else measure).alias(f"{name}_{measure}")
        for measure in BOUNDED
        for name, side in (("min", F.min), ("max", F.max))
    ]


def _finish(windowed: DataFrame) -> DataFrame:
    return windowed.withColumns(
        {
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
            "total_wind_alerts": F.col("wind_level1_count") + F.col("wind_level2_count"),
            "total_heat_alerts": F.col("heat_level1_count") + F.col("heat_level2_count"),
        }
    ).select(*AGGREGATE_COLUMNS)


def sliding_aggregates_stream(
    readings: DataFrame,
    window: str = SLIDING_WINDOW,
    slide: str = SLIDING_STEP,
    time: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """Sliding aggregates as one stateful step, for streams (and small batches).

    Without a watermark the state keeps every window; with one, closed windows are
    dropped and append mode becomes possible.
    """
    timed = with_event_timestamp(readings, time)
    if watermark:
        timed = timed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
        timed = timed.withWatermark("event_timestamp", watermark)
    averages = [F.avg(measure).alias(f"avg_{measure}") for measure in AVERAGED]
    windowed = timed.groupBy(F.window("event_timestamp", window, slide), *PLACE).agg(
        *averages, *_bounds(), *_reading_counters()
    )
    return _finish(windowed)


def _duration(interval: str) -> pd.Timedelta:
    """Length of ``"5 minutes"`` or ``"interval 5 minutes"``; raises on what is no fixed length."""
    return pd.Timedelta(interval.lower().removeprefix("interval").strip())


def _whole_slides(window: str, slide: str) -> bool:
    return _duration(window) % _duration(slide) == pd.Timedelta(0)


def _pane_parts() -> list[Column]:
    parts = [
        part(measure).alias(f"{name}_{measure}")
        for measure in AVERAGED
        for name, part in (("sum", F.sum), ("n", F.count))
    ]
    return [*parts, *_bounds(), *_reading_counters()]


def _merged_panes() -> list[Column]:
    averages = [
        F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}")).alias(f"avg_{measure}")
        for measure in AVERAGED
    ]
    return [*averages, *_bounds(of_panes=True), *[F.sum(name).alias(name) for name in COUNTERS]]


def sliding_aggregates(
    readings: DataFrame,
    window: str = SLIDING_WINDOW,
    slide: str = SLIDING_STEP,
    time: str = "event_time",
) -> DataFrame:
    """Sliding aggregates of a bounded table through panes.

    Both steps combine map-side, so a place holding most readings ships one partial row
    per pane and task.  A window that is no whole number of slides has no panes and is
    computed directly.
    """
    if not _whole_slides(window, slide):
        return sliding_aggregates_stream(readings, window, slide, time)
    timed = with_event_timestamp(readings, time)
    panes = timed.groupBy(F.window("event_timestamp", slide).alias("pane"), *PLACE).agg(*_pane_parts())
    panes = panes.withColumn("pane_start", F.col("pane.start"))
    return _finish(panes.groupBy(F.window("pane_start", window, slide), *PLACE).agg(*_merged_panes()))


def closed_sliding_aggregates(
    readings: DataFrame,
    watermark: str,
    window: str = SLIDING_WINDOW,
    slide: str = SLIDING_STEP,
    time: str = "event_time",
) -> DataFrame:
    """Sliding aggregates of a stream through panes: each window once, when the watermark has closed it.

    Two stateful steps in append mode.  The first folds readings into panes of one slide; a closed pane goes once to
    each window that holds it.  State and shuffle thus hold one row per place and pane where the single
    step has one per place and window and copies every reading into all its windows.
    """
    if not _whole_slides(window, slide):
        return sliding_aggregates_stream(readings, window, slide, time, watermark)
    timed = with_event_timestamp(readings, time)
    timed = timed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    timed = timed.withWatermark("event_timestamp", watermark)
    panes = timed.groupBy(F.window("event_timestamp", slide).alias("pane"), *PLACE).agg(*_pane_parts())
    at = F.window_time("pane").alias("pane_time")
    panes = panes.select(at, *PLACE, *[c for c in panes.columns if c not in ("pane", *PLACE)])
    return _finish(panes.groupBy(F.window("pane_time", window, slide), *PLACE).agg(*_merged_panes()))


def tumbling_aggregates(
    readings: DataFrame, window: str = TUMBLING_WINDOW, time: str = "time"
) -> DataFrame:
    """Mean temperature and alert counts per window.

    ``alert_count`` counts readings that carry the flag at all, ``high_wind_count`` those
    where it is true.
    """
    timed = with_event_timestamp(readings, time)
    windowed = timed.groupBy(F.window("event_timestamp", window)).agg(
        F.avg("temperature").alias("avg_temp_c"),
        F.count("high_wind_alert").alias("alert_count"),
        F.count_if("high_wind_alert").alias("high_wind_count"),
    )
    return windowed.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "avg_temp_c",
        "alert_count",
        "high_wind_count",
    )


def with_computed_at(aggregates: DataFrame) -> DataFrame:
    return aggregates.withColumn("computed_at", F.current_timestamp())
