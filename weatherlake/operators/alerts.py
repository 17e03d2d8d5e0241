"""Readings to classified readings to alert rows.  Every step is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weatherlake.constants import UNKNOWN_LEVEL, UNKNOWN_PLACE
from weatherlake.functions.levels import fahrenheit, heat_level, is_alert, is_high_wind, or_default, wind_level
from weatherlake.functions.text import coordinate_name, path_safe
from weatherlake.functions.times import parse_time

# Output name of each measure inside ``current``, places, stored columns.
MEASURES = {
    "event_time": "time",
    "temperature": "temperature_2m",
    "windspeed": "windspeed_10m",
    "weathercode": "weathercode",
    "humidity": "relative_humidity_2m",
    "apparent_temperature": "apparent_temperature",
}
GEO_COLUMNS = ("city", "country", "country_code", "region", "population")
ALERT_COLUMNS = (
    "country", "city", "latitude", "longitude", "event_time", "temperature", "windspeed",
    "wind_alert_level", "heat_alert_level", "weathercode", "humidity",
)


def flatten_reading(readings: DataFrame, carry_geo: bool = False) -> DataFrame:
    """Lift ``current.*`` to the top level under the output names."""
    measures = [
        (F.col(f"current.{field}").try_cast("int") if field == "weathercode" else F.col(f"current.{field}"))
        .alias(name)
        for name, field in MEASURES.items()
    ]
    geo = [F.col(name) for name in GEO_COLUMNS] if carry_geo else []
    return readings.select(
        "latitude", "longitude", "timezone", "elevation", *measures, "timestamp", "fetched_at", *geo
    )


def with_alert_levels(
    readings: DataFrame, closed: str = "both", null_level: str = UNKNOWN_LEVEL
) -> DataFrame:
    return readings.withColumns(
        {
            "wind_alert_level": wind_level(closed=closed, null_level=null_level),
            "heat_alert_level": heat_level(closed=closed, null_level=null_level),
        }
    )


def classify_readings(
    readings: DataFrame,
    carry_geo: bool = False,
    closed: str = "both",
    null_level: str = UNKNOWN_LEVEL,
) -> DataFrame:
    """Nested readings to the classified 15-column shape (plus geography on request)."""
    leveled = with_alert_levels(flatten_reading(readings, carry_geo), closed, null_level)
    return leveled.withColumn("processing_time", F.current_timestamp())


def classify_flat_readings(readings: DataFrame, closed: str, null_level: str) -> DataFrame:
    """Flat raw readings with a parsed event time and alert levels."""
    timed = readings.withColumn("event_time", parse_time("time"))
    return with_alert_levels(timed, closed, null_level)


def transform_flat(readings: DataFrame) -> DataFrame:
    """Fahrenheit temperature and the high-wind flag."""
    return readings.withColumns({"temp_f": fahrenheit(), "high_wind_alert": is_high_wind()})


def high_wind_rows(transformed: DataFrame) -> DataFrame:
    return transformed.filter(or_default("high_wind_alert", False))


def alert_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(is_alert())


def with_place_fallback(df: DataFrame) -> DataFrame:
    """Replace both place names by coordinates where either name is missing."""
    nameless = (or_default("country", UNKNOWN_PLACE) == UNKNOWN_PLACE) | (
        or_default("city", UNKNOWN_PLACE) == UNKNOWN_PLACE
    )
    return df.withColumns(
        {
            "country": F.when(nameless, coordinate_name("latitude")).otherwise(F.col("country")),
            "city": F.when(nameless, coordinate_name("longitude")).otherwise(F.col("city")),
        }
    )


def alerts_to_store(classified: DataFrame) -> DataFrame:
    """Alert rows in their stored form, with the two folder columns."""
    named = classified
    for column in ("country", "city"):
        if column not in classified.columns:
            named = named.withColumn(column, F.lit(None).cast("string"))
    rows = with_place_fallback(alert_rows(named)).select(*ALERT_COLUMNS)
    return rows.withColumns({"country_path": path_safe("country"), "city_path": path_safe("city")})


def stamp_saved(alerts: DataFrame) -> DataFrame:
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return alerts.withColumn("saved_at", stamp)


def required_fields_split(df: DataFrame, required: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows that have every required field, and the rest."""
    complete = F.lit(True)
    for field in required:
        complete = complete & F.col(field).isNotNull()
    return df.filter(complete), df.filter(~complete)
