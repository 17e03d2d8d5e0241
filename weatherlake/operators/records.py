"""Daily history and per-city climate records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.functions.joins import join_null_safe

# Column names of the daily table and the arrays they come from.
CITY_KEYS = ("city", "country", "country_code", "latitude", "longitude")
DAILY_MEASURES = ("temp_max", "temp_min", "wind_max", "precipitation")
DAILY_ARRAYS = {
    "temp_max": "temperature_2m_max",
    "temp_min": "temperature_2m_min",
    "wind_max": "windspeed_10m_max",
    "precipitation": "precipitation_sum",
}


def explode_history(documents: DataFrame) -> DataFrame:
    """One row per element of ``daily.time``; arrays that are shorter give NULL."""
    days = documents.select(
        "geocode_info.city",
        "geocode_info.country",
        "geocode_info.country_code",
        "historical_data.latitude",
        "historical_data.longitude",
        F.posexplode("historical_data.daily.time").alias("day", "date"),
        F.col("historical_data.daily").alias("daily"),
    )
    values = [F.get(f"daily.{array}", F.col("day")).alias(name) for name, array in DAILY_ARRAYS.items()]
    return days.select(*CITY_KEYS, F.col("date").try_cast("date").alias("date"), *values)


def days_in_history(documents: DataFrame) -> DataFrame:
    return documents.select(
        "geocode_info.city",
        "geocode_info.country",
        F.coalesce(F.size("historical_data.daily.time"), F.lit(0)).alias("days"),
    )


def complete_days(daily: DataFrame) -> DataFrame:
    """Days on which no measure is NULL; NaN is a value here."""
    return daily.filter(" AND ".join(f"{name} IS NOT NULL" for name in DAILY_MEASURES))


def _extremes() -> list[Column]:
    return [
        F.max("temp_max").alias("hottest_temp"),
        F.min("temp_min").alias("coldest_temp"),
        F.max("wind_max").alias("strongest_wind"),
        F.max("precipitation").alias("max_daily_precipitation"),
        F.sum("precipitation").alias("total_precipitation"),
    ]


def climate_records(daily: DataFrame) -> DataFrame:
    """Extremes of every city with the earliest day each was reached, in one pass.

    The day travels with its measure through ``min_by``, so the table is scanned and
    shuffled once (partial results only) instead of being joined back three times.
    """
    return complete_days(daily).groupBy(*CITY_KEYS).agg(
        *_extremes(),
        F.min_by("date", F.struct(-F.col("temp_max"), "date")).alias("hottest_day"),
        F.min_by("date", F.struct("temp_min", "date")).alias("coldest_day"),
        F.min_by("date", F.struct(-F.col("wind_max"), "date")).alias("windiest_day"),
    )


def climate_records_by_join(daily: DataFrame) -> DataFrame:
    """The same records by joining each extreme back to its days, on the full city key."""
    clean = complete_days(daily)
    result = clean.groupBy(*CITY_KEYS).agg(*_extremes())
    extremes = result
    for measure, extreme, day in (
        ("temp_max", "hottest_temp", "hottest_day"),
        ("temp_min", "coldest_temp", "coldest_day"),
        ("wind_max", "strongest_wind", "windiest_day"),
    ):
        reached = join_null_safe(clean, extremes.select(*CITY_KEYS, extreme), CITY_KEYS).filter(
            F.col(measure) == F.col(extreme)
        )
        first_day = reached.groupBy(*CITY_KEYS).agg(F.min("date").alias(day))
        result = join_null_safe(result, first_day, CITY_KEYS, "left")
    return result


def first_row_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Deduplicate by key, keeping the smallest row in ``order`` (combined map-side)."""
    rest = [name for name in df.columns if name not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return first.select(*keys, "row.*")


def _records_struct(with_total: bool) -> Column:
    precipitation = [F.col("max_daily_precipitation").alias("max_daily")]
    if with_total:
        precipitation.append(F.col("total_precipitation").alias("total_period"))

    def day(column: str, value: str, name: str) -> Column:
        return F.struct(F.col(column).cast("string").alias("date"), F.col(value).alias(name)).alias(column)

    return F.struct(
        day("hottest_day", "hottest_temp", "temperature"),
        day("coldest_day", "coldest_temp", "temperature"),
        day("windiest_day", "strongest_wind", "windspeed"),
        F.struct(*precipitation).alias("precipitation"),
    ).alias("records")


def record_documents(records: DataFrame) -> DataFrame:
    """Nested document per city, totals included."""
    return records.select(*CITY_KEYS, _records_struct(with_total=True))


def record_messages(records: DataFrame) -> DataFrame:
    """Nested message per city, without the period total."""
    return records.select(*CITY_KEYS, _records_struct(with_total=False))


def stamp_computed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("computed_at", F.current_timestamp())
