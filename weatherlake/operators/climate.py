"""Yearly, station and country analyses of a climate table.

``climate`` has ``station, date, temperature, precipitation``; ``stations`` is the
dimension ``station, country``.  Country analyses fold the climate table per station and
year before they meet the dimension, so the large table is never shuffled row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weatherlake.constants import HOT_DAY
from weatherlake.operators.profile import distinct_sketches, merged_distinct

VIEW = "climate"
TREND_YEARS = 50


def with_date_parts(climate: DataFrame) -> DataFrame:
    return climate.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "day": F.dayofmonth("date"),
            "is_hot": F.col("temperature") > HOT_DAY,
        }
    )


def clean_climate(climate: DataFrame) -> DataFrame:
    """Rows with date, station and temperature; NaN is a value here, only NULL is missing."""
    return climate.filter(F.col("date").isNotNull() & F.col("station").isNotNull() & F.col("temperature").isNotNull())


def years_and_stations(climate: DataFrame) -> DataFrame:
    """Number of years and of stations, counted on their distinct pairs only."""
    pairs = climate.select(F.year("date").alias("year"), "station").distinct()
    return pairs.agg(
        F.count_distinct("year").alias("n_years"), F.count_distinct("station").alias("n_stations")
    )


def station_sketches(climate: DataFrame) -> DataFrame:
    """year, sketch: the stations of each year, small enough to store."""
    return distinct_sketches(climate, "station", F.year("date").alias("year"))


def stations_of_periods(sketches: DataFrame, years: int) -> DataFrame:
    """first_year, n_stations: estimated stations of periods of so many years, from the sketches of the years alone."""
    first = (F.floor(F.col("year") / years) * years).cast("int").alias("first_year")
    return merged_distinct(sketches.filter("year IS NOT NULL"), first, name="n_stations")


def hot_days(climate: DataFrame) -> DataFrame:
    return with_date_parts(climate).agg(F.count_if("is_hot").alias("hot_days"))


def hot_days_by_year(climate: DataFrame) -> DataFrame:
    return with_date_parts(climate).groupBy("year").agg(F.count_if("is_hot").alias("hot_days"))


def mean_temperature_by_year(climate: DataFrame) -> DataFrame:
    return climate.groupBy(F.year("date").alias("year")).agg(F.avg("temperature").alias("avg_temperature"))


def mean_temperature_of(climate: DataFrame, year: int) -> DataFrame:
    """World mean of one year; the year is a date range, so the filter reaches the scan."""
    first, after = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    of_year = climate.filter((F.col("date") >= first) & (F.col("date") < after))
    return of_year.agg(F.lit(year).alias("year"), F.avg("temperature").alias("avg_temperature"))


def hottest_stations(climate: DataFrame, stations: DataFrame, n: int = 5) -> DataFrame:
    """The n stations with the highest mean temperature, with their location.

    Only the n winners are joined to the dimension.
    """
    means = climate.groupBy("station").agg(F.avg("temperature").alias("avg_temperature"))
    top = means.orderBy(F.desc("avg_temperature"), "station").limit(n)
    return top.join(stations, "station", "left")


def coldest_year(climate: DataFrame) -> DataFrame:
    return mean_temperature_by_year(climate).orderBy("avg_temperature", "year").limit(1)


def busiest_station(climate: DataFrame) -> DataFrame:
    counted = climate.groupBy("station").agg(F.count("*").alias("n_records"))
    return counted.orderBy(F.desc("n_records"), "station").limit(1)


def register_view(climate: DataFrame, name: str = VIEW) -> None:
    with_date_parts(climate).createOrReplaceTempView(name)


def coldest_year_sql(climate: DataFrame) -> DataFrame:
    register_view(climate)
    return climate.sparkSession.sql(
        f"SELECT year, avg(temperature) AS avg_temperature FROM {VIEW} "
        "GROUP BY year ORDER BY avg_temperature, year LIMIT 1"
    )


def busiest_station_sql(climate: DataFrame) -> DataFrame:
    register_view(climate)
    return climate.sparkSession.sql(
        f"SELECT station, count(*) AS n_records FROM {VIEW} "
        "GROUP BY station ORDER BY n_records DESC, station LIMIT 1"
    )


def precipitation_series(climate: DataFrame) -> DataFrame:
    return climate.groupBy(F.year("date").alias("year")).agg(
        F.sum("precipitation").alias("total_precipitation"), F.avg("precipitation").alias("avg_precipitation")
    )


def _last_years(yearly: DataFrame, years: int) -> DataFrame:
    """Rows of the last ``years`` years; ``yearly`` has one row per year (and country), so
    the window over all of it stays small at any data size."""
    last = F.max("year").over(Window.partitionBy())
    recent = yearly.withColumn("last_year", last).filter(F.col("year") > F.col("last_year") - years)
    return recent.drop("last_year")


def precipitation_trend_world(climate: DataFrame, years: int = TREND_YEARS) -> DataFrame:
    return _last_years(precipitation_series(climate), years)


def trend(yearly: DataFrame, measure: str, *by: str) -> DataFrame:
    """slope, r2, n_years: the least-squares line through the yearly values of a measure, per group.

    ``yearly`` has one row per year and group.  Years without a value do not count; a single
    year has no slope.
    """
    fitted = (
        F.regr_slope(measure, "year").alias("slope"),
        F.regr_r2(measure, "year").alias("r2"),
        F.regr_count(measure, "year").alias("n_years"),
    )
    return yearly.groupBy(*by).agg(*fitted)


def precipitation_slope_world(climate: DataFrame, years: int | None = None) -> DataFrame:
    """Change of the yearly precipitation per year, over all or the last ``years`` years."""
    yearly = precipitation_series(climate).filter("year IS NOT NULL")
    return trend(_last_years(yearly, years) if years else yearly, "total_precipitation")


def precipitation_slope_by_country(climate: DataFrame, stations: DataFrame) -> DataFrame:
    yearly = precipitation_by_country_year(climate, stations).filter("_located AND year IS NOT NULL")
    return trend(yearly, "total_precipitation", "country")


def _station_years(climate: DataFrame, measure: str) -> DataFrame:
    return climate.groupBy("station", F.year("date").alias("year")).agg(
        F.sum(measure).alias("total"), F.count(measure).alias("n")
    )


def _located(per_station: DataFrame, stations: DataFrame) -> DataFrame:
    """Folded station rows with their country; stations missing from the dimension are kept, marked."""
    return per_station.join(stations.withColumn("_located", F.lit(True)), "station", "left")


def precipitation_by_country_year(climate: DataFrame, stations: DataFrame) -> DataFrame:
    per_station = _located(_station_years(climate, "precipitation"), stations)
    return per_station.groupBy("country", "_located", "year").agg(
        F.sum("total").alias("total_precipitation"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("avg_precipitation"),
    )


def precipitation_trend_country(
    climate: DataFrame, stations: DataFrame, country: str, years: int = TREND_YEARS
) -> DataFrame:
    """Yearly precipitation of one country over the last years of the whole table.

    The last year counts all measurements, also those of stations without a country.
    """
    yearly = _last_years(precipitation_by_country_year(climate, stations), years)
    return yearly.filter(F.col("_located") & (F.col("country") == country)).drop("_located")


def _percent_of_world(grouped: DataFrame) -> DataFrame:
    """Percent difference of each group's mean from the mean of all rows, NULL where that mean is 0.

    ``grouped`` holds one row per year or country with ``total`` and ``n``, so the window
    over all of it sees a few hundred rows at any data size.
    """
    everything = Window.partitionBy()
    world = F.try_divide(F.sum("total").over(everything), F.sum("n").over(everything))
    mean = F.try_divide("total", "n")
    return grouped.select(
        *[name for name in grouped.columns if name not in ("total", "n")],
        mean.alias("avg_temperature"),
        F.try_divide(F.lit(100.0) * (mean - world), world).alias("pct_vs_world"),
    )


def temperature_vs_world_by_year(climate: DataFrame) -> DataFrame:
    yearly = climate.groupBy(F.year("date").alias("year")).agg(
        F.sum("temperature").alias("total"), F.count("temperature").alias("n")
    )
    return _percent_of_world(yearly)


def temperature_vs_world_by_country(climate: DataFrame, stations: DataFrame) -> DataFrame:
    per_station = climate.groupBy("station").agg(
        F.sum("temperature").alias("total"), F.count("temperature").alias("n")
    )
    by_country = _located(per_station, stations).groupBy("country", "_located").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    return _percent_of_world(by_country).filter("_located").drop("_located")
