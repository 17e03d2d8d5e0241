"""Summaries over stored alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.constants import LEVEL_0, LEVELS, UNKNOWN_PLACE
from weatherlake.functions.levels import or_default
from weatherlake.functions.text import place_label

SORT_SEED = 17


def alert_level_counts(alerts: DataFrame) -> DataFrame:
    """Number of rows at each of the three levels, for wind and for heat.

    One global aggregate of six counters, unpivoted: zero counts need no outer join.
    """
    wind, heat = or_default("wind_alert_level", LEVEL_0), or_default("heat_alert_level", LEVEL_0)
    counters = [
        F.count_if(column == level).alias(f"{kind}_{level}")
        for kind, column in (("wind", wind), ("heat", heat))
        for level in LEVELS
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                F.col(f"wind_{level}").alias("wind_count"),
                F.col(f"heat_{level}").alias("heat_count"),
            )
            for level in LEVELS
        ]
    )
    return alerts.agg(*counters).select(F.inline(rows))


def top_weathercode_by_country(alerts: DataFrame) -> DataFrame:
    """Most frequent weather code of each country; the lowest code wins a tie."""
    counted = (
        alerts.filter(F.col("weathercode").isNotNull())
        .groupBy(or_default("country", UNKNOWN_PLACE).alias("country"), "weathercode")
        .agg(F.count("*").alias("n"))
    )
    best = F.max(F.struct("n", (-F.col("weathercode")).alias("negated"), "weathercode")).alias("best")
    return counted.groupBy("country").agg(best).select("country", "best.weathercode", "best.n")


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Row count of each place, a missing name counting as ``Unknown``."""
    keys = [or_default(column, UNKNOWN_PLACE).alias(column) for column in columns]
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def records_per_country(alerts: DataFrame) -> DataFrame:
    return counts_by(alerts, "country").orderBy(F.desc("n"), "country")


def top_cities(alerts: DataFrame, n: int = 10) -> DataFrame:
    return counts_by(alerts, "city").orderBy(F.desc("n"), "city").limit(n)


def place_totals(alerts: DataFrame) -> DataFrame:
    """Number of countries and of cities, counted on the distinct pairs only."""
    pairs = alerts.select(
        or_default("country", UNKNOWN_PLACE).alias("country"), or_default("city", UNKNOWN_PLACE).alias("city")
    ).distinct()
    return pairs.agg(
        F.count_distinct("country").alias("n_countries"), F.count_distinct("city").alias("n_cities")
    )


def reading_stats(readings: DataFrame, decimals: int = 1) -> DataFrame:
    """Mean, minimum and maximum of temperature and wind over all rows."""
    return readings.agg(
        *[
            F.round(side(measure), decimals).alias(f"{name}_{measure}")
            for measure in ("temperature", "windspeed")
            for name, side in (("avg", F.avg), ("min", F.min), ("max", F.max))
        ]
    )


def alerts_per_city(stored: DataFrame) -> DataFrame:
    """Alert lines of every stored city, in name order."""
    counted = stored.groupBy("country", "city").agg(F.count("*").alias("alerts"))
    return counted.orderBy("country", "city")


def sorted_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Global sort whose last key is random, so that any number of identical rows can be
    spread over several range partitions."""
    return df.orderBy(*keys, F.rand(SORT_SEED))


def measure_series(alerts: DataFrame, measure: str, time: str = "event_time") -> DataFrame:
    """Time series of one measure per place label, in label, time and value order."""
    series = alerts.select(
        place_label().alias("label"), F.col(time).alias("time"), F.col(measure).alias("value")
    )
    present = series.filter(F.col("time").isNotNull() & F.col("value").isNotNull())
    return sorted_by(present, "label", "time", "value")


def series_arrays(alerts: DataFrame, measure: str, time: str = "event_time") -> DataFrame:
    """label, day, times, values: the series of each place as arrays, one row per day.

    A day bounds the arrays by what one place reports in a day; a label's rows in day order are its whole series.
    """
    series = alerts.select(place_label().alias("label"), F.col(time).alias("time"), F.col(measure).alias("value"))
    present = series.filter(F.col("time").isNotNull() & F.col("value").isNotNull())
    points = F.array_sort(F.collect_list(F.struct("time", "value"))).alias("points")
    daily = present.groupBy("label", F.to_date("time").alias("day")).agg(points)
    return daily.select("label", "day", F.col("points.time").alias("times"), F.col("points.value").alias("values"))
