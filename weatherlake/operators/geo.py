"""City resolution and message building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.functions.joins import join_null_safe, lookup_join
from weatherlake.functions.levels import or_default
from weatherlake.functions.text import contains_ignoring_case
from weatherlake.operators.alerts import required_fields_split

REQUEST = ("requested_city", "requested_country")
BASIC_REQUIRED = ("latitude", "longitude", "timezone", "elevation", "current", "current.time")


def resolve_cities(candidates: DataFrame) -> DataFrame:
    """Best candidate of every requested place: the first one whose country contains the
    requested country, else the first one.

    One aggregation with map-side combine: however many candidates a request has, each
    map task ships at most one of them per request.  A request without candidates has no row.
    """
    place = F.struct(
        F.col("name").alias("city"),
        "country",
        or_default("country_code", "").alias("country_code"),
        "latitude",
        "longitude",
        or_default("admin1", "").alias("admin1"),
        or_default("population", 0).alias("population"),
        or_default("timezone", "").alias("timezone"),
    )
    in_country = contains_ignoring_case(or_default("country", ""), "requested_country")
    rank = F.struct(F.when(in_country, 0).otherwise(1).alias("miss"), F.col("position"))
    best = candidates.groupBy(*REQUEST).agg(F.min_by(place, rank).alias("place"))
    return best.select(*REQUEST, "place.*")


def resolve_requests(requests: DataFrame, candidates: DataFrame) -> DataFrame:
    """Resolved place of each request row; unresolved requests drop out.

    The candidates are reduced to one row per request before the join, so the join never
    multiplies rows.
    """
    return lookup_join(requests, resolve_cities(candidates), REQUEST)


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def enrich_readings(readings: DataFrame, places: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach the resolved place to each reading and shape the enriched message.

    ``on`` names the key columns, one place per key.  Works for a streaming ``readings``
    with a static ``places``.
    """
    geo = places.drop("latitude", "longitude", "timezone")
    joined = lookup_join(readings, geo, on)
    return joined.select(
        *readings.columns,
        "city",
        "country",
        "country_code",
        F.col("admin1").alias("region"),
        "population",
    )


def enriched_split(readings: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Enriched, stamped messages of readings that name a place, and the readings that cannot be sent.

    ``places`` has one resolved place per request (``resolve_cities``).  A reading cannot be sent if its place
    is unknown or a field that every message needs is missing.
    """
    complete, incomplete = required_fields_split(readings, BASIC_REQUIRED)
    messages = stamp_message(enrich_readings(complete, places, REQUEST)).drop(*REQUEST)
    unknown = join_null_safe(complete, places.select(*REQUEST), REQUEST, "left_anti")
    return messages, unknown.unionByName(incomplete)


def stamp_message(df: DataFrame) -> DataFrame:
    """Clock columns of an outgoing message."""
    return df.withColumns({"timestamp": _now(), "fetched_at": F.col("current.time")})


def basic_messages(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Basic message of each complete reading, and the readings that lack a needed field."""
    complete, incomplete = required_fields_split(readings, BASIC_REQUIRED)
    fields = complete.select("latitude", "longitude", "timezone", "elevation", "current")
    return fields, incomplete


def stamped_history_messages(documents: DataFrame) -> DataFrame:
    """History messages with the time at which they are sent."""
    return history_messages(documents).withColumn("timestamp", _now())


def history_messages(documents: DataFrame) -> DataFrame:
    """History documents in message form, one per city, without the clock column."""
    return documents.select(
        "geocode_info.city",
        "geocode_info.country",
        "geocode_info.country_code",
        F.col("geocode_info.admin1").alias("region"),
        "historical_data.latitude",
        "historical_data.longitude",
        "historical_data.timezone",
        "historical_data.elevation",
        "historical_data",
    )
