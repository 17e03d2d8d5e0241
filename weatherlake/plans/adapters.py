"""Weather-shaped views of the star-schema tables.

The tables hold no weather, so each function renames and combines columns into one of the
shapes the operators work on.  Joins run from the large table outwards and carry no hint:
Spark broadcasts a dimension while its size statistics allow it and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.functions.codec import parsed_columns
from weatherlake.functions.text import truth
from weatherlake.operators.alerts import transform_flat, with_alert_levels
from weatherlake.operators.records import CITY_KEYS
from weatherlake.operators.trips import STATE
from weatherlake.schemas import struct
from weatherlake.sources.files import read_parquet

# Weather code of each event type is its place in this list.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# Country asked for by a request, by request number; each is part of one priority name.
WANTED = ("urgent", "High", "MEDIUM", "specified", "low")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _null_every(n: int, key: str, value: Column) -> Column:
    """Blank out a measure by rule, so that every query meets NULLs."""
    return F.when(F.col(key) % n != 0, value)


def _located(spark: SparkSession, sf_dir: str, fact: DataFrame, customer_key: str) -> DataFrame:
    return (
        fact.join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col(customer_key))
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    )


def measured_events(spark: SparkSession, sf_dir: str, wind_filtered: bool = False) -> DataFrame:
    """Events with the number ``k`` of their JSON properties.

    As a projection ``k`` costs nothing where it is not used; queries that filter on wind
    parse it through a generator instead, because a pushed-down filter would parse it again.
    """
    events = table(spark, sf_dir, "events")
    if wind_filtered:
        return parsed_columns(events, F.col("props"), struct("k double"), *[F.col(name) for name in events.columns])
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("double"))


def _measures() -> dict[str, Column]:
    code = F.array_position(F.array(*[F.lit(name) for name in EVENT_TYPES]), F.col("event_type")) - 1
    return {
        "temperature": _null_every(89, "event_id", F.col("value")),
        "windspeed": _null_every(97, "event_id", F.col("k") * 0.5),
        "humidity": (F.col("event_id") % 101).cast("double"),
        "weathercode": code.cast("int"),
        "event_time": F.col("ts"),
    }


def readings(spark: SparkSession, sf_dir: str, wind_filtered: bool = False) -> DataFrame:
    """Flat readings of every event, located through its customer."""
    located = _located(spark, sf_dir, measured_events(spark, sf_dir, wind_filtered), "user_id")
    return located.select(
        "event_id",
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        *[column.alias(name) for name, column in _measures().items()],
    )


def measurements(spark: SparkSession, sf_dir: str, wind_filtered: bool = False) -> DataFrame:
    """Flat readings of every event without their place, so without any join."""
    events = measured_events(spark, sf_dir, wind_filtered)
    return events.select("event_id", *[column.alias(name) for name, column in _measures().items()])


def classified(spark: SparkSession, sf_dir: str, wind_filtered: bool = False) -> DataFrame:
    return with_alert_levels(readings(spark, sf_dir, wind_filtered))


def reading_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings as JSON messages; some are cut short and some have a word for a number."""
    whole = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("latitude"), "temperature", "windspeed",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm").alias("time"),
    ))
    mistyped = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("latitude"), "temperature", F.lit("calm").alias("windspeed"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm").alias("time"),
    ))
    text = (
        F.when(F.col("event_id") % 71 == 0, F.concat(F.lit('{"latitude": '), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 67 == 0, mistyped)
        .otherwise(whole)
    )
    return measurements(spark, sf_dir).select(text.alias("value"))


def partly_named(spark: SparkSession, sf_dir: str, wind_filtered: bool = False) -> DataFrame:
    """Classified readings of which some miss their city and some their country."""
    return classified(spark, sf_dir, wind_filtered).withColumns(
        {
            "city": _null_every(83, "event_id", F.col("city")),
            "country": F.when(F.col("event_id") % 79 == 0, F.lit("Unknown")).otherwise(F.col("country")),
        }
    )


def nested_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in the nested message shape; some lack ``current`` altogether."""
    flat = readings(spark, sf_dir)
    current = F.struct(
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("temperature").alias("temperature_2m"),
        F.col("windspeed").alias("windspeed_10m"),
        F.col("weathercode").cast("double").alias("weathercode"),
        F.col("humidity").alias("relative_humidity_2m"),
        (F.col("temperature") - 1).alias("apparent_temperature"),
    )
    return flat.select(
        "event_id",
        "latitude",
        "longitude",
        F.lit("UTC").alias("timezone"),
        (F.col("event_id") % 7 * 100).cast("double").alias("elevation"),
        _null_every(73, "event_id", current).alias("current"),
        F.lit(None).cast("string").alias("timestamp"),
        F.col("event_id").cast("string").alias("fetched_at"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages, some of them cut short."""
    text = F.to_json(F.struct("event_id", "event_type", "value", "props"))
    damaged = F.when(F.col("event_id") % 71 == 0, F.lit('{"event_id": ')).otherwise(text)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("offset"), F.col("user_id").alias("key"), "props", damaged.alias("value")
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows per nation from the orders of that day."""
    located = _located(spark, sf_dir, table(spark, sf_dir, "orders"), "o_custkey")
    per_day = located.groupBy("n_nationkey", "n_name", "r_name", "n_regionkey", "o_orderdate").agg(
        F.max("o_totalprice").alias("temp_max"),
        F.min("o_totalprice").alias("temp_min"),
        F.max("c_acctbal").alias("wind_max"),
        (F.count("*") * 0.5).cast("double").alias("precipitation"),
        F.min("o_orderkey").alias("first_order"),
    )
    return per_day.select(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.substring("r_name", 1, 2).alias("country_code"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        F.col("o_orderdate").cast("date").alias("date"),
        "temp_max",
        _null_every(53, "first_order", F.col("temp_min")).alias("temp_min"),
        "wind_max",
        "precipitation",
    )


def history_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows folded to one document per city.

    A document has one element per calendar day, so its size is bounded by the period.
    The precipitation array is three elements short and the wind array one too long.
    """
    day = F.struct("date", "temp_max", "temp_min", "wind_max", "precipitation")
    folded = (
        daily(spark, sf_dir)
        .groupBy(*CITY_KEYS)
        .agg(F.array_sort(F.collect_list(day)).alias("days"))
    )
    texts = F.transform("days", lambda d: d["date"].cast("string"))
    short = F.slice(F.col("days.precipitation"), F.lit(1), F.greatest(F.size("days") - 3, F.lit(0)))
    series = F.struct(
        texts.alias("time"),
        F.col("days.temp_max").alias("temperature_2m_max"),
        F.col("days.temp_min").alias("temperature_2m_min"),
        F.concat(F.col("days.wind_max"), F.array(F.lit(-1.0))).alias("windspeed_10m_max"),
        short.alias("precipitation_sum"),
    )
    geocode = F.struct("city", "country", "country_code", "latitude", "longitude", F.lit("").alias("admin1"))
    history = F.struct(
        "latitude",
        "longitude",
        F.lit(0.0).alias("elevation"),
        F.lit("UTC").alias("timezone"),
        series.alias("daily"),
    )
    return folded.select(geocode.alias("geocode_info"), history.alias("historical_data"))


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State log per user: riding on click and view, unknown on error."""
    spelled = (
        F.when(F.col("event_type") == "click", "True")
        .when(F.col("event_type") == "view", "1")
        .when(F.col("event_type") != "error", "False")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("id"), F.col("ts").alias("date"), truth(spelled).alias(STATE)
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station measurements from line items."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station"),
        F.col("l_shipdate").alias("date"),
        _null_every(101, "l_orderkey", F.col("l_quantity")).alias("temperature"),
        F.col("l_extendedprice").alias("precipitation"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station table."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(F.col("s_suppkey").alias("station"), F.col("n_name").alias("country"))
    )


def _request_of(key: str) -> list[Column]:
    """City and country asked for; some requests name no country."""
    wanted = F.array(*[F.lit(name) for name in WANTED])
    return [
        F.concat(F.lit("place "), F.col(key).cast("string")).alias("requested_city"),
        _null_every(17, key, F.element_at(wanted, (F.col(key) % len(WANTED) + 1).cast("int"))).alias("requested_country"),
    ]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place request per customer."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request_id"), *_request_of("c_custkey"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of a customer as the answers to its request, in order-key order."""
    return table(spark, sf_dir, "orders").select(
        *_request_of("o_custkey"),
        F.col("o_orderkey").alias("position"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("country"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("country_code"),
        F.lit(None).cast("string").alias("admin1"),
        F.lit(None).cast("string").alias("timezone"),
        F.col("o_totalprice").alias("latitude"),
        (-F.col("o_totalprice")).alias("longitude"),
        _null_every(10, "o_orderkey", F.col("o_orderkey")).alias("population"),
    )


def requested_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that still carry the request of their place."""
    measures = _measures()
    return measured_events(spark, sf_dir).select(
        "event_id",
        *_request_of("user_id"),
        measures["temperature"].alias("temperature"),
        measures["windspeed"].alias("windspeed"),
    )
