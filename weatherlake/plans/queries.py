"""Every registered query: ``name -> callable(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.constants import LEVEL_2, RIDE_TIME_FORMAT
from weatherlake.functions.codec import decode_with_rejects, rejected
from weatherlake.functions.levels import or_default
from weatherlake.functions.text import coordinate_key, place_key
from weatherlake.functions.times import in_history_period, local_to_utc, parse_time
from weatherlake.operators import alerts, climate, geo, profile, records, reports, trips, windows
from weatherlake.plans import adapters
from weatherlake.schemas import CORRUPT_COLUMN, FLAT_READING, struct
from weatherlake.sources.topics import topic_tail
from weatherlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters the SQL counterparts repeat.
CHOSEN_YEAR = 1999
TREND_YEARS = 3
TREND_COUNTRY = "NATION_7"
HISTORY_END = "2001-12-31"
HISTORY_YEARS = 3
QUANTILES = (0.25, 0.5, 0.75)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    """Round sums and means of doubles: their last digits depend on the order of addition."""
    return df.withColumns({name: F.round(name, decimals) for name in columns})


# --- readings and alerts ----------------------------------------------------------------


@query
def flatten_reading(spark, sf_dir):
    return alerts.flatten_reading(adapters.nested_readings(spark, sf_dir)).drop("timestamp")


@query
def basic_messages(spark, sf_dir):
    complete, _ = geo.basic_messages(adapters.nested_readings(spark, sf_dir))
    return complete.select(
        "latitude",
        "longitude",
        "timezone",
        "elevation",
        F.col("current.time").alias("fetched_at"),
        F.col("current.temperature_2m").alias("temperature"),
        F.col("current.windspeed_10m").alias("windspeed"),
        F.col("current.weathercode").alias("weathercode"),
        F.col("current.relative_humidity_2m").alias("humidity"),
        F.col("current.apparent_temperature").alias("apparent_temperature"),
    )


@query
def incomplete_messages(spark, sf_dir):
    _, incomplete = geo.basic_messages(adapters.nested_readings(spark, sf_dir))
    return incomplete.select(F.col("fetched_at").cast("bigint").alias("event_id"))


@query
def classify_alerts(spark, sf_dir):
    return alerts.with_alert_levels(adapters.measurements(spark, sf_dir)).select(
        "event_id", "temperature", "windspeed", "wind_alert_level", "heat_alert_level"
    )


@query
def classify_alerts_half_open(spark, sf_dir):
    leveled = alerts.with_alert_levels(adapters.measurements(spark, sf_dir), closed="left", null_level=LEVEL_2)
    return leveled.select("event_id", "temperature", "windspeed", "wind_alert_level", "heat_alert_level")


@query
def flat_transform(spark, sf_dir):
    flat = alerts.transform_flat(adapters.measurements(spark, sf_dir)).select("event_id", "temp_f", "high_wind_alert")
    return rounded(flat, "temp_f")


@query
def high_wind_alerts(spark, sf_dir):
    measured = adapters.measurements(spark, sf_dir, wind_filtered=True)
    return alerts.high_wind_rows(alerts.transform_flat(measured)).select("event_id", "windspeed")


@query
def stored_alerts(spark, sf_dir):
    return alerts.alerts_to_store(adapters.partly_named(spark, sf_dir, wind_filtered=True))


@query
def alerts_per_city(spark, sf_dir):
    return reports.alerts_per_city(alerts.alerts_to_store(adapters.partly_named(spark, sf_dir, wind_filtered=True)))


@query
def coordinate_keys(spark, sf_dir):
    return adapters.readings(spark, sf_dir).select("event_id", coordinate_key().alias("key"))


# --- windows ----------------------------------------------------------------------------


@query
def sliding_agg(spark, sf_dir):
    aggregates = windows.sliding_aggregates(adapters.classified(spark, sf_dir))
    return rounded(aggregates, "avg_temperature", "avg_windspeed", "avg_humidity")


@query
def sliding_agg_stream_form(spark, sf_dir):
    """The streaming operator on a bounded table."""
    aggregates = windows.sliding_aggregates_stream(adapters.classified(spark, sf_dir))
    return rounded(aggregates, "avg_temperature", "avg_windspeed", "avg_humidity")


@query
def tumbling_agg(spark, sf_dir):
    aggregates = windows.tumbling_aggregates(alerts.transform_flat(adapters.measurements(spark, sf_dir)), time="event_time")
    return rounded(aggregates, "avg_temp_c")


# --- reports ----------------------------------------------------------------------------


@query
def alert_level_counts(spark, sf_dir):
    return reports.alert_level_counts(alerts.with_alert_levels(adapters.measurements(spark, sf_dir)))


@query
def top_weathercode_by_country(spark, sf_dir):
    return reports.top_weathercode_by_country(adapters.partly_named(spark, sf_dir))


@query
def country_counts(spark, sf_dir):
    return reports.records_per_country(adapters.partly_named(spark, sf_dir))


@query
def top_cities(spark, sf_dir):
    return reports.top_cities(adapters.partly_named(spark, sf_dir))


@query
def place_totals(spark, sf_dir):
    return reports.place_totals(adapters.partly_named(spark, sf_dir))


@query
def reading_stats(spark, sf_dir):
    return reports.reading_stats(adapters.measurements(spark, sf_dir))


@query
def temperature_series(spark, sf_dir):
    return reports.measure_series(adapters.partly_named(spark, sf_dir), "temperature")


@query
def temperature_arrays(spark, sf_dir):
    """The arrays as text: seconds of the day, and hundredths of a degree."""
    arrays = reports.series_arrays(adapters.partly_named(spark, sf_dir), "temperature")
    second = lambda t: F.date_format(t, "HH:mm:ss")
    hundredths = lambda v: F.round(v * 100).cast("long").cast("string")
    return arrays.select(
        "label", "day", F.size("times").cast("long").alias("n"),
        F.array_join(F.transform("times", second), " ").alias("times"),
        F.array_join(F.transform("values", hundredths), " ").alias("values"),
    )


@query
def wind_series(spark, sf_dir):
    return reports.measure_series(adapters.partly_named(spark, sf_dir, wind_filtered=True), "windspeed")


# --- places -----------------------------------------------------------------------------


@query
def resolve_city(spark, sf_dir):
    return geo.resolve_requests(adapters.requests(spark, sf_dir), adapters.candidates(spark, sf_dir))


@query
def enrich_readings(spark, sf_dir):
    places = geo.resolve_cities(adapters.candidates(spark, sf_dir))
    return geo.enrich_readings(adapters.requested_readings(spark, sf_dir), places, geo.REQUEST)


# --- messages ---------------------------------------------------------------------------


@query
def json_round_trip(spark, sf_dir):
    schema = struct("event_id long, event_type string, value double, props string")
    decoded = decode_with_rejects(adapters.messages(spark, sf_dir), schema)
    return decoded.withColumnRenamed(CORRUPT_COLUMN, "reject")


@query
def classified_messages(spark, sf_dir):
    """Decode and classify flat messages; a field of the wrong type is NULL."""
    leveled = jobs.flat_classified_stream(adapters.reading_messages(spark, sf_dir))
    return leveled.select("latitude", "temperature", "windspeed", "wind_alert_level", "heat_alert_level")


@query
def dead_letters(spark, sf_dir):
    return rejected(decode_with_rejects(adapters.reading_messages(spark, sf_dir), FLAT_READING))


@query
def encoded_messages(spark, sf_dir):
    """JSON messages of the transform job, read back field by field."""
    sent = jobs.messages_of(jobs.flat_transformed_stream(adapters.reading_messages(spark, sf_dir)))
    fields = sent.select(F.from_json("value", "latitude string, temp_f double, high_wind_alert boolean").alias("m"))
    return rounded(fields.select("m.*"), "temp_f")


@query
def topic_tail_rows(spark, sf_dir):
    return topic_tail(adapters.messages(spark, sf_dir).select("offset", "key", F.col("props").alias("value")))


# --- history and records ----------------------------------------------------------------


@query
def explode_history(spark, sf_dir):
    return records.explode_history(adapters.history_documents(spark, sf_dir))


@query
def history_days(spark, sf_dir):
    return records.days_in_history(adapters.history_documents(spark, sf_dir))


@query
def history_message_fields(spark, sf_dir):
    messages = geo.history_messages(adapters.history_documents(spark, sf_dir))
    return messages.select(
        place_key().alias("key"),
        "city",
        "country",
        "region",
        "latitude",
        "timezone",
        F.array_join("historical_data.daily.time", ",").alias("days"),
        F.aggregate("historical_data.daily.temperature_2m_max", F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0))).alias("max_total"),
        F.size("historical_data.daily.precipitation_sum").alias("precipitation_days"),
    ).withColumn("max_total", F.round("max_total", 2))


@query
def recent_daily(spark, sf_dir):
    in_period = in_history_period("date", F.lit(HISTORY_END).cast("date"), HISTORY_YEARS)
    return adapters.daily(spark, sf_dir).filter(in_period)


@query
def climate_records(spark, sf_dir):
    return rounded(records.climate_records(adapters.daily(spark, sf_dir)), "total_precipitation")


@query
def records_join_form(spark, sf_dir):
    return rounded(records.climate_records_by_join(adapters.daily(spark, sf_dir)), "total_precipitation")


@query
def record_documents(spark, sf_dir):
    documents = records.record_documents(records.climate_records(adapters.daily(spark, sf_dir)))
    fields = documents.select(
        "city",
        "country_code",
        F.col("records.hottest_day.date").alias("hottest_date"),
        F.col("records.hottest_day.temperature").alias("hottest"),
        F.col("records.coldest_day.date").alias("coldest_date"),
        F.col("records.coldest_day.temperature").alias("coldest"),
        F.col("records.windiest_day.date").alias("windiest_date"),
        F.col("records.windiest_day.windspeed").alias("windiest"),
        F.col("records.precipitation.max_daily").alias("max_daily"),
        F.col("records.precipitation.total_period").alias("total_period"),
    )
    return rounded(fields, "total_period")


@query
def record_messages(spark, sf_dir):
    documents = records.record_messages(records.climate_records(adapters.daily(spark, sf_dir)))
    message = F.to_json(F.struct(*documents.columns))
    return documents.select(
        place_key().alias("key"),
        F.get_json_object(message, "$.records.hottest_day.date").alias("hottest_date"),
        F.get_json_object(message, "$.records.hottest_day.temperature").cast("double").alias("hottest"),
        F.get_json_object(message, "$.records.coldest_day.date").alias("coldest_date"),
        F.get_json_object(message, "$.records.coldest_day.temperature").cast("double").alias("coldest"),
        F.get_json_object(message, "$.records.windiest_day.date").alias("windiest_date"),
        F.get_json_object(message, "$.records.windiest_day.windspeed").cast("double").alias("windiest"),
        F.get_json_object(message, "$.records.precipitation.max_daily").cast("double").alias("max_daily"),
        F.get_json_object(message, "$.records.precipitation.total_period").alias("total_period"),
    )


@query
def first_day_per_city(spark, sf_dir):
    daily = adapters.daily(spark, sf_dir).select("city", "date", "temp_max")
    return records.first_row_per_key(daily, ["city"], ["date"])


# --- trips ------------------------------------------------------------------------------


def _numbered(spark, sf_dir):
    return trips.number_trips(adapters.rides(spark, sf_dir), tie=["event_id"])


@query
def trip_numbers(spark, sf_dir):
    return _numbered(spark, sf_dir)


@query
def trip_durations(spark, sf_dir):
    return rounded(trips.trip_durations(_numbered(spark, sf_dir)), "duree_trajet_minutes")


@query
def riding_totals(spark, sf_dir):
    return rounded(trips.riding_totals(trips.trip_durations(_numbered(spark, sf_dir))), "duree_trajet_minutes")


@query
def trips_of_id(spark, sf_dir):
    rides = trips.rides_of_first_rider(adapters.rides(spark, sf_dir))
    durations = trips.trip_durations(trips.number_trips(rides, tie=["event_id"]))
    return rounded(durations, "duree_trajet_minutes").orderBy("numero_de_trajet")


@query
def distinct_ids(spark, sf_dir):
    return trips.distinct_ids(adapters.rides(spark, sf_dir))


@query
def distinct_ids_approximate(spark, sf_dir):
    """The number of ids, and whether the estimate is within three standard deviations of it."""
    rides = adapters.rides(spark, sf_dir)
    exact = trips.distinct_ids(rides)
    estimate = trips.distinct_ids(rides, error=0.02).select("nb_ids_uniques").scalar()
    close = F.abs(estimate - F.col("nb_ids_uniques")) <= 3 * 0.02 * F.col("nb_ids_uniques")
    return exact.select("nb_ids_uniques", close.alias("within_error"))


@query
def ordered_rides(spark, sf_dir):
    return trips.ordered_rides(adapters.rides(spark, sf_dir), "event_id")


@query
def first_rides(spark, sf_dir):
    return adapters.rides(spark, sf_dir).orderBy("id", "date", "event_id").limit(10)


# --- profiling --------------------------------------------------------------------------


@query
def row_count(spark, sf_dir):
    return profile.row_count(adapters.table(spark, sf_dir, "events"))


@query
def column_mean(spark, sf_dir):
    return rounded(profile.column_mean(adapters.table(spark, sf_dir, "events"), "value"), "mean_value")


@query
def group_means(spark, sf_dir):
    customers = adapters.table(spark, sf_dir, "customer")
    stats = profile.group_stats(
        customers, "c_mktsegment", mean=["c_acctbal", "c_nationkey"], largest=["c_acctbal"]
    )
    return rounded(stats, "mean_c_acctbal", "mean_c_nationkey")


def _numeric(statistics: DataFrame, *columns: str, decimals: int = 4) -> DataFrame:
    """Statistics come as text; compare them as numbers."""
    numbers = [F.round(F.col(name).cast("double"), decimals).alias(name) for name in columns]
    return statistics.select("summary", *numbers)


@query
def describe_col(spark, sf_dir):
    return _numeric(adapters.table(spark, sf_dir, "customer").describe("c_acctbal"), "c_acctbal")


@query
def summary_count_max(spark, sf_dir):
    return adapters.table(spark, sf_dir, "nation").join(
        adapters.table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey")
    ).select("c_custkey", "c_name", "n_name", "c_mktsegment").summary("count", "max")


@query
def summary_all(spark, sf_dir):
    """All eight statistics of every column; texts have a count, a least and a greatest value."""
    customers = adapters.table(spark, sf_dir, "customer")
    summary = profile.full_summary(customers)
    numbers = [name for name, kind in customers.dtypes if kind != "string"]
    return summary.withColumns({name: F.round(F.col(name).cast("double"), 4) for name in numbers})


@query
def quantiles(spark, sf_dir):
    return profile.quantile_rows(adapters.table(spark, sf_dir, "events"), "value", QUANTILES, errors=[0.0])


@query
def quantiles_approximate(spark, sf_dir):
    """Whether the approximate quantiles keep their rank error."""
    events = adapters.table(spark, sf_dir, "events")
    return profile.rank_errors(events, "value", QUANTILES, 0.05).union(profile.rank_errors(events, "value", QUANTILES, 0.01))


@query
def quantiles_of_merged_sketches(spark, sf_dir):
    """Whether quantiles from one sketch per day keep their rank error."""
    events = adapters.table(spark, sf_dir, "events")
    return profile.sketched_rank_errors(events, "value", QUANTILES, 0.01, F.to_date("ts").alias("day"))


@query
def corr_cov(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    return rounded(profile.correlation(events, "value", "user_id"), "corr", "covar_samp")


@query
def filter_category(spark, sf_dir):
    return profile.in_category(adapters.table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


@query
def concat_cols(spark, sf_dir):
    return profile.with_concat(adapters.rides(spark, sf_dir), "id_sur_velo", "id", trips.STATE).select(
        "event_id", "id_sur_velo"
    )


@query
def self_join(spark, sf_dir):
    customers = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return profile.widen(customers, customers, "c_custkey")


@query
def union_by_name(spark, sf_dir):
    customers = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return profile.union_rows(customers, customers.select("c_mktsegment", "c_custkey"))


@query
def except_all(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    pairs = events.select("user_id", "event_type")
    return profile.bag_difference(pairs, events.filter(F.col("value") > 50).select("user_id", "event_type"))


@query
def sample_1pct(spark, sf_dir):
    return profile.sample_by_key(adapters.table(spark, sf_dir, "events"), "event_id").select("event_id", "event_type", "value")


@query
def schema_rows(spark, sf_dir):
    return profile.describe_schema(adapters.table(spark, sf_dir, "customer")).select("name", "type", "nullable")


@query
def missing_by_column(spark, sf_dir):
    measured = adapters.readings(spark, sf_dir).select("city", "temperature", "windspeed", "humidity")
    return profile.missing_by_column(measured)


@query
def clean_count(spark, sf_dir):
    return profile.rows_after_cleaning(adapters.measurements(spark, sf_dir), ["temperature", "windspeed"])


@query
def parse_times(spark, sf_dir):
    orders = adapters.table(spark, sf_dir, "orders")
    written = {
        "not_a_time": parse_time("o_orderpriority"),
        "minute_form": parse_time(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")),
        # An instant: shown as UTC wall-clock time whatever the session zone is.
        "zulu_form": local_to_utc(
            parse_time(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.current_timezone()
        ),
        "ride_form": parse_time(F.date_format("o_orderdate", RIDE_TIME_FORMAT), RIDE_TIME_FORMAT),
    }
    return orders.select(
        "o_orderkey", *[column.cast("timestamp_ntz").alias(name) for name, column in written.items()]
    )


@query
def default_values(spark, sf_dir):
    places = adapters.candidates(spark, sf_dir)
    return places.select(
        "name",
        or_default("country_code", "").alias("country_code"),
        or_default("population", 0).alias("population"),
    )


# --- climate ----------------------------------------------------------------------------


@query
def date_parts(spark, sf_dir):
    parts = climate.with_date_parts(adapters.climate(spark, sf_dir))
    return parts.groupBy("year", "month", "day", "is_hot").agg(F.count("*").alias("n"))


@query
def climate_clean_count(spark, sf_dir):
    return profile.row_count(climate.clean_climate(adapters.climate(spark, sf_dir)))


@query
def first_parsed_days(spark, sf_dir):
    parts = climate.with_date_parts(adapters.climate(spark, sf_dir))
    order = ["date", "station", "temperature", "precipitation"]
    return parts.select(*order, "year").orderBy(*order).limit(5)


@query
def years_stations(spark, sf_dir):
    return climate.years_and_stations(adapters.climate(spark, sf_dir))


@query
def stations_of_periods(spark, sf_dir):
    """Stations of each period of three years, and whether the estimate from yearly sketches is within five percent."""
    table = adapters.climate(spark, sf_dir)
    first = (F.floor(F.year("date") / 3) * 3).cast("int").alias("first_year")
    exact = table.groupBy(first).agg(F.count_distinct("station").alias("n_stations"))
    estimated = climate.stations_of_periods(climate.station_sketches(table), 3)
    both = exact.join(estimated.withColumnRenamed("n_stations", "estimate"), "first_year", "left")
    close = F.abs(F.col("estimate") - F.col("n_stations")) <= 0.05 * F.col("n_stations")
    return both.select("first_year", "n_stations", F.coalesce(close, F.lit(False)).alias("within_error"))


@query
def hot_day_total(spark, sf_dir):
    return climate.hot_days(adapters.climate(spark, sf_dir))


@query
def hot_days_by_year(spark, sf_dir):
    return climate.hot_days_by_year(adapters.climate(spark, sf_dir))


@query
def mean_by_year(spark, sf_dir):
    return rounded(climate.mean_temperature_by_year(adapters.climate(spark, sf_dir)), "avg_temperature")


@query
def mean_one_year(spark, sf_dir):
    return rounded(climate.mean_temperature_of(adapters.climate(spark, sf_dir), CHOSEN_YEAR), "avg_temperature")


@query
def top5_stations(spark, sf_dir):
    top = climate.hottest_stations(adapters.climate(spark, sf_dir), adapters.stations(spark, sf_dir))
    return rounded(top, "avg_temperature")


@query
def coldest_year(spark, sf_dir):
    return rounded(climate.coldest_year(adapters.climate(spark, sf_dir)), "avg_temperature")


@query
def coldest_year_sql(spark, sf_dir):
    return rounded(climate.coldest_year_sql(adapters.climate(spark, sf_dir)), "avg_temperature")


@query
def busiest_station(spark, sf_dir):
    return climate.busiest_station(adapters.climate(spark, sf_dir))


@query
def busiest_station_sql(spark, sf_dir):
    return climate.busiest_station_sql(adapters.climate(spark, sf_dir))


@query
def precip_series(spark, sf_dir):
    series = climate.precipitation_series(adapters.climate(spark, sf_dir))
    return rounded(series, "total_precipitation", "avg_precipitation", decimals=2)


@query
def precip_trend_world(spark, sf_dir):
    trend = climate.precipitation_trend_world(adapters.climate(spark, sf_dir), TREND_YEARS)
    return rounded(trend, "total_precipitation", "avg_precipitation", decimals=2)


@query
def precip_trend_country(spark, sf_dir):
    trend = climate.precipitation_trend_country(
        adapters.climate(spark, sf_dir), adapters.stations(spark, sf_dir), TREND_COUNTRY, TREND_YEARS
    )
    return rounded(trend, "total_precipitation", "avg_precipitation", decimals=2)


@query
def precip_slope_world(spark, sf_dir):
    return rounded(climate.precipitation_slope_world(adapters.climate(spark, sf_dir)), "slope", "r2", decimals=4)


@query
def precip_slope_by_country(spark, sf_dir):
    slopes = climate.precipitation_slope_by_country(adapters.climate(spark, sf_dir), adapters.stations(spark, sf_dir))
    return rounded(slopes, "slope", "r2", decimals=4)


@query
def temp_pct_by_year(spark, sf_dir):
    compared = climate.temperature_vs_world_by_year(adapters.climate(spark, sf_dir))
    return rounded(compared, "avg_temperature", "pct_vs_world")


@query
def temp_pct_by_country(spark, sf_dir):
    compared = climate.temperature_vs_world_by_country(
        adapters.climate(spark, sf_dir), adapters.stations(spark, sf_dir)
    )
    return rounded(compared, "avg_temperature", "pct_vs_world")
