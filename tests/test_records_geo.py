from __future__ import annotations

import datetime as dt
import json

from helpers import bag, plan_text, tuples

from pyspark.sql import functions as F
from weatherlake import schemas
from weatherlake.operators import geo, records


def _day(n):
    return dt.date(2025, 1, n)


def _daily(spark, rows):
    return spark.createDataFrame(
        [(city, country, code, 1.0, 2.0, _day(day), *values) for city, country, code, day, values in rows],
        schemas.DAILY,
    )


def test_records_use_the_full_city_key_and_the_earliest_day(spark):
    daily = _daily(
        spark,
        [
            ("Paris", "France", "FR", 1, (5.0, 1.0, 7.0, 0.5)),
            ("Paris", "France", "FR", 2, (5.0, -3.0, 7.0, 2.0)),
            ("Paris", "United States", "US", 1, (9.0, 0.0, 3.0, 0.0)),
            ("Paris", "United States", "US", 2, (5.0, -9.0, 4.0, 1.0)),
            ("Paris", "France", "FR", 3, (99.0, None, 99.0, 99.0)),
        ],
    )
    found = records.climate_records(daily).select(
        "country", "hottest_temp", "hottest_day", "coldest_temp", "coldest_day", "strongest_wind", "windiest_day",
        "max_daily_precipitation", "total_precipitation",
    )
    assert bag(found) == [
        ("France", 5.0, _day(1), -3.0, _day(2), 7.0, _day(1), 2.0, 2.5),
        ("United States", 9.0, _day(1), -9.0, _day(2), 4.0, _day(2), 1.0, 1.0),
    ]
    joined = records.climate_records_by_join(daily)
    assert bag(records.climate_records(daily).select(*joined.columns)) == bag(joined)
    assert len(set(joined.columns)) == len(joined.columns)


def test_records_shuffle_once(spark):
    daily = _daily(spark, [("a", "b", "c", 1, (1.0, 1.0, 1.0, 1.0))])
    assert plan_text(records.climate_records(daily)).count("Exchange hashpartitioning") == 1


def _document(times, high, rain, city="Lyon"):
    daily = (times, high, [0.0] * 9, None, [1.0] * 9, None, rain, None, None, None)
    place = (city, "France", "FR", 9.0, 9.0, "Rhone")
    return (place, (1.0, 2.0, 3.0, "UTC", daily), None)


def test_explode_history_follows_time(spark):
    documents = spark.createDataFrame(
        [
            _document(["2025-01-01", "2025-01-02", "bad"], [1.0, None], [1.0, 2.0, 3.0, 4.0]),
            _document(None, [1.0], [1.0], city="Empty"),
        ],
        schemas.HISTORY_DOCUMENT,
    )
    rows = tuples(records.explode_history(documents).select("city", "latitude", "date", "temp_max", "precipitation"))
    assert rows == [
        ("Lyon", 1.0, _day(1), 1.0, 1.0), ("Lyon", 1.0, _day(2), None, 2.0), ("Lyon", 1.0, None, None, 3.0),
    ]
    assert bag(records.days_in_history(documents)) == [("Empty", "France", 0), ("Lyon", "France", 3)]


def test_documents_and_messages(spark):
    daily = _daily(spark, [("Paris", "France", "FR", 1, (5.0, 1.0, 7.0, 0.5))])
    found = records.climate_records(daily)
    document = json.loads(records.record_documents(found).toJSON().first())
    assert document["records"] == {
        "hottest_day": {"date": "2025-01-01", "temperature": 5.0},
        "coldest_day": {"date": "2025-01-01", "temperature": 1.0},
        "windiest_day": {"date": "2025-01-01", "windspeed": 7.0},
        "precipitation": {"max_daily": 0.5, "total_period": 0.5},
    }
    message = json.loads(records.record_messages(found).toJSON().first())
    assert message["records"]["precipitation"] == {"max_daily": 0.5}
    assert "computed_at" in records.stamp_computed(records.record_documents(found)).columns


def test_first_row_per_key(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 3, None)], "k string, n int, v string")
    assert bag(records.first_row_per_key(rows, ["k"], ["n"])) == [("a", 1, "x"), ("b", 3, None)]


def _candidates(spark, rows):
    return spark.createDataFrame(
        [(city, country, position, name, found, code, None, None, 1.0, 2.0, people)
         for city, country, position, name, found, code, people in rows],
        schemas.CANDIDATE,
    )


def test_city_resolution(spark):
    candidates = _candidates(
        spark,
        [
            ("Paris", "france", 0, "Paris TX", "United States", "US", 10),
            ("Paris", "france", 1, "Paris", "France", None, None),
            ("Paris", "france", 2, "Paris 2", "France", "FR", 5),
            ("Rome", "Atlantis", 1, "Rome NY", "United States", "US", 3),
            ("Rome", "Atlantis", 0, "Roma", "Italy", "IT", 4),
        ],
    )
    requests = spark.createDataFrame(
        [(1, "Paris", "france"), (2, "Rome", "Atlantis"), (3, "Nowhere", "X"), (4, "Paris", "france")],
        "request_id int, requested_city string, requested_country string",
    )
    resolved = geo.resolve_requests(requests, candidates)
    assert bag(resolved.select("request_id", "city", "country_code", "population", "admin1", "timezone")) == [
        (1, "Paris", "", 0, "", ""), (2, "Roma", "IT", 4, "", ""), (4, "Paris", "", 0, "", ""),
    ]
    readings = spark.createDataFrame(
        [(7, "Rome", "Atlantis", 40.0), (8, "Nowhere", "X", 50.0)],
        "event_id int, requested_city string, requested_country string, latitude double",
    )
    enriched = geo.enrich_readings(readings, geo.resolve_cities(candidates), geo.REQUEST)
    assert tuples(enriched.select("event_id", "latitude", "city", "region", "population")) == [(7, 40.0, "Roma", "", 4)]


def test_messages(spark):
    nested = spark.createDataFrame(
        [
            (1.0, 2.0, "UTC", 3.0, ("2025-01-01T10:00", 1.0, 2.0, 3.0, 4.0, 5.0), None, None),
            (1.0, None, "UTC", 3.0, ("2025-01-01T10:00", 1.0, 2.0, 3.0, 4.0, 5.0), None, None),
            (1.0, 2.0, "UTC", 3.0, None, None, None),
        ],
        schemas.READING,
    )
    complete, incomplete = geo.basic_messages(nested)
    assert (complete.count(), incomplete.count()) == (1, 2)
    assert geo.stamp_message(complete).first().fetched_at == "2025-01-01T10:00"
    history = geo.history_messages(spark.createDataFrame([_document(["2025-01-01"], [1.0], [1.0])], schemas.HISTORY_DOCUMENT))
    assert tuples(history.select("city", "region", "latitude")) == [("Lyon", "Rhone", 1.0)]


def test_requests_without_a_country_get_the_first_candidate(spark):
    requests = spark.createDataFrame([(1, "Lyon", None), (2, "Lyon", "france")], "request_id long, requested_city string, requested_country string")
    rows = [(c, w, i, n, n) for w in (None, "france") for i, (c, n) in enumerate((("Lyon", "Chad"), ("Lyon", "France")))]
    candidates = spark.createDataFrame(rows, "requested_city string, requested_country string, position int, name string, country string")
    for name in ("country_code", "admin1", "timezone"):
        candidates = candidates.withColumn(name, F.lit(None).cast("string"))
    for name in ("latitude", "longitude", "population"):
        candidates = candidates.withColumn(name, F.lit(None).cast("long"))
    found = {row.request_id: row.country for row in geo.resolve_requests(requests, candidates).collect()}
    assert found == {1: "Chad", 2: "France"}
