from __future__ import annotations

import datetime as dt

import pytest
from helpers import bag, tuples

from pyspark.sql import functions as F
from weatherlake.operators import alerts, reports, windows
from weatherlake.plans import adapters

SF_DIR = "/root/testdata/sf0.001"
T0 = dt.datetime(2025, 1, 1, 10, 0)
COLUMNS = "latitude double, longitude double, event_time string, temperature double, windspeed double, weathercode int, humidity double"


def _readings(spark, rows):
    return alerts.with_alert_levels(spark.createDataFrame(rows, COLUMNS))


def test_sliding_windows_cover_each_reading_five_times(spark):
    readings = _readings(spark, [(1.0, 2.0, "2025-01-01T10:00", 30.0, 25.0, 3, 50.0)])
    rows = windows.sliding_aggregates(readings).orderBy("window_start").collect()
    assert [row.window_start for row in rows] == [T0 - dt.timedelta(minutes=m) for m in (4, 3, 2, 1, 0)]
    assert all(row.window_end - row.window_start == dt.timedelta(minutes=5) for row in rows)
    assert {(r.wind_level2_count, r.heat_level1_count, r.total_wind_alerts, r.weather_reports) for r in rows} == {
        (1, 1, 1, 1)
    }
    assert tuple(rows[0].asDict()) == windows.AGGREGATE_COLUMNS


def test_untimed_rows_leave_the_windows_and_nulls_stay_null(spark):
    readings = _readings(
        spark,
        [
            (1.0, 2.0, "later", 30.0, 25.0, 3, 50.0),
            (1.0, 2.0, None, 30.0, 25.0, 3, 50.0),
            (1.0, 2.0, "2025-01-01T10:00:30", None, None, None, None),
        ],
    )
    rows = windows.sliding_aggregates(readings).collect()
    assert len(rows) == 5
    assert {
        (r.avg_temperature, r.min_windspeed, r.avg_humidity, r.total_measurements, r.weather_reports, r.total_heat_alerts)
        for r in rows
    } == {(None, None, None, 1, 0, 0)}


@pytest.mark.parametrize(("window", "slide"), [("5 minutes", "1 minute"), ("10 minutes", "5 minutes"), ("1 hour", "1 hour"), ("5 minutes", "2 minutes")])
def test_panes_equal_direct_windows(spark, window, slide):
    readings = adapters.classified(spark, SF_DIR)
    rounded = ["avg_temperature", "avg_windspeed", "avg_humidity"]

    def rows(aggregates):
        return bag(aggregates.withColumns({name: F.round(name, 6) for name in rounded}))

    assert rows(windows.sliding_aggregates(readings, window, slide)) == rows(
        windows.sliding_aggregates_stream(readings, window, slide)
    )


def test_tumbling_counts_flags_and_true_flags(spark):
    flat = spark.createDataFrame(
        [
            ("2025-01-01T10:00:05", 10.0, True),
            ("2025-01-01T10:00:59", 20.0, False),
            ("2025-01-01T10:01:00", 30.0, None),
            (None, 99.0, True),
        ],
        "time string, temperature double, high_wind_alert boolean",
    )
    minute = dt.timedelta(minutes=1)
    assert bag(windows.tumbling_aggregates(flat)) == [
        (T0, T0 + minute, 15.0, 2, 1), (T0 + minute, T0 + 2 * minute, 30.0, 0, 0),
    ]


def test_level_counts_are_zero_filled(spark):
    stored = spark.createDataFrame(
        [("level_2", "unknown"), (None, "level_1")], "wind_alert_level string, heat_alert_level string"
    )
    assert tuples(reports.alert_level_counts(stored)) == [("level_0", 1, 0), ("level_1", 0, 1), ("level_2", 1, 0)]


def test_top_weathercode(spark):
    stored = spark.createDataFrame(
        [("FR", 3), ("FR", 3), ("FR", 1), ("DE", 5), ("DE", 2), (None, 7), ("IT", None)],
        "country string, weathercode int",
    )
    assert bag(reports.top_weathercode_by_country(stored)) == [("DE", 2, 1), ("FR", 3, 2), ("Unknown", 7, 1)]


def test_place_counts(spark):
    stored = spark.createDataFrame(
        [("FR", f"c{i}") for i in range(12)] + [("FR", "c3"), ("DE", None)], "country string, city string"
    )
    assert tuples(reports.records_per_country(stored)) == [("FR", 13), ("DE", 1)]
    top = tuples(reports.top_cities(stored))
    assert len(top) == 10
    assert top[:3] == [("c3", 2), ("Unknown", 1), ("c0", 1)]
    assert tuples(reports.place_totals(stored)) == [(2, 13)]
    assert tuples(reports.alerts_per_city(stored.filter("country = 'DE'"))) == [("DE", None, 1)]


def test_reading_stats_ignore_nulls(spark):
    readings = spark.createDataFrame([(1.0, None), (2.25, 4.0)], "temperature double, windspeed double")
    assert tuples(reports.reading_stats(readings)) == [(1.6, 1.0, 2.3, 4.0, 4.0, 4.0)]


def test_series_are_sorted(spark):
    stored = spark.createDataFrame(
        [("b", "X", 2, 5.0), ("a", "X", 3, 1.0), ("a", "X", 1, 9.0), ("a", "X", 1, 2.0), ("a", "X", 4, None)],
        "city string, country string, event_time int, temperature double",
    )
    assert tuples(reports.measure_series(stored, "temperature")) == [
        ("a, X", 1, 2.0), ("a, X", 1, 9.0), ("a, X", 3, 1.0), ("b, X", 2, 5.0),
    ]
