from __future__ import annotations

import pytest
from helpers import tuples

from pyspark.sql import functions as F
from weatherlake import schemas
from weatherlake.constants import LEVEL_2
from weatherlake.functions.levels import heat_level, is_alert, wind_level
from weatherlake.functions.text import coordinate_key, path_safe, place_key, place_label, truth
from weatherlake.operators import alerts

NAN = float("nan")


@pytest.mark.parametrize(
    ("wind", "closed", "half_open"),
    [
        (9.99, "level_0", "level_0"),
        (10.0, "level_1", "level_1"),
        (19.99, "level_1", "level_1"),
        (20.0, "level_1", "level_2"),
        (20.01, "level_2", "level_2"),
        (None, "unknown", "level_2"),
        (NAN, "level_2", "level_2"),
    ],
)
def test_wind_levels(spark, wind, closed, half_open):
    row = (
        spark.createDataFrame([(wind,)], "windspeed double")
        .select(wind_level().alias("a"), wind_level(closed="left", null_level=LEVEL_2).alias("b"))
        .first()
    )
    assert (row.a, row.b) == (closed, half_open)


@pytest.mark.parametrize(
    ("temperature", "level"),
    [(24.99, "level_0"), (25.0, "level_1"), (35.0, "level_1"), (35.01, "level_2"), (None, "unknown")],
)
def test_heat_levels(spark, temperature, level):
    row = spark.createDataFrame([(temperature,)], "temperature double").select(heat_level()).first()
    assert row[0] == level


def test_level_bounds_argument_is_checked():
    with pytest.raises(ValueError):
        wind_level(closed="right")


def test_classified_readings_have_the_declared_columns(spark):
    nested = spark.createDataFrame(
        [
            (48.85, 2.35, "Europe/Paris", 42.0, ("2025-01-01T10:15", 36.0, 21.0, 3.0, 50.0, 35.0), "t", "f"),
            (48.85, 2.35, "Europe/Paris", 42.0, None, "t", "f"),
        ],
        schemas.READING,
    )
    classified = alerts.classify_readings(nested)
    assert classified.columns == schemas.TRANSFORMED.fieldNames()
    first, second = classified.collect()
    assert (first.weathercode, first.wind_alert_level, first.heat_alert_level) == (3, LEVEL_2, LEVEL_2)
    assert (second.event_time, second.wind_alert_level, second.heat_alert_level) == (None, "unknown", "unknown")


def test_geography_is_carried_on_request(spark):
    nested = spark.createDataFrame([], schemas.ENRICHED_READING)
    assert set(alerts.classify_readings(nested, carry_geo=True).columns) == set(schemas.TRANSFORMED_GEO.fieldNames())


def test_flat_transform(spark):
    flat = spark.createDataFrame(
        [(100.0, 10.0), (None, 10.5), (0.0, None)], "temperature double, windspeed double"
    )
    rows = alerts.transform_flat(flat)
    assert tuples(rows.select("temp_f", "high_wind_alert")) == [(212.0, False), (None, True), (32.0, False)]
    assert alerts.high_wind_rows(rows).count() == 1


def test_high_wind_rows_skip_missing_flags(spark):
    flags = spark.createDataFrame([(True,), (False,), (None,)], "high_wind_alert boolean")
    assert tuples(alerts.high_wind_rows(flags)) == [(True,)]


def test_alert_predicate(spark):
    levels = spark.createDataFrame(
        [("level_0", "level_0"), ("level_1", "level_0"), ("unknown", "level_0"), (None, None), (None, "level_2")],
        "wind_alert_level string, heat_alert_level string",
    )
    assert [row[0] for row in levels.select(is_alert()).collect()] == [False, True, True, False, True]


def _classified(spark, rows):
    fields = (
        "country string, city string, latitude double, longitude double, event_time string, temperature double, "
        "windspeed double, wind_alert_level string, heat_alert_level string, weathercode int, humidity double"
    )
    return spark.createDataFrame(
        [(*row, "2025-01-01T10:15", 36.0, 21.0, "level_2", "level_2", 3, 50.0) for row in rows], fields
    )


def test_place_fallback_replaces_both_names(spark):
    stored = alerts.alerts_to_store(
        _classified(
            spark,
            [
                ("United States", "New York/NY", 1.5, 2.5),
                ("Unknown", "Paris", 48.85, 2.35),
                ("France", None, None, 2.0),
            ],
        )
    )
    assert tuples(stored.select("country", "city", "country_path", "city_path")) == [
        ("United States", "New York/NY", "United_States", "New_York_NY"),
        ("coord_48.85", "coord_2.35", "coord_48.85", "coord_2.35"),
        ("coord_0", "coord_2.0", "coord_0", "coord_2.0"),
    ]


def test_alerts_without_geography_columns(spark):
    classified = _classified(spark, [("x", "y", 1.0, 2.0)]).drop("country", "city")
    assert tuples(alerts.alerts_to_store(classified).select("country", "city")) == [("coord_1.0", "coord_2.0")]


def test_names_and_keys(spark):
    row = spark.createDataFrame(
        [("a b/c", "FR", "France", 1.5, -2.0)],
        "city string, country_code string, country string, latitude double, longitude double",
    ).select(path_safe("city"), place_key(), place_label(), coordinate_key())
    assert tuples(row) == [("a_b_c", "FR_a b/c", "a b/c, France", "1.5_-2.0")]
    missing = spark.createDataFrame([(None, None)], "city string, country string").select(place_label())
    assert tuples(missing) == [("Unknown, Unknown",)]


def test_truth_words(spark):
    words = spark.createDataFrame([("True",), ("true",), ("1",), ("False",), ("maybe",), (None,)], "w string")
    assert [row[0] for row in words.select(truth("w")).collect()] == [True, True, True, False, False, None]
    flags = spark.createDataFrame([(True,), (None,)], "w boolean")
    assert [row[0] for row in flags.select(truth("w")).collect()] == [True, None]


def test_incomplete_rows_are_kept_apart(spark):
    rows = spark.createDataFrame([(1.0, None), (None, "z"), (2.0, "z")], "latitude double, timezone string")
    complete, incomplete = alerts.required_fields_split(rows, ("latitude", "timezone"))
    assert (complete.count(), incomplete.count()) == (1, 2)


def test_classification_is_one_stage(spark):
    nested = spark.createDataFrame([], schemas.READING)
    from helpers import plan_text

    assert "Exchange" not in plan_text(alerts.classify_readings(nested).select(F.to_json(F.struct("*"))))
