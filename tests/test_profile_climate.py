from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter

import pytest
from helpers import bag, plan_text, tuples

from pyspark.sql import functions as F
from weatherlake.operators import climate, profile


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles(spark, seed):
    rng = random.Random(seed)
    values = [7.0] * 400 + [rng.choice([rng.random() * 20, -0.5, 3.25, 1e300]) for _ in range(600)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(4)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    expected = {p: sorted(values)[max(1, math.ceil(p * len(values))) - 1] for p in probabilities}
    assert dict(tuples(profile.exact_quantiles(rows, "v", probabilities))) == expected
    assert dict(tuples(profile.approximate_quantiles(rows, "v", probabilities, 0.0))) == expected


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert profile.exact_quantiles(empty, "v", [0.5]).collect() == []
    assert profile.approximate_quantiles(empty, "v", [0.5], 0.1).collect() == []


def test_rank_errors(spark):
    rows = spark.range(5000).select((F.col("id") % 37).cast("double").alias("v"))
    assert all(row.within_error for row in profile.rank_errors(rows, "v", [0.1, 0.5, 1.0], 0.01).collect())


def test_quantile_rows_respect_the_error(spark):
    rows = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    for row in profile.quantile_rows(rows, "v", [0.25, 0.5, 0.75], [0.05, 0.01, 0.0]).collect():
        assert abs(row.quantile / 10_000 - row.probability) <= row.relative_error + 1e-3


def test_bag_difference(spark):
    left = spark.createDataFrame([("a", 1)] * 10 + [("b", 2)] * 3 + [(None, 3)] * 4 + [("d", 4)], "k string, n int")
    right = spark.createDataFrame([("a", 1)] * 2 + [("b", 2)] * 5 + [(None, 3)], "k string, n int")
    found = profile.bag_difference(left, right)
    assert bag(found) == bag(spark.createDataFrame([("a", 1)] * 8 + [(None, 3)] * 3 + [("d", 4)], "k string, n int"))


def test_sample_by_key_repeats(spark):
    rows = spark.range(20_000)
    first = bag(profile.sample_by_key(rows, "id", 2))
    assert first == bag(profile.sample_by_key(rows.repartition(7), "id", 2))
    assert 250 < len(first) < 550


def test_sample_and_its_complement(spark):
    rows = spark.range(5000).repartition(4)
    sample = profile.sample_rows(rows, 0.01, seed=3)
    n = sample.count()
    assert 10 < n < 120
    assert profile.bag_difference(rows, sample).count() == 5000 - n
    assert Counter(tuples(sample)) <= Counter(tuples(rows))


def test_union_join_concat_filter(spark):
    cities = spark.createDataFrame([(1, "F", 3.0), (2, "M", None)], "id long, sexe string, age double")
    assert profile.union_rows(cities, cities.select("age", "id", "sexe")).count() == 4
    assert profile.widen(cities, cities, "id").columns == ["id", "sexe", "age", "right_sexe", "right_age"]
    assert tuples(profile.with_concat(cities, "both", "id", "age").select("both")) == [("13.0",), (None,)]
    assert tuples(profile.in_category(cities, "sexe", "F").select("id")) == [(1,)]
    assert tuples(profile.describe_schema(cities).select("name", "type", "nullable").orderBy("position")) == [
        ("id", "bigint", True), ("sexe", "string", True), ("age", "double", True),
    ]


def test_statistics(spark):
    rows = spark.createDataFrame([("F", 1.0, 2.0), ("F", 3.0, 6.0), ("M", 5.0, 10.0)], "sexe string, a double, b double")
    assert bag(profile.group_stats(rows, "sexe", mean=["a"], largest=["b"])) == [("F", 2.0, 6.0), ("M", 5.0, 10.0)]
    assert tuples(profile.column_mean(rows, "a")) == [(3.0,)]
    corr, cov = profile.correlation(rows, "a", "b").first()
    assert (round(corr, 9), round(cov, 9)) == (1.0, 8.0)
    assert tuples(rows.describe("a"))[0] == ("count", "3")
    assert [row[0] for row in rows.summary("count", "max").collect()] == ["count", "max"]


def test_missing_values(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, b string")
    assert tuples(profile.missing_by_column(rows)) == [("b", 2), ("a", 1)]
    assert tuples(profile.rows_after_cleaning(rows, ["a"])) == [(2,)]


def _climate(spark):
    days = [
        ("s1", dt.date(2019, 5, 1), 30.0, 1.0), ("s1", dt.date(2020, 5, 1), 30.5, 2.0),
        ("s2", dt.date(2020, 6, 1), 10.0, 4.0), ("s2", dt.date(2021, 1, 1), None, 8.0),
        ("s2", None, 99.0, 1.0), ("s3", dt.date(2021, 2, 3), 20.0, None),
    ]
    table = spark.createDataFrame(days, "station string, date date, temperature double, precipitation double")
    stations = spark.createDataFrame([("s1", "France"), ("s2", "Spain"), ("s3", "France")], "station string, country string")
    return table, stations


def test_cleaning_and_parts(spark):
    table, _ = _climate(spark)
    clean = climate.clean_climate(table)
    assert clean.count() == 4
    parts = climate.with_date_parts(table).filter("station = 's1'").select("year", "month", "day", "is_hot")
    assert bag(parts) == [(2019, 5, 1, False), (2020, 5, 1, True)]
    assert tuples(climate.hot_days(clean)) == [(1,)]
    assert bag(climate.hot_days_by_year(clean)) == [(2019, 0), (2020, 1), (2021, 0)]
    assert tuples(climate.years_and_stations(clean)) == [(3, 3)]


def test_yearly_means(spark):
    clean = climate.clean_climate(_climate(spark)[0])
    assert bag(climate.mean_temperature_by_year(clean)) == [(2019, 30.0), (2020, 20.25), (2021, 20.0)]
    assert tuples(climate.mean_temperature_of(clean, 2020)) == [(2020, 20.25)]
    assert tuples(climate.coldest_year(clean)) == [(2021, 20.0)]
    assert tuples(climate.coldest_year_sql(clean)) == [(2021, 20.0)]
    assert tuples(climate.busiest_station(clean)) == [("s1", 2)]
    assert tuples(climate.busiest_station_sql(clean)) == [("s1", 2)]


def test_stations_and_countries(spark):
    table, stations = _climate(spark)
    dated = table.filter("date is not null")
    top = climate.hottest_stations(dated, stations, 2)
    assert bag(top) == [("s1", 30.25, "France"), ("s3", 20.0, "France")]
    trend = climate.precipitation_trend_country(dated, stations, "France", 2)
    assert bag(trend) == [("France", 2020, 2.0, 2.0), ("France", 2021, None, None)]
    assert bag(climate.precipitation_trend_world(dated, 1)) == [(2021, 8.0, 8.0)]
    percent = climate.temperature_vs_world_by_country(dated, stations)
    world = (30 + 30.5 + 10 + 20) / 4
    found = {row.country: row.pct_vs_world for row in percent.collect()}
    assert found["Spain"] == pytest.approx(100 * (10 - world) / world)
    by_year = {row.year: row.pct_vs_world for row in climate.temperature_vs_world_by_year(dated).collect()}
    assert by_year[2019] == pytest.approx(100 * (30 - world) / world)


def test_world_figures_count_stations_without_a_country(spark):
    days = [("s1", 2020, 10.0), ("s2", 2020, 20.0), ("s3", 2022, 90.0)]
    table = spark.createDataFrame([(s, dt.date(y, 1, 1), v, v) for s, y, v in days], "station string, date date, temperature double, precipitation double")
    stations = spark.createDataFrame([("s1", "France"), ("s2", "Spain")], "station string, country string")
    found = {row.country: row.pct_vs_world for row in climate.temperature_vs_world_by_country(table, stations).collect()}
    assert found == {"France": -75.0, "Spain": -50.0}
    assert climate.precipitation_trend_country(table, stations, "France", 2).collect() == []
    assert len(climate.precipitation_trend_country(table, stations, "France", 3).collect()) == 1


def test_a_world_mean_of_zero_gives_null(spark):
    table = spark.createDataFrame([("s1", dt.date(2020, 1, 1), -5.0), ("s2", dt.date(2021, 1, 1), 5.0)], "station string, date date, temperature double")
    assert bag(climate.temperature_vs_world_by_year(table).select("year", "pct_vs_world")) == [(2020, None), (2021, None)]


def test_top_stations_do_not_sort_everything(spark):
    table, stations = _climate(spark)
    assert "TakeOrderedAndProject" in plan_text(climate.hottest_stations(table, stations))


def test_one_year_filter_reaches_the_scan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "l_suppkey station", "l_shipdate date", "l_quantity temperature"
    )
    plan = plan_text(climate.mean_temperature_of(table, 1999))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_exact_quantiles_order_one_range_only(spark, monkeypatch):
    """All values are near the median here, so many ranges are cut and few values ordered."""
    monkeypatch.setattr(profile, "SKETCH_ACCURACY", 4)
    monkeypatch.setattr(profile, "NEAR_PARTS", 16)
    rng = random.Random(5)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [0.5] * 700 + [float("inf"), float("-inf")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    probabilities = [0.0, 0.1, 0.5, 0.66, 0.7, 0.9, 1.0]
    expected = {p: sorted(values)[max(1, math.ceil(p * len(values))) - 1] for p in probabilities}
    assert dict(tuples(profile.exact_quantiles(rows, "v", probabilities))) == expected


def test_merged_quantile_sketches(spark):
    """Sketches of the days, merged for any set of days, agree with the rows of those days."""
    rows = spark.range(30_000).select((F.col("id") % 3).alias("day"), (F.col("id") * 1.0).alias("v"))
    rows = rows.union(spark.createDataFrame([(0, None), (0, float("nan"))], "day long, v double"))
    sketches = profile.quantile_sketches(rows, "v", "day")
    whole = dict(tuples(profile.merged_quantiles(sketches, [0.1, 0.5, 0.9])))
    assert all(abs(q / 30_000 - p) < 0.01 for p, q in whole.items())
    two = profile.merged_quantiles(sketches.filter("day < 2"), [0.5])
    assert abs(two.first().quantile / 30_000 - 0.5) < 0.01
    assert profile.merged_quantiles(sketches, [0.5], "day").count() == 3
    nothing = spark.createDataFrame([], "day long, v double")
    assert profile.merged_quantiles(profile.quantile_sketches(nothing, "v", "day"), [0.5]).collect() == []


def test_merged_distinct_sketches_count_a_value_once(spark):
    rows = spark.range(4000).select((F.col("id") % 4).alias("day"), (F.col("id") % 1000).alias("station"))
    sketches = profile.distinct_sketches(rows.union(spark.createDataFrame([(9, None)], "day long, station long")), "station", "day")
    assert abs(profile.merged_distinct(sketches).first().n_distinct - 1000) < 60
    assert {r.n_distinct for r in profile.merged_distinct(sketches, "day").filter("day < 4").collect()} <= set(range(235, 266))
    assert profile.merged_distinct(sketches, "day").filter("day = 9").first().n_distinct == 0


def test_trend_is_the_least_squares_line(spark):
    points = [(2000, 1.0, "a"), (2001, 3.0, "a"), (2002, 5.0, "a"), (2003, None, "a"), (2000, 4.0, "b")]
    yearly = spark.createDataFrame(points, "year int, total double, country string")
    found = {row.country: row for row in climate.trend(yearly, "total", "country").collect()}
    assert (found["a"].slope, found["a"].r2, found["a"].n_years) == (2.0, 1.0, 3)
    assert (found["b"].slope, found["b"].n_years) == (None, 1)


def test_full_summary_has_every_column(spark):
    rows = spark.createDataFrame([(1, "b", 2.0, True), (3, "7", None, False)], "n int, t string, d double, f boolean")
    found = {row.summary: row for row in profile.full_summary(rows).collect()}
    assert list(found["count"][1:]) == ["2", "2", "1", "2"]
    assert (found["min"].t, found["max"].t, found["mean"].t, found["mean"].n) == ("7", "b", None, "2.0")
    assert found["max"].f == "true" and set(found) == {"count", "mean", "stddev", "min", "25%", "50%", "75%", "max"}


def test_series_arrays_hold_one_day_each(spark):
    from weatherlake.operators import reports

    rows = [("Paris", "France", t, v) for t, v in (("2025-01-01 10:00", 2.0), ("2025-01-01 09:00", 1.0), ("2025-01-02 00:00", 3.0), (None, 4.0), ("2025-01-02 01:00", None))]
    table = spark.createDataFrame(rows, "city string, country string, event_time string, temperature double")
    found = reports.series_arrays(table.withColumn("event_time", F.to_timestamp("event_time")), "temperature").orderBy("day").collect()
    assert [(r.label, str(r.day), [t.hour for t in r.times], r["values"]) for r in found] == [
        ("Paris, France", "2025-01-01", [9, 10], [1.0, 2.0]), ("Paris, France", "2025-01-02", [0], [3.0]),
    ]
