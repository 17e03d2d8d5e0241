"""Properties of the plans that matter at scale."""

from __future__ import annotations

import pytest
from helpers import bag, plan_text

from pyspark.sql import functions as F
from weatherlake.operators import geo, records, reports, windows
from weatherlake.plans import adapters
from weatherlake.plans.queries import QUERIES
from weatherlake.sinks.files import PLACE_FOLDERS

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_DIR))
    assert [operator for operator in FORBIDDEN if operator in plan] == []


@pytest.fixture
def settings(spark):
    """Change SQL settings for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            key = "spark.sql." + key.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "build",
    [
        lambda df: windows.sliding_aggregates(df),
        lambda df: reports.alerts_per_city(df),
        lambda df: reports.alert_level_counts(df),
        lambda df: reports.top_weathercode_by_country(df),
        lambda df: records.first_row_per_key(df, ["city"], ["event_id"]),
    ],
)
def test_groups_are_combined_before_the_shuffle(spark, build):
    """The operator right under the first exchange is a partial aggregate."""
    lines = plan_text(build(adapters.classified(spark, SF_DIR))).splitlines()
    # The deepest shuffle is the one that reads the table.
    last = max(i for i, line in enumerate(lines) if "- Exchange" in line)
    assert "partial_" in lines[last + 1]


def test_hot_key_of_a_shuffled_join_is_split(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    key = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    readings = spark.range(60_000).repartition(6).select(key.alias("request"), F.col("id").alias("event_id"))
    places = readings.select("request").distinct().select(
        "request", F.lit("c").alias("city"), F.lit("l").alias("country"), F.lit("x").alias("country_code"),
        F.lit("r").alias("admin1"), F.lit(1).alias("population"),
    )
    enriched = geo.enrich_readings(readings, places, ["request"])
    assert enriched.count() == 60_000
    enriched.collect()
    assert "skew=true" in enriched._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["sliding_agg", "climate_records", "enrich_readings", "top5_stations", "trip_numbers"])
def test_results_do_not_depend_on_the_join_strategy(spark, settings, name):
    expected = bag(QUERIES[name](spark, SF_DIR))
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    assert bag(QUERIES[name](spark, SF_DIR)) == expected


def test_place_writes_are_rebalanced(spark):
    frame = spark.createDataFrame([("a", "b")], "country_path string, city_path string")
    plan = frame.hint("rebalance", *PLACE_FOLDERS)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_text(QUERIES["hot_days_by_year"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
