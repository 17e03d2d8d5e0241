from __future__ import annotations

import json
import os

import pytest
from helpers import bag, plan_text, tuples

from pyspark.sql import functions as F
from weatherlake import schemas
from weatherlake.operators import records
from weatherlake.plans import adapters
from weatherlake.sinks import files as sinks, topics as topic_sinks
from weatherlake.sources import files as sources

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def cities(spark):
    return spark.createDataFrame([(1, "F", 3.5), (2, "M", 4.0)], "id int, sexe string, age double")


def test_csv_round_trips(spark, cities, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(cities, path)
    assert sources.read_csv(spark, path).dtypes == [("id", "string"), ("sexe", "string"), ("age", "string")]
    assert bag(sources.read_csv(spark, path, infer=True)) == bag(cities)
    assert bag(sources.read_csv(spark, f"{path}/*.csv", schema=cities.schema)) == bag(cities)
    raw = sources.read_csv(spark, path, header=False)
    assert raw.columns == ["_c0", "_c1", "_c2"]
    assert ("id", "sexe", "age") in tuples(raw)


def test_single_file_csv_overwrites(spark, cities, tmp_path):
    path = str(tmp_path / "one")
    for _ in range(2):
        sinks.write_csv(cities.repartition(4), path, mode="overwrite", single_file=True)
    assert len([name for name in os.listdir(path) if name.endswith(".csv")]) == 1
    assert sources.read_csv(spark, path).count() == 2


def test_csv_in_year_folders(spark, cities, tmp_path):
    for year in (2019, 2020):
        sinks.write_csv(cities, str(tmp_path / "gsod" / str(year)))
    assert sources.read_csv(spark, str(tmp_path / "gsod"), recursive=True).count() == 4


def test_json_and_parquet_round_trips(spark, cities, tmp_path):
    sinks.write_json(cities, str(tmp_path / "json"))
    sinks.write_parquet(cities, str(tmp_path / "parquet"))
    assert bag(sources.read_json(spark, str(tmp_path / "json"), cities.schema)) == bag(cities)
    assert bag(sources.read_json(spark, str(tmp_path / "json")).select("id", "sexe", "age")) == bag(cities)
    assert bag(sources.read_parquet(spark, str(tmp_path / "parquet"))) == bag(cities)


def _document(city="Lyon"):
    return {
        "geocode_info": {"city": city, "country": "France", "country_code": "FR", "admin1": "Rhone"},
        "historical_data": {
            "latitude": 1.0, "longitude": 2.0, "timezone": "UTC", "elevation": 3.0,
            "daily": {"time": ["2025-01-01", "2025-01-02"], "temperature_2m_max": [1, 2.5], "precipitation_sum": [0.5]},
        },
        "downloaded_at": "2025-01-03",
    }


def test_history_files(spark, tmp_path):
    def put(folder, text):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "weather_history_raw.json").write_text(text)

    put("France/Lyon", json.dumps(_document(), indent=2))
    put("France/Paris", json.dumps(_document("Paris"), indent=2))
    put("France/Broken", '{"geocode_info": {')
    put("France/Partial", json.dumps({"geocode_info": {"city": "x"}}))
    (tmp_path / "France" / "other.json").write_text("{}")
    good, bad = sources.read_history(spark, str(tmp_path))
    assert bag(good.select("geocode_info.city")) == [("Lyon",), ("Paris",)]
    assert sorted(row.file.split("/")[-2] for row in bad.collect()) == ["Broken", "Partial"]
    days = records.explode_history(good)
    assert days.columns == schemas.DAILY.fieldNames()
    assert [row.precipitation for row in days.filter("city = 'Lyon'").orderBy("date").collect()] == [0.5, None]


def test_history_store_replaces_only_the_cities_it_gets(spark, tmp_path):
    path = str(tmp_path / "store")
    documents = adapters.history_documents(spark, SF_DIR)
    sinks.write_history(documents, path)
    sinks.write_history(documents.filter("geocode_info.city = 'NATION_3'"), path)
    stored, bad = sources.read_history(spark, path)
    assert bad.count() == 0
    assert stored.count() == documents.count()
    columns = schemas.DAILY.fieldNames()
    assert bag(records.explode_history(stored).select(columns)) == bag(records.explode_history(documents).select(columns))


CLASHING = ["A/B", "A B", "A_B", "A_ B", "", "Unknown", None]


def test_cities_whose_folders_clash_do_not_replace_each_other(spark, tmp_path):
    """Space, slash and underscore look alike in a folder name, as do an empty and an unknown one."""
    days = [(city, "X", "XX", float(i), 0.0, "2025-01-01", 1.0 + i, 0.0, 1.0, 0.0) for i, city in enumerate(CLASHING)]
    daily = spark.createDataFrame(days, "city string, country string, country_code string, latitude double, longitude double, "
                                        "date string, temp_max double, temp_min double, wind_max double, precipitation double")
    found = records.record_documents(records.climate_records(daily.withColumn("date", F.col("date").cast("date"))))
    path = str(tmp_path / "records")
    sinks.write_records(found, path)
    sinks.write_records(found.filter("city = 'A_B'"), path)
    stored = spark.read.json(path)
    assert sorted(str(row.city) for row in stored.collect()) == sorted(map(str, CLASHING))
    # The same name elsewhere is another city; the city itself is replaced.
    sinks.write_records(found.filter("city = 'A_B'").withColumn("latitude", F.lit(50.0)), path)
    sinks.write_records(found.filter("city = 'A_B'").withColumn("records", F.col("records").withField("hottest_day.temperature", F.lit(99.0))), path)
    rows = spark.read.json(path).filter("city = 'A_B'").select("latitude", "records.hottest_day.temperature")
    assert bag(rows) == [(2.0, 99.0), (50.0, 3.0)]


def test_clashing_history_documents(spark, tmp_path):
    path = str(tmp_path / "history")
    texts = [json.dumps(_document(city) | {"n": 1}) for city in CLASHING if city is not None]
    (tmp_path / "in").mkdir()
    for i, text in enumerate(texts):
        (tmp_path / "in" / str(i)).mkdir()
        (tmp_path / "in" / str(i) / "weather_history_raw.json").write_text(text)
    documents, _ = sources.read_history(spark, str(tmp_path / "in"))
    sinks.write_history(documents, path)
    sinks.write_history(documents.filter("geocode_info.city = 'A_B'"), path)
    stored, bad = sources.read_history(spark, path)
    assert sorted(row.geocode_info.city for row in stored.collect()) == sorted(city for city in CLASHING if city is not None)
    assert bad.count() == 0
    # Two documents of one city in one write: the one downloaded last stays.
    older = documents.filter("geocode_info.city = 'A B'").withColumn("downloaded_at", F.lit("2020")).withColumn(
        "historical_data", F.col("historical_data").withField("latitude", F.lit(7.0)))
    newer = older.withColumn("downloaded_at", F.lit("2021")).withColumn("historical_data", F.col("historical_data").withField("latitude", F.lit(8.0)))
    sinks.write_history(newer.unionByName(older), path)
    again, _ = sources.read_history(spark, path)
    assert [row.historical_data.latitude for row in again.filter("geocode_info.city = 'A B'").collect()] == [8.0]


def test_record_store(spark, tmp_path):
    path = str(tmp_path / "records")
    documents = records.record_documents(records.climate_records(adapters.daily(spark, SF_DIR)))
    sinks.write_records(documents, path)
    sinks.write_records(documents.limit(1), path)
    stored = spark.read.json(path)
    assert stored.count() == documents.count()
    assert stored.filter("computed_at is null or records.precipitation.total_period is null").count() == 0


def test_alert_store(spark, tmp_path):
    path = str(tmp_path / "alerts")
    classified = adapters.partly_named(spark, SF_DIR)
    sinks.append_alerts(classified, path)
    everything = sources.read_alerts(spark, path)
    n = everything.count()
    assert n == classified.filter("wind_alert_level != 'level_0' or heat_alert_level != 'level_0'").count()
    one = sources.read_alerts(spark, path, "AFRICA", "NATION_5")
    assert 0 < one.count() < n
    assert {(row.country, row.city) for row in one.collect()} == {("AFRICA", "NATION_5")}
    assert "PartitionFilters: [isnotnull" in plan_text(one)
    assert everything.filter("datetime is null or saved_at is null").count() == 0
    # One name alone selects nothing in particular.
    assert sources.read_alerts(spark, path, country="AFRICA").count() == n
    sinks.append_alerts(classified, path)
    assert sources.read_alerts(spark, path).count() == 2 * n


def test_stored_alert_times_and_blank_lines(spark, tmp_path):
    folder = tmp_path / "country_path=France" / "city_path=Le_Mans"
    folder.mkdir(parents=True)
    line = '{"country": "France", "city": "Le Mans", "event_time": "%s"}'
    (folder / "alerts.json").write_text("\n".join([line % "2025-01-01T10:00:00Z", "", line % "soon", "  "]) + "\n")
    alerts = sources.read_alerts(spark, str(tmp_path), "France", "Le Mans")
    assert sorted(str(row.datetime) for row in alerts.collect()) == ["2025-01-01 10:00:00", "None"]


def test_small_pandas_refuses_large_tables(spark):
    assert len(sinks.to_small_pandas(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        sinks.to_small_pandas(spark.range(6), 5)


def test_keyed_messages(spark):
    documents = records.record_messages(records.climate_records(adapters.daily(spark, SF_DIR)))
    message = topic_sinks.keyed_messages(documents).filter("key = 'AF_NATION_0'").first()
    assert json.loads(message.value)["city"] == "NATION_0"


def test_alert_lines_that_are_none(spark, tmp_path):
    """Broken lines are kept apart, and names that share a folder are told apart."""
    folder = tmp_path / "country_path=A_B" / "city_path=C"
    folder.mkdir(parents=True)
    lines = ['{"country": "A B", "city": "C", "event_time": "2025-01-01T10:00"}', '{"country": "A/B", "city": "C"}', "{broken", ""]
    (folder / "part-0.json").write_text("\n".join(lines) + "\n")
    root = str(tmp_path)
    assert sorted(row.country for row in sources.read_alerts(spark, root).collect()) == ["A B", "A/B"]
    assert [row.country for row in sources.read_alerts(spark, root, "A/B", "C").collect()] == ["A/B"]
    assert [row.text for row in sources.unreadable_alerts(spark, root).collect()] == ["{broken"]


def test_both_history_layouts(spark, tmp_path):
    """One scan reads downloads and stored documents; files of others are neither read nor reported."""
    place = {"city": "Lyon", "country": "France", "country_code": "FR"}
    document = {"geocode_info": place, "historical_data": {"latitude": 1.0, "daily": {"time": ["2025-01-01"]}}}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "weather_history_raw.json").write_text(json.dumps(document, indent=1))
    good, _ = sources.read_history(spark, str(tmp_path))
    sinks.write_history(good.withColumn("geocode_info", good.geocode_info.withField("city", F.lit("Nice"))), str(tmp_path / "store"))
    broken = tmp_path / "store" / "country_path=France" / "city_path=Metz" / "place=0123456789abcdef"
    broken.mkdir(parents=True)
    (broken / "part-broken.json").write_text("{oops\n")
    (tmp_path / "raw" / "part-00000.csv").write_text("a,b\n")
    documents, bad = sources.read_history(spark, str(tmp_path))
    assert sorted(row.geocode_info.city for row in documents.collect()) == ["Lyon", "Nice"]
    assert [row.text for row in bad.collect()] == ["{oops\n"]
    assert plan_text(documents).count("FileScan") == 1
