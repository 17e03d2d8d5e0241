from __future__ import annotations

import datetime as dt

from helpers import plan_text, tuples

from pyspark.sql import functions as F
from weatherlake import schemas
from weatherlake.constants import RIDE_TIME_FORMAT
from weatherlake.functions import codec
from weatherlake.functions.times import in_history_period, local_to_utc, minutes_between, parse_time
from weatherlake.sources.topics import topic_options, topic_tail

SCHEMA = schemas.struct("a long, b string")


def _messages(spark):
    return spark.createDataFrame(
        [('{"a": 1, "b": "x"}',), ('{"a": 2}',), ("{oops",), (None,)], "value string"
    ).withColumn("value", F.col("value").cast("binary"))


def test_decode_gives_nulls_for_bad_text(spark):
    expected = [(1, "x"), (2, None), (None, None), (None, None)]
    assert tuples(codec.decode_json(_messages(spark), SCHEMA)) == expected
    assert tuples(codec.decode_json_sql(_messages(spark), SCHEMA)) == expected


def test_rejects_are_kept_apart(spark):
    decoded = codec.decode_with_rejects(_messages(spark), SCHEMA)
    assert decoded.columns == ["a", "b", schemas.CORRUPT_COLUMN]
    assert tuples(codec.accepted(decoded)) == [(1, "x"), (2, None)]
    assert tuples(codec.rejected(decoded)) == [("{oops",), ("",)]
    blank = spark.createDataFrame([(" ",), ('{"a": "text"}',)], "value string")
    decoded = codec.decode_with_rejects(blank, SCHEMA)
    assert tuples(codec.rejected(decoded)) == [(" ",)]
    assert tuples(codec.accepted(decoded)) == [(None, None)]  # a misfit field is NULL, the message stays


def test_filtered_messages_are_parsed_once(spark):
    decoded = codec.decode_with_rejects(_messages(spark), SCHEMA)
    assert plan_text(codec.accepted(decoded).filter("a > 1")).count("from_json(") == 1


def test_encode_leaves_out_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, "y")], "a long, b string")
    expected = ['{"a":1}', '{"a":2,"b":"y"}']
    assert [row.value for row in codec.encode_json(rows).collect()] == expected
    assert [row.value for row in codec.encode_json_sql(rows).collect()] == expected
    keyed = codec.encode_json(rows, F.col("a").cast("string"))
    assert tuples(keyed) == [("1", expected[0]), ("2", expected[1])]


def test_weathercode_survives_a_decimal_point(spark):
    text = '{"current": {"weathercode": 3.0}}'
    decoded = codec.decode_json(spark.createDataFrame([(text,)], "value string"), schemas.READING)
    assert decoded.select("current.weathercode").first()[0] == 3.0


def test_parse_time_never_fails(spark):
    texts = spark.createDataFrame(
        [("2025-01-01T10:15",), ("2025-01-01T10:15:30Z",), ("soon",), (None,)], "t string"
    )
    assert [row[0] for row in texts.select(parse_time("t")).collect()] == [
        dt.datetime(2025, 1, 1, 10, 15), dt.datetime(2025, 1, 1, 10, 15, 30), None, None,
    ]
    rides = spark.createDataFrame([("2025-01-01 10:15:30",), ("2025-01-01",)], "t string")
    parsed = [row[0] for row in rides.select(parse_time("t", RIDE_TIME_FORMAT)).collect()]
    assert parsed == [dt.datetime(2025, 1, 1, 10, 15, 30), None]


def test_local_time_to_utc(spark):
    row = spark.createDataFrame([("2025-07-01T12:00", "Europe/Paris")], "t string, zone string")
    assert row.select(local_to_utc(parse_time("t"), "zone")).first()[0] == dt.datetime(2025, 7, 1, 10)


def test_minutes_between_counts_whole_seconds(spark):
    times = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 0, 0, 0, 900000), dt.datetime(2025, 1, 1, 0, 1, 30, 100000))],
        "a timestamp, b timestamp",
    )
    assert times.select(minutes_between("a", "b")).first()[0] == 1.5


def test_history_period(spark):
    end = dt.date(2025, 1, 1)
    days = spark.createDataFrame(
        [(end,), (end - dt.timedelta(days=3650),), (end - dt.timedelta(days=3651),), (end + dt.timedelta(days=1),)],
        "date date",
    )
    inside = in_history_period("date", F.lit(end))
    assert [row[0] for row in days.select(inside).collect()] == [True, True, False, False]


def test_topic_tail(spark):
    messages = spark.createDataFrame(
        [("t", 0, 5, "k", '{"b": [1, 2],  "a": null}'), ("t", 1, 6, None, "not json")],
        "topic string, partition int, offset long, key string, value string",
    )
    assert tuples(topic_tail(messages)) == [("t", 0, 5, "k", '{"a":null,"b":[1,2]}'), ("t", 1, 6, None, None)]


def test_topic_options():
    assert topic_options("h:1", "t", "latest", max_per_trigger=10) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10",
    }
    assert topic_options("h:1", "t", "earliest", ending="latest")["endingOffsets"] == "latest"
