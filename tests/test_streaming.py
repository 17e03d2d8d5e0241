from __future__ import annotations

import json
import os
import uuid

import pytest
from helpers import bag

from pyspark.sql import Observation, functions as F
from weatherlake import schemas
from weatherlake.functions.codec import decode_with_rejects, rejected
from weatherlake.operators import alerts, geo, windows
from weatherlake.plans import adapters
from weatherlake.session import checkpoint_root
from weatherlake.sinks import files as sinks
from weatherlake.sources import files as sources
from weatherlake.streaming import batches, jobs, metrics

SF_DIR = "/root/testdata/sf0.001"
AVERAGES = ("avg_temperature", "avg_windspeed", "avg_humidity")


def _name():
    return f"q_{uuid.uuid4().hex[:8]}"


def _finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def _put(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(message + "\n" for message in messages))


def _stream(spark, folder):
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))


def _reading(wind, temperature, time="2025-01-01T10:00", **extra):
    current = {"time": time, "windspeed_10m": wind, "temperature_2m": temperature, "weathercode": 3}
    return json.dumps({"latitude": 1.0, "longitude": 2.0, "timezone": "UTC", "elevation": 3.0, "current": current, **extra})


@pytest.fixture
def readings_folder(tmp_path):
    folder = tmp_path / "in"
    _put(folder, "a.txt", [_reading(25, 20), "{broken", _reading(5, 5)])
    _put(folder, "b.txt", [_reading(15, 40, city="Paris", country="France")])
    return folder


def _collect(spark, writer):
    name = _name()
    _finish(jobs.start(spark, writer.format("memory"), name, available_now=True))
    return spark.table(name)


def test_classification_stream(spark, readings_folder):
    classified = jobs.classified_stream(_stream(spark, readings_folder))
    rows = _collect(spark, classified.writeStream)
    assert rows.columns == schemas.TRANSFORMED.fieldNames()
    assert bag(rows.select("wind_alert_level", "heat_alert_level")) == [
        ("level_0", "level_0"), ("level_1", "level_2"), ("level_2", "level_0"),
    ]
    assert rows.filter("processing_time is null").count() == 0


def test_dead_letters(spark, readings_folder):
    bad = rejected(decode_with_rejects(_stream(spark, readings_folder), schemas.READING))
    assert bag(_collect(spark, bad.writeStream)) == [("{broken",)]


def test_flat_streams(spark, tmp_path):
    folder = tmp_path / "in"
    _put(folder, "a.txt", ['{"temperature": 35, "windspeed": 20, "time": "2025-01-01T10:00"}', '{"temperature": 0, "time": "x"}'])
    levels = _collect(spark, jobs.flat_classified_stream(_stream(spark, folder)).writeStream)
    assert bag(levels.select("wind_alert_level", "heat_alert_level", F.col("event_time").isNull())) == [
        ("level_2", "level_0", True), ("level_2", "level_2", False),
    ]
    flat = _collect(spark, jobs.flat_transformed_stream(_stream(spark, folder)).writeStream)
    assert bag(flat.select("temp_f", "high_wind_alert")) == [(32.0, False), (95.0, True)]
    out = str(tmp_path / "high")
    high = batches.split_writer(
        _stream(spark, folder), schemas.FLAT_TRANSFORMED, lambda df: alerts.high_wind_rows(alerts.transform_flat(df.drop("temp_f", "high_wind_alert"))),
        batches.json_sink(out), batches.text_sink(str(tmp_path / "bad")),
    )
    _finish(jobs.start(spark, high, _name(), available_now=True))
    assert bag(spark.read.json(out).select("windspeed")) == [(20.0,)]


def _write_classified(spark, folder, parts=3):
    classified = adapters.classified(spark, SF_DIR).select(
        "latitude", "longitude", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
        "temperature", "windspeed", "weathercode", "humidity", "wind_alert_level", "heat_alert_level", "city", "country",
    )
    jobs.messages_of(classified).repartition(parts).write.text(str(folder))
    return classified


def test_stream_aggregates_equal_batch_aggregates(spark, tmp_path):
    classified = _write_classified(spark, tmp_path / "in")
    name = _name()
    aggregates = jobs.aggregates_stream(_stream(spark, tmp_path / "in"))
    writer = aggregates.writeStream.outputMode("complete").format("memory")
    _finish(jobs.start(spark, writer, name, available_now=True))

    def rows(df):
        return bag(df.select(*windows.AGGREGATE_COLUMNS).withColumns({c: F.round(c, 6) for c in AVERAGES}))

    assert rows(spark.table(name)) == rows(windows.sliding_aggregates(classified))


def test_update_mode_sends_changed_windows_again(spark, tmp_path):
    folder = tmp_path / "in"
    row = '{"latitude": 1.0, "longitude": 2.0, "event_time": "2025-01-01T10:00:00", "temperature": %d}'
    _put(folder, "a.txt", [row % 10])
    _put(folder, "b.txt", [row % 20])
    sent = []

    def keep(batch):
        sent.extend(batch.select("window_start", "avg_temperature").collect())

    writer = jobs.shared_writer(jobs.aggregates_stream(_stream(spark, folder)), keep, output_mode="update")
    _finish(jobs.start(spark, writer, _name(), available_now=True))
    assert len(sent) == 10
    assert {r.avg_temperature for r in sent[:5]} in ({10.0}, {20.0})
    assert {r.avg_temperature for r in sent[5:]} == {15.0}


def test_watermark_allows_append_mode(spark, tmp_path):
    folder = tmp_path / "in"
    row = '{"latitude": 1.0, "longitude": 2.0, "event_time": "%s", "temperature": 1.0}'
    _put(folder, "a.txt", [row % "2025-01-01T10:00:00"])
    _put(folder, "b.txt", [row % "2025-01-01T12:00:00"])
    _put(folder, "c.txt", [row % "2025-01-01T10:00:00"])
    aggregates = jobs.aggregates_stream(_stream(spark, folder), watermark="10 minutes")
    closed = _collect(spark, aggregates.writeStream.outputMode("append"))
    assert {r.window_start.hour for r in closed.collect()} <= {9, 10}


def test_alert_store_stream_resumes_where_it_stopped(spark, tmp_path):
    folder, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    classified = _write_classified(spark, folder)

    def run():
        letters = batches.text_sink(str(tmp_path / "bad"))
        sink = sinks.alert_store_sink(store)
        writer = batches.split_writer(_stream(spark, folder), schemas.TRANSFORMED_GEO, lambda df: df, sink, letters)
        _finish(jobs.start(spark, writer, _name(), checkpoint=checkpoint, available_now=True))

    run()
    expected = alerts.alert_rows(classified).count()
    assert sources.read_alerts(spark, store).count() == expected
    run()
    assert sources.read_alerts(spark, store).count() == expected
    _put(folder, "more.txt", ['{"city": "Paris", "country": "France", "wind_alert_level": "level_1"}'])
    run()
    assert sources.read_alerts(spark, store).count() == expected + 1
    assert sources.read_alerts(spark, store, "France", "Paris").count() == 1


def test_stream_is_enriched_from_a_static_table(spark, tmp_path):
    folder = tmp_path / "in"
    _put(folder, "a.txt", ["Paris", "Nowhere"])
    places = spark.createDataFrame(
        [("Paris", "Paris", "France", "FR", "IdF", 2)],
        "request string, city string, country string, country_code string, admin1 string, population long",
    )
    readings = _stream(spark, folder).withColumnRenamed("value", "request")
    assert bag(_collect(spark, geo.enrich_readings(readings, places, ["request"]).writeStream)) == [
        ("Paris", "Paris", "France", "FR", "IdF", 2)
    ]


def test_counters(spark, readings_folder, tmp_path):
    listener = metrics.TotalsListener()
    spark.streams.addListener(listener)
    try:
        counted = jobs.classified_stream(_stream(spark, readings_folder))
        _collect(spark, counted.writeStream)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert dict(listener.totals["alerts"]) == {"processed": 3, "alerts": 2}

    observation = Observation("batch")
    metrics.observe_alerts(adapters.classified(spark, SF_DIR), observation).write.json(str(tmp_path / "out"))
    assert observation.get["processed"] == 1000
    sent = Observation("sent")
    metrics.observe_sent(spark.range(7), sent).write.json(str(tmp_path / "sent"))
    assert sent.get == {"sent": 7}
    untimed = windows.with_event_timestamp(spark.createDataFrame([("x",), ("2025-01-01",)], "event_time string"))
    seen = Observation("untimed")
    untimed.observe(seen, F.count_if(F.col("event_timestamp").isNull()).alias("n")).collect()
    assert seen.get == {"n": 1}


def test_untimed_readings_are_counted(spark, tmp_path):
    folder = tmp_path / "in"
    _put(folder, "a.txt", ['{"event_time": "x"}', '{"temperature": 1.0}', '{"event_time": "2025-01-01T10:00"}'])
    listener = metrics.TotalsListener()
    spark.streams.addListener(listener)
    try:
        aggregates = jobs.aggregates_stream(_stream(spark, folder))
        assert _collect(spark, aggregates.writeStream.outputMode("complete")).count() == 5
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert dict(listener.totals["untimed"]) == {"untimed": 2}


def test_local_times_shift_to_utc_on_request(spark):
    rows = spark.createDataFrame([("2025-07-01T12:00", "Europe/Paris")], "event_time string, timezone string")
    as_is, shifted = windows.with_event_timestamp(rows), windows.with_event_timestamp(rows, zone="timezone")
    assert (as_is.first().event_timestamp.hour, shifted.first().event_timestamp.hour) == (12, 10)


def test_run_until_stopped(spark, readings_folder):
    classified = jobs.classified_stream(_stream(spark, readings_folder))
    finite = jobs.start(spark, classified.writeStream.format("noop"), _name(), available_now=True)
    endless = jobs.start(spark, classified.writeStream.format("noop"), _name(), every="1 second")
    jobs.run_until_stopped(spark, finite, endless)
    assert not finite.isActive and not endless.isActive


def test_failed_query_raises(spark, readings_folder):
    def fail(_batch):
        raise ValueError("no room")

    writer = jobs.shared_writer(jobs.classified_stream(_stream(spark, readings_folder)), jobs.show_batch(), fail)
    with pytest.raises(Exception, match="no room"):
        jobs.run_until_stopped(spark, jobs.start(spark, writer, _name()))


def test_checkpoint_root_comes_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_default_checkpoint_depends_on_the_name(spark, readings_folder):
    import os

    name = _name()
    query = jobs.start(spark, jobs.console_writer(jobs.classified_stream(_stream(spark, readings_folder))), name, available_now=True)
    _finish(query)
    assert os.path.isdir(f"{checkpoint_root(spark)}/queries/{name}")


def test_kafka_writers_are_wired(spark, readings_folder):
    """The connector jar is not part of PySpark; without it the sink must fail by name only."""
    from weatherlake.sinks.topics import topic_writer

    messages = jobs.messages_of(jobs.classified_stream(_stream(spark, readings_folder)))
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.start(spark, topic_writer(messages, "localhost:1", "t"), _name(), available_now=True)


def _levels(root):
    """Sorted (label, number of lines) of the batch folders below a text output."""
    return sorted((p.name, sum(len(f.read_text().splitlines()) for f in p.glob("part-*"))) for p in root.glob("batch=*"))


def test_one_query_writes_messages_and_letters_and_replays_a_batch_once(spark, tmp_path):
    folder, out, bad = tmp_path / "in", tmp_path / "out", tmp_path / "bad"
    _put(folder, "a.txt", [_reading(25, 20), "{broken", _reading(5, 5), "no json"])
    _put(folder, "b.txt", [_reading(15, 40)])
    checkpoint, totals = tmp_path / "checkpoint", batches.Totals()

    def run():
        writer = batches.split_writer(
            _stream(spark, folder), schemas.READING, alerts.classify_readings, batches.text_sink(str(out)),
            batches.text_sink(str(bad)), totals, encode=True,
        )
        before = len(spark.streams.active)
        query = jobs.start(spark, writer, _name(), checkpoint=str(checkpoint), available_now=True)
        assert len(spark.streams.active) <= before + 1
        _finish(query)

    run()
    messages, letters = _levels(out), _levels(bad)
    assert [n for _, n in messages] in ([2, 1], [1, 2]) and [n for _, n in letters] == [2]
    assert dict(totals.totals["messages"]) == {"received": 5, "rejected": 2}
    assert dict(totals.totals["output"]) == {"processed": 3, "alerts": 2}
    # As if the driver had died between writing the last batch and noting it.
    for name in ("1", ".1.crc"):
        (checkpoint / "commits" / name).unlink()
    (out / messages[1][0] / "part-left-over.txt").write_text("half a line\n")
    run()
    assert (_levels(out), _levels(bad)) == (messages, letters)
    # A new checkpoint is another query: its batches get labels of their own.
    checkpoint = tmp_path / "second"
    run()
    assert sum(n for _, n in _levels(out)) == 6 and sum(n for _, n in _levels(bad)) == 4


def test_a_batch_without_output_rows(spark, tmp_path):
    folder, store, totals = tmp_path / "in", str(tmp_path / "store"), batches.Totals()
    _put(folder, "a.txt", ['{"city": "Paris", "country": "France", "wind_alert_level": "level_0", "heat_alert_level": "level_0"}'])
    writer = batches.split_writer(
        _stream(spark, folder), schemas.TRANSFORMED_GEO, lambda df: df, sinks.alert_store_sink(store),
        batches.text_sink(str(tmp_path / "bad")), totals,
    )
    _finish(jobs.start(spark, writer, _name(), available_now=True))
    assert dict(totals.totals["output"]) == {"processed": 1, "alerts": 0}
    assert not (tmp_path / "bad").exists()


def test_merged_store_keeps_its_rows_in_one_file_per_place(spark, tmp_path):
    folder, store = tmp_path / "in", tmp_path / "store"
    row = '{"city": "%s", "country": "France", "wind_alert_level": "level_1", "latitude": %d}'
    for i in range(9):
        _put(folder, f"{i}.txt", [row % ("Paris", i), row % ("Le Mans", i)])
    sink = sinks.merging_sink(sinks.alert_store_sink(str(store)), str(store), 4)
    writer = batches.split_writer(
        _stream(spark, folder), schemas.TRANSFORMED_GEO, lambda df: df, sink, batches.text_sink(str(tmp_path / "bad"))
    )
    _finish(jobs.start(spark, writer, _name(), available_now=True))
    stored = sources.read_alerts(spark, str(store))
    assert bag(stored.select("city", F.col("latitude").cast("int"))) == sorted(
        (city, i) for city in ("Paris", "Le Mans") for i in range(9)
    )
    # Batches 0-3 and 4-7 are merged; 0-3 are deleted, 4-7 stay for readers that began before the last merge.
    names = {p.name.split("-", 5)[-1] for p in (store / "country_path=France" / "city_path=Paris").glob("batch=*")}
    single = [f"{i:010d}" for i in (4, 5, 6, 7, 8)]
    assert names == {*single, "0000000000-0000000003", "0000000004-0000000007"}
    live = stored.filter("city = 'Paris'").select(F.input_file_name()).distinct().count()
    assert live == 3
    assert len(list((store / "_merged").glob("[!.]*"))) == 1
    assert sources.read_alerts(spark, str(store), "France", "Le Mans").count() == 9


def test_unmarked_merge_is_not_seen(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([("Paris", "France", "level_1", "level_0")], "city string, country string, wind_alert_level string, heat_alert_level string")
    full = rows.selectExpr("*", *[f"cast(null as {t}) {c}" for c, t in (("latitude", "double"), ("longitude", "double"), ("event_time", "string"), ("temperature", "double"), ("windspeed", "double"), ("weathercode", "int"), ("humidity", "double"))])
    for number in range(3):
        sinks.alert_store_sink(store)(full, f"q-{number:010d}")
    assert sinks.merge_batches(spark, store, "q", 1) == 0
    assert sources.read_alerts(spark, store).count() == 3
    # A merge that died before its mark leaves folders above it.
    sinks.alert_store_sink(store)(full, "q-0000000002-0000000005")
    sinks.alert_store_sink(store)(full, "other-0000000000")
    assert sources.read_alerts(spark, store).count() == 4
    assert sinks.merge_batches(spark, store, "q", 1) == -1


def test_closed_windows_through_panes_equal_the_direct_form(spark, tmp_path):
    folder = tmp_path / "in"
    row = '{"latitude": %d.0, "longitude": 2.0, "event_time": "2025-01-01T10:%02d:%02d", "temperature": %d, "wind_alert_level": "level_%d"}'
    _put(folder, "a.txt", [row % (i % 3, i % 7, i % 60, i % 40, i % 3) for i in range(300)])
    _put(folder, "b.txt", [row % (i % 3, 7 + i % 5, i % 60, i % 40, i % 3) for i in range(300)])
    _put(folder, "c.txt", ['{"latitude": 9.0, "longitude": 2.0, "event_time": "2025-01-01T12:00:00", "temperature": 1}'])
    found, copied_first = {}, {}
    for panes in (True, False):
        aggregates = jobs.aggregates_stream(_stream(spark, folder), watermark="10 minutes", panes=panes)
        name = _name()
        query = jobs.start(spark, aggregates.writeStream.outputMode("append").format("memory"), name, available_now=True)
        _finish(query)
        closed = spark.table(name).filter("window_end <= '2025-01-01 11:00:00'")
        found[panes] = bag(closed.select(*windows.AGGREGATE_COLUMNS).withColumns({c: F.round(c, 6) for c in AVERAGES}))
        plan = query._jsq.explainInternal(False)
        # Plans are printed from the result down to the source.
        copied_first[panes] = plan.index("Expand") > plan.rindex("StateStoreSave")
    assert len(found[True]) == 48 and found[True] == found[False]
    # Readings reach the first state uncopied; only closed panes are copied into their windows.
    assert copied_first == {True: False, False: True}


def test_late_readings_are_counted(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    row = '{"latitude": 1.0, "longitude": 2.0, "event_time": "%s", "temperature": 1.0}'
    _put(folder, "a.txt", [row % "2025-01-01T10:00:00"])
    _put(folder, "b.txt", [row % "2025-01-01T12:00:00"])
    _put(folder, "c.txt", [row % "2025-01-01T12:01:00"])
    _put(folder, "d.txt", [row % "2025-01-01T10:30:00"])
    for i, name in enumerate(("a.txt", "b.txt", "c.txt", "d.txt")):  # files are read in the order of their age
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    listener = metrics.TotalsListener()
    spark.streams.addListener(listener)
    try:
        aggregates = jobs.aggregates_stream(_stream(spark, folder), window="1 minute", slide="1 minute", watermark="10 minutes", panes=True)
        _collect(spark, aggregates.writeStream.outputMode("append"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert dict(listener.totals["late"]) == {"dropped": 1}


def test_enriching_reads_the_places_of_each_batch(spark, tmp_path):
    folder, out, places = tmp_path / "in", tmp_path / "out", tmp_path / "places"

    def place(name, country="France"):
        return json.dumps({"requested_city": name, "requested_country": country, "position": 0, "name": name, "country": country,
                           "country_code": "FR", "admin1": "R", "population": 5, "latitude": 1.0, "longitude": 2.0})

    def asked(name, **more):
        return _reading(5, 5, requested_city=name, requested_country="France", **more)

    _put(places, "a.json", [place("Paris")])
    _put(folder, "a.txt", [asked("Paris"), asked("Lyon"), "{broken"])
    _put(folder, "b.txt", [asked("Lyon"), asked("Paris") .replace('"timezone": "UTC", ', "")])
    for i, name in enumerate(("a.txt", "b.txt")):
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    from weatherlake.__main__ import main

    def run():
        main(["enrich", "--input", str(folder), "--output", str(out), "--places", str(places), "--rejects", str(tmp_path / "bad"),
              "--available-now", "--checkpoint", str(tmp_path / "c")], spark)

    run()
    assert bag(spark.read.json(str(out)).select("city", "region", "population", "fetched_at")) == [("Paris", "R", 5, "2025-01-01T10:00")]
    unresolved = spark.read.json(str(tmp_path / "bad-unresolved"))
    assert sorted(row.requested_city for row in unresolved.collect()) == ["Lyon", "Lyon", "Paris"]
    _put(places, "b.json", [place("Lyon")])
    _put(folder, "c.txt", [asked("Lyon")])
    run()
    stored = spark.read.json(str(out))
    assert sorted(row.city for row in stored.collect()) == ["Lyon", "Paris"]
    assert stored.filter("timestamp is null").count() == 0


def test_places_are_looked_up_for_every_batch_of_one_run(spark, tmp_path):
    folder = tmp_path / "in"
    for i, name in enumerate(("a.txt", "b.txt")):
        _put(folder, name, [_reading(5, 5, requested_city="Lyon", requested_country="France")])
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    calls, sent = [], []

    def places():
        calls.append(1)
        names = ["Paris"] if len(calls) == 1 else ["Paris", "Lyon"]
        rows = [(name, "France", name, "France", "FR", "R", 5) for name in names]
        return spark.createDataFrame(rows, "requested_city string, requested_country string, city string, country string, country_code string, admin1 string, population long")

    nothing = batches.text_sink(str(tmp_path / "bad"))
    writer = jobs.enriching_writer(
        _stream(spark, folder), places, lambda df, label: sent.append([row.key for row in df.collect()]), nothing,
        batches.json_sink(str(tmp_path / "unresolved")),
    )
    _finish(jobs.start(spark, writer, _name(), available_now=True))
    assert sent == [[], ["FR_Lyon"]]
