from __future__ import annotations

import json

import pytest
from helpers import bag

from weatherlake.__main__ import main
from weatherlake.sources.files import read_alerts, read_history


def _lines(folder, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.txt").write_text("".join(json.dumps(row) + "\n" for row in rows))
    return str(folder)


def _reading(wind, temperature, city="Paris"):
    current = {"time": "2025-01-01T10:00", "windspeed_10m": wind, "temperature_2m": temperature, "weathercode": 3}
    return {"city": city, "country": "France", "latitude": 1.0, "longitude": 2.0, "current": current}


def test_readings_to_alerts_to_report(spark, tmp_path, capsys):
    raw = _lines(tmp_path / "raw", _reading(25, 20), _reading(5, 5), _reading(15, 40, "Le Mans"))
    transformed, store, sums = (str(tmp_path / name) for name in ("transformed", "store", "sums"))

    def run(job, source, target, *more):
        checkpoint = str(tmp_path / f"checkpoint-{job}")
        main([job, "--input", source, "--output", target, "--available-now", "--checkpoint", checkpoint, *more], spark)

    run("classify", raw, transformed, "--carry-geo")
    run("store-alerts", transformed, store, "--carry-geo")
    run("aggregate", transformed, sums, "--unbounded")
    alerts = read_alerts(spark, store)
    assert bag(alerts.select("city", "wind_alert_level", "heat_alert_level")) == [
        ("Le Mans", "level_1", "level_2"), ("Paris", "level_2", "level_0"),
    ]
    assert {row.total_measurements for row in spark.read.json(sums).collect()} == {3}
    main(["report", "--input", store], spark)
    printed = capsys.readouterr().out
    assert "top cities" in printed and "Le Mans" in printed


def test_flat_jobs(spark, tmp_path):
    raw = _lines(
        tmp_path / "raw",
        {"temperature": 10.0, "windspeed": 11.0, "time": "2025-01-01T10:00"},
        {"temperature": 20.0, "time": "2025-01-01T10:00"},
    )
    flat, high, minutes, levels = (str(tmp_path / name) for name in ("flat", "high", "minutes", "levels"))

    def run(job, source, target, *more):
        checkpoint = str(tmp_path / f"checkpoint-{job}")
        main([job, "--input", source, "--output", target, "--available-now", "--checkpoint", checkpoint, *more], spark)

    run("transform", raw, flat)
    run("high-wind", flat, high)
    run("classify", raw, levels, "--shape", "flat")
    main(["tumbling", "--input", flat, "--output", minutes], spark)
    assert bag(spark.read.json(high).select("windspeed")) == [(11.0,)]
    assert bag(spark.read.json(minutes).select("avg_temp_c", "alert_count", "high_wind_count")) == [(15.0, 2, 1)]
    assert bag(spark.read.json(levels).select("wind_alert_level")) == [("level_1",), ("level_2",)]


def test_records_job(spark, tmp_path, capsys):
    place = {"city": "Lyon", "country": "France", "country_code": "FR"}
    daily = {
        "time": ["2025-01-01", "2025-01-02"], "temperature_2m_max": [1, 2], "temperature_2m_min": [0, -1],
        "windspeed_10m_max": [3, 3], "precipitation_sum": [0.5, 0],
    }
    good = {"geocode_info": place, "historical_data": {"latitude": 1.0, "longitude": 2.0, "daily": daily}}
    for name, text in (("Lyon", json.dumps(good, indent=1)), ("Broken", "{")):
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "weather_history_raw.json").write_text(text)
    main(["records", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")], spark)
    row = spark.read.json(str(tmp_path / "out")).select("city", "records.hottest_day.date", "records.windiest_day").first()
    assert (row.city, row.date, row.windiest_day.date) == ("Lyon", "2025-01-02", "2025-01-01")
    assert "Broken" in capsys.readouterr().out


def test_jobs_keep_what_they_cannot_decode(spark, tmp_path, capsys):
    """A field of the wrong type costs that field only; broken text is written and counted."""
    folder = tmp_path / "raw"
    folder.mkdir()
    good = {"temperature": 30.0, "windspeed": "calm", "time": "2025-01-01T10:00"}
    (folder / "part.txt").write_text(json.dumps(good) + "\n" + '{"temperature": \n' + "[1, 2]\n" + "no json\n")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    main(["classify", "--shape", "flat", "--input", str(folder), "--output", out, "--rejects", bad, "--available-now",
          "--checkpoint", str(tmp_path / "c")], spark)
    assert bag(spark.read.json(out).select("temperature", "heat_alert_level")) == [(30.0, "level_1")]
    assert sorted(row.value for row in spark.read.text(bad).collect()) == ["[1, 2]", "no json", '{"temperature": ']
    assert "4 received, 3 rejected" in capsys.readouterr().out


def test_tumbling_job_counts_in_the_write(spark, tmp_path, capsys):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "part.txt").write_text('{"temperature": 10.0, "time": "2025-01-01T10:00"}\nno json\n')
    for _ in range(2):  # a run without a record replaces the last one
        main(["tumbling", "--input", str(folder), "--output", str(tmp_path / "out"), "--rejects", str(tmp_path / "bad")], spark)
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    assert [row.value for row in spark.read.text(str(tmp_path / "bad")).collect()] == ["no json"]
    assert "2 received, 1 rejected" in capsys.readouterr().out


def test_history_job(spark, tmp_path, capsys):
    documents = {
        "Lyon": {"geocode_info": {"city": "Lyon", "country": "France", "country_code": "FR", "admin1": "R"},
                 "historical_data": {"latitude": 1.0, "timezone": "UTC", "daily": {"time": ["2025-01-01"]}}},
        "Partial": {"geocode_info": {"city": "x"}},
    }
    for name, document in documents.items():
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "weather_history_raw.json").write_text(json.dumps(document, indent=1))
    for _ in range(2):
        main(["history", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--store", str(tmp_path / "store"),
              "--rejects", str(tmp_path / "bad"), "--available-now", "--checkpoint", str(tmp_path / "c")], spark)
    sent = spark.read.json(str(tmp_path / "out"))
    assert bag(sent.select("city", "region", "historical_data.timezone")) == [("Lyon", "R", "UTC")]
    assert sent.filter("timestamp is null").count() == 0
    stored, _ = read_history(spark, str(tmp_path / "store"))
    assert [row.geocode_info.city for row in stored.collect()] == ["Lyon"]
    assert ["Partial" in row.value for row in spark.read.text(str(tmp_path / "bad")).collect()] == [True]
    assert "2 received, 1 rejected" in capsys.readouterr().out


def test_aggregate_job_sends_closed_windows_once(spark, tmp_path, capsys):
    row = {"latitude": 1.0, "longitude": 2.0, "temperature": 1.0}
    folder = _lines(tmp_path / "in", *[row | {"event_time": f"2025-01-01T{hour}:00:00"} for hour in ("10", "12")])
    main(["aggregate", "--closed", "--watermark", "10 minutes", "--input", folder, "--output", str(tmp_path / "out"), "--available-now",
          "--checkpoint", str(tmp_path / "c"), "--rejects", str(tmp_path / "bad")], spark)
    assert {(r.window_start[11:13], r.total_measurements) for r in spark.read.json(str(tmp_path / "out")).collect()} == {("09", 1), ("10", 1)}


def test_reports_are_not_cut(spark, tmp_path, capsys):
    rows = [_reading(25, 40, f"City{i:02d}") | {"country": f"Country{i:02d}"} for i in range(30)]
    raw, store = _lines(tmp_path / "raw", *rows), str(tmp_path / "store")
    for job, source, target in (("classify", raw, str(tmp_path / "t")), ("store-alerts", str(tmp_path / "t"), store)):
        main([job, "--input", source, "--output", target, "--available-now", "--carry-geo",
              "--checkpoint", str(tmp_path / f"c-{job}")], spark)
    main(["report", "--input", store], spark)
    printed = capsys.readouterr().out
    assert all(f"Country{i:02d} | City{i:02d}" in printed for i in range(30))
    assert "unreadable lines: 0" in printed


def test_records_job_needs_input_and_names_every_bad_file(spark, tmp_path, capsys):
    for i in range(25):
        folder = tmp_path / "in" / f"Broken{i:02d}"
        folder.mkdir(parents=True)
        (folder / "weather_history_raw.json").write_text("{")
    with pytest.raises(SystemExit, match="25 skipped"):
        main(["records", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")], spark)
    printed = capsys.readouterr().out
    assert all(f"Broken{i:02d}" in printed for i in range(25))


def test_aggregate_needs_a_bound_for_its_state(spark, tmp_path):
    with pytest.raises(SystemExit, match="watermark"):
        main(["aggregate", "--input", str(tmp_path), "--output", str(tmp_path / "o")], spark)


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["nothing"])
