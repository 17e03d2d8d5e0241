from __future__ import annotations

import json

from pyspark.sql import Observation
from weatherlake.sources.offsets import OffsetRecord, advanced, observe_offsets
from weatherlake.sources.topics import topic_options


def _messages(spark, *rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")


def test_record_goes_on_where_the_last_run_ended(spark, tmp_path):
    path = str(tmp_path / "record")
    record = OffsetRecord(spark, path)
    assert (record.run, json.loads(record.starting("t", 2))) == (0, {"t": {"0": -2, "1": -2}})
    seen = Observation()
    read = observe_offsets(_messages(spark, ("t", 0, 4, "a"), ("t", 0, 9, "b")), seen, 2)
    read.select("value").write.text(str(tmp_path / "out"))  # the job that writes also tells how far it read
    record.advance("t", seen.get)
    later = OffsetRecord(spark, path)
    assert (later.run, json.loads(later.starting("t", 2))) == (1, {"t": {"0": 10, "1": -2}})
    options = topic_options("broker:1", "t", later.starting("t", 2), ending="latest")
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 10, "1": -2}}
    seen = Observation()
    observe_offsets(_messages(spark, ("t", 1, 0, "c")), seen, 2).write.format("noop").mode("overwrite").save()
    later.advance("t", seen.get)
    assert json.loads(OffsetRecord(spark, path).starting("t", 3)) == {"t": {"0": 10, "1": 1, "2": -2}}


def test_a_run_without_messages_changes_nothing(spark, tmp_path):
    record = OffsetRecord(spark, str(tmp_path / "record"))
    seen = Observation()
    observe_offsets(_messages(spark, ("t", 0, 4, "a")), seen, 1).write.format("noop").mode("overwrite").save()
    record.advance("t", seen.get)
    record.advance("t", {"0": None, "unlisted": 0})
    assert OffsetRecord(spark, str(tmp_path / "record")).offsets == {"t": {"0": 5}}
    assert advanced({"t": {"0": 5}}, "u", {"0": 1}) == {"t": {"0": 5}, "u": {"0": 1}}


def test_unlisted_partitions_are_not_passed_over(spark, tmp_path):
    import pytest

    record = OffsetRecord(spark, str(tmp_path / "record"))
    seen = Observation()
    observe_offsets(_messages(spark, ("t", 3, 4, "a")), seen, 2).write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="more partitions"):
        record.advance("t", seen.get)
