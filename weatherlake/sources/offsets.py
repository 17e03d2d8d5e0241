"""Bounded topic reads that go on where the last one ended.

A stream keeps its offsets in its checkpoint; a bounded read has none, so a job keeps a record of
its own: one line of JSON per finished run, the last of which counts.  How far a run has read is observed by the job that
writes its output, and noted when that output is written: a failed run is read again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weatherlake.sources.labels import file_system

# What the connector understands as the first message of a partition.
FIRST = -2
Offsets = dict[str, dict[str, int]]


def observe_offsets(messages: DataFrame, observation: Observation, partitions: int) -> DataFrame:
    """Report the offset behind the last message of each partition as the messages are read."""
    ends = [F.max(F.when(F.col("partition") == i, F.col("offset") + 1)).alias(str(i)) for i in range(partitions)]
    unlisted = F.count_if(F.col("partition") >= partitions).alias("unlisted")
    return messages.observe(observation, *ends, unlisted)


def advanced(before: Offsets, topic: str, read: dict[str, int | None]) -> Offsets:
    """Offsets after a run; partitions without new messages keep theirs."""
    new = {partition: end for partition, end in read.items() if end is not None}
    return {**before, topic: {**before.get(topic, {}), **new}}


class OffsetRecord:
    """The record of one job, a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.run, self.offsets = self._last()

    def _last(self) -> tuple[int, Offsets]:
        """Number of the next run, and the offsets at which it begins."""
        folder, system = file_system(self.spark, self.path)
        if not system.exists(folder):
            return 0, {}
        rows = self.spark.read.schema("run long, offsets string").json(self.path)
        last = rows.agg(F.max_by(F.struct("*"), "run").alias("last")).first().last
        return (last.run + 1, json.loads(last.offsets)) if last else (0, {})

    def starting(self, topic: str, partitions: int) -> str:
        """Value for ``startingOffsets``; the connector wants every partition named."""
        known = self.offsets.get(topic, {})
        named = {str(i): known.get(str(i), FIRST) for i in range(partitions)}
        return json.dumps({topic: {**named, **known}}, sort_keys=True)

    def advance(self, topic: str, read: dict[str, int | None]) -> None:
        """Note what ``observe_offsets`` has seen in this run."""
        seen = dict(read)
        if seen.pop("unlisted", 0):
            raise ValueError(f"{topic} has more partitions than this job was told of")
        self.offsets = advanced(self.offsets, topic, seen)
        row = (self.run, json.dumps(self.offsets, sort_keys=True))
        self.spark.createDataFrame([row], "run long, offsets string").coalesce(1).write.mode("append").json(self.path)
        self.run += 1
