"""One query, several outputs.

A job reads and decodes its source once; every micro-batch goes to the output proper and, where it holds any, to the
folder of dead letters.  Each output files a batch under a label made of the query's own id and the
batch number.  A batch that is replayed after a failure has the same label and
replaces what its first try left, so files hold every row once.  Topics get replayed batches again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from weatherlake.functions.codec import accepted, decode_with_rejects, encode_json, rejected
from weatherlake.functions.counting import Count
from weatherlake.functions.levels import is_alert
from weatherlake.schemas import CORRUPT_COLUMN
from weatherlake.sources.labels import single_label

BATCH_FOLDER = "batch"
QUERY_ID = "sql.streaming.queryId"
# Writes one batch under its label.
Sink = Callable[[DataFrame, str], None]
# Output and rest of a batch of decoded rows.
Split = Callable[[DataFrame], "tuple[DataFrame, DataFrame | None]"]


def batch_label(spark: SparkSession, batch_id: int) -> str:
    """Name of a batch: the id that the query keeps in its checkpoint, and the number there.

    Two queries, or one with a new checkpoint, never share a label.
    """
    query = spark.sparkContext.getLocalProperty(QUERY_ID) or "bounded"
    return single_label(query, batch_id)


def _labelled(df: DataFrame, label: str):
    """Writer that replaces the folders of this batch only."""
    labelled = df.withColumn(BATCH_FOLDER, F.lit(label)).write.mode("overwrite")
    return labelled.option("partitionOverwriteMode", "dynamic")


def text_sink(path: str) -> Sink:
    """One folder ``batch=<label>`` per batch with the lines of the column ``value``."""
    return lambda df, label: _labelled(df.select("value"), label).partitionBy(BATCH_FOLDER).text(path)


def json_sink(path: str) -> Sink:
    return lambda df, label: _labelled(df, label).partitionBy(BATCH_FOLDER).json(path)


def place_sink(path: str, folders: tuple[str, ...]) -> Sink:
    """JSON lines in one folder per place and batch; a hot place is written by several tasks."""
    return lambda df, label: (
        _labelled(df.hint("rebalance", *folders), label).partitionBy(*folders, BATCH_FOLDER).json(path)
    )


def every(*sinks: Sink) -> Sink:
    def write(df: DataFrame, label: str) -> None:
        for sink in sinks:
            sink(df, label)

    return write


class Totals:
    """Counters added up over batches, each taken by the job that writes the batch."""

    def __init__(self) -> None:
        self.totals: dict[str, Counter] = {}

    def add(self, name: str, counts: dict) -> None:
        self.totals.setdefault(name, Counter()).update({kind: n or 0 for kind, n in counts.items()})

    def lines(self) -> list[str]:
        return [
            f"{name}: " + ", ".join(f"{n} {kind}" for kind, n in counts.items())
            for name, counts in sorted(self.totals.items())
        ]


def _output_counters(df: DataFrame) -> list[Column]:
    """Rows of an output and, where levels are known, the alerts among them."""
    counters = [F.count("*").alias("processed")]
    if {"wind_alert_level", "heat_alert_level"} <= set(df.columns):
        counters.append(F.count_if(is_alert()).alias("alerts"))
    return counters


def message_counters() -> list[Column]:
    return [F.count("*").alias("received"), F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("rejected")]


class SplitBatch:
    """Writes one batch of decoded messages (see ``split_writer``)."""

    def __init__(self, split: Split, sink: Sink, letters: Sink, rest: Sink | None, totals: Totals, finish=None):
        self.split, self.sink, self.letters, self.rest = split, sink, letters, rest
        self.totals, self.finish = totals, finish or (lambda df: df)

    def write(self, batch: DataFrame, label: str) -> None:
        received = Count(batch, *message_counters())
        good, rest = self.split(accepted(received.rows))
        output = Count(good, *_output_counters(good))
        self.sink(self.finish(output.rows), label)
        counts, processed = received.get(), output.get()
        # The few batches with rejected rows are read once more; their offsets are fixed by then.
        if counts["rejected"]:
            self.letters(rejected(batch), label)
        if self.rest is not None and counts["received"] - counts["rejected"] > processed["processed"]:
            left = Count(self.split(accepted(batch))[1], F.count("*").alias("unresolved"))
            self.rest(left.rows, label)
            self.totals.add("rest", left.get())
        self.totals.add("messages", counts)
        self.totals.add("output", processed)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch, batch_label(batch.sparkSession, batch_id))


def split_writer(
    messages: DataFrame,
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    sink: Sink,
    letters: Sink,
    totals: Totals | None = None,
    encode: bool = False,
) -> DataStreamWriter:
    """One query for messages and dead letters.

    What ``transform`` makes of the decoded messages goes to ``sink`` (as JSON text with ``encode``), the text of messages
    that are no JSON object to ``letters``.  ``transform`` may be any batch transformation without state across batches.
    """
    batch = SplitBatch(
        lambda decoded: (transform(decoded), None), sink, letters, None, totals or Totals(), encode_json if encode else None
    )
    return decode_with_rejects(messages, schema).writeStream.foreachBatch(batch)
