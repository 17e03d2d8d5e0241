"""The streaming jobs: raw messages in, classified readings, aggregates and stored alerts out.

Every ``*_stream`` function is a plain DataFrame transformation, so the same code runs on
a topic, a folder of files or a bounded table.  ``start`` gives a query its name,
checkpoint and trigger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from weatherlake.constants import LEVEL_2, SLIDING_STEP, SLIDING_WINDOW
from weatherlake.functions.codec import accepted, decode_with_rejects, encode_json, rejected
from weatherlake.functions.counting import Count
from weatherlake.operators.alerts import (
    classify_flat_readings,
    classify_readings,
    transform_flat,
)
from weatherlake.operators.geo import enriched_split
from weatherlake.operators.windows import (
    closed_sliding_aggregates, sliding_aggregates_stream, with_computed_at, with_event_timestamp,
)
from weatherlake.schemas import ENRICHED_READING, FLAT_READING, READING, REQUESTED_READING, TRANSFORMED
from weatherlake.sinks.topics import keyed_messages
from weatherlake.sources.files import has_history, skipped_history, usable_history
from weatherlake.streaming.batches import Sink, SplitBatch, Totals, batch_label
from weatherlake.streaming.metrics import observe_alert_stream, observe_rejects, observe_untimed


def decoded_stream(messages: DataFrame, schema: StructType) -> DataFrame:
    """Messages that are JSON objects, fields of the wrong type as NULL.

    Every batch reports received and rejected messages under the observation ``messages``.
    """
    return accepted(observe_rejects(decode_with_rejects(messages, schema)))


def dead_letter_writer(messages: DataFrame, schema: StructType, path: str) -> DataStreamWriter:
    """Append the text of every message that is no JSON object, exactly once.

    For a query with window state, whose one output are the windows; the other jobs
    write their dead letters themselves (``batches.split_writer``).
    """
    letters = rejected(decode_with_rejects(messages, schema))
    return letters.writeStream.format("text").option("path", path).outputMode("append")


def classified_stream(messages: DataFrame, carry_geo: bool = False) -> DataFrame:
    """Nested reading messages to classified readings; processed rows and alerts are counted."""
    schema = ENRICHED_READING if carry_geo else READING
    return observe_alert_stream(classify_readings(decoded_stream(messages, schema), carry_geo))


def classified_flat(readings: DataFrame) -> DataFrame:
    """Flat readings classified with half-open levels; missing measures are level 2."""
    return classify_flat_readings(readings, closed="left", null_level=LEVEL_2)


def flat_classified_stream(messages: DataFrame) -> DataFrame:
    return classified_flat(decoded_stream(messages, FLAT_READING))


def flat_transformed_stream(messages: DataFrame) -> DataFrame:
    return transform_flat(decoded_stream(messages, FLAT_READING))


def enriching_writer(
    messages: DataFrame, places: Callable[[], DataFrame], sink: Sink, letters: Sink, unresolved: Sink,
    totals: Totals | None = None,
) -> DataStreamWriter:
    """Readings with the place they name, stamped and keyed by place.

    ``places`` is called for every batch, so a place that was added meanwhile counts from the next batch on.
    Readings whose place is not known, or that lack a field, go to ``unresolved`` as JSON.
    """

    def split(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
        return enriched_split(readings, places())

    batch = SplitBatch(split, sink, letters, unresolved, totals or Totals(), keyed_messages)
    return decode_with_rejects(messages, REQUESTED_READING).writeStream.foreachBatch(batch)


def history_writer(files: DataFrame, sink: Sink, letters: Sink, totals: Totals | None = None) -> DataStreamWriter:
    """History documents to ``sink``, the names of broken files to ``letters``."""
    counters = totals or Totals()

    def write(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch.sparkSession, batch_id)
        received = Count(batch, F.count("*").alias("received"), F.count_if(~has_history()).alias("rejected"))
        sink(usable_history(received.rows), label)
        counts = received.get()
        if counts["rejected"]:
            letters(skipped_history(batch).select(F.col("file").alias("value")), label)
        counters.add("documents", counts)

    return files.writeStream.foreachBatch(write)


def aggregates_stream(
    messages: DataFrame,
    window: str = SLIDING_WINDOW,
    slide: str = SLIDING_STEP,
    watermark: str | None = None,
    schema: StructType = TRANSFORMED,
    zone: str | None = None,
    panes: bool = False,
) -> DataFrame:
    """Classified reading messages to sliding aggregates stamped ``computed_at``.

    Readings without a usable event time fall into no window; every batch reports how many
    under the observation ``untimed``.  With ``panes`` (append mode and a watermark) readings are
    folded into panes first, and each window is sent once.
    """
    readings = decoded_stream(messages, schema)
    timed = observe_untimed(with_event_timestamp(readings, zone=zone))
    if panes:
        if not watermark:
            raise ValueError("windows close only behind a watermark")
        return with_computed_at(closed_sliding_aggregates(timed, watermark, window, slide, "event_timestamp"))
    aggregates = sliding_aggregates_stream(timed, window, slide, "event_timestamp", watermark)
    return with_computed_at(aggregates)


def messages_of(df: DataFrame) -> DataFrame:
    return encode_json(df)


def console_writer(df: DataFrame, rows: int = 5, output_mode: str = "append") -> DataStreamWriter:
    return (
        df.writeStream.format("console")
        .option("truncate", "false")
        .option("numRows", rows)
        .outputMode(output_mode)
    )


def shared_writer(
    df: DataFrame, *sinks: Callable[[DataFrame], None], output_mode: str = "append"
) -> DataStreamWriter:
    """Feed several batch sinks from one query, so that the source is read, and any
    aggregate state kept, once.  A batch may be replayed after a failure: sinks get it at
    least once."""

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch)
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(write_batch).outputMode(output_mode)


def print_batch(batch: DataFrame) -> None:
    """Every row of a batch as JSON, fetched partition by partition."""
    for row in encode_json(batch).toLocalIterator():
        print(row.value)


def show_batch(rows: int = 5) -> Callable[[DataFrame], None]:
    return lambda batch: batch.show(rows, truncate=False)


def start(
    spark: SparkSession,
    writer: DataStreamWriter,
    name: str,
    checkpoint: str | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start a query under its own checkpoint folder.

    The default folder is below ``spark.checkpoint.dir`` and depends only on the name, so a restarted
    job goes on where the last one stopped; without that setting the folder must be named.
    ``available_now`` works off what is there and ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not (checkpoint or root):
        raise ValueError("name a checkpoint folder or set spark.checkpoint.dir")
    location = checkpoint or f"{root.rstrip('/')}/queries/{name}"
    writer = writer.queryName(name).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def run_until_stopped(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait until any of the queries ends or the user interrupts, then stop all in order.

    A query that failed raises its error after the others are stopped.
    """
    try:
        spark.streams.resetTerminated()
        while all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination(10)
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
