"""Run one job from the command line: ``python -m weatherlake <job> ...``.

With ``--servers`` the input and output of a streaming job are topics; without, the input is
a folder of text files with one message per line and the output a folder of JSON text.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from weatherlake import constants
from weatherlake.functions.codec import accepted, decode_with_rejects, rejected
from weatherlake.functions.counting import Count
from weatherlake.operators import alerts, geo, records, reports, windows
from weatherlake.schemas import (
    CANDIDATE, ENRICHED_READING, FLAT_READING, FLAT_TRANSFORMED, READING, TRANSFORMED, TRANSFORMED_GEO,
)
from weatherlake.session import build_session, checkpoint_root
from weatherlake.sinks import files, topics
from weatherlake.sources.files import (
    has_history, history_files, read_alerts, read_json, skipped_history, stream_history, unreadable_alerts,
    usable_history,
)
from weatherlake.sources.labels import single_label
from weatherlake.sources.offsets import OffsetRecord, observe_offsets
from weatherlake.sources.topics import batch_topic, stream_topic, topic_tail
from weatherlake.streaming import jobs
from weatherlake.streaming.batches import (
    Sink, Totals, batch_label, every, json_sink, message_counters, split_writer, text_sink,
)
from weatherlake.streaming.metrics import TotalsListener, observe_sent


def _messages(spark: SparkSession, args) -> DataFrame:
    if args.servers:
        return stream_topic(spark, args.servers, args.input, args.starting, args.max_per_trigger)
    return spark.readStream.text(args.input)


def _update_writer(df: DataFrame, args, output_mode: str) -> DataStreamWriter:
    """Writer of a stream of windows as messages."""
    messages = jobs.messages_of(df)
    if args.servers:
        return topics.topic_writer(messages, args.servers, args.output, output_mode)
    if output_mode == "append":
        return messages.writeStream.format("text").option("path", args.output)
    # Files cannot take back a window they already hold, so each batch adds its changes.
    sink = text_sink(args.output)
    return messages.writeStream.outputMode(output_mode).foreachBatch(
        lambda batch, batch_id: sink(batch, batch_label(batch.sparkSession, batch_id))
    )


def _message_sink(args) -> Sink:
    """Messages to the topic or to a folder with one part per batch."""
    if args.servers:
        return lambda messages, _label: topics.write_topic(messages, args.servers, args.output)
    return text_sink(args.output)


def _rejects(spark: SparkSession, args) -> str:
    return args.rejects or f"{checkpoint_root(spark).rstrip('/')}/rejected/{args.job}"


def _run(spark: SparkSession, args, *writers: tuple[str, DataStreamWriter], totals: Totals | None = None) -> None:
    """Run a job's queries, by default one, and print the counters."""
    listener = TotalsListener(totals)
    spark.streams.addListener(listener)
    try:
        queries = [
            jobs.start(spark, writer, args.job + name, args.checkpoint and args.checkpoint + name, available_now=args.available_now)
            for name, writer in writers
        ]
        if args.available_now:
            for query in queries:
                query.awaitTermination()
        else:
            jobs.run_until_stopped(spark, *queries)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    for line in listener.counters.lines():
        print(line)


def _split(spark: SparkSession, args, schema, transform, sink: Sink, encode: bool = False) -> None:
    """Run a job whose one query writes its output and its dead letters."""
    totals = Totals()
    letters = text_sink(_rejects(spark, args))
    _run(spark, args, ("", split_writer(_messages(spark, args), schema, transform, sink, letters, totals, encode)), totals=totals)


def _print_all(table: DataFrame) -> None:
    """Every row, fetched partition by partition."""
    print(" | ".join(table.columns))
    for row in table.toLocalIterator():
        print(" | ".join(str(value) for value in row))


def classify(spark: SparkSession, args) -> None:
    if args.shape == "flat":
        return _split(spark, args, FLAT_READING, jobs.classified_flat, _message_sink(args), encode=True)
    schema = ENRICHED_READING if args.carry_geo else READING
    _split(spark, args, schema, lambda df: alerts.classify_readings(df, args.carry_geo), _message_sink(args), encode=True)


def transform(spark: SparkSession, args) -> None:
    _split(spark, args, FLAT_READING, alerts.transform_flat, _message_sink(args), encode=True)


def aggregate(spark: SparkSession, args) -> None:
    if not (args.watermark or args.unbounded):
        raise SystemExit("give --watermark, or --unbounded to keep the state of every window for ever")
    if args.closed and not args.watermark:
        raise SystemExit("--closed needs --watermark: without one no window ever closes")
    raw = _messages(spark, args)
    aggregates = jobs.aggregates_stream(raw, args.window, args.slide, args.watermark, panes=args.closed)
    letters = jobs.dead_letter_writer(raw, TRANSFORMED, _rejects(spark, args))
    writer = _update_writer(aggregates, args, "append" if args.closed else "update")
    _run(spark, args, ("", writer), ("-rejected", letters))


def tumbling(spark: SparkSession, args) -> None:
    """With ``--resume`` only messages that came after the last run are read, and each run adds its windows."""
    record = OffsetRecord(spark, args.resume) if args.resume else None
    ends = Observation()
    if not args.servers:
        raw = spark.read.text(args.input)
    elif record:
        raw = batch_topic(spark, args.servers, args.input, record.starting(args.input, args.partitions))
        raw = observe_offsets(raw, ends, args.partitions)
    else:
        raw = batch_topic(spark, args.servers, args.input)
    decoded = decode_with_rejects(raw, FLAT_TRANSFORMED)
    label = single_label("run", record.run if record else 0)
    messages = Count(decoded, *message_counters())
    json_sink(args.output)(windows.tumbling_aggregates(accepted(messages.rows)), label)
    counts = messages.get()
    if counts["rejected"]:
        text_sink(_rejects(spark, args))(rejected(decoded), label)
    if record and args.servers:
        record.advance(args.input, ends.get)
    print(f"messages: {counts['received']} received, {counts['rejected']} rejected")


def store_alerts(spark: SparkSession, args) -> None:
    schema = TRANSFORMED_GEO if args.carry_geo else TRANSFORMED
    sink = files.alert_store_sink(args.output)
    if args.merge_every:
        sink = files.merging_sink(sink, args.output, args.merge_every)
    _split(spark, args, schema, lambda df: df, sink)


def high_wind(spark: SparkSession, args) -> None:
    _split(spark, args, FLAT_TRANSFORMED, alerts.high_wind_rows, json_sink(args.output))


def enrich(spark: SparkSession, args) -> None:
    """Readings that name a place, to messages with the place; ``--places`` is read anew for every batch."""
    totals, rejects = Totals(), _rejects(spark, args)

    def places() -> DataFrame:
        return geo.resolve_cities(read_json(spark, args.places, CANDIDATE))

    writer = jobs.enriching_writer(
        _messages(spark, args), places, _message_sink(args), text_sink(rejects), json_sink(f"{rejects}-unresolved"), totals
    )
    _run(spark, args, ("", writer), totals=totals)


def history(spark: SparkSession, args) -> None:
    """New history documents to the store of documents and, as messages, to the topic or folder."""
    totals = Totals()
    send = _message_sink(args)

    def messages(documents: DataFrame, label: str) -> None:
        send(topics.keyed_messages(geo.stamped_history_messages(documents)), label)

    sinks = [messages]
    if args.store:
        sinks.append(lambda documents, _label: files.write_history(documents, args.store))
    writer = jobs.history_writer(stream_history(spark, args.input), every(*sinks), text_sink(_rejects(spark, args)), totals)
    _run(spark, args, ("", writer), totals=totals)


def climate_records(spark: SparkSession, args) -> None:
    documents = history_files(spark, args.input)
    read = Count(documents, F.count("*").alias("files"), F.count_if(~has_history()).alias("skipped"))
    # One row per city, and two outputs.
    found = records.climate_records(records.explode_history(usable_history(read.rows))).persist()
    try:
        written = Count(records.record_documents(found), F.count("*").alias("cities"))
        files.write_records(written.rows, args.output)
        cities, skipped = written.get()["cities"], read.get()["skipped"]
        if skipped:  # the files are named by another scan only where there are any
            for row in skipped_history(documents).select("file").toLocalIterator():
                print(f"skipped: {row.file}")
        if not cities:
            raise SystemExit(f"no usable history below {args.input} ({skipped} skipped)")
        print(f"records: {cities} cities, {skipped} skipped")
        if args.servers:
            sent = Observation()
            topics.write_topic(observe_sent(topics.keyed_messages(records.record_messages(found)), sent), args.servers, args.topic)
            print(f"messages: {sent.get['sent']} sent")
    finally:
        found.unpersist()


def report(spark: SparkSession, args) -> None:
    stored = read_alerts(spark, args.input, args.country, args.city)
    for title, table in (
        ("records per country", reports.records_per_country(stored)),
        ("top cities", reports.top_cities(stored)),
        ("countries and cities", reports.place_totals(stored)),
        ("temperature and wind", reports.reading_stats(stored)),
        ("alerts per level", reports.alert_level_counts(stored)),
        ("most frequent weather code", reports.top_weathercode_by_country(stored)),
        ("alerts per city", reports.alerts_per_city(stored)),
    ):
        print(title)
        _print_all(table)
    print(f"unreadable lines: {unreadable_alerts(spark, args.input).count()}")


def tail(spark: SparkSession, args) -> None:
    rows = topic_tail(stream_topic(spark, args.servers, args.input, "earliest"))
    _run(spark, args, ("", jobs.shared_writer(rows, jobs.print_batch)))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="weatherlake", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def add(name: str, function, topic_in: str | None = None, topic_out: str | None = None,
            stream: bool = True, writes: bool = True):
        command = commands.add_parser(name)
        command.set_defaults(function=function)
        command.add_argument("--servers")
        command.add_argument("--input", required=topic_in is None, default=topic_in)
        command.add_argument("--output", default=topic_out, required=topic_out is None and writes)
        command.add_argument("--rejects", help="folder for messages that do not decode")
        if stream:
            command.add_argument("--starting", default="latest", choices=["latest", "earliest"])
            command.add_argument("--max-per-trigger", type=int)
            command.add_argument("--checkpoint")
            command.add_argument("--available-now", action="store_true")
        return command

    command = add("classify", classify, constants.TOPIC_READINGS, constants.TOPIC_TRANSFORMED)
    command.add_argument("--shape", choices=["nested", "flat"], default="nested")
    command.add_argument("--carry-geo", action="store_true")
    add("transform", transform, constants.TOPIC_CURRENT, constants.TOPIC_TRANSFORMED)
    command = add("aggregate", aggregate, constants.TOPIC_TRANSFORMED, constants.TOPIC_AGGREGATES)
    command.add_argument("--window", default=constants.SLIDING_WINDOW)
    command.add_argument("--slide", default=constants.SLIDING_STEP)
    command.add_argument("--watermark")
    command.add_argument("--unbounded", action="store_true")
    command.add_argument("--closed", action="store_true", help="send each window once, when the watermark has closed it")
    command = add("tumbling", tumbling, constants.TOPIC_TRANSFORMED, stream=False)
    command.add_argument("--resume", help="folder that keeps the topic offsets up to which earlier runs have read")
    command.add_argument("--partitions", type=int, default=1, help="partitions of the topic, for --resume")
    command = add("store-alerts", store_alerts, constants.TOPIC_TRANSFORMED)
    command.add_argument("--carry-geo", action="store_true")
    command.add_argument("--merge-every", type=int, help="merge the files of each place every so many batches")
    command = add("enrich", enrich, constants.TOPIC_REQUESTED, constants.TOPIC_READINGS)
    command.add_argument("--places", required=True, help="folder of place candidates, one JSON object per line")
    command = add("history", history, topic_out=constants.TOPIC_HISTORY)
    command.add_argument("--store", help="folder of the raw history documents by place")
    add("high-wind", high_wind, constants.TOPIC_TRANSFORMED)
    add("records", climate_records, stream=False).add_argument("--topic", default=constants.TOPIC_RECORDS)
    command = add("report", report, stream=False, writes=False)
    command.add_argument("--country")
    command.add_argument("--city")
    add("tail", tail, constants.TOPIC_READINGS, writes=False)
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    args.function(spark or build_session(f"weatherlake-{args.job}"), args)


if __name__ == "__main__":
    main()
