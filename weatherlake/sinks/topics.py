"""Writing messages to topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from weatherlake.functions.codec import encode_json
from weatherlake.functions.text import place_key


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a bounded table of ``key, value`` rows straight from the executors."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def topic_writer(messages: DataFrame, servers: str, topic: str, output_mode: str = "append") -> DataStreamWriter:
    """Stream writer; ``update`` re-sends a window whenever it changes."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .outputMode(output_mode)
    )


def keyed_messages(documents: DataFrame) -> DataFrame:
    """JSON message of each document under its place key."""
    return encode_json(documents, place_key())
