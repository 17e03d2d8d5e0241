"""Message topics, read as streams or as bounded tables.

The connector is the separate package ``org.apache.spark:spark-sql-kafka-0-10`` of the
running Spark version; it is named by the submitting user, not here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TOPIC_METADATA = ("topic", "partition", "offset", "timestamp")


def topic_options(
    servers: str, topic: str, starting: str, max_per_trigger: int | None = None, ending: str | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if ending is not None:
        options["endingOffsets"] = ending
    return options


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded read.  ``starting`` counts on the first start only: afterwards the query's
    checkpoint holds the offsets, which is what a consumer group's commits did."""
    options = topic_options(servers, topic, starting, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def batch_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Bounded read up to the newest message."""
    return spark.read.format("kafka").options(**topic_options(servers, topic, starting, ending="latest")).load()


def topic_tail(messages: DataFrame) -> DataFrame:
    """Metadata, key and normalised JSON value of each message; other text gives NULL."""
    present = [name for name in TOPIC_METADATA if name in messages.columns]
    value = F.to_json(F.try_parse_json(F.col("value").cast("string")))
    return messages.select(*present, F.col("key").cast("string").alias("key"), value.alias("value"))
