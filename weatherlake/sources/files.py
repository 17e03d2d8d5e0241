"""File readers: CSV, JSON, Parquet, history documents and stored alerts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weatherlake.constants import HISTORY_FILE
from weatherlake.functions.text import path_safe
from weatherlake.functions.times import parse_time
from weatherlake.sources.labels import live, merged_upto
from weatherlake.schemas import CORRUPT_COLUMN, HISTORY_DOCUMENT, STORED_ALERT, with_corrupt_column

# Raw downloads by their name, stored documents by the folder of their place.
HISTORY_PATHS = f"/{re.escape(HISTORY_FILE)}$|/place=[0-9a-f]{{16}}/part-[^/]*$"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    schema: StructType | None = None,
    infer: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """CSV from a file, folder or glob.

    Without ``schema`` and ``infer`` every column is text; inference costs an extra scan,
    so large tables should pass a schema.
    """
    reader = spark.read.option("header", header).option("recursiveFileLookup", recursive)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def history_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per history file below ``root``: the document, its file and, where it is broken, its text.

    A file is either a raw download or one written by ``sinks.files.write_history``; both hold one
    document, so one listing and one scan read both layouts.  Other files are none of ours.
    """
    files = (
        spark.read.schema(with_corrupt_column(HISTORY_DOCUMENT))
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"{{{HISTORY_FILE},part-*}}")
        .json(root)
        .withColumn("file", F.input_file_name())
    )
    return files.filter(F.col("file").rlike(HISTORY_PATHS))


def stream_history(spark: SparkSession, root: str) -> DataFrame:
    """``history_files`` as a stream: every file once, as it appears."""
    files = (
        spark.readStream.schema(with_corrupt_column(HISTORY_DOCUMENT))
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", HISTORY_FILE)
        .json(root)
    )
    return files.withColumn("file", F.input_file_name())


def has_history() -> Column:
    """Whether a row of ``history_files`` is a usable document."""
    return F.col(CORRUPT_COLUMN).isNull() & F.col("geocode_info").isNotNull() & F.col("historical_data").isNotNull()


def usable_history(files: DataFrame) -> DataFrame:
    return files.filter(has_history()).drop(CORRUPT_COLUMN, "file")


def skipped_history(files: DataFrame) -> DataFrame:
    """``file`` and ``text`` of what is not JSON or lacks one of its two parts: the skip report."""
    return files.filter(~has_history()).select("file", F.col(CORRUPT_COLUMN).alias("text"))


def read_history(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The usable history documents below ``root`` and the files that hold none.

    Files are parsed by the tasks that read them; an empty folder gives empty tables.
    """
    files = history_files(spark, root)
    return usable_history(files), skipped_history(files)


def _alert_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the store that count; an alert parses and has a place (the writer sees to that)."""
    lines = spark.read.schema(with_corrupt_column(STORED_ALERT)).json(root)
    upto = merged_upto(spark, root)
    return lines.filter(live(upto)) if upto else lines


def read_alerts(
    spark: SparkSession, root: str, country: str | None = None, city: str | None = None
) -> DataFrame:
    """Stored alerts, all of them or (with both names) those of one city.

    The names select folders, so one city reads only its own files, and then the raw names, since
    several names can share a folder.  Lines that are no alert are left out
    (``unreadable_alerts`` gives them).  ``datetime`` is the parsed event time, NULL where the
    text is not a time.
    """
    alerts = _alert_lines(spark, root)
    if country and city:
        alerts = alerts.filter(
            (F.col("country_path") == path_safe(F.lit(country))) & (F.col("city_path") == path_safe(F.lit(city)))
            & (F.col("country") == country) & (F.col("city") == city)
        )
    alerts = alerts.filter(F.col(CORRUPT_COLUMN).isNull() & F.col("country").isNotNull()).drop(CORRUPT_COLUMN)
    return alerts.withColumn("datetime", parse_time("event_time"))


def unreadable_alerts(spark: SparkSession, root: str) -> DataFrame:
    """Text and folders of the lines in the alert store that are no alert."""
    bad = _alert_lines(spark, root).filter(F.col(CORRUPT_COLUMN).isNotNull() | F.col("country").isNull())
    return bad.select("country_path", "city_path", F.col(CORRUPT_COLUMN).alias("text"))
