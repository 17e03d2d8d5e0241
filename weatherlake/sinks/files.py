"""File writers.

Tables stored by place are written one folder per country and city.  A rebalance before
the write gathers each place in few files but lets AQE split a place that holds much more
than the rest over several tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.functions.text import path_safe, place_digest
from weatherlake.operators.alerts import alerts_to_store, stamp_saved
from weatherlake.operators.records import CITY_KEYS, stamp_computed
from weatherlake.sources.labels import DIGITS, MARKS, file_system, merged_label, merged_upto, single_label, singles
from weatherlake.streaming.batches import BATCH_FOLDER, Sink, place_sink

PLACE_FOLDERS = ("country_path", "city_path")
PLACE_FOLDER = "place"
# What makes a city of the history store one city.
HISTORY_KEYS = ("geocode_info.country", "geocode_info.city", "geocode_info.country_code", "geocode_info.admin1")


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
              single_file: bool = False) -> None:
    """``single_file`` funnels the whole table through one task: small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.csv(path, header=header, mode=mode)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.parquet(path, mode=mode)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.json(path, mode=mode)


def append_alerts(classified: DataFrame, path: str) -> None:
    """Append the alerts of a bounded table to the alert store."""
    placed = stamp_saved(alerts_to_store(classified)).hint("rebalance", *PLACE_FOLDERS)
    label = f"append-{uuid.uuid4().hex}"
    placed.withColumn(BATCH_FOLDER, F.lit(label)).write.mode("append").partitionBy(*PLACE_FOLDERS, BATCH_FOLDER).json(path)


def alert_store_sink(path: str) -> Sink:
    """Files the alerts among classified rows by place; a batch that comes again replaces its own files only."""
    write = place_sink(path, PLACE_FOLDERS)
    return lambda classified, label: write(stamp_saved(alerts_to_store(classified)), label)


def merge_batches(spark: SparkSession, path: str, query: str, last: int) -> int:
    """File the rows of a query's batches up to ``last`` once per place instead of once per place and batch.

    Lines are copied as they are.  Readers change over when the mark is set; the
    folders that the mark before this one had replaced are deleted now, so a reader that began
    earlier still finds its files.  Returns the first batch merged, or -1 if there was nothing to do.
    """
    before = merged_upto(spark, path).get(query, -1)
    if last <= before:
        return -1
    schema = f"value STRING, {', '.join(f'{name} STRING' for name in (*PLACE_FOLDERS, BATCH_FOLDER))}"
    lines = spark.read.schema(schema).text(path).filter(singles(query, before + 1, last)).drop(BATCH_FOLDER)
    labelled = lines.hint("rebalance", *PLACE_FOLDERS).withColumn(BATCH_FOLDER, F.lit(merged_label(query, before + 1, last)))
    writer = labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PLACE_FOLDERS, BATCH_FOLDER).text(path)
    mark, system = file_system(spark, f"{path.rstrip('/')}/{MARKS}/{single_label(query, last)}")
    system.create(mark, True).close()
    if before >= 0:
        _delete_replaced(spark, path, query, before)
    return before + 1


def _delete_replaced(spark: SparkSession, path: str, query: str, upto: int) -> None:
    """Delete the folders of single batches up to ``upto`` and the mark that replaced them."""
    folders = "/".join(f"{name}=*" for name in PLACE_FOLDERS)
    digits = "[0-9]" * DIGITS
    pattern, system = file_system(spark, f"{path.rstrip('/')}/{folders}/{BATCH_FOLDER}={query}-{digits}")
    for status in system.globStatus(pattern):
        if int(status.getPath().getName().rsplit("-", 1)[1]) <= upto:
            system.delete(status.getPath(), True)
    system.delete(file_system(spark, f"{path.rstrip('/')}/{MARKS}/{single_label(query, upto)}")[0], False)


def merging_sink(sink: Sink, path: str, every: int) -> Sink:
    """``sink``, and after each ``every`` batches a merge of what they wrote; no other query may write under the same id."""

    def write(df: DataFrame, label: str) -> None:
        sink(df, label)
        query, number = label.rsplit("-", 1)
        if (int(number) + 1) % every == 0:
            merge_batches(df.sparkSession, path, query, int(number))

    return write


def _replace_places(documents: DataFrame, country: str, city: str, keys: Sequence[str], path: str) -> None:
    """Write one folder per place, replacing those of the places in this run and no others.

    Different names may give the same two folder names (``A/B``, ``A B`` and ``A_B`` do), so a third folder
    below them is named by a digest of the raw key: no place can remove another's document.
    """
    placed = documents.withColumns(
        {"country_path": path_safe(country), "city_path": path_safe(city), PLACE_FOLDER: place_digest(*keys)}
    )
    folders = (*PLACE_FOLDERS, PLACE_FOLDER)
    writer = placed.hint("rebalance", *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).json(path)


def write_records(documents: DataFrame, path: str) -> None:
    """One record document per city (all of ``CITY_KEYS``), replacing that city's previous one."""
    _replace_places(stamp_computed(documents), "country", "city", CITY_KEYS, path)


def write_history(documents: DataFrame, path: str) -> None:
    """One raw history document per city (``HISTORY_KEYS``), replacing that city's previous one.

    Of several documents of a city the one downloaded last stays.  A file holds one document.
    """
    age = [F.col("downloaded_at")] if "downloaded_at" in documents.columns else []
    newest = F.max_by(F.struct(*documents.columns), F.struct(*age, F.to_json("historical_data"))).alias("document")
    one = documents.groupBy(place_digest(*HISTORY_KEYS).alias(PLACE_FOLDER)).agg(newest).select("document.*")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    _replace_places(one.withColumn("downloaded_at", stamp), "geocode_info.country", "geocode_info.city", HISTORY_KEYS, path)


def to_small_pandas(df: DataFrame, limit: int):
    """Local frame of a result of at most ``limit`` rows; refuses a larger one instead of cutting it."""
    frame = df.limit(limit + 1).toPandas()
    if len(frame) > limit:
        raise ValueError(f"more than {limit} rows: aggregate further or write the table instead")
    return frame
