"""Labels of batches in a store, and which of them count.

A batch of a query is filed under ``<query>-<number>``.  Merging files the rows of consecutive batches once more under
``<query>-<first>-<last>`` and then sets a mark, an empty file ``_merged/<query>-<last>``.  The mark switches all
readers at once: below it merged folders count, above it single batches do.  What a failed merge left
lies above the mark and is not seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession, functions as F

MARKS = "_merged"
DIGITS = 10


def single_label(query: str, number: int) -> str:
    return f"{query}-{number:0{DIGITS}d}"


def merged_label(query: str, first: int, last: int) -> str:
    return f"{query}-{first:0{DIGITS}d}-{last:0{DIGITS}d}"


def file_system(spark: SparkSession, path: str):
    """Hadoop path and the file system that holds it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def merged_upto(spark: SparkSession, root: str) -> dict[str, int]:
    """Last merged batch of each query that writes to the store; there is one mark per query."""
    folder, system = file_system(spark, f"{root.rstrip('/')}/{MARKS}")
    if not system.exists(folder):
        return {}
    marks = [status.getPath().getName() for status in system.listStatus(folder)]
    found: dict[str, int] = {}
    for mark in marks:
        query, number = mark.rsplit("-", 1)
        found[query] = max(found.get(query, -1), int(number))
    return found


def singles(query: str, first: int, last: int, label: str = "batch") -> Column:
    """Whether a row was filed by one of these batches of the query."""
    column = F.col(label)
    own = column.between(single_label(query, first), single_label(query, last))
    return own & (F.length(column) == len(single_label(query, 0)))


def live(upto: dict[str, int], label: str = "batch") -> Column:
    """Whether a row's label counts; on a partition column this prunes folders.  Other labels always count."""

    def counts(query: str, last: int) -> Column:
        column = F.col(label)
        merged = column.startswith(f"{query}-") & (F.length(column) == len(merged_label(query, 0, 0)))
        unmarked = merged & (F.right(column, F.lit(DIGITS)) > f"{last:0{DIGITS}d}")
        return ~(singles(query, 0, last, label) | unmarked)

    every = reduce(lambda a, b: a & b, [counts(*mark) for mark in upto.items()], F.lit(True))
    return F.coalesce(every, F.lit(True))
