"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in a grouping."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of a large table with a table that has one row per key; NULL keys match each other.

    While the lookup's measured size allows it Spark broadcasts it.  Beyond that AQE splits
    the shuffle partitions of hot keys, but only where both sides come straight from a
    shuffle made for this join.  A lookup that was just grouped by the same keys would skip
    that shuffle, and one task would get the hot key whole; the hash as a further key
    keeps the shuffle (of the small side) in place.
    """
    facts = facts.withColumn("_probe", F.xxhash64(*keys))
    lookup = lookup.withColumn("_probe", F.xxhash64(*keys))
    return join_null_safe(facts, lookup, [*keys, "_probe"]).drop("_probe")
