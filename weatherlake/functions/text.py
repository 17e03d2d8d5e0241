"""Names, keys and text tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weatherlake.constants import COORD_PREFIX, TRUE_WORDS, UNKNOWN_PLACE
from weatherlake.functions.levels import or_default


def path_safe(name: str | Column) -> Column:
    """A place name usable as one folder name: space and slash become underscores, an empty name ``Unknown``."""
    name = F.col(name) if isinstance(name, str) else name
    return F.translate(F.when(name == "", F.lit(UNKNOWN_PLACE)).otherwise(name), " /", "__")


def place_digest(*keys: str) -> Column:
    """Folder name that differs wherever the raw keys differ; NULL and empty text are different keys."""
    named = F.struct(*[F.col(key).cast("string").alias(f"k{i}") for i, key in enumerate(keys)])
    return F.substring(F.sha2(F.to_json(named).cast("binary"), 256), 1, 16)


def contains_ignoring_case(text: str | Column, part: str | Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def place_label(city: str = "city", country: str = "country") -> Column:
    return F.concat_ws(", ", or_default(city, UNKNOWN_PLACE), or_default(country, UNKNOWN_PLACE))


def place_key(country_code: str = "country_code", city: str = "city") -> Column:
    """Message key that keeps one city's messages in one topic partition."""
    return F.concat_ws("_", or_default(country_code, ""), or_default(city, ""))


def coordinate_key(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    return F.concat(F.col(latitude).cast("string"), F.lit("_"), F.col(longitude).cast("string"))


def coordinate_name(coordinate: str) -> Column:
    """Stand-in for a missing place name; a missing coordinate counts as 0."""
    return F.concat(F.lit(COORD_PREFIX), or_default(F.col(coordinate).cast("string"), "0"))


def truth(column: str | Column) -> Column:
    """Boolean from a boolean, ``1`` or ``true`` in any case; NULL stays NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.lower(value.cast("string")).isin(*TRUE_WORDS)
