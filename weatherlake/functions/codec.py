"""JSON messages to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from weatherlake.schemas import CORRUPT_COLUMN, with_corrupt_column


def decode_json(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """One column per field; undecodable text gives a row of NULLs."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")


def decode_json_sql(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """``decode_json`` written as SQL expression strings."""
    ddl = schema.toDDL().replace("'", "\\'")
    return df.selectExpr(f"from_json(CAST({value} AS STRING), '{ddl}') AS data").selectExpr("data.*")


def parsed_columns(df: DataFrame, text: Column, schema: StructType, *keep: Column, **options: str) -> DataFrame:
    """Kept columns followed by the fields of the JSON ``text``, parsed once per row.

    The fields come out of a generator rather than a projection: filters on projected
    fields are pushed below the projection and would parse the text a second time.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema, options))))


def decode_with_rejects(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """``decode_json`` plus a column holding the text of messages that are no JSON object.

    A field whose value does not fit its type is NULL and the message is kept.  A missing or
    blank message is a reject; its reject text is empty or blank.
    """
    text = F.col(value).cast("string")
    fields = parsed_columns(
        df, text, with_corrupt_column(schema), text.alias("_text"), columnNameOfCorruptRecord=CORRUPT_COLUMN
    )
    blank = F.coalesce(F.trim("_text"), F.lit("")) == ""
    # The parser marks misfit fields and broken text alike; only marked messages are looked at again.
    is_object = F.ltrim("_text").startswith("{") & F.try_parse_json("_text").isNotNull()
    broken = F.col(CORRUPT_COLUMN).isNotNull() & ~is_object
    reject = F.when(blank, F.coalesce("_text", F.lit(""))).when(broken, F.col("_text"))
    return fields.withColumn(CORRUPT_COLUMN, reject).drop("_text")


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def rejected(decoded: DataFrame) -> DataFrame:
    """Dead letters: the raw text of every message that did not decode."""
    return decoded.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(F.col(CORRUPT_COLUMN).alias("value"))


def encode_json(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Whole row as JSON ``value`` (NULL fields are left out), with an optional ``key``."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(key.alias("key"), value)


def encode_json_sql(df: DataFrame) -> DataFrame:
    """``encode_json`` written as an SQL expression string."""
    return df.selectExpr("to_json(struct(*)) AS value")
