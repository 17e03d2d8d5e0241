"""A corpus pipeline: toxicity, exact dedup, near dedup, source mix, token encoding.

Every stage takes all rows its predecessor kept and, but for the last, returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.llm import toxicity
from weatherlake.llm.bpe import encode_decode
from weatherlake.llm.common import fold_of, keep, lower_ascii, table
from weatherlake.llm.exact_dedup import exact_dedup
from weatherlake.llm.mixing import mix
from weatherlake.llm.near_dedup import near_duplicates
from weatherlake.llm.queries import VOCABULARY, token_digests

KEY = "__row_key"


def _key(digest: Column) -> Column:
    """Names a row by id and text; rows that agree in both are interchangeable."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), digest)


def _chosen(docs: DataFrame, key: Column, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key in ``chosen``; join and grouping share one shuffle."""
    keyed = docs.withColumn(KEY, key).join(chosen, KEY, "left_semi")
    return keyed.dropDuplicates([KEY]).drop(KEY)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the rejection threshold of their language."""
    labels = table(spark, sf_dir, "labels").filter(fold_of(F.col("doc_id"), 5) != 0)
    return toxicity.clean(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    stay = exact_dedup(docs).filter("kept").select(_key(F.col("text_sha256")).alias(KEY))
    return _chosen(docs, _key(F.sha2(lower_ascii(F.col("text")).cast("binary"), 256)), stay)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the least doc_id."""
    stay = near_duplicates(docs).filter("kept").select(_key(F.col("text_md5")).alias(KEY))
    return _chosen(docs, _key(F.md5(F.coalesce("text", F.lit("")).cast("binary"))), stay)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mix(docs).groupBy(_key(F.col("text_hash").cast("string")).alias(KEY)).agg(F.sum("copies").alias("__copies"))
    keyed = docs.withColumn(KEY, _key(F.xxhash64("text").cast("string"))).join(taken.filter("__copies > 0"), KEY)
    once = keyed.dropDuplicates([KEY])
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy")
    return once.select(*[once[c] for c in docs.columns], copies).drop("__copy")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return token_digests(encode_decode(docs, VOCABULARY), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("bpe_codec", encode_tokens),
]
# Trained scores and sampled signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
