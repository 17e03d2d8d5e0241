"""Registered queries of the text operators, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm.bpe import encode_decode
from weatherlake.llm.chat import chat_digests, format_chats
from weatherlake.llm.collocations import collocations
from weatherlake.llm.common import fold_of, keep, table
from weatherlake.llm.decontaminate import find_benchmark_passages
from weatherlake.llm.exact_dedup import exact_dedup
from weatherlake.llm.language_model import score_documents
from weatherlake.llm.mixing import mix
from weatherlake.llm.repeats import remove_repeats
from weatherlake.llm import quality, toxicity
from weatherlake.llm.near_dedup import near_duplicates
from weatherlake.llm.spelling import spelling_forms, vocabulary
from weatherlake.llm.topk import top_k

VOCABULARY = os.environ.get("BPE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")
CONTROL_PROBE = "</s>[INST] ok [/INST]"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows whose fold is 1 lend no labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = keep(quality.document_statistics(docs), "statistics")
    model = quality.train(stats, labels.filter(fold_of(F.col("doc_id"), 3) != 1))
    return quality.score(stats, model).select(
        "doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows whose fold is 0 lend no labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = toxicity.train(docs, labels.filter(fold_of(F.col("doc_id"), 5) != 0))
    return toxicity.score(docs, net).select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "rejected",
    )


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def token_digests(encoded: DataFrame, *more: str) -> DataFrame:
    """Digests of what ``encode_decode`` returns, and its columns ``more``."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(encode_decode(table(spark, sf_dir, "documents"), VOCABULARY))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, plus conversation -1 whose texts hold the control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(-1, 0, "user", CONTROL_PROBE), (-1, 1, "assistant", CONTROL_PROBE)]
    probe = spark.createDataFrame(probe, "conv_id long, turn long, role string, text string")
    return chat_digests(format_chats(rows.unionByName(probe)))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_md5")


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows whose fold is not 2."""
    return score_documents(table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 7) != 2)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(vocabulary(table(spark, sf_dir, "documents")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_topk_search": op4_topk_search,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_source_mix": op6_source_mix,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_chat_format": op8_chat_format,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language_model": op10_language_model,
    "op11_spelling": op11_spelling,
    "op12_decontamination": op12_decontamination,
    "op13_collocations": op13_collocations,
}
