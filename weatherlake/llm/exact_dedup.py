"""Exact deduplication by content-defined chunk recipes.

A text is cut where a rolling hash of its last 16 bytes says so, each chunk is named by a digest,
and a text becomes the ordered list of its chunks' names.  Names are verified: each distinct pair of
name and content is counted once, and where one name stands for several contents the
occurrences get an ordinal besides.  Chunk contents are shuffled once, with copies
combined before; whole texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from weatherlake.functions.joins import lookup_join
from weatherlake.llm.common import in_small_batches, keep
from weatherlake.llm.words import slices, text_batches

LEAST, MOST, BITS, PAD = 128, 8192, 9, 16
DIGEST_BYTES = 16
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalised(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower changes A-Z only


def cut_points(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text."""
    buf = np.frombuffer(bytes(PAD).join([b"", *texts]), dtype=np.uint8)
    h = _GEAR[buf]
    for shift in (1, 2, 4, 8):
        h[shift:] += h[:-shift] << np.uint32(shift)  # numpy buffers the overlapping operand
    marks = np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + 1
    out, start = [], 0
    for text in texts:
        start += PAD
        n, at, cuts = len(text), 0, []
        low, high = np.searchsorted(marks, (start + 1, start + n))
        for mark in (*(marks[low:high] - start).tolist(), n):
            while mark - at > MOST:
                at += MOST
                cuts.append(at)
            if mark - at >= LEAST or mark == n > at:
                at = mark
                cuts.append(at)
        out.append(cuts)
        start += n
    return out


def _chunked(column: pa.Array) -> Iterator[tuple[bytes, list[bytes]]]:
    """Normalised text and chunks of each row."""
    texts = [normalised(t) for t in column.to_pylist()]
    for a, b in text_batches([len(t) for t in texts], 1 << 18):
        for text, cuts in zip(texts[a:b], cut_points(texts[a:b])):
            yield text, [text[i:j] for i, j in zip((0, *cuts), cuts)]


def _recipes(digest_bytes: int):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            names, shas = [], []
            for text, chunks in _chunked(batch.column("_text")):
                names.append([hashlib.blake2b(c, digest_size=digest_bytes).digest() for c in chunks])
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.list_(pa.binary())), pa.array(shas, pa.string())],
                ["doc_id", "recipe", "text_sha256"],
            )

    return run


def _contents(digest_bytes: int):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            seen = {c for _, chunks in _chunked(batch.column("_text")) for c in chunks}
            names = [hashlib.blake2b(c, digest_size=digest_bytes).digest() for c in seen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(list(seen), pa.binary())], ["name", "content"]
            )

    return run


def _occurrences(digest_bytes: int):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            ids = batch.column("doc_id").to_pylist()
            rows = [
                (doc_id, hashlib.sha256(text).hexdigest(), i, hashlib.blake2b(c, digest_size=digest_bytes).digest(), c)
                for doc_id, (text, chunks) in zip(ids, _chunked(batch.column("_text")))
                for i, c in enumerate(chunks)
            ]
            kinds = [batch.schema.field("doc_id").type, pa.string(), pa.int32(), pa.binary(), pa.binary()]
            arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_sha256", "place", "name", "content"])

    return run


def recipes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """doc_id, recipe (verified chunk names in order), ordinals (of names with several contents), text_sha256."""
    rows = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    docs = rows.mapInArrow(_recipes(digest_bytes), f"doc_id {kind}, recipe array<binary>, text_sha256 string")
    docs = keep(docs, "recipes")
    contents = rows.select("_text").mapInArrow(_contents(digest_bytes), "name binary, content binary").distinct()
    shared = keep(contents.groupBy("name").count().filter("count > 1").select("name"), "shared-names")
    none = F.array().cast("array<struct<place:int,ordinal:int>>")
    if shared.isEmpty():
        return docs.withColumn("ordinals", none)
    # One name, several contents: number the contents, and note the number at each place.
    numbered = contents.join(shared, "name").withColumn(
        "ordinal", F.row_number().over(W.partitionBy("name").orderBy("content"))
    )
    places = rows.mapInArrow(
        _occurrences(digest_bytes), f"doc_id {kind}, text_sha256 string, place int, name binary, content binary"
    )
    places = lookup_join(places, numbered, ["name", "content"]).dropDuplicates(["doc_id", "text_sha256", "place"])
    listed = F.sort_array(F.collect_list(F.struct("place", "ordinal"))).alias("ordinals")
    listed = places.groupBy("doc_id", "text_sha256").agg(listed).withColumnsRenamed({"doc_id": "_i", "text_sha256": "_t"})
    same = F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("text_sha256") == F.col("_t"))
    return docs.join(listed, same, "left").drop("_i", "_t").withColumn("ordinals", F.coalesce("ordinals", none))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The row with the largest id
    stays.  Of repeated rows with that id one stays.  Null ids lose to any other; in a group of
    null ids only, one row stays and keep_id is null.  Other columns are left out.
    """
    docs = recipes(df, id_col, text_col, digest_bytes)
    # Repeated rows are folded first, so that a hot group is summed in parts.
    rows = docs.groupBy("doc_id", "recipe", "ordinals", "text_sha256").agg(F.count(F.lit(1)).alias("_copies"))
    groups = rows.groupBy("recipe", "ordinals").agg(
        F.max("doc_id").alias("keep_id"), F.sum("_copies").alias("group_size")
    )
    joined = lookup_join(rows, groups, ["recipe", "ordinals"])
    joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
