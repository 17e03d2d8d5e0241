"""Removal of repeated passages: bytes covered by a string of ``WINDOW`` bytes that also starts earlier.

All strings of that length are compared, but never written out.  At depth K each of them is represented by
an anchor, the K-gram of least hash inside it, so that equal strings have equal anchors.  Neighbouring
strings with one anchor form a span.  The task that reads a batch sorts its spans by anchor and content; these
sorted runs are merged by hash shard into blocks of equal anchor (a common prefix of K bytes around which
the strings agree) and of equal content.  Of spans with equal content all but the earliest are repeats; a
block with a single content is settled.  Only the earliest spans of blocks with several contents are refined
at the next depth, and at K = WINDOW a block is exactly one repeated string.

A frequent passage costs one entry per batch, so no shard grows with the number of its copies.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.common import in_small_batches, keep
from weatherlake.llm.words import _mix, _powers, encoded, give_back, slices, text_batches
from weatherlake.session import checkpoint_root

WINDOW = 100
DEPTHS = (28, 64, WINDOW)
PIECE = 1 << 20
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 1 << 16
SHARD_BYTES = 6 << 20
LAST = (1 << 63) - 1
_BYTES = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.uint64((1 << 21) - 1)


def spans_of(pieces: list[bytes], depth: int):
    """Spans of all pieces: piece, first and last start of a string, anchor hash and content hash."""
    buf = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    n, width = len(buf), WINDOW - depth + 1
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[:n], out=sums[1:])
    gram = _mix((sums[depth:] - sums[:-depth]) * down[: n - depth + 1])
    # The place in the low bits makes the leftmost of equal K-grams the least.
    least, done = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64), 1
    while done * 2 <= width:
        least, done = np.minimum(least[:-done], least[done:]), done * 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    anchor = (least & _PLACE).astype(np.int64)
    ends = np.cumsum([len(p) for p in pieces])
    start = np.arange(len(anchor))
    piece = np.searchsorted(ends, start, side="right")
    inside = start + WINDOW <= ends[piece]
    start, anchor, piece = start[inside], anchor[inside], piece[inside]
    if not len(start):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))))
    low, high = start[first], start[np.append(first[1:], len(start)) - 1]
    anchor, piece = anchor[first], piece[first]
    shape = ((high - low) << 8 | (anchor - low)).astype(np.uint64)
    content = _mix((sums[high + WINDOW] - sums[low]) * down[low] + shape * np.uint64(0xD6E8FEB86659FD93))
    offset = (ends - [len(p) for p in pieces])[piece]
    return piece, low - offset, high - offset, gram[anchor], content


FIELDS = (("anchor", np.uint64), ("content", np.uint64), ("doc_id", np.int64), ("rid", np.int64), ("low", np.int64), ("span", np.uint16))
PACKED = "shard int, " + ", ".join(f"{name} binary" for name, _ in FIELDS) + ", copies binary"


def _requests(depth: int, shards: int):
    """Packed spans by shard; of equal content in a batch only the earliest, the others as ``copies``."""

    def run(batches):
        for rows in (part for batch in batches for part in slices(batch, "content", 1 << 20)):
            texts, names = rows.column("content").to_pylist(), (rows.column("doc_id").to_pylist(), rows.column("rid").to_pylist(), rows.column("at").to_pylist())
            parts, owners, bases = [], [], []
            for i, text in enumerate(texts):
                for a in range(0, max(len(text) - WINDOW + 1, 0), PIECE):  # strings that start in this piece
                    parts.append(text[a : a + PIECE + WINDOW - 1])
                    owners.append(i)
                    bases.append(a)
            found = []
            for a, b in text_batches([len(p) for p in parts], 1 << 18):
                piece, low, high, anchor, content = spans_of(parts[a:b], depth)
                found.append((np.array(owners[a:b], dtype=np.int64)[piece], low + np.array(bases[a:b], dtype=np.int64)[piece], high - low, anchor, content))
            if not found:
                continue
            owner, low, span, anchor, content = (np.concatenate(f) for f in zip(*found))
            doc_id, rid, at = (np.array(x, dtype=np.int64) for x in names)
            low = low + at[owner]
            doc_id, rid = doc_id[owner], rid[owner]
            order = np.lexsort((low, rid, doc_id, content, anchor))
            columns = dict(zip([f for f, _ in FIELDS], (x[order] for x in (anchor, content, doc_id, rid, low, span))))
            a, c = columns["anchor"], columns["content"]
            first = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]))) if len(a) else np.zeros(0, bool)
            shard = ((a >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            out = []
            for s, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if i < j:
                    here = first[i:j]
                    packed = [columns[f][i:j][here].astype(kind).tobytes() for f, kind in FIELDS]
                    copies = np.stack([columns[f][i:j][~here] for f in ("rid", "low", "span")]).astype(np.int64)
                    out.append((s, *packed, copies.tobytes()))
            kinds = [pa.int32(), *[pa.binary()] * (len(FIELDS) + 1)]
            arrays = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", *[f for f, _ in FIELDS], "copies"])
        give_back()

    return run


SETTLED = "rid long, low long, span int, repeat boolean"


def _settle(table: pa.Table) -> pa.Table:
    """Repeats, and (repeat false) the earliest spans of blocks with several contents."""
    c = {f: np.concatenate([np.frombuffer(b, dtype=kind) for b in table.column(f).to_pylist()]) for f, kind in FIELDS}
    order = np.lexsort((c["low"], c["rid"], c["doc_id"], c["content"], c["anchor"]))
    c = {f: v[order] for f, v in c.items()}
    new_block = np.concatenate(([True], c["anchor"][1:] != c["anchor"][:-1]))
    first = new_block | np.concatenate(([True], c["content"][1:] != c["content"][:-1]))
    contents = np.bincount(np.cumsum(new_block) - 1, weights=first)
    several = first & (contents[np.cumsum(new_block) - 1] > 1)
    copies = [np.frombuffer(b, dtype=np.int64).reshape(3, -1) for b in table.column("copies").to_pylist()]
    copies = np.concatenate(copies, axis=1)
    told = ~first | several
    rid, low, span = (np.concatenate([c[f][told].astype(np.int64), copies[i]]) for i, f in enumerate(("rid", "low", "span")))
    repeat = np.concatenate([~first[told], np.ones(copies.shape[1], dtype=bool)])
    found = {"rid": pa.array(rid), "low": pa.array(low), "span": pa.array(span, pa.int32()), "repeat": pa.array(repeat)}
    del c, order, copies, rid, low, span
    give_back()
    return pa.table(found)


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """The bytes of the spans on the right, from the pieces on the left that hold them."""
    pieces = sorted(zip(*(left.column(f).to_pylist() for f in ("rid", "at", "doc_id", "content"))), key=lambda p: p[:2])
    spans = sorted(zip(*(right.column(f).to_pylist() for f in ("rid", "low", "span"))))
    out, i = [], 0
    for rid, low, span in spans:
        while i + 1 < len(pieces) and pieces[i + 1][:2] <= (rid, low):  # pieces do not overlap in their starts
            i += 1
        _, at, doc_id, content = pieces[i]
        out.append((rid, doc_id, low, content[low - at : low - at + span + WINDOW]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({f: pa.array([r[k] for r in out], kinds[k]) for k, f in enumerate(("rid", "doc_id", "at", "content"))})


PIECES = "rid long, doc_id long, at long, content binary"


def _numbered(batches):
    """Rows in blocks of about ``BLOCK_BYTES``; a row id is block << 16 | place."""
    from pyspark import TaskContext

    block, place, filled = TaskContext.get().partitionId() << 24, 0, 0
    for rows in (part for batch in batches for part in slices(batch, "_text")):
        texts = encoded(rows.column("_text").to_pylist())
        blocks, rids = [], []
        for text in texts:
            if place == BLOCK_ROWS or (filled and filled + len(text) > BLOCK_BYTES):
                block, place, filled = block + 1, 0, 0
            blocks.append(block)
            rids.append(block << 16 | place)
            place, filled = place + 1, filled + len(text)
        arrays = [pa.array(blocks, pa.int64()), pa.array(rids, pa.int64()), rows.column("doc_id"), pa.array(texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "rid", "doc_id", "content"])
    give_back()


def _removed(left: pa.Table, right: pa.Table) -> pa.Table:
    """Each row of a block without the bytes that its repeats cover."""
    marks = np.stack([right.column(f).to_numpy().astype(np.int64) for f in ("rid", "low", "span")], axis=1)
    marks = marks[np.lexsort((marks[:, 1], marks[:, 0]))]
    out: dict[str, list] = {"doc_id": [], "n_bytes": [], "removed": [], "kept": []}
    for rid, doc_id, text in zip(*(left.column(f).to_pylist() for f in ("rid", "doc_id", "content"))):
        a, b = np.searchsorted(marks[:, 0], (rid, rid + 1))
        cover = np.zeros(len(text) + 1, dtype=np.int64)
        np.add.at(cover, marks[a:b, 1], 1)
        np.add.at(cover, marks[a:b, 1] + marks[a:b, 2] + WINDOW, -1)
        gone = np.cumsum(cover)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2).tolist()
        out["doc_id"].append(doc_id)
        out["n_bytes"].append(len(text))
        out["removed"].append([{"start": i, "end": j} for i, j in edges])
        out["kept"].append(np.frombuffer(text, np.uint8)[~gone].tobytes())
    run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int64(), run, pa.binary())
    return pa.table({f: pa.array(v, k) for (f, v), k in zip(out.items(), kinds)})


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed (maximal byte runs) and kept (the other bytes) of every row.

    A byte goes if a string of 100 bytes that covers it also starts earlier: in a row of smaller id, or before in
    the same row.  Ids are integers; null ids come last; rows with equal ids follow each other as they are read.
    Null text is empty; texts under 100 bytes stay whole.  Other columns are left out.
    """
    spark = df.sparkSession
    rows = in_small_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text")).alias("n")).first()["n"] or 0
    shards = int(max(4, -(-size // SHARD_BYTES)))
    # Bucketed by block: later joins with what belongs to a block do not shuffle the texts again.
    name = f"repeats_{uuid.uuid4().hex}"
    blocks = rows.mapInArrow(_numbered, "block long, rid long, doc_id long, content binary")
    blocks.write.bucketBy(shards, "block").option("path", f"{checkpoint_root(spark)}/{name}").saveAsTable(name)
    blocks = spark.table(name)
    pieces = blocks.select("block", "rid", F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), F.lit(0).cast("long").alias("at"), "content")
    marks = None
    for depth in DEPTHS:
        asked = pieces.select("rid", "doc_id", "at", "content").mapInArrow(_requests(depth, shards), PACKED)
        settled = keep(asked.groupBy("shard").applyInArrow(_settle, SETTLED), "settled").withColumn("block", F.shiftright("rid", 16))
        found = settled.filter("repeat").select("block", "rid", "low", "span")
        marks = found if marks is None else marks.unionByName(found)
        if depth < WINDOW:
            open_spans = settled.filter("not repeat")
            pieces = pieces.groupBy("block").cogroup(open_spans.groupBy("block")).applyInArrow(_cut, PIECES)
            pieces = keep(pieces, "open-spans").withColumn("block", F.shiftright("rid", 16))
    schema = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_removed, schema)
