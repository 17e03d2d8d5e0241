"""Spelling variants by blocked Gram matrices.

Words are blocked by length and by how many of their letters fall into each of a few groups of letters.
If two words differ by one edit, their letter counts have squared distance 2 (one letter replaced) or
1 (one letter more), and so have the sums of the counts over groups of letters.  Only blocks whose group counts are that close
are multiplied: a NumPy product of their letter counts gives all squared distances, and the pairs at that
distance are verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.llm.common import in_small_batches, keep
from weatherlake.llm.tokens import numbered
from weatherlake.llm.words import give_back

LEAST_LETTERS = 5
LEAST_COUNT = 3
NOISE = 97  # one run in so many loses a letter
MORE_FREQUENT = 2  # a form occurs at least so many times as often
BLOCK_WORDS = 500  # aimed size of a block; blocks of twice that size are cut by hash
MOST_GROUPS = 8
COLUMNS = 4096  # words gathered for one product
TILE = 1 << 21  # cells of one product
PIECE = 1 << 20
SLICE = 8 << 20  # bytes of text counted at once
SHORT_WORD = 64  # crcs of words of at most so many bytes are taken from a table
# The letters that words consist of: a-z, A-Z (none is left after lower-casing) and U+00C0 to U+00FF.
_TABLE = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_GAP = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
_ALPHABET = [*range(97, 123), *range(0xC0, 0x100)]
_INDEX = np.zeros(256, dtype=np.uint8)
_INDEX[_ALPHABET] = np.arange(len(_ALPHABET))


# --- words ------------------------------------------------------------------------------


def _zero_byte_step() -> np.ndarray:
    """What a crc32 register becomes on a zero byte, by its lowest byte (the rest is shifted down)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    return step


def _crcs(starts: list[int], doc: np.ndarray, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of each document's start followed by each of its words.

    crc32 is linear: it is the crc of the start moved on by as many zero bytes as the word has, xor the word's own.
    """
    step, moved = _zero_byte_step(), [np.array(starts, dtype=np.uint32)]
    own = np.array([zlib.crc32(w) for w in words.to_pylist()], dtype=np.uint32)
    for _ in range(min(int(lengths.max(initial=0)), SHORT_WORD)):
        moved.append(step[moved[-1] & np.uint32(255)] ^ (moved[-1] >> np.uint32(8)))
    short = np.minimum(lengths, SHORT_WORD)
    h = own[ids] ^ np.concatenate(moved)[short * len(starts) + doc]
    for i in np.flatnonzero(lengths > SHORT_WORD).tolist():
        h[i] = zlib.crc32(words[ids[i]].as_py(), starts[doc[i]])
    return h


def _letters(buf: np.ndarray) -> np.ndarray:
    """Which bytes of lower-cased UTF-8 are of a-z or U+00C0 to U+00FF (lead byte C3)."""
    lead = buf == 0xC3
    inside = ((buf >= 97) & (buf <= 122)) | lead
    inside[1:] |= lead[:-1]
    return inside


def _without(word: bytes, h: int) -> bytes:
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counted(docs: list[str], texts: list[bytes], noise: int, least: int) -> pa.RecordBatch:
    """Words of some texts with their counts."""
    buf = np.frombuffer(b" ".join(texts).translate(_TABLE), dtype=np.uint8)
    ids, words, starts, lengths = numbered(buf, _letters(buf))
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    h = _crcs([zlib.crc32(f"{d}:".encode()) for d in docs], doc, words, ids, lengths)
    hit = h % np.uint32(noise) == 0
    counts = np.bincount(ids[~hit], minlength=len(words))
    shorter = Counter(_without(words[i].as_py(), k) for i, k in zip(ids[hit].tolist(), h[hit].tolist()))
    column = pa.concat_arrays([words.cast(pa.string()), pa.array([w.decode() for w in shorter], pa.string())])
    counts = np.concatenate((counts, np.array(list(shorter.values()), dtype=np.int64)))
    rows = pa.RecordBatch.from_arrays([column, pa.array(counts, pa.int64())], ["word", "n"])
    return rows.filter(pc.and_(pc.greater(rows.column("n"), 0), pc.greater_equal(pc.utf8_length(column), least)))


def _pieces(texts: list[bytes], docs: list[str]):
    """Texts with their documents; long texts in pieces cut behind a byte that is in no word."""
    for text, doc in zip(texts, docs):
        at = 0
        while at < len(text):
            gap = _GAP.search(text, at + PIECE)
            end = gap.end() if gap else len(text)
            yield text[at:end], doc
            at = end


def _count_words(noise: int, least: int):
    def run(batches):
        for batch in batches:
            texts, docs, size = [], [], 0
            for text, doc in _pieces(batch.column("_text").to_pylist(), batch.column("_doc").to_pylist()):
                texts.append(text)
                docs.append(doc)
                size += len(text)
                if size >= SLICE:
                    yield _counted(docs, texts, noise, least)
                    texts, docs, size = [], [], 0
            if texts:
                yield _counted(docs, texts, noise, least)
        give_back()

    return run


def vocabulary(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, noise: int = NOISE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """word, n: letter runs of all texts, A-Z lower-cased, one run in ``noise`` with a letter less.

    Null texts have no words, repeated rows count again, a null id counts as empty text, other columns do not matter.
    """
    rows = in_small_batches(docs).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_doc"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"),
    )
    counted = rows.mapInArrow(_count_words(noise, least_letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- blocks -----------------------------------------------------------------------------


def _letter_groups(words: DataFrame, most: int) -> list[str]:
    """The letters in groups of about equal weight, by how often they stand in the words (at most 90 letters)."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count()
    groups, loads = [""] * most, [0] * most
    for row in sorted(letters.collect(), key=lambda r: (-r["count"], r["c"])):
        least = loads.index(min(loads))
        groups[least] += row["c"]
        loads[least] += row["count"]
    return [g for g in groups if g]


def _key(length: Column, counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in (length, *counts)])


def _blocked(words: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """The words with length ``l``, group counts ``c0``.. and as many groups as bring blocks to the aimed size."""
    groups = _letter_groups(words, MOST_GROUPS)
    counts = [(F.length("word") - F.length(F.translate("word", g, ""))).alias(f"c{i}") for i, g in enumerate(groups)]
    counted = keep(words.select("word", "n", F.length("word").alias("l"), *counts), "counted")
    names = [f"c{i}" for i in range(len(groups))]
    # Blocks of every number of groups at once; a word's block at depth g is its first g counts.
    sizes = counted.rollup("l", *names).agg(F.count("*").alias("s"), F.grouping_id().alias("id"))
    by_depth = sizes.groupBy("id").agg((F.sum(F.col("s") * F.col("s")) / F.sum("s")).alias("mean")).collect()
    means = {len(names) - int(r["id"]).bit_length(): r["mean"] for r in by_depth}
    depth = next((g for g in range(len(names)) if means.get(g, 0) <= block_words), len(names))
    return counted, depth


def _packed(counted: DataFrame, depth: int, block_words: int) -> DataFrame:
    """block, chunk, words, ns and the counts of the block: its words in chunks of at most about twice the aimed size."""
    names = [f"c{i}" for i in range(depth)]
    placed = counted.select("word", "n", "l", *names, _key(F.col("l"), [F.col(c) for c in names]).alias("block"))
    large = placed.groupBy("block").agg(F.count("*").alias("s")).filter(F.col("s") >= 2 * block_words)
    large = large.select("block", F.floor(F.col("s") / block_words).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("word"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk")
    dealt = placed.join(large, "block", "left").select("block", chunk, "l", *names, "word", "n")
    packed = dealt.groupBy("block", "chunk", "l", *names).agg(F.collect_list(F.struct("word", "n")).alias("w"))
    return packed.select("block", "chunk", "l", *names, F.col("w.word").alias("words"), F.col("w.n").alias("ns"))


def _dealt(packed: DataFrame, depth: int) -> DataFrame:
    """block, chunk, kind, words, ns: every chunk as rows of its own matrix (kind -1), and as columns for each chunk of
    the blocks that may hold near words and come before its own: the same block (0), one letter less (1), one replaced (2)."""
    own = [F.col(f"c{i}") for i in range(depth)]

    def moved(down: int, up: int, shorter: int) -> Column:
        """Key of the block with one letter less in a group and one more in another; the last group stands for the rest."""
        return _key(F.col("l") - shorter, [c - int(i == down) + int(i == up) for i, c in enumerate(own)])

    targets = [(0, F.col("block"))]
    targets += [(1, moved(i, -1, 1)) for i in range(depth + 1)]
    targets += [(2, moved(i, j, 0)) for i in range(depth + 1) for j in range(i + 1, depth + 1)]
    targets = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("block")) for kind, key in targets])
    sources = packed.select(F.col("block").alias("from"), F.col("chunk").alias("part"), F.inline(targets))
    links = sources.join(packed.select("block", "chunk"), "block")
    payload = packed.select(F.col("block").alias("from"), F.col("chunk").alias("part"), "words", "ns")
    columns = links.join(payload, ["from", "part"]).select("block", "chunk", "kind", "words", "ns")
    return packed.select("block", "chunk", F.lit(-1).alias("kind"), "words", "ns").unionByName(columns)


# --- products ---------------------------------------------------------------------------


class _Side:
    """Words of one length as letter numbers and as letter counts."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = words, np.array(counts, dtype=np.int64)
        self.length = len(words[0])
        codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        self.codes = _INDEX[codes].reshape(len(words), self.length)
        # Counts are whole numbers below 2**24, or 2**53, in the products.
        kind = np.float32 if self.length < 2048 else np.float64
        cells = np.repeat(np.arange(len(words)), self.length) * len(_ALPHABET) + self.codes.ravel()
        self.vectors = np.bincount(cells, minlength=len(words) * len(_ALPHABET)).astype(kind).reshape(len(words), -1)
        self.norms = np.einsum("ij,ij->i", self.vectors, self.vectors)


def _near(left: _Side, right: _Side) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the near words of two sides, where the right words have the same length or one letter more."""
    wanted = 1 if right.length > left.length else 2
    used = left.vectors.any(0) & right.vectors.any(0)
    a, b = left.vectors[:, used], right.vectors[:, used]
    found = []
    step = max(1, TILE // len(right.words))
    for at in range(0, len(left.words), step):
        part = slice(at, at + step)
        # |a|^2 + |b|^2 - 2ab as one product
        rows = np.column_stack((a[part], left.norms[part], np.ones(len(a[part]), a.dtype)))
        columns = np.column_stack((-2 * b, np.ones(len(b), b.dtype), right.norms))
        i, j = np.divmod(np.flatnonzero((rows @ columns.T).ravel() == wanted), len(right.words))
        i += at
        for c in range(0, len(i), 1 + TILE // left.length):
            x, y = i[c : c + 1 + TILE // left.length], j[c : c + 1 + TILE // left.length]
            if wanted == 2:
                ok = np.count_nonzero(left.codes[x] != right.codes[y], axis=1) == 1
            else:  # a common start and a common end cover the shorter word
                head = np.logical_and.accumulate(left.codes[x] == right.codes[y][:, :-1], axis=1).sum(1)
                tail = np.logical_and.accumulate((left.codes[x] == right.codes[y][:, 1:])[:, ::-1], axis=1).sum(1)
                ok = head + tail >= left.length
            found.append((x[ok], y[ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _pairs(word: _Side, other: _Side, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    columns = [np.array(word.words, object)[i], word.n[i], np.array(other.words, object)[j], other.n[j]]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "n", "near", "near_n"])


def _products(batches):
    """Near words from rows sorted by block, chunk and kind: the rows of a matrix are held, its columns stream by."""
    unit, kind, left, words, ns = None, None, None, [], []

    def multiplied():
        if left is None or not words:
            return
        right = _Side(words, ns)
        i, j = _near(left, right)
        if len(i):
            yield _pairs(left, right, i, j)
            if kind:  # columns of the same block are its rows elsewhere
                yield _pairs(right, left, j, i)

    for batch in batches:
        blocks, chunks, kinds = (batch.column(c).to_pylist() for c in ("block", "chunk", "kind"))
        for k in range(batch.num_rows):
            here = blocks[k], chunks[k]
            if (here, kinds[k]) != (unit, kind) or len(words) >= COLUMNS:
                yield from multiplied()
                words, ns = [], []
            if here != unit:
                unit, left = here, None
            kind = kinds[k]
            if kind < 0:
                left = _Side(batch.column("words")[k].as_py(), batch.column("ns")[k].as_py())
            else:
                words += batch.column("words")[k].as_py()
                ns += batch.column("ns")[k].as_py()
    yield from multiplied()
    give_back()


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n, near, near_n: every ordered pair of words one edit apart, from a table ``word, n`` of distinct words."""
    counted, depth = _blocked(words, block_words)
    packed = keep(_packed(counted, depth, block_words), "packed")
    dealt = in_small_batches(_dealt(packed, depth)).repartition("block", "chunk")
    return dealt.sortWithinPartitions("block", "chunk", "kind").mapInArrow(
        _products, "word string, n long, near string, near_n long"
    )


# --- forms ------------------------------------------------------------------------------


def spelling_forms(words: DataFrame, more_frequent: int = MORE_FREQUENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a table ``word, n`` of distinct words.

    The form is the near word of largest n (ties: the smallest) if it occurs ``more_frequent`` times as often, else null;
    the root is where the forms end.  Counts grow along forms, so there are no cycles; each round doubles
    the steps taken.  An empty table has no rows.
    """
    words = keep(words.select("word", "n"), "words")
    best = near_words(words, block_words).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min_by(F.struct("near", "near_n"), F.struct((-F.col("near_n")).alias("most"), "near")).alias("best"),
    )
    joined = words.join(best, "word", "left")
    takes = F.col("best.near_n") >= more_frequent * F.col("n")
    forms = keep(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, F.col("best.near_n")).alias("form_n"),
    ), "forms")
    steps = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = keep(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), "roots")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    rooted = forms.join(steps.select("word", "root"), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
