"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

Stripes of prefixes of 0, 1, 2.. words are counted one length after the other.  A task emits one counter per prefix
and slice of text; the counters are merged cell by cell.  A phrase of a given frequency
consists of shorter ones that are no rarer, so a task only counts a word after a prefix where the prefix
and what follows its first word were frequent.  Which were is told by a bitmap of fixed size over hashes of phrases:
a false positive costs a cell that the exact count drops again.  The merged table holds extensions
(cells), prefix totals (the cell of a prefix itself) and, by maxima over cells, the phrases that a longer one covers.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weatherlake.llm.common import in_small_batches, keep, probe_join
from weatherlake.llm.tokens import numbered
from weatherlake.llm.words import give_back

LONGEST = 5
LEAST_COUNT = 100
BEST = 2000
SHARE = 100  # percent of a phrase's occurrences in a longer one that make it superfluous
BITS = 25  # the bitmap of frequent phrases has 2**BITS bits, 4 MB
PIECE = 1 << 20
SLICE = 8 << 20  # bytes of text, of all languages, held by a task
SALTS = 64
HOT = 256  # the counter of a prefix with more than one in so many words is dealt out over all bundles
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# A-Z are lower-cased, what ends a piece becomes a line end, a tab a space.
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")
_END = re.compile(rb"[.,;:!?\x0a-\x0d]")


def _positions(lang: str, marks: list[np.ndarray]) -> np.ndarray:
    """Bit of each phrase: ``marks`` holds the crc32 of the phrases' first words, of their second words and so on."""
    h = np.full(len(marks[0]), zlib.crc32(lang.encode()), dtype=np.uint64)
    for mark in marks:
        h = (h ^ mark) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return (h * _MULTIPLIER >> np.uint64(64 - BITS)).astype(np.int64)


def _crc(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words.to_pylist()], dtype=np.uint64)


def _bundled(
    lang: str, bundles: np.ndarray, prefixes: pa.Array, prefix: np.ndarray, nexts: pa.Array, counts: np.ndarray
) -> pa.RecordBatch:
    """Counters from cells (bundle, number of the prefix, next word, count), one row per bundle of prefixes."""
    order = np.lexsort((prefix, bundles))
    bundles, prefix = bundles[order], prefix[order]
    row = np.concatenate(([True], bundles[1:] != bundles[:-1]))
    stripe = np.concatenate(([True], prefix[1:] != prefix[:-1])) | row
    cells = pa.array(np.append(np.flatnonzero(row), len(order)).astype(np.int32))
    held = np.cumsum(stripe)
    before = held[row] - 1  # stripes ahead of each row's
    stripes = pa.array(np.append(before, held[-1]).astype(np.int32))
    of = held - 1 - np.repeat(before, np.diff(cells.to_numpy()))
    return pa.RecordBatch.from_pydict({
        "lang": pa.repeat(pa.scalar(lang), len(before)),
        "bundle": pa.array(bundles[row].astype(np.int32)),
        "prefixes": pa.ListArray.from_arrays(stripes, prefixes.take(pa.array(prefix[stripe]))),
        "of": pa.ListArray.from_arrays(cells, pa.array(of.astype(np.int32))),
        "nexts": pa.ListArray.from_arrays(cells, nexts.take(pa.array(order))),
        "counts": pa.ListArray.from_arrays(cells, pa.array(counts[order].astype(np.int32))),
    })


def _stripes_of(lang: str, texts: list[bytes], k: int, frequent, hot: list[str], bundles: int) -> pa.RecordBatch | None:
    """Counters of the words behind each prefix of ``k - 1`` words; those of hot prefixes are dealt out by next word."""
    buf = np.frombuffer(b"\n".join(texts).translate(_TABLE), dtype=np.uint8)
    ids, words, starts, _ = numbered(buf, (buf != 0x20) & (buf != 0x0A))
    if k == 1:  # the cell without a word holds the number of all words
        nexts = pa.concat_arrays([words.cast(pa.string()), pa.nulls(1, pa.string())])
        counts = np.append(np.bincount(ids, minlength=len(words)), len(ids))
        dealt = np.append(_crc(words).astype(np.int64) % bundles, 0)
        return _bundled(lang, dealt, pa.array([""]), np.zeros(len(nexts), dtype=np.int64), nexts, counts)
    if len(ids) < k:
        return None
    piece = np.cumsum(buf == 0x0A, dtype=np.int32)[starts]
    crcs = _crc(words)
    marks = crcs[ids]
    n = len(ids) - k + 2  # phrases of k - 1 words
    bits = _positions(lang, [marks[t : t + n] for t in range(k - 1)])
    known = (frequent[bits >> 3] >> (bits & 7)) & 1 == 1
    at = np.flatnonzero(known[:-1] & known[1:] & (piece[: 1 - k] == piece[k - 1 :]))
    if not len(at):
        return None
    ids, many = ids.astype(np.int64), len(words)
    prefix = ids[at]
    for t in range(1, k - 1):
        prefix = np.unique(prefix * many + ids[at + t], return_inverse=True)[1]
    cells, counts = np.unique(prefix * many + ids[at + k - 1], return_counts=True)
    held, first = np.unique(prefix, return_index=True)
    parts = [words.take(pa.array(ids[at[first] + t])) for t in range(k - 1)]
    prefixes = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())).cast(pa.string())
    of, following = np.searchsorted(held, cells // many), cells % many
    split = pc.is_in(prefixes, value_set=pa.array(hot, pa.string())).to_numpy(zero_copy_only=False)
    own = _positions(lang, [crcs[ids[at[first] + t]] for t in range(k - 1)])
    dealt = (own[of] + np.where(split[of], crcs[following].astype(np.int64), 0)) % bundles
    return _bundled(lang, dealt, prefixes, of, words.take(pa.array(following)).cast(pa.string()), counts)


def _pieces(text: bytes):
    """The text in parts of about ``PIECE`` bytes, cut where a piece ends."""
    at = 0
    while at < len(text):
        stop = _END.search(text, at + PIECE)
        end = stop.end() if stop else len(text)
        yield text[at:end]
        at = end


def _stripes(k: int, bitmap, hot: dict[str, list[str]], bundles: int):
    def run(batches):
        frequent = None if bitmap is None else np.frombuffer(bitmap.value, dtype=np.uint8)
        slices: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()

        def counted(lang):
            rows = _stripes_of(lang, slices.pop(lang), k, frequent, hot.get(lang, []), bundles)
            sizes[lang] = 0
            return [] if rows is None or not rows.num_rows else [rows]

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_text").to_pylist()):
                for part in _pieces(text):
                    slices.setdefault(lang, []).append(part)
                    sizes[lang] += len(part)
                    if sizes.total() >= SLICE:
                        yield from counted(max(sizes, key=sizes.get))
        for lang in list(slices):
            yield from counted(lang)
        give_back()

    return run


def _bits(batches):
    for batch in batches:
        out = []
        for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
            marks = [np.array([zlib.crc32(w)], dtype=np.uint64) for w in phrase.encode().split(b" ")]
            out.append(int(_positions(lang, marks)[0]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["bit"])


def _bitmap(phrases: DataFrame) -> bytes:
    """The bits of all phrases, gathered by Spark in blocks of 4 KB: 2**BITS bits at any number of phrases."""
    found = phrases.select("lang", "phrase").mapInArrow(_bits, "bit long")
    blocks = found.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits")
    )
    out = bytearray(1 << BITS >> 3)
    for row in blocks.toLocalIterator():
        out[(row.block - 1) * 4096 : row.block * 4096] = row.bits
    return bytes(out)


def merged_stripes(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT) -> DataFrame:
    """lang, k, prefix, next, phrase, f: cells of the merged stripes with at least ``least`` occurrences.

    For k = 1 the prefix is empty, and the cell without a next word holds the number of all words of the language.
    """
    schema = "lang string, bundle int, prefixes array<string>, of array<int>, nexts array<string>, counts array<int>"
    # As many bundles of counters in a language as there are shuffle partitions.
    bundles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_small_batches(docs).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("_text")
    )
    levels: list[DataFrame] = []
    for k in range(1, longest + 1):
        bitmap, hot = None, {}
        if levels:
            frequent = levels[-1].filter(F.col("phrase").isNotNull())
            if frequent.isEmpty():
                break
            bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(frequent))
            total = levels[0].filter(F.col("next").isNull()).agg(F.sum("f")).first()[0]
            # At most HOT phrases of one length reach this share of all words.
            for row in frequent.filter(F.col("f") * HOT >= total).select("lang", "phrase").collect():
                hot.setdefault(row.lang, []).append(row.phrase)
        # The counters travel whole; their cells are added up where they arrive, without another shuffle.
        stripes = rows.mapInArrow(_stripes(k, bitmap, hot, bundles), schema).repartition("lang", "bundle")
        cells = stripes.select("lang", "bundle", "prefixes", F.inline(F.arrays_zip("of", "nexts", "counts")))
        cells = cells.select("lang", "bundle", F.element_at("prefixes", F.col("of") + 1).alias("prefix"), F.col("nexts").alias("next"), "counts")
        merged = cells.groupBy("lang", "bundle", "prefix", "next").agg(F.sum("counts").alias("f"))
        phrase = F.when(F.lit(k == 1), F.col("next")).otherwise(F.concat("prefix", F.lit(" "), "next"))
        held = merged.filter((F.col("f") >= least) | F.col("next").isNull())
        levels.append(keep(held.select("lang", F.lit(k).alias("k"), "prefix", "next", phrase.alias("phrase"), "f"), f"stripes{k}"))
    return reduce(DataFrame.unionByName, levels)


def _score(a: str, n: str, left: str, right: str) -> Column:
    wide = {x: f"cast({x} AS decimal(19, 0))" for x in (a, n, left, right)}
    return F.expr(f"(1000 * {wide[a]} * {wide[n]}) div ({wide[left]} * {wide[right]})")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, best: int = BEST, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` phrases of 2 to ``longest`` words of each language.

    Texts are split into pieces and words as the module says; a null text is empty, a null language ``und``, repeated rows
    count again, ids and other columns do not matter.  The score is that of the phrase's weakest cut.  A
    phrase with ``share`` percent of its occurrences inside a longer candidate is left out.  Ties go by
    frequency, then by the phrase's bytes; without texts there are no rows.
    """
    stripes = merged_stripes(docs, longest, least)
    phrases = stripes.filter(F.col("phrase").isNotNull())
    totals = phrases.select("lang", "phrase", "f")
    sizes = stripes.filter(F.col("next").isNull()).select("lang", F.col("f").alias("n"))
    candidates = phrases.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def part(first: Column | int, length: Column | int) -> Column:
        return F.array_join(F.slice("w", first, length), " ")

    cuts = candidates.select("lang", "phrase", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(1, F.col("cut")).alias("first"), part(F.col("cut") + 1, F.col("k")).alias("rest"))
    cuts = probe_join(cuts, totals.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = probe_join(cuts, totals.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(sizes, "lang").withColumn("score", _score("a", "n", "l", "r"))
    weakest = F.min_by(F.struct("l", "r", "n", "score"), F.struct("score", "cut")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.*")

    # The shares of a phrase in longer ones fall with every word, so one word more tells of all longer ones.
    shorter = F.explode(F.array(part(1, F.col("k") - 1), part(2, F.col("k")))).alias("phrase")
    covered = candidates.filter("k > 2").select("lang", shorter, "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    ).drop("longer")

    # First per hash part of a language, so that no task sorts a language whole.
    order = "score DESC, a DESC, phrase"
    salted = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("at", F.expr(f"row_number() OVER (PARTITION BY lang, part ORDER BY {order})")).filter(F.col("at") <= best)
    ranked = some.withColumn("rank", F.expr(f"cast(row_number() OVER (PARTITION BY lang ORDER BY {order}) AS long)"))
    return ranked.filter(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
