"""Benchmark decontamination by one Aho-Corasick automaton over the windows of all benchmark items.

A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter item.  The letters of
the automaton are words, not characters: each word of a window gets a code point of its own, any other word of
a document the code point 0.  A document is thus scanned once, and a match ends at a word number, which is
mapped back to offsets in the original text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.common import in_small_batches, keep, lower_ascii
from weatherlake.llm.words import give_back, slices

WINDOW = 10
# Words of all windows in one automaton; each takes about 100 bytes of a task's memory, and there are
# more code points than that.  A larger benchmark is dealt over several automata, one scan each.
AUTOMATON_WORDS = 1_000_000
PIECE = 1 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS = bytes(c for c in range(128) if not chr(c).isalnum())
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_TABLE = bytes.maketrans(_UPPER + _GAPS, _UPPER.lower() + b" " * len(_GAPS))
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_SURROGATES = 0xD800, 0x800


def item_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """words (array), items (sorted ids as text): each distinct window of the benchmark.

    A null text has no words and no window.  An item without an id marks words but is not listed.
    """
    words = F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(WORD), F.lit(0))
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), words.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = rows.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("words"))
    return cut.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _letter(number: int) -> str:
    """Code point of a word; 0 stands for all other words, surrogates are left out."""
    point = number + 1
    return chr(point if point < _SURROGATES[0] else point + _SURROGATES[1])


def _automaton(windows: list[list[str]]):
    """The automaton, whose values are (words, number) of a window, and the letter of each word."""
    letters: dict[bytes, str] = {}
    machine = ahocorasick.Automaton()
    machine.add_word(_letter(0x10F000), (0, -1))  # matches nothing; an automaton without any key cannot scan
    for number, words in enumerate(windows):
        key = "".join([letters.setdefault(w.encode(), _letter(len(letters))) for w in words])
        machine.add_word(key, (len(words), number))
    machine.make_automaton()
    return machine, letters


def _pieces(text: bytes):
    """The text in pieces of about ``PIECE`` bytes, cut behind a byte that is in no word."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end


def _add(runs: list[tuple[int, int]], first: int, after: int) -> None:
    """Add a run of words that ends no earlier than those before it; runs that touch become one."""
    while runs and runs[-1][1] >= first:
        first = min(first, runs.pop()[0])
    runs.append((first, after))


def _scan(text: bytes, machine, letters: dict[bytes, str], longest: int):
    """Number of words, runs of words hit, and numbers of the windows that occur."""
    get, n, carry = letters.get, 0, ""
    runs: list[tuple[int, int]] = []
    found: set[int] = set()
    for piece in _pieces(text):
        line = carry + "".join([get(word, "\0") for word in piece.translate(_TABLE).split()])
        base = n - len(carry)
        n = base + len(line)
        for last, (length, number) in machine.iter(line):
            _add(runs, base + last + 1 - length, base + last + 1)
            found.add(number)
        carry = line[max(0, len(line) - longest + 1):]
    return n, runs, found


def _offsets(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code-point offsets of runs of words in the original text."""
    firsts, chars, edges = [0], [0], []
    for piece in _pieces(text):
        firsts.append(firsts[-1] + len(piece.translate(_TABLE).split()))
        chars.append(chars[-1] + len(piece.decode()))
        edges.append(piece)
    held: dict[int, tuple] = {}

    def at(word: int, end: bool) -> int:
        k = bisect_right(firsts, word) - 1
        if k not in held:
            held.clear()
            buf = np.frombuffer(edges[k], dtype=np.uint8)
            inside = np.concatenate(([False], np.frombuffer(edges[k].translate(_TABLE), dtype=np.uint8) != 0x20, [False]))
            turns = np.flatnonzero(inside[1:] != inside[:-1])
            points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80, dtype=np.int32)))
            held[k] = points[turns[::2]], points[turns[1::2]]
        return chars[k] + int(held[k][end][word - firsts[k]])

    return [{"start": at(first, False), "end": at(after - 1, True)} for first, after in runs]


def _marked(windows, last: bool):
    """Scan the rows for the windows of one automaton, and add what is found to what they hold."""

    def run(batches):
        lists, items = windows.value
        machine, letters = _automaton(lists)
        longest = max(map(len, lists), default=1)
        for rows in (part for batch in batches for part in slices(batch, "_text")):
            out = []
            for text, runs, known in zip(*(rows.column(c).to_pylist() for c in ("_text", "runs", "items"))):
                text = text or b""
                n, more, found = _scan(text, machine, letters, longest)
                merged: list[tuple[int, int]] = []
                for first, after in sorted([(r["first"], r["after"]) for r in runs] + more, key=lambda r: r[1]):
                    _add(merged, first, after)
                known = sorted({*known, *(i for number in found for i in items[number])})
                out.append((n, merged, known, _offsets(text, merged) if last and merged else []))
            columns = {
                "doc_id": rows.column("doc_id"),
                "_text": rows.column("_text"),
                "n_words": pa.array([x[0] for x in out], pa.int64()),
                "runs": pa.array([[{"first": a, "after": b} for a, b in x[1]] for x in out], _RUNS),
                "items": pa.array([x[2] for x in out], pa.list_(pa.string())),
                "spans": pa.array([x[3] for x in out], _SPANS),
            }
            if last:
                columns.pop("_text")
            yield pa.RecordBatch.from_pydict(columns)
        give_back()

    return run


_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_benchmark_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_words: int = AUTOMATON_WORDS
) -> DataFrame:
    """doc_id, n_words, n_hit, spans (start, end), items: what of the benchmark stands in each document.

    ``spans`` are the maximal runs of words that windows cover, as code-point offsets in the original text;
    ``items`` the ids, as sorted text, of items with a window in the document.  One row per row of ``docs``,
    repeated rows and null ids included; null and empty texts have no words.  Other columns are left out.

    The windows are counted first.  Up to ``automaton_words`` words of windows they are one broadcast
    automaton; more are dealt over several by their hash, and the text is scanned once for each.
    """
    spark = docs.sparkSession
    windows = keep(item_windows(benchmark, window), "windows")
    total = windows.agg(F.sum(F.size("words") + F.size("items"))).first()[0] or 0
    parts = max(1, math.ceil(total / automaton_words))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = in_small_batches(docs).select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_text"),
        F.expr("cast(array() as array<struct<first: long, after: long>>)").alias("runs"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    found = "n_words long, runs array<struct<first: long, after: long>>, items array<string>, spans array<struct<start: long, end: long>>"
    for part in range(parts):
        last = part == parts - 1
        mine = windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == part).orderBy("words").toArrow()
        lists = mine.column("words").to_pylist(), mine.column("items").to_pylist()
        text = "" if last else "_text binary, "
        rows = rows.mapInArrow(_marked(spark.sparkContext.broadcast(lists), last), f"doc_id {kind}, {text}{found}")
        if not last:
            rows = keep(rows, "scanned")
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["after"] - r["first"])
    return rows.select("doc_id", "n_words", hit.alias("n_hit"), "spans", "items")
