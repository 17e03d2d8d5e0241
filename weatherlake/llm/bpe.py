"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

The BPE encoding of a prefix has one last token.  An Aho-Corasick automaton over the vocabulary gives, at
each position, the tokens that are a suffix of the prefix; the last token is the one that
is compatible with the last token of what stands before it, which means that no merge across the
two comes before the merges that built them.  Following the back-pointers gives the ids.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
import unicodedata
from array import array
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.common import in_small_batches
from weatherlake.llm.words import slices

# Fixed value: the pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PATTERN_WITHOUT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[NEW]]+| ?[\p{N}--[NEW]]+| ?[[^\s\p{L}\p{N}]||[NEW]]+|\s+(?!\S)|\s+"
)
# Fixed value: letters and numbers of Unicode 16 that Python 3.13 (Unicode 15.1) has as unassigned.
UNICODE_16 = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 "
    "1138B 1138E 11390-113B5 113B7 113D1 113D3 116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA "
    "16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA "
)
CACHED_PIECES = 250_000
CACHED_CHARS = 64
CACHED_PAIRS = 500_000
WORKER = "weatherlake_worker_codecs"  # a module of the Python worker that outlives its tasks


def _printable() -> dict[str, int]:
    """Byte of each character that stands for a byte in vocabulary files: printable Latin-1
    characters stand for themselves, all other bytes follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def _recent() -> str:
    """Letters and numbers that ``regex`` knows but Unicode 16 has as unassigned, as a character class.

    The library whose ids we reproduce follows Unicode 16.
    """
    known = set()
    for part in UNICODE_16.split():
        first, _, last = part.partition("-")
        known.update(range(int(first, 16), int(last or first, 16) + 1))
    unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    recent = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", unassigned) if ord(c) not in known]
    starts = [c for c, before in zip(recent, [None, *recent]) if before != c - 1]
    ends = [c for c, after in zip(recent, [*recent[1:], None]) if after != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


class Codec:
    """Encodes and decodes with the model of a tokenizer file (JSON text)."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model, to_byte = data["model"], _printable()
        raw = {t: bytes(to_byte[c] for c in t) for t in model["vocab"]}
        ids = model["vocab"]
        self.bytes_of = {i: raw[t] for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes_of.update({i: t.encode() for t, i in self.added.items()})
        self.rank, self.parts, self.pairs = dict.fromkeys(self.bytes_of, -1), {}, {}
        for n, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.pairs.setdefault((left, right), n)
            if whole not in self.parts:
                self.rank[whole], self.parts[whole] = n, (left, right)
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if len(raw[token]) == 1 or i in self.parts:
                self.automaton.add_word(raw[token].decode("latin-1"), (i, len(raw[token])))
        self.automaton.make_automaton()
        self.fast = regex.compile(PATTERN)
        recent = _recent()
        self.recent = regex.compile(f"[{recent}]") if recent else None
        self.slow = regex.compile(PATTERN_WITHOUT.replace("NEW", recent), regex.V1) if recent else self.fast
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.known: dict[tuple[int, int], bool] = {}
        self.cache, self.odd_cache = _Pieces(self, self.recent), _Pieces(self, None)

    def compatible(self, a: int, b: int) -> bool:
        """Whether a, b next to each other stay as they are, when each is the encoding of its own bytes."""
        rank, limit = self.rank, len(self.pairs) + 1
        while True:
            if self.pairs.get((a, b), limit) < limit:
                return False
            if rank[a] > rank[b]:  # undo the later merge; crossing merges before it count
                limit = rank[a]
                a = self.parts[a][1]
            elif rank[b] < 0:
                return True
            else:  # of equal merges the leftmost comes first
                limit = rank[b] + 1
                b = self.parts[b][0]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        n, known = len(piece), self.known
        last: list = [None] * n
        size = [0] * n
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            if last[end] is None:
                before = end - length
                if before >= 0:
                    pair = (last[before], token)
                    fits = known.get(pair)
                    if fits is None:
                        if len(known) >= CACHED_PAIRS:
                            known.clear()
                        fits = known[pair] = self.compatible(*pair)
                    if not fits:
                        continue
                last[end], size[end] = token, length
        out, at = [], n - 1
        while at >= 0:
            out.append(last[at])
            at -= size[at]
        return tuple(out[::-1])

    def encode(self, text: str) -> list[int]:
        """Token ids of a text; added tokens are found first, as whole strings."""
        if self.special is None or not self.special.search(text):
            return self._split(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += (self.added[part],) if i % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[int]:
        """Ids of a text without added tokens; a piece with a recent letter has it split anew."""
        try:
            return list(chain.from_iterable(map(self.cache.__getitem__, self.fast.findall(text))))
        except _RecentLetter:
            return list(chain.from_iterable(map(self.odd_cache.__getitem__, self.slow.findall(text))))

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _RecentLetter(Exception):
    """A piece holds a letter or number that the library's Unicode does not know yet."""


class _Pieces(dict):
    """Ids of pieces seen.  When full, what was not used since the last time is forgotten, which costs time only."""

    def __init__(self, codec: Codec, refused):
        self.codec, self.refused, self.older = codec, refused, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            if self.refused is not None and not piece.isascii() and self.refused.search(piece):
                raise _RecentLetter
            ids = self.codec.encode_piece(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def _worker_codec(digest: str, spec) -> Codec:
    """The codec of a file, built once per Python worker; a worker keeps the one it used last."""
    held = sys.modules.setdefault(WORKER, types.ModuleType(WORKER))
    if getattr(held, "digest", None) != digest:
        held.codec, held.digest = Codec(spec.value), digest
    return held.codec


def _run(digest, spec):
    def run(batches):
        codec = _worker_codec(digest, spec)
        for rows in (part for batch in batches for part in slices(batch, "_text")):
            flat, ends, decoded = array("i"), array("i", [0]), []
            for text in rows.column("_text").to_pylist():
                ids = codec.encode(text or "")
                flat.extend(ids)
                ends.append(len(flat))
                decoded.append(codec.decode(ids))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            arrays = [rows.column("doc_id"), listed, pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    return run


def encode_decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (token ids of the whole text) and decoded (the text that the ids stand for).

    ``vocabulary`` is the path of a byte-level BPE tokenizer file, read on the driver and
    broadcast; its size does not depend on the table.  Null and empty text have no ids; rows are handled
    one by one, so repeated rows and null ids stay as they are.  Other columns are left out.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    digest = hashlib.sha256(content.encode()).hexdigest()
    spec = df.sparkSession.sparkContext.broadcast(content)
    rows = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_run(digest, spec), f"doc_id {kind}, ids array<int>, decoded string")
