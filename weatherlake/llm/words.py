"""Splitting batches of texts into hashed words with numpy.

A word is a run of bytes other than space and \\x09-\\x0D; A-Z are lower-cased first.  Words
are named by a 64-bit hash: the sum over their letters of a mixed value of letter and place, mixed
again with the length.  No arrangement of letters makes two words meet but by chance.  Work arrays are bounded by ``SLICE`` bytes, except where one word is longer.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalizer with full avalanche on uint64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _tables(between: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Random value of each byte (0 for those between words) and which bytes stand between words."""
    rng = np.random.default_rng(20240229)
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    upper = np.arange(ord("A"), ord("Z") + 1)
    values[upper] = values[upper + 32]
    space = np.zeros(256, dtype=bool)
    space[between] = True
    values[space] = 0
    return values, space


SPACES = _tables([0x20, *range(0x09, 0x0E)])
# Here every ASCII character but letters and digits stands between words.
LETTERS = _tables([b for b in range(128) if not chr(b).isalnum()])
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        inverse = pow(MULTIPLIER, -1, 1 << 64)
        for name, base in (("up", MULTIPLIER), ("down", inverse)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _slice_words(buf: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a buffer."""
    values, space = tables
    gap = space[buf]
    word = ~gap
    starts = np.flatnonzero(word & np.concatenate(([True], gap[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    ends = np.flatnonzero(word & np.concatenate((gap[1:], [True]))) + 1
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = (np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)).astype(np.uint64)
    h = np.add.reduceat(_mix(values[buf[word]] + place * np.uint64(MULTIPLIER)), first)
    return _mix(h + lengths.astype(np.uint64) * np.uint64(MULTIPLIER)), starts


def hashed_words(texts: list[bytes], tables=SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the number of words of each text."""
    counts = np.zeros(len(texts), dtype=np.int64)
    if not texts:
        return np.zeros(0, np.uint64), counts
    buf = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts])  # a text's words start below its bound
    parts, at = [], 0
    while at < len(buf):
        end = min(at + SLICE, len(buf))
        if end < len(buf):  # cut behind white space, so that no word is split
            blanks = np.flatnonzero(tables[1][buf[at:end]])
            while not len(blanks) and end < len(buf):
                end = min(end + SLICE, len(buf))
                blanks = np.flatnonzero(tables[1][buf[at:end]])
            if end < len(buf):
                end = at + blanks[-1] + 1
        h, starts = _slice_words(buf[at:end], tables)
        counts += np.bincount(np.searchsorted(bounds, starts + at, side="right"), minlength=len(texts))
        parts.append(h)
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), counts


def encoded(texts) -> list[bytes]:
    """UTF-8 of each text; null and NaN count as empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def give_back() -> None:
    """Return freed memory to the system; Python workers are reused and would keep their peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_batches(sizes: list[int], limit: int = 4 << 20):
    """Ranges of rows whose texts have about ``limit`` bytes together."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """The batch in slices with about ``limit`` bytes of text each, so that work arrays stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for a, b in text_batches(sizes, limit):
        yield batch.slice(a, b - a)
