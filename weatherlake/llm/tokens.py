"""Words of a byte buffer as numbers into a dictionary of the distinct ones, with numpy and Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def numbered(buf: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Number, distinct words, first byte and length of the words of a buffer.

    ``inside`` marks the bytes that belong to words; a word is a maximal run of them.
    """
    padded = np.zeros(len(buf) + 2, dtype=bool)
    padded[1:-1] = inside
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    data = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[inside]))]
    encoded = pa.Array.from_buffers(pa.large_binary(), len(starts), data).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary, starts, lengths
