"""The words of many texts at once, as Arrow columns, and their hashes.

The texts of a block lie one after the other in one byte buffer. Its words become one column whose dictionary holds
each distinct word once, so that whatever needs Python (hashing, encoding) runs over distinct words only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLOCK_BYTES = 2 << 20

#: ASCII white space: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64's finisher)."""
    x = x.astype(U)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about `most` bytes; a longer text is a run of its own. Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, buf[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def slices(batch: pa.RecordBatch, text_col: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of text; a longer text is a piece of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def words(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of bytes for which `inside` holds, cut at texts; first word of each text."""
    m = np.zeros(len(buf) + 2, bool)
    m[1:-1] = inside[buf]
    start, end = m[1:-1] & ~m[:-2], m[1:-1] & ~m[2:]
    cut = offsets[(offsets > 0) & (offsets < len(buf))]
    cut = cut[m[1:-1][cut] & m[cut]]
    start[cut] = True
    end[cut - 1] = True
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_column(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of `words` as one column, and the first word of each text."""
    starts, ends, at = words(buf, offsets, inside)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    flat = np.ascontiguousarray(buf[inside[buf]])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)]), at


def codes_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each entry of a column its place among the distinct ones, and these."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def string_hashes(distinct: pa.Array) -> np.ndarray:
    """64 bits of BLAKE2 of each entry."""
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in distinct.to_pylist()), "<u8").astype(U)


def word_hashes(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and the first word of each text."""
    column, at = word_column(buf, offsets, inside)
    code, distinct = codes_of(column)
    return string_hashes(distinct)[code], at


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive hashes; as many fewer than the input as k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for i in range(k):
        out = (out + hashes[i : i + n]) * U(0xC2B2AE3D27D4EB4F) + U(0x165667B19E3779F9)
    return mix(out)
