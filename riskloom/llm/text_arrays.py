"""Words and hashes of whole texts as numpy arrays over the UTF-8 bytes of an Arrow column.

Words are ``[^\\x20\\x09-\\x0D]+``. These six separators are single bytes in UTF-8, so the work is exact on bytes.
Texts are taken in chunks of about ``CHUNK`` bytes; a longer text is a chunk of its own and its words are hashed in
windows, so memory follows the words of one text, not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` bytes with their bytes and offsets."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def apart(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with a space behind each, so that no word or window reaches over an end."""
    rows = len(offsets) - 1
    out = np.full(len(data) + rows, 0x20, np.uint8)
    at = offsets + np.arange(rows + 1)
    if rows == 1:
        out[: len(data)] = data
    else:
        out[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))] = data
    return out, at


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one array of bytes."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[data]
    change = np.flatnonzero(word[1:] != word[:-1]) + 1
    bounds = np.concatenate(([0] if word[0] else [], change, [len(data)] if word[-1] else [])).astype(np.int64)
    return bounds[::2], bounds[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, window: int = 4 * CHUNK) -> np.ndarray:
    """64-bit hashes of byte spans given in order; ``lower`` folds A-Z. A span's hash depends on its bytes alone."""
    out, i, values = np.empty(len(starts), U64), 0, _LOWER if lower else _BYTES
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + window, "right")))
        base, top = int(starts[i]), int(ends[j - 1])
        powers, inverses = _tables(top - base + 1)
        sums = np.zeros(top - base + 1, U64)
        np.cumsum(values[data[base:top]] * powers[: top - base], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * inverses[s] + (e - s).astype(U64) * U64(0x9E3779B97F4A7C15))
        i = j
    return out


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a chunk, and where each row's words begin (one more entry than rows)."""
    buffer, at = apart(data, offsets)
    starts, ends = word_spans(buffer)
    return span_hashes(buffer, starts, ends, lower), np.searchsorted(starts, at)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; the whole sequence as one if it is shorter, none of no words."""
    if not len(words):
        return words
    span = min(n, len(words))
    out = mix(words[: len(words) - span + 1] + U64(span))
    for k in range(1, span):
        out = mix(out * U64(3) + words[k : len(words) - span + 1 + k])
    return out


def hand_back() -> None:
    """This process gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def handing_back(run: Callable) -> Callable:
    """``run``, after whose last batch the worker gives freed memory back: it may stay idle while others of its executor work."""

    @wraps(run)
    def wrapped(batches):
        yield from run(batches)
        hand_back()

    return wrapped
