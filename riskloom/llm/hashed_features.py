"""Hashed n-grams of bytes and hashed words of whole texts, as sums per text and as sparse vectors."""

from __future__ import annotations

import numpy as np

from riskloom.llm import text_arrays

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[48:58] = 48
_FOLDED[text_arrays.SPACE] = 32
_PLAIN = _FOLDED.copy()
_PLAIN[65:91] -= 32


class Hashed:
    """Features: runs of ``orders`` bytes and, if ``words``, whole words, each hashed to one of ``2 ** bits`` buckets.

    White space counts as one kind and digits as another; ``folded`` also lower-cases A-Z. A space stands behind each text.
    """

    def __init__(self, bits: int, orders: tuple[int, ...], words: bool, folded: bool):
        self.bits, self.orders, self.words, self.table = bits, orders, words, _FOLDED if folded else _PLAIN
        self.folded = folded

    def parts(self, data: np.ndarray, offsets: np.ndarray):
        """For each kind of feature: the buckets, and where each row's begin and end."""
        buffer, begin = text_arrays.apart(data, offsets)
        codes = self.table[buffer].astype(np.uint32)
        for n in self.orders:
            if len(codes) < n:
                continue
            h = codes[: len(codes) - n + 1] + np.uint32(n * 977)
            for k in range(1, n):
                h = h * np.uint32(0x01000193) ^ codes[k : len(codes) - n + 1 + k]
            h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)
            first = np.minimum(begin[:-1], len(h))
            yield h, first, np.maximum(first, begin[1:] - n + 1)
        if self.words:
            starts, ends = text_arrays.word_spans(buffer)
            h = (text_arrays.span_hashes(buffer, starts, ends, lower=self.folded) >> np.uint64(64 - self.bits)).astype(np.uint32)
            at = np.searchsorted(starts, begin)
            yield h, at[:-1], at[1:]

    def means(self, column, weights: np.ndarray) -> np.ndarray:
        """Mean of ``weights`` (buckets x outputs) over the features of each text; 0 without a feature."""
        data, offsets = text_arrays.utf8(column)
        out = np.zeros((len(offsets) - 1, weights.shape[1]))
        tables = [np.ascontiguousarray(weights[:, k]) for k in range(weights.shape[1])]
        for lo, hi, part, at in text_arrays.chunks(data, offsets):
            count = np.zeros(hi - lo)
            for h, first, last in self.parts(part, at):
                count += last - first
                for k, w in enumerate(tables):
                    sums = np.concatenate(([0.0], np.cumsum(w[h], dtype=np.float64)))
                    out[lo:hi, k] += sums[last] - sums[first]
            out[lo:hi] /= np.maximum(count, 1)[:, None]
        return out

    def vectors(self, column) -> list[tuple[np.ndarray, np.ndarray]]:
        """(buckets, shares) of each text."""
        data, offsets = text_arrays.utf8(column)
        out = []
        for lo, hi, part, at in text_arrays.chunks(data, offsets):
            kinds = list(self.parts(part, at))
            for i in range(hi - lo):
                mine = np.concatenate([h[f[i] : e[i]] for h, f, e in kinds] or [np.zeros(0, np.uint32)])
                ids, counts = np.unique(mine, return_counts=True)
                out.append((ids.astype(np.int32), (counts / max(1, len(mine))).astype(np.float32)))
        return out
