"""Right-closed bins ``(lo, hi]`` as codegen-friendly expressions.

A balanced tree of CASE WHEN compares log2(n) edges per row and stays inside whole-stage codegen;
array higher-order functions would leave it, and ``Bucketizer`` closes the wrong side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _tree(test, leaf, lo: int, hi: int) -> Column:
    if lo == hi:
        return leaf(lo)
    mid = (lo + hi) // 2
    return F.when(test(mid), _tree(test, leaf, lo, mid)).otherwise(_tree(test, leaf, mid + 1, hi))


def pick(x: Column, uppers: Sequence[float], outcomes: Sequence) -> Column:
    """``outcomes[i]`` for the first upper edge with ``x <= uppers[i]``, the last one beyond; NULL for NULL."""
    if len(outcomes) != len(uppers) + 1:
        raise ValueError("one outcome more than upper edges is needed")
    chosen = _tree(lambda i: x <= F.lit(uppers[i]), lambda i: F.lit(outcomes[i]), 0, len(uppers))
    return F.when(x.isNotNull(), chosen)


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """Index of the bin ``(edges[i], edges[i+1]]``, the lowest edge included; NULL outside."""
    inner = list(edges[1:-1])
    index = pick(x, inner, list(range(len(inner) + 1)))
    inside = F.lit(True)
    if not math.isinf(edges[0]):
        inside = inside & (x >= F.lit(float(edges[0])))
    if not math.isinf(edges[-1]):
        inside = inside & (x <= F.lit(float(edges[-1])))
    return F.when(inside, index)


def reached(x: Column, levels: Sequence[float]) -> Column:
    """How many of the ascending ``levels`` are ``<= x``."""
    return _tree(lambda i: x < F.lit(levels[i]), lambda i: F.lit(i), 0, len(levels))


def segment_index(x: Column, points: Sequence) -> Column:
    """``2k`` between point k-1 and point k, ``2k + 1`` exactly on point k."""

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(2 * lo)
        mid = (lo + hi) // 2
        return (
            F.when(x < F.lit(points[mid]), build(lo, mid))
            .when(x == F.lit(points[mid]), F.lit(2 * mid + 1))
            .otherwise(build(mid + 1, hi))
        )

    return build(0, len(points))


def _shorten(edge: float, digits: int) -> float:
    """Keep ``digits`` decimals, or that many significant ones for a pure fraction."""
    if not math.isfinite(edge) or edge == 0:
        return edge
    if abs(edge) >= 1:
        return round(edge, digits)
    fraction = abs(edge)
    return round(edge, digits - 1 - math.floor(math.log10(fraction)))


def bin_labels(edges: Sequence[float], include_lowest: bool = True, digits: int = 3) -> list[str]:
    """Interval texts such as ``(0.25, 0.5]`` with just enough digits to keep the edges apart."""
    edges = [float(e) for e in edges]
    while digits < 20 and len({_shorten(e, digits) for e in edges}) < len(edges):
        digits += 1
    shown = [_shorten(e, digits) for e in edges]
    if include_lowest and math.isfinite(shown[0]):
        shown[0] = shown[0] - 10 ** (-digits)
    return [f"({lo}, {hi}]" for lo, hi in zip(shown[:-1], shown[1:])]


def equal_width_edges(lo: float, hi: float, bins: int) -> list[float]:
    """Equal-width edges; the lowest is moved out by 0.1 % of the range so that the minimum falls inside."""
    if lo == hi:
        pad = 0.001 * abs(lo) if lo else 0.001
        lo, hi = lo - pad, hi + pad
        return [lo + (hi - lo) * i / bins for i in range(bins + 1)]
    edges = [lo + (hi - lo) * i / bins for i in range(bins)] + [hi]
    edges[0] -= (hi - lo) * 0.001
    return edges
