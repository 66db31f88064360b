"""Exact order statistics and quantiles without sorting the table.

The built-in ``percentile`` keeps a value-to-count map of the whole column in one task. Here a column
is narrowed first: a bounded sketch proposes two values around each wanted rank, one counting pass says
exactly how many rows lie below and between them, and only the values inside the bracket go on. With a
sketch accuracy of 10,000 every round keeps about 1/2500 of the rows, so 10^12 rows need three rounds,
and no round shuffles more than counts. The last round groups at most ``resolve_limit`` rows per bracket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.bins import segment_index

SKETCH_ACCURACY = 10_000
RESOLVE_LIMIT = 1_000_000
#: Least number of partitions that sketches are taken of, where there are as many.
SKETCHES = 16


class Found(NamedTuple):
    """The value at a rank and the number of rows below that value."""

    value: object
    below: int


@dataclass
class _Bracket:
    """Open interval (lo, hi) that holds the wanted ranks; ``below`` rows are <= lo."""

    column: str
    lo: object
    hi: object
    below: int
    size: int
    ranks: list[int] = field(default_factory=list)

    def holds(self, c: Column) -> Column:
        inside = c.isNotNull()
        if self.lo is not None:
            inside = inside & (c > F.lit(self.lo))
        if self.hi is not None:
            inside = inside & (c < F.lit(self.hi))
        return inside


def _narrow(base: DataFrame, wide: list[_Bracket], found: dict, accuracy: int) -> list[_Bracket]:
    step = 2.0 / accuracy
    sketches = []
    for i, b in enumerate(wide):
        grid = sorted(
            {min(1.0, max(0.0, (r - b.below) / b.size + d)) for r in b.ranks for d in (-step, 0.0, step)}
        )
        value = F.when(b.holds(F.col(b.column)), F.col(b.column))
        sketches.append(F.percentile_approx(value, grid, accuracy).alias(f"s{i}"))
    # One task merges the sketches of all partitions: their number is bounded by the cores, not by the input.
    proposed = base.coalesce(max(SKETCHES, base.sparkSession.sparkContext.defaultParallelism)).agg(*sketches).first()

    # Brackets of one column are disjoint, so one sorted list of points per column covers them all.
    points: dict[str, list] = {}
    for i, b in enumerate(wide):
        ends = [e for e in (b.lo, b.hi) if e is not None]
        points.setdefault(b.column, []).extend(list(proposed[f"s{i}"]) + ends)
    points = {c: sorted(set(p)) for c, p in points.items()}

    pairs = [F.struct(F.lit(c).alias("c"), segment_index(F.col(c), p).alias("s")) for c, p in points.items()]
    keys = [F.when(F.col(c).isNotNull(), pair) for c, pair in zip(points, pairs)]
    counted = (
        base.select(F.explode(F.array(*keys)).alias("k"))
        .where(F.col("k").isNotNull())
        .groupBy("k.c", "k.s")
        .count()
        .collect()
    )
    sizes: dict[str, dict[int, int]] = {c: {} for c in points}
    for row in counted:
        sizes[row["c"]][row["s"]] = row["count"]

    out: dict[tuple, _Bracket] = {}
    for b in wide:
        p = points[b.column]
        for rank in b.ranks:
            passed = 0
            for s in range(2 * len(p) + 1):
                size = sizes[b.column].get(s, 0)
                if rank < passed + size:
                    break
                passed += size
            if s % 2:
                found[b.column][rank] = Found(p[s // 2], passed)
                continue
            k = s // 2
            lo, hi = (p[k - 1] if k else None), (p[k] if k < len(p) else None)
            nb = out.setdefault((b.column, s), _Bracket(b.column, lo, hi, passed, size))
            nb.ranks.append(rank)
    return list(out.values())


def _resolve(base: DataFrame, narrow: list[_Bracket], found: dict) -> None:
    # Group by value before ranking: repeated values shrink to one row each on the map side.
    keys = [
        F.when(b.holds(F.col(b.column)), F.struct(F.lit(i).alias("b"), F.col(b.column).alias("v")))
        for i, b in enumerate(narrow)
    ]
    grouped = (
        base.select(F.explode(F.array(*keys)).alias("k"))
        .where(F.col("k").isNotNull())
        .groupBy(F.col("k.b").alias("b"), F.col("k.v").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    # Per bracket the wanted local ranks; a value is wanted if one falls on its run of equal rows.
    asked = F.array(*[F.array(*[F.lit(r - b.below).cast("bigint") for r in b.ranks]) for b in narrow])
    wanted = F.exists(
        F.element_at(asked, F.col("b") + 1),
        lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")),
    )
    for row in grouped.withColumn("upto", upto).where(wanted).collect():
        b = narrow[row["b"]]
        for rank in b.ranks:
            if row["upto"] - row["n"] <= rank - b.below < row["upto"]:
                found[b.column][rank] = Found(row["v"], row["upto"] - row["n"] + b.below)


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks: Callable[[str, int], Iterable[int]],
    accuracy: int = SKETCH_ACCURACY,
    resolve_limit: int = RESOLVE_LIMIT,
) -> tuple[dict[str, int], dict[str, dict[int, Found]]]:
    """Non-null counts and what is found at 0-based ``ranks(name, count)`` of each column's ascending order."""
    names = {f"c{i}": name for i, name in enumerate(columns)}
    base = df.select(*[columns[name].alias(key) for key, name in names.items()])
    row = base.agg(*[F.count(key).alias(key) for key in names]).first()
    found: dict[str, dict[int, Found]] = {key: {} for key in names}

    pending = []
    for key, name in names.items():
        wanted = sorted(set(ranks(name, row[key]))) if row[key] else []
        if wanted:
            pending.append(_Bracket(key, None, None, 0, row[key], wanted))
    while any(b.size > resolve_limit for b in pending):
        wide = [b for b in pending if b.size > resolve_limit]
        pending = [b for b in pending if b.size <= resolve_limit]
        pending += _narrow(base, wide, found, accuracy)
    if pending:
        _resolve(base, pending, found)
    return ({name: row[key] for key, name in names.items()}, {name: found[key] for key, name in names.items()})


def quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probs: Sequence[float] | Mapping[str, Sequence[float]],
    method: str = "exact",
    accuracy: int = SKETCH_ACCURACY,
    resolve_limit: int = RESOLVE_LIMIT,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column (doubles); ``method='approx'`` takes one bounded sketch."""
    per_column = {name: list(probs[name] if isinstance(probs, Mapping) else probs) for name in columns}
    if not columns:
        return {}
    if method == "approx":
        keys = {name: f"q{i}" for i, name in enumerate(columns)}
        row = df.agg(
            *[F.percentile_approx(columns[n], per_column[n], accuracy).alias(k) for n, k in keys.items()]
        ).first()
        return {n: list(row[k]) if row[k] is not None else [None] * len(per_column[n]) for n, k in keys.items()}
    if method != "exact":
        raise ValueError("method is 'exact' or 'approx'")

    def ranks(name: str, n: int) -> list[int]:
        out = []
        for q in per_column[name]:
            at = q * (n - 1)
            out += [math.floor(at), math.ceil(at)]
        return out

    counts, values = order_statistics(df, columns, ranks, accuracy, resolve_limit)
    result: dict[str, list[float | None]] = {}
    for name, wanted in per_column.items():
        n, line = counts[name], []
        for q in wanted:
            if not n:
                line.append(None)
                continue
            at = q * (n - 1)
            lo, hi = values[name][math.floor(at)].value, values[name][math.ceil(at)].value
            line.append(float(lo) if lo == hi else float(lo) + (float(hi) - float(lo)) * (at - math.floor(at)))
        result[name] = line
    return result


def grouped_quantiles(df: DataFrame, group: str, columns: Mapping[str, Column], probs: Sequence[float], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact interpolated quantiles of each column within each group: rows (group, ``feature``, ``quantiles``).

    Groups are found in the data. One sketch by (group, feature) proposes a closed bracket around every wanted rank; one counting
    pass then keeps a count of what lies below and the distinct values inside. The plan has the same size for any number of
    groups, and a hot group is counted map-side before the shuffle. Null values are left out; a null group is a group; a group
    without a value of a feature has no row for it.
    """
    # The sketch is off by n / accuracy ranks at most, interpolation and rounding by two more: four cover them from n = accuracy on.
    step = 4.0 / accuracy
    pairs = F.array(*[F.struct(F.lit(name).alias("feature"), c.cast("double").alias("v")) for name, c in columns.items()])
    values = df.select(F.col(group).alias("g"), F.inline(pairs)).where(F.col("v").isNotNull())
    grid = [min(1.0, max(0.0, q + d)) for q in probs for d in (-step, step)]
    sketch = values.groupBy("g", "feature").agg(F.count("*").alias("n"), F.percentile_approx("v", grid, accuracy).alias("p"))
    small = F.col("n") <= accuracy

    def end(i: int, unbounded: float) -> Column:
        return F.when(small, F.lit(unbounded)).otherwise(F.get("p", F.lit(i)))

    brackets = sketch.select(
        F.col("g").alias("bg"),
        F.col("feature").alias("bf"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("q"),
                        (F.lit(prob) * (F.col("n") - 1)).alias("at"),
                        end(2 * i, -math.inf).alias("lo"),
                        end(2 * i + 1, math.inf).alias("hi"),
                    )
                    for i, prob in enumerate(probs)
                ]
            )
        ),
    )
    bracketed = brackets.groupBy("bg", "bf").agg(F.collect_list(F.struct("q", "at", "lo", "hi")).alias("b"))
    held = values.join(bracketed, F.col("g").eqNullSafe(F.col("bg")) & (F.col("feature") == F.col("bf")))
    held = held.select("g", "feature", "v", F.inline("b")).where(F.col("v") <= F.col("hi"))
    # Whatever lies below a bracket becomes one row, the one without a value.
    inside = F.when(F.col("v") >= F.col("lo"), F.col("v"))
    counted = held.groupBy("g", "feature", "q", "at", inside.alias("v")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("g", "feature", "q", "at").orderBy(F.col("v").asc_nulls_first())
    counted = counted.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("v")))

    ends = counted.groupBy("g", "feature", "q", "at").agg(at_rank(F.floor("at")).alias("lo"), at_rank(F.ceil("at")).alias("hi"))
    part = F.col("at") - F.floor("at")
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * part)
    lined = ends.groupBy("g", "feature").agg(F.array_sort(F.collect_list(F.struct("q", value.alias("x")))).alias("l"))
    return lined.select(F.col("g").alias(group), "feature", F.col("l.x").alias("quantiles"))
