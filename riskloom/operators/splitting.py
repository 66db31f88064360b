"""Exact train / validation / test splits that never sort or shuffle the table.

A split is a cut in a total order. The rows at the two cut positions are found by order statistics, then
every row compares its own key with two literals: a narrow projection, also when a third of all rows
share one timestamp.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import RAW_TIMESTAMP, TARGET, TIMESTAMP
from riskloom.functions.order_stats import RESOLVE_LIMIT, Found, order_statistics
from riskloom.functions.scalars import clock_micros, number
from riskloom.operators.timing import parsed_time
from riskloom.sources.tables import require_columns

SPLITS = ("train", "validation", "test")


def _check_sizes(train: float, valid: float, test: float) -> None:
    if abs(train + valid + test - 1.0) > 1e-9:
        raise ValueError("split sizes must add up to 1")


def ensure_datetime(df: DataFrame, timestamp: str = TIMESTAMP, fallback: str = RAW_TIMESTAMP) -> DataFrame:
    for name in (timestamp, fallback):
        if name in df.columns:
            return df.withColumn(timestamp, parsed_time(df, name))
    raise ValueError(f"neither {timestamp} nor {fallback} is in the table")


def _before(df: DataFrame, key: Column, tie: Column, cut: Found, rank: int, resolve_limit: int) -> Column:
    """Condition that holds for exactly the first ``rank`` rows by (key, tie); ``cut`` was found at ``rank``."""
    if cut.below == rank:
        return key < F.lit(cut.value)
    inside = rank - cut.below
    tied = df.where(key == F.lit(cut.value))
    _, found = order_statistics(tied, {"t": tie}, lambda _, n: [inside], resolve_limit=resolve_limit)
    return (key < F.lit(cut.value)) | ((key == F.lit(cut.value)) & (tie < F.lit(found["t"][inside].value)))


def time_split(
    df: DataFrame,
    tie: str,
    target: str = TARGET,
    timestamp: str = TIMESTAMP,
    fallback: str = RAW_TIMESTAMP,
    train: float = 0.70,
    valid: float = 0.15,
    test: float = 0.15,
    resolve_limit: int = RESOLVE_LIMIT,
) -> DataFrame:
    """Rows in time order cut at ``int(n * train)`` and ``int(n * (train + valid))``, as a ``split`` column.

    Rows without a time are dropped. ``tie`` is a unique integer column that orders equal times.
    """
    _check_sizes(train, valid, test)
    require_columns(df, target, tie)
    timed = ensure_datetime(df, timestamp, fallback).where(F.col(timestamp).isNotNull())
    key, order = clock_micros(F.col(timestamp)), F.col(tie).cast("bigint")

    def cuts(_, n: int) -> list[int]:
        return [c for c in (int(n * train), int(n * (train + valid))) if c < n]

    counts, values = order_statistics(timed, {"k": key}, cuts, resolve_limit=resolve_limit)
    n, at = counts["k"], values["k"]

    def first(rank: int) -> Column:
        return F.lit(True) if rank >= n else _before(timed, key, order, at[rank], rank, resolve_limit)

    split = F.when(first(int(n * train)), "train").when(first(int(n * (train + valid))), "validation").otherwise("test")
    return timed.withColumn("split", split)


def apportion(counts: list[int], draws: int) -> list[int]:
    """``draws`` spread over classes in proportion to their counts, largest remainders first."""
    total = sum(counts)
    ideal = [c * draws / total for c in counts]
    out = [math.floor(x) for x in ideal]
    by_remainder = sorted(range(len(counts)), key=lambda i: (out[i] - ideal[i], i))
    for i in by_remainder[: draws - sum(out)]:
        out[i] += 1
    return out


def stratified_split(
    df: DataFrame,
    tie: str,
    target: str = TARGET,
    train: float = 0.70,
    valid: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
    resolve_limit: int = RESOLVE_LIMIT,
) -> DataFrame:
    """Exact per-class sizes in the order of a seeded hash of the unique integer column ``tie``.

    The 64-bit hash of one integer and a constant is one-to-one, so the order has no ties.
    """
    _check_sizes(train, valid, test)
    require_columns(df, target, tie)
    classes = sorted((r[0], r[1]) for r in df.where(F.col(target).isNotNull()).groupBy(target).count().collect())
    counts = [c for _, c in classes]
    n_train = apportion(counts, math.floor(sum(counts) * train))
    rest = [c - t for c, t in zip(counts, n_train)]
    n_valid = apportion(rest, math.floor(sum(rest) * (valid / (valid + test)))) if sum(rest) else rest
    key = F.xxhash64(F.col(tie).cast("bigint"), F.lit(seed))

    def cuts(name: str, n: int) -> list[int]:
        i = int(name)
        return [c for c in (n_train[i], n_train[i] + n_valid[i]) if c < n]

    per_class = {str(i): F.when(F.col(target) == F.lit(v), key) for i, (v, _) in enumerate(classes)}
    _, at = order_statistics(df, per_class, cuts, resolve_limit=resolve_limit)
    split = F.lit(None).cast("string")
    for i, (value, n) in enumerate(classes):

        def first(rank: int) -> Column:
            return F.lit(True) if rank >= n else key < F.lit(at[str(i)][rank].value)

        own = F.when(first(n_train[i]), "train").when(first(n_train[i] + n_valid[i]), "validation").otherwise("test")
        split = F.when(F.col(target) == F.lit(value), own).otherwise(split)
    return df.where(F.col(target).isNotNull()).withColumn("split", split)


def split_summary(df: DataFrame, target: str = TARGET, timestamp: str = TIMESTAMP, strategy: str | None = None) -> DataFrame:
    y = number(df, target)
    times = [F.min(timestamp), F.max(timestamp)] if timestamp in df.columns else [F.lit(None).cast("timestamp_ntz")] * 2
    out = df.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(y), F.lit(0.0)).cast("bigint").alias("fraud_count"),
        F.count_if(y == 0).alias("non_fraud_count"),
        F.avg(y).alias("fraud_rate"),
        times[0].alias("start_time"),
        times[1].alias("end_time"),
    )
    return out if strategy is None else out.withColumn("split_strategy", F.lit(strategy))


def split_table(
    df: DataFrame,
    tie: str,
    strategy: str = "time",
    target: str = TARGET,
    timestamp: str = TIMESTAMP,
    fallback: str = RAW_TIMESTAMP,
    train: float = 0.70,
    valid: float = 0.15,
    test: float = 0.15,
    min_events: int = 50,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """The table with its ``split`` column, and the summary. ``auto`` takes the time split unless it has no
    time column or a split holds fewer than ``min_events`` events; then it stratifies."""
    if strategy not in ("time", "stratified", "auto"):
        raise ValueError("strategy is 'time', 'stratified' or 'auto'")
    sizes = {"train": train, "valid": valid, "test": test}
    if strategy != "stratified":
        try:
            timed = time_split(df, tie, target, timestamp, fallback, **sizes)
        except ValueError:
            if strategy == "time":
                raise
        else:
            events = {r["split"]: r["fraud_count"] for r in split_summary(timed, target, timestamp).collect()} if strategy == "auto" else {}
            if strategy == "time" or min(events.get(s, 0) for s in SPLITS) >= min_events:
                return timed, split_summary(timed, target, timestamp, "time")
    drawn = stratified_split(df, tie, target, seed=seed, **sizes)
    return drawn, split_summary(drawn, target, timestamp, "stratified")
