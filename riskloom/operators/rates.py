"""Event rate and lift of values and numeric bins.

Many features are analysed in one pass: the wanted columns are turned into (feature, value) rows, which
map-side aggregation collapses before the one shuffle. The overall count and rate come from the same
shuffle as a scalar subquery, so there is neither a second scan nor a join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import TARGET
from riskloom.functions.bins import bin_index, bin_labels, equal_width_edges
from riskloom.functions.order_stats import quantiles
from riskloom.functions.scalars import number, one_row, share
from riskloom.sources.tables import require_columns

MIN_COUNT_RATIO = 0.005
DEFAULT_MIN_COUNT = 100

# Default order of every pattern report.
STRONGEST_FIRST = ["lift", "fraud_rate"]


def global_rate(df: DataFrame, target: str = TARGET) -> float:
    require_columns(df, target)
    rate = df.agg(F.avg(number(df, target))).first()[0]
    if rate is None:
        raise ValueError(f"target {target} holds no usable value")
    return rate


def least_count(rows: Column, explicit: int | None = None, ratio: float = MIN_COUNT_RATIO, default: int = DEFAULT_MIN_COUNT) -> Column:
    """The explicit count, else ``max(default, int(rows * ratio))``."""
    if explicit is not None:
        return F.lit(int(explicit)).cast("bigint")
    return F.greatest(F.lit(default).cast("bigint"), F.floor(rows * F.lit(ratio)))


def global_summary(df: DataFrame, target: str = TARGET, min_count: int | None = None, ratio: float = MIN_COUNT_RATIO, default: int = DEFAULT_MIN_COUNT) -> DataFrame:
    """Rows, event count and rate and the count a pattern must reach, as one row."""
    y = number(df, target)
    return df.agg(F.count("*").alias("rows"), F.sum(y).alias("fraud_count"), F.avg(y).alias("global_fraud_rate")).withColumn(
        "min_count", least_count(F.col("rows"), min_count, ratio, default)
    )


def with_risk_metrics(report: DataFrame, overall: Column) -> DataFrame:
    """Global rate, difference and lift (NULL when the global rate is 0) for a report with ``fraud_rate``."""
    rate = F.col("fraud_rate")
    return (
        report.withColumn("global_fraud_rate", overall)
        .withColumn("fraud_rate_diff", rate - F.col("global_fraud_rate"))
        .withColumn("lift", F.try_divide(rate, F.col("global_fraud_rate")))
    )


def _finish(grouped: DataFrame, features: list[str], rates: dict, keep: list[str], usable: Column | None = None) -> DataFrame:
    """Attach the totals of one feature's groups (all rows are in them) and keep groups large enough.

    Spark runs the pass over the table once for groups and totals if both have the same plan below. So the totals filter nothing before
    they sum, and both sides use all three counts. (Bins without a value are filtered before they are grouped: a pass of their own.)
    """
    first, summed = F.col("feature") == features[0], {"all_rows": "rows", "count": "n", "fraud_count": "s"}
    totals = one_row(grouped.agg(*[F.sum(F.when(first, F.col(c))).alias(n) for c, n in summed.items()]))
    out = grouped.withColumn("totals", totals)
    big = (F.col("all_rows") > 0) & (F.col("count") >= least_count(F.col("totals.rows"), rates["min_count"], rates["ratio"], rates["default"]))
    out = out.where(big if usable is None else big & usable)
    out = out.withColumn("fraud_rate", share(F.col("fraud_count"), F.col("count")))
    out = with_risk_metrics(out, share(F.col("totals.s"), F.col("totals.n")))
    measures = ["count", "fraud_count", "fraud_rate", "global_fraud_rate", "fraud_rate_diff", "lift"]
    return out.select(*keep[:2], *measures, *keep[2:])


def categorical_report(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    min_count: int | None = None,
    ratio: float = MIN_COUNT_RATIO,
    default: int = DEFAULT_MIN_COUNT,
) -> DataFrame:
    """(feature, value) report for every feature present; values as text, null is a value."""
    require_columns(df, target)
    names = [f for f in features if f in df.columns]
    if not names:
        raise ValueError("none of the features is in the table")
    y = number(df, target)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in names])
    grouped = (
        df.select(y.alias("y"), F.inline(pairs))
        .groupBy("feature", "value")
        .agg(F.count("*").alias("all_rows"), F.count("y").alias("count"), F.coalesce(F.sum("y"), F.lit(0.0)).cast("bigint").alias("fraud_count"))
    )
    rates = {"min_count": min_count, "ratio": ratio, "default": default}
    return _finish(grouped, names, rates, ["feature", "value"], F.col("count") > 0)


def category_rate(df: DataFrame, feature: str, target: str = TARGET, min_count: int | None = None, ratio: float = MIN_COUNT_RATIO, default: int = DEFAULT_MIN_COUNT) -> DataFrame:
    """Report of one feature, its values in their own type."""
    require_columns(df, feature, target)
    grouped = (
        df.select(number(df, target).alias("y"), F.col(feature).alias("value"))
        .groupBy("value")
        .agg(F.count("*").alias("all_rows"), F.count("y").alias("count"), F.coalesce(F.sum("y"), F.lit(0.0)).cast("bigint").alias("fraud_count"))
        .withColumn("feature", F.lit(feature))
    )
    rates = {"min_count": min_count, "ratio": ratio, "default": default}
    return _finish(grouped, [feature], rates, ["feature", "value"], F.col("count") > 0)


def numeric_edges(
    df: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    method: str = "quantile",
    quantile_method: str = "exact",
    target: str | None = None,
) -> dict[str, list[float]]:
    """Bin edges per feature with at least two distinct values; equal quantiles are merged.

    With a ``target`` only rows that have one count.
    """
    known = df if target is None else df.where(number(df, target).isNotNull())
    columns = {f: number(df, f) for f in features if f in df.columns}
    if method == "quantile":
        probs = [i / bins for i in range(bins + 1)]
        found = quantiles(known, columns, probs, quantile_method)
        edges = {f: sorted({e for e in line if e is not None}) for f, line in found.items()}
    elif method == "equal_width":
        names = list(columns)
        row = known.agg(*[agg(columns[f]).alias(f"{k}{i}") for i, f in enumerate(names) for k, agg in (("lo", F.min), ("hi", F.max))]).first()
        edges = {f: equal_width_edges(row[f"lo{i}"], row[f"hi{i}"], bins) if row[f"lo{i}"] is not None and row[f"lo{i}"] < row[f"hi{i}"] else [] for i, f in enumerate(names)}
    else:
        raise ValueError("method is 'quantile' or 'equal_width'; custom edges go straight into numeric_report")
    return {f: e for f, e in edges.items() if len(e) > 1}


def open_ended(edges: Mapping[str, Sequence[float]]) -> dict[str, list[float]]:
    """The same edges with the outer ones moved to infinity, so that other data falls into some bin."""
    return {f: [-math.inf, *list(e)[1:-1], math.inf] for f, e in edges.items()}


def numeric_report(
    df: DataFrame,
    edges: Mapping[str, Sequence[float]],
    target: str = TARGET,
    min_count: int | None = None,
    ratio: float = MIN_COUNT_RATIO,
    default: int = DEFAULT_MIN_COUNT,
) -> DataFrame:
    """(feature, bin) report with the extremes and mean of each bin.

    Rows without a value fall out of the bins but stay in the global rate.
    """
    require_columns(df, target)
    names = [f for f in edges if f in df.columns]
    if not names:
        raise ValueError("none of the features is in the table")
    cuts = {f: sorted({float(e) for e in edges[f]}) for f in names}
    # Values first, bins in a second projection: each number is parsed once, then compared log2(bins) times.
    values = df.select(number(df, target).alias("y"), *[number(df, f).alias(f"x{i}") for i, f in enumerate(names)])
    structs = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), bin_index(F.col(f"x{i}"), cuts[f]).alias("bin_id"), F.col(f"x{i}").alias("x"))
            for i, f in enumerate(names)
        ]
    )
    known = F.when(F.col("y").isNotNull(), F.col("x"))
    grouped = (
        values.select("y", F.inline(structs))
        .groupBy("feature", "bin_id")
        .agg(
            F.count("*").alias("all_rows"),
            F.count("y").alias("count"),
            F.coalesce(F.sum("y"), F.lit(0.0)).cast("bigint").alias("fraud_count"),
            F.min(known).alias("min_value"),
            F.max(known).alias("max_value"),
            F.avg(known).alias("mean_value"),
        )
    )
    bins = [(f, i, label, cuts[f][i], cuts[f][i + 1]) for f in names for i, label in enumerate(bin_labels(cuts[f]))]
    labels = F.create_map(*[x for f, i, label, _, _ in bins for x in (F.lit(f"{f}/{i}"), F.lit(label))])
    rates = {"min_count": min_count, "ratio": ratio, "default": default}
    labelled = grouped.withColumn("bin", F.element_at(labels, F.concat_ws("/", "feature", "bin_id")))
    return _finish(
        labelled, names, rates, ["feature", "bin", "min_value", "max_value", "mean_value", "bin_id"],
        F.col("bin_id").isNotNull() & (F.col("count") > 0),
    )


def bin_rate(
    df: DataFrame,
    feature: str,
    target: str = TARGET,
    bins: int | Sequence[float] = 10,
    method: str = "quantile",
    **least,
) -> DataFrame:
    """Report of one numeric feature; an empty report when it has fewer than two distinct values."""
    require_columns(df, feature, target)
    edges = {feature: list(bins)} if method == "custom" else numeric_edges(df, [feature], bins, method, target=target)
    if not edges:
        return numeric_report(df.limit(0), {feature: [-math.inf, math.inf]}, target, **least)
    return numeric_report(df, edges, target, **least)


def many_bin_rates(df: DataFrame, features: Sequence[str], target: str = TARGET, bins: int = 10, method: str = "quantile", **least) -> DataFrame:
    edges = numeric_edges(df, features, bins, method, target=target)
    if not edges:
        raise ValueError("no feature has two distinct values")
    return numeric_report(df, edges, target, **least)


def strong_patterns(report: DataFrame, min_lift: float = 2.0, min_rate: float | None = None, min_count: int | Column | None = None) -> DataFrame:
    """Patterns above a lift and, if given, a rate and a count (defaults: 2.0 for bins; use 1.5 and 100 for values)."""
    keep = F.col("lift") >= min_lift
    if min_rate is not None:
        keep = keep & (F.col("fraud_rate") >= min_rate)
    if min_count is not None:
        keep = keep & (F.col("count") >= min_count)
    return report.where(keep)
