"""Support, event rate and lift of conditions: business segments and fixed rules.

All conditions of a report are counted in one aggregation over the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import PRIORITY_RULES, SEGMENTS, SPENDING_COLUMNS, TARGET
from riskloom.functions.order_stats import quantiles
from riskloom.functions.scalars import number, says_false, says_true, share
from riskloom.sources.tables import require_columns


def evaluate_conditions(df: DataFrame, conditions: Mapping[str, Column], target: str = TARGET, name: str = "rule") -> DataFrame:
    """One row per condition. An empty condition has rate and lift 0; its difference is 0 for a rule."""
    require_columns(df, target)
    y = number(df, target)
    names = list(conditions)
    # Conditions become 0/1 columns first, so that each is evaluated once per row.
    bits = df.select(y.alias("y"), *[F.coalesce(conditions[n], F.lit(False)).alias(f"c{i}") for i, n in enumerate(names)]).where(F.col("y").isNotNull())
    agg = bits.agg(
        F.count("*").alias("n"),
        F.sum("y").alias("s"),
        *[a for i in range(len(names)) for a in (F.count_if(f"c{i}").alias(f"n{i}"), F.sum(F.when(F.col(f"c{i}"), F.col("y"))).alias(f"s{i}"))],
    )
    rows = F.array(*[F.struct(F.lit(n).alias(name), F.col(f"n{i}").alias("support"), F.col(f"s{i}").alias("hits")) for i, n in enumerate(names)])
    empty, overall = F.col("support") == 0, F.coalesce(share(F.col("s"), F.col("n")), F.lit(0.0))
    rate = F.when(empty, 0.0).otherwise(share(F.col("hits"), F.col("support")))
    none = F.lit(0.0) if name == "rule" else -overall
    return agg.select("n", "s", F.inline(rows)).select(
        name,
        "support",
        F.when(empty, 0.0).otherwise(share(F.col("support"), F.col("n"))).alias("support_rate"),
        F.coalesce(F.col("hits"), F.lit(0.0)).cast("bigint").alias("fraud_count"),
        rate.alias("fraud_rate"),
        overall.alias("global_fraud_rate"),
        F.when(empty, none).otherwise(rate - overall).alias("fraud_rate_diff"),
        F.when(empty, 0.0).otherwise(F.try_divide(rate, overall)).alias("lift"),
    )


def _column_of(df: DataFrame, name: str) -> str | None:
    names = SPENDING_COLUMNS if name == "spending" else [name]
    return next((n for n in names if n in df.columns), None)


def quantile_limits(df: DataFrame, method: str = "exact") -> dict[tuple[str, float], float | None]:
    """The quantiles the segments compare with, fitted on ``df`` in one go."""
    wanted: dict[str, list[float]] = {}
    for _, conditions in SEGMENTS.values():
        for kind, source, q in conditions:
            column = _column_of(df, source)
            if kind in ("low", "high") and column and q not in wanted.setdefault(column, []):
                wanted[column].append(q)
    values = quantiles(df, {c: number(df, c) for c in wanted}, wanted, method)
    return {(c, q): v for c, qs in wanted.items() for q, v in zip(qs, values[c])}


def _condition(df: DataFrame, kind: str, source: str, argument, limits: Mapping) -> Column:
    column = _column_of(df, source)
    if column is None:
        return F.lit(False)
    if kind in ("low", "high"):
        limit = limits.get((column, argument))
        if limit is None:
            return F.lit(False)
        x = number(df, column)
        return x <= F.lit(limit) if kind == "low" else x >= F.lit(limit)
    if kind == "equals":
        return F.col(column) == F.lit(argument)
    if kind == "positive":
        return number(df, column) > 0
    return says_true(df, column) if kind == "true" else says_false(df, column)


def segment_conditions(df: DataFrame, limits: Mapping[tuple[str, float], float | None] | None = None) -> dict[str, Column]:
    """Segment predicates; the limits default to the frame's own quantiles, pass the train ones to reuse them."""
    used = quantile_limits(df) if limits is None else limits
    out = {}
    for name, (_, parts) in SEGMENTS.items():
        whole = F.lit(True)
        for kind, source, argument in parts:
            whole = whole & _condition(df, kind, source, argument, used)
        out[name] = whole
    return out


def segment_report(df: DataFrame, target: str = TARGET, limits: Mapping | None = None) -> DataFrame:
    report = evaluate_conditions(df, segment_conditions(df, limits), target, "segment_name")
    texts = F.create_map(*[F.lit(x) for name, (text, _) in SEGMENTS.items() for x in (name, text)])
    return report.withColumn("description", F.element_at(texts, F.col("segment_name")))


def rule_condition(df: DataFrame, flags: list[str]) -> Column:
    whole = F.lit(True)
    for f in flags:
        whole = whole & (number(df, f) == 1)
    return whole


def priority_rules(df: DataFrame, target: str = TARGET, min_support: int = 30) -> DataFrame:
    """The fixed flag rules whose flags exist, with at least ``min_support`` rows; ``order`` counts the terms."""
    rules = {name: flags for name, flags in PRIORITY_RULES.items() if set(flags) <= set(df.columns)}
    if not rules:
        raise ValueError("no priority rule has all its flags in the table")
    report = evaluate_conditions(df, {n: rule_condition(df, f) for n, f in rules.items()}, target)
    terms = F.create_map(*[F.lit(x) for n, f in rules.items() for x in (n, len(f))])
    return report.where(F.col("support") >= min_support).withColumn("order", F.element_at(terms, F.col("rule")))
