"""Flag combinations and categorical pairs, counted in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import MINED_PAIRS, TARGET
from riskloom.functions.scalars import is_numeric, null_if_nan, number, one_row, share
from riskloom.sources.tables import require_columns

BITS_PER_MASK = 60


def flag_columns(df: DataFrame) -> list[str]:
    """0/1 typed columns named like a flag or an interaction."""
    return [c for c in df.columns if (c.endswith("_flag") or "_x_" in c) and is_numeric(df, c)]


def _rule_metrics(grouped: DataFrame, totals: Column, min_support: int, keep: list[str]) -> DataFrame:
    out = grouped.where(F.col("support") >= min_support).withColumn("totals", totals)
    overall, rate = share(F.col("totals.s"), F.col("totals.n")), share(F.col("hits"), F.col("support"))
    return out.select(
        *keep,
        "support",
        share(F.col("support"), F.col("totals.n")).alias("support_rate"),
        F.col("hits").cast("bigint").alias("fraud_count"),
        rate.alias("fraud_rate"),
        overall.alias("global_fraud_rate"),
        (rate - overall).alias("fraud_rate_diff"),
        F.try_divide(rate, overall).alias("lift"),
        "order",
    )


def flag_patterns(df: DataFrame, flags: Sequence[str], target: str = TARGET) -> DataFrame:
    """Rows collapsed to distinct flag patterns (bit masks) with row and event counts."""
    y = number(df, target)
    masks = []
    for start in range(0, len(flags), BITS_PER_MASK):
        mask = F.lit(0).cast("bigint")
        for i, f in enumerate(flags[start : start + BITS_PER_MASK]):
            mask = mask.bitwiseOR(F.when(number(df, f) == 1, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
        masks.append(mask.alias(f"mask{start // BITS_PER_MASK}"))
    rows = df.where(y.isNotNull()).select(y.alias("y"), *masks)
    return rows.groupBy(*[c for c in rows.columns if c != "y"]).agg(F.count("*").alias("n"), F.sum("y").alias("s"))


def _drawn(flags: Column, order: int, last: Column | None = None, prefix: Column | None = None) -> Column:
    """All ascending combinations of ``order`` elements of an ascending array, as an array of arrays."""
    rest = flags if last is None else F.filter(flags, lambda x: x > last)

    def grown(x: Column) -> Column:
        return F.array(x) if prefix is None else F.array_append(prefix, x)

    if order == 1:
        return F.transform(rest, grown)
    return F.flatten(F.transform(rest, lambda x: _drawn(flags, order - 1, x, grown(x))))


def flag_combinations(
    df: DataFrame,
    flags: Sequence[str] | None = None,
    target: str = TARGET,
    min_support: int = 50,
    max_order: int = 3,
) -> DataFrame:
    """Every combination of 2 to ``max_order`` flags that are all set on at least ``min_support`` rows.

    The table is reduced to its distinct flag patterns first; combinations are drawn per pattern from the
    flags set in it, so the cost follows the patterns, not the rows.
    """
    require_columns(df, target)
    names = [f for f in (flags if flags is not None else flag_columns(df)) if f in df.columns]
    if len(names) < 2:
        raise ValueError("combinations need at least two flags")
    patterns = flag_patterns(df, names, target)

    def is_set(i: int) -> Column:
        return F.col(f"mask{i // BITS_PER_MASK}").bitwiseAND(F.lit(1 << (i % BITS_PER_MASK))) != 0

    totals = one_row(patterns.agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    # A pattern may yield thousands of combinations: spread the patterns before drawing them.
    spread = patterns.repartition(*[c for c in patterns.columns if c.startswith("mask")])
    indexed = spread.select("n", "s", F.array_compact(F.array(*[F.when(is_set(i), F.lit(i)) for i in range(len(names))])).alias("set"))
    combos = F.concat(*[_drawn(F.col("set"), order) for order in range(2, max_order + 1)])
    texts = F.array(*[F.lit(n) for n in names])
    grouped = (
        indexed.select("n", "s", F.explode(combos).alias("combo"))
        .groupBy("combo")
        .agg(F.sum("n").alias("support"), F.sum("s").alias("hits"))
        .withColumn("rule", F.array_join(F.transform("combo", lambda i: F.element_at(texts, i + 1)), " AND "))
        .withColumn("order", F.size("combo"))
    )
    return _rule_metrics(grouped, totals, min_support, ["rule"])


def categorical_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]] = MINED_PAIRS, target: str = TARGET, min_support: int = 50) -> DataFrame:
    """Value pairs of the listed column pairs with at least ``min_support`` rows (null is a value)."""
    require_columns(df, target)
    have = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    if not have:
        raise ValueError("none of the pairs is in the table")

    def text(name: str) -> Column:
        c = F.col(name)
        return (null_if_nan(c) if dict(df.dtypes)[name] in ("double", "float") else c).cast("string")

    structs = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), text(a).alias("value_a"), F.lit(b).alias("feature_b"), text(b).alias("value_b"))
            for a, b in have
        ]
    )
    y = number(df, target)
    grouped = (
        df.where(y.isNotNull())
        .select(y.alias("y"), F.inline(structs))
        .groupBy("feature_a", "value_a", "feature_b", "value_b")
        .agg(F.count("*").alias("support"), F.sum("y").alias("hits"))
    )
    first = (F.col("feature_a") == have[0][0]) & (F.col("feature_b") == have[0][1])
    # Nothing is filtered before the sums: totals and pairs then have the same plan below, which Spark runs once.
    totals = one_row(grouped.agg(*[F.sum(F.when(first, F.col(c))).alias(n) for c, n in (("support", "n"), ("hits", "s"))]))

    def term(side: str) -> Column:
        return F.concat(F.col(f"feature_{side}"), F.lit("="), F.coalesce(F.col(f"value_{side}"), F.lit("nan")))

    named = grouped.withColumn("rule", F.concat(term("a"), F.lit(" AND "), term("b"))).withColumn("order", F.lit(2))
    return _rule_metrics(named, totals, min_support, ["rule", "feature_a", "value_a", "feature_b", "value_b"])
