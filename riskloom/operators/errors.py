"""Error analysis: which rows the model got wrong, and what they look like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.fixed_values import ERROR_CATEGORICAL, ERROR_NUMERIC
from riskloom.functions.order_stats import SKETCH_ACCURACY, grouped_quantiles
from riskloom.functions.scalars import null_if_nan, number, one_row, share

ERROR_TYPES = ["FN", "FP", "TN", "TP"]


def attach_predictions(features: DataFrame, predictions: DataFrame, row_id: str) -> DataFrame:
    """Features and predictions side by side; both must hold the same number of rows, each id once."""
    rows, scored = features.count(), predictions.count()
    if rows != scored:
        raise ValueError(f"{scored} predictions for {rows} rows")
    return features.join(predictions, row_id, "inner")


def with_error_type(df: DataFrame) -> DataFrame:
    y, p = F.col("y_true") == 1, F.col("y_pred") == 1
    kind = F.when(y & p, "TP").when(~y & p, "FP").when(y & ~p, "FN").otherwise("TN")
    return df.withColumn("error_type", kind)


def error_rows(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("error_type") == kind)


def error_counts(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("error_type").agg(F.count("*").alias("count"))
    total = one_row(grouped.agg(F.sum("count").alias("n")))
    return grouped.withColumn("total", total).select("error_type", "count", share(F.col("count"), F.col("total.n")).alias("ratio"))


def numeric_by_error_type(df: DataFrame, columns: Sequence[str] = ERROR_NUMERIC, groups: Sequence[str] | None = ERROR_TYPES, group: str = "error_type", method: str = "exact") -> DataFrame:
    """Rows, mean, median and 90 % quantile of each column per error type; ``groups=None`` takes every value of ``group``.

    (type, column) are keys of the quantiles, so the plan doesn't grow with the types and no type is gathered in a task.
    """
    if method not in ("exact", "approx"):
        raise ValueError("method is 'exact' or 'approx'")
    names = [c for c in columns if c in df.columns]
    rows = df if groups is None else df.where(F.col(group).isin(list(groups)))
    rows = rows.select(group, *[number(df, c).alias(c) for c in names])
    means = rows.groupBy(group).agg(F.count("*").alias("rows"), *[F.avg(c).alias(f"{c}_mean") for c in names])
    if not names:
        return means
    if method == "approx":
        wide = rows.groupBy(group).agg(*[F.percentile_approx(F.col(c).cast("double"), [0.5, 0.9], SKETCH_ACCURACY).alias(f"_{c}") for c in names])
    else:
        found = grouped_quantiles(rows, group, {c: F.col(c) for c in names}, [0.5, 0.9])
        wide = found.groupBy(group).agg(*[F.max(F.when(F.col("feature") == c, F.col("quantiles"))).alias(f"_{c}") for c in names])
    out = means.join(wide.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group")), "left")
    measures = [x for c in names for x in (F.col(f"{c}_mean"), F.get(f"_{c}", F.lit(0)).alias(f"{c}_median"), F.get(f"_{c}", F.lit(1)).alias(f"{c}_p90"))]
    return out.select(group, "rows", *measures)


def categories_by_error_type(df: DataFrame, columns: Sequence[str] = ERROR_CATEGORICAL, top: int = 10) -> DataFrame:
    """The ``top`` most frequent values per error type and column, nulls shown as ``missing``."""
    names = [c for c in columns if c in df.columns]
    kinds = dict(df.dtypes)

    def text(c: str):
        x = null_if_nan(F.col(c)) if kinds[c] in ("double", "float") else F.col(c)
        return F.coalesce(x.cast("string"), F.lit("missing"))

    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), text(c).alias("value")) for c in names])
    counted = df.select("error_type", F.inline(pairs)).groupBy("error_type", "feature", "value").agg(F.count("*").alias("count"))
    totals = counted.where(F.col("feature") == names[0]).groupBy("error_type").agg(F.sum("count").alias("n"))
    rank = F.row_number().over(Window.partitionBy("error_type", "feature").orderBy(F.desc("count"), F.asc("value")))
    return (
        counted.withColumn("rank", rank)
        .where(F.col("rank") <= top)
        .join(totals, "error_type")
        .select("error_type", "feature", "value", share(F.col("count"), F.col("n")).alias("ratio"), "count")
    )
