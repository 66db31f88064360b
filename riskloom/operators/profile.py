"""Table profiling.

All per-column figures of a table come from one aggregation, laid out as rows by ``stack``; value lists
come from one unpivot and group-by. Reports are not sorted here: order belongs to the sink.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.fixed_values import TARGET
from riskloom.functions.bins import bin_index
from riskloom.functions.order_stats import quantiles
from riskloom.functions.scalars import is_numeric, null_if_nan, number, one_row, share
from riskloom.sources.tables import require_columns


def _seen(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL."""
    c = F.col(f"`{name}`")
    return null_if_nan(c) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c


def _rows_per_column(df: DataFrame, figures: dict[str, dict[str, Column]], shared: dict[str, Column]) -> DataFrame:
    """One aggregation over the table, one output row per column name in ``figures``."""
    names = list(figures)
    measures = list(next(iter(figures.values())))
    aggs = [figures[n][m].alias(f"m{i}_{m}") for i, n in enumerate(names) for m in measures]
    agg = df.agg(*aggs, *[c.alias(k) for k, c in shared.items()])
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column"), *[F.col(f"m{i}_{m}").alias(m) for m in measures])
            for i, n in enumerate(names)
        ]
    )
    return agg.select(F.inline(rows), *shared) if shared else agg.select(F.inline(rows))


def basic_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("num_rows")).withColumn("num_columns", F.lit(len(df.columns)).cast("bigint"))


def _distinct_values(df: DataFrame) -> DataFrame:
    """Exact number of distinct values per column that has any.

    Columns of one type become rows of a place and a value, so a row of the shuffle holds one value and not all columns.
    """
    kinds: dict[str, list[int]] = {}
    for i, (_, kind) in enumerate(df.dtypes):
        kinds.setdefault(kind, []).append(i)
    counted = None
    for places in kinds.values():
        values = df.select(*[_seen(df, df.columns[i]).alias(str(i)) for i in places])
        rows = values.unpivot([], [str(i) for i in places], "place", "value") if len(places) > 1 else values.toDF("value").withColumn("place", F.lit(str(places[0])))
        found = rows.where(F.col("value").isNotNull()).groupBy("place", "value").agg(F.lit(1).alias("one")).groupBy("place").agg(F.count("*").alias("unique_count"))
        counted = found if counted is None else counted.unionByName(found)
    names = F.array(*[F.lit(n) for n in df.columns])
    return counted.select(F.get(names, F.col("place").cast("int")).alias("column"), "unique_count")


def column_types(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, non-null, null and distinct count and null rate per column.

    Exact distinct counts of all columns shuffle each (column, value) once; ``approximate`` keeps
    one bounded sketch per column instead.
    """
    figures = {n: {"non_null_count": F.count(_seen(df, n))} for n in df.columns}
    if approximate:
        for n in df.columns:
            figures[n]["unique_count"] = F.approx_count_distinct(_seen(df, n))
    out = _rows_per_column(df, figures, {"num_rows": F.count("*")})
    if not approximate:
        out = out.join(F.broadcast(_distinct_values(df)), "column", "left").withColumn("unique_count", F.coalesce("unique_count", F.lit(0).cast("bigint")))
    kinds = F.create_map(*[F.lit(x) for n, k in df.dtypes for x in (n, k)])
    return out.select(
        "column",
        F.element_at(kinds, F.col("column")).alias("dtype"),
        "non_null_count",
        (F.col("num_rows") - F.col("non_null_count")).alias("null_count"),
        "unique_count",
        share(F.col("num_rows") - F.col("non_null_count"), F.col("num_rows")).alias("null_rate"),
        share(F.col("unique_count"), F.col("num_rows")).alias("unique_rate"),
    )


def feature_groups(df: DataFrame, target: str = TARGET, high_cardinality: int = 1000) -> DataFrame:
    """One row per column with its group and whether it is datetime-like and high-cardinality."""
    counts = column_types(df).where(F.col("column") != target)
    numeric = [n for n in df.columns if is_numeric(df, n)]
    boolean = [n for n in df.columns if isinstance(df.schema[n].dataType, T.BooleanType)]
    c = F.col("column")
    other = ~c.isin(numeric + boolean)
    return counts.select(
        "column",
        F.when(c.isin(boolean), "boolean").when(c.isin(numeric), "numeric").otherwise("categorical").alias("feature_group"),
        (other & F.lower(c).rlike("time|date")).alias("datetime_like"),
        (F.col("unique_count") > high_cardinality).alias("high_cardinality"),
        "unique_count",
    )


def distinct_row_counts(df: DataFrame) -> DataFrame:
    """Every distinct row once, with its number of copies (``copies``)."""
    return df.groupBy(*[F.col(f"`{n}`") for n in df.columns]).agg(F.count("*").alias("copies"))


def dataset_overview(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows, columns, duplicates, missing cells and target counts as one row.

    Everything is derived from the distinct rows and their number of copies, so hot copies are merged
    before the shuffle and one shuffle serves the whole report.
    """
    rows = distinct_row_counts(df)
    n = F.col("copies")
    missing = sum((_seen(df, c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    aggs = [
        F.sum(n).alias("num_rows"),
        F.sum(n - 1).alias("duplicate_rows"),
        F.sum(missing * n).alias("total_missing_values"),
    ]
    cells = F.col("num_rows") * len(df.columns)
    out = [
        "num_rows",
        F.lit(len(df.columns)).cast("bigint").alias("num_columns"),
        "duplicate_rows",
        share(F.col("duplicate_rows"), F.col("num_rows")).alias("duplicate_rate"),
        "total_missing_values",
        share(F.col("total_missing_values"), cells).alias("total_missing_rate"),
    ]
    if target in df.columns:
        y = number(df, target)
        aggs += [F.sum(y * n).alias("s"), F.sum(F.when(y.isNotNull(), n)).alias("k"), F.sum(F.when(y == 0, n)).alias("z")]
        out += [
            F.lit(target).alias("target_column"),
            F.coalesce(F.col("s"), F.lit(0)).cast("bigint").alias("fraud_count"),
            F.coalesce(F.col("z"), F.lit(0)).alias("non_fraud_count"),
            share(F.col("s"), F.col("k")).alias("fraud_rate"),
        ]
    return rows.agg(*aggs).select(*out)


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    require_columns(df, target)
    grouped = df.groupBy(target).agg(F.count("*").alias("count"))
    total = one_row(grouped.agg(F.sum("count").alias("n")))
    return grouped.withColumn("total", total).select(target, "count", share(F.col("count"), F.col("total.n")).alias("rate"))


def present_cells(df: DataFrame) -> Column:
    """How many cells of the table hold a value, as one aggregate."""
    return sum((F.count(_seen(df, n)) for n in df.columns), F.lit(0).cast("bigint"))


def missing_report(df: DataFrame) -> DataFrame:
    figures = {n: {"non_missing_count": F.count(_seen(df, n))} for n in df.columns}
    out = _rows_per_column(df, figures, {"num_rows": F.count("*")})
    return out.select(
        "column",
        (F.col("num_rows") - F.col("non_missing_count")).alias("missing_count"),
        share(F.col("num_rows") - F.col("non_missing_count"), F.col("num_rows")).alias("missing_rate"),
        "non_missing_count",
    )


def _as_text_pairs(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot the named columns to (column, value as text), keeping other columns beside them."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), _seen(df, n).cast("string").alias("value")) for n in names])
    return df.select(*[F.col(k) for k in keep], F.inline(pairs))


def column_overview(df: DataFrame, samples: int = 5, approximate: bool = False) -> DataFrame:
    """Column types plus the first ``samples`` distinct values in text order.

    ``row_number() <= n`` lets Spark keep n rows per column and task before the shuffle.
    """
    values = _as_text_pairs(df, df.columns).where(F.col("value").isNotNull()).distinct()
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    shown = (
        values.withColumn("rank", rank)
        .where(F.col("rank") <= samples)
        .groupBy("column")
        .agg(F.array_join(F.sort_array(F.collect_list("value")), ", ").alias("sample_values"))
    )
    return column_types(df, approximate).join(shown, "column", "left").withColumn(
        "sample_values", F.coalesce("sample_values", F.lit(""))
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Count, mean, deviation, quartiles, extremes, missing and bias-corrected skewness per numeric column."""
    names = [n for n in (columns or df.columns) if is_numeric(df, n)]
    q = quantiles(df, {n: number(df, n) for n in names}, [0.25, 0.5, 0.75], method)
    figures = {}
    for name in names:
        x = number(df, name)
        n = F.count(x).cast("double")
        corrected = F.try_divide(F.skewness(x) * F.sqrt(n * (n - 1)), n - 2)
        figures[name] = {
            "count": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
            "skewness": F.when(n > 2, corrected),
        }
    out = _rows_per_column(df, figures, {"num_rows": F.count("*")})
    quart = F.create_map(*[e for n in names for e in (F.lit(n), F.array(*[F.lit(v).cast("double") for v in q[n]]))])
    at = F.element_at(quart, F.col("column"))
    return out.select(
        "column", "count", "mean", "std", "min",
        at[0].alias("q25"), at[1].alias("q50"), at[2].alias("q75"),
        "max",
        (F.col("num_rows") - F.col("count")).alias("missing_count"),
        share(F.col("num_rows") - F.col("count"), F.col("num_rows")).alias("missing_rate"),
        "skewness",
    )


def categorical_summary(df: DataFrame, top: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct and missing count and the ``top`` most frequent values (nulls count as a value) per column."""
    names = [n for n in (columns or df.columns) if not is_numeric(df, n)]
    counted = _as_text_pairs(df, names).groupBy("column", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value")))
    listed = (
        counted.withColumn("rank", rank)
        .where(F.col("rank") <= top)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("rank", F.concat(F.coalesce("value", F.lit("nan")), F.lit(": "), "n").alias("t")))).alias("l"))
        .select("column", F.array_join(F.col("l.t"), "; ").alias("top_values"))
    )
    whole = counted.groupBy("column").agg(
        F.count("value").alias("unique_count"),
        F.sum("n").alias("num_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"),
    )
    kinds = F.create_map(*[F.lit(x) for n, k in df.dtypes if n in names for x in (n, k)])
    return whole.join(listed, "column").select(
        "column",
        F.element_at(kinds, F.col("column")).alias("dtype"),
        "unique_count",
        "missing_count",
        share(F.col("missing_count"), F.col("num_rows")).alias("missing_rate"),
        "top_values",
    )


def high_cardinality_report(df: DataFrame, threshold: int = 1000, target: str = TARGET, approximate: bool = False) -> DataFrame:
    return (
        column_types(df, approximate)
        .where((F.col("column") != target) & (F.col("unique_count") >= threshold))
        .select("column", "dtype", "unique_count", "unique_rate", F.lit("high cardinality: do not one-hot as it is").alias("note"))
    )


def rate_by_category(df: DataFrame, feature: str, target: str = TARGET, min_count: int = 30) -> DataFrame:
    """Count, event count and rate per value (null is a value) with at least ``min_count`` rows."""
    require_columns(df, feature, target)
    y = number(df, target)
    return (
        df.groupBy(feature)
        .agg(F.count("*").alias("count"), F.sum(y).alias("fraud_count"), F.avg(y).alias("fraud_rate"))
        .where(F.col("count") >= min_count)
    )


def _moments(x: np.ndarray, y: np.ndarray) -> tuple:
    """Rows, means, sums of squares and of products about the means. A constant column has a sum of squares of exactly 0."""
    x0, y0 = x[0], y[0]
    x, y = x - x0, y - y0
    mx, my = x.mean(), y.mean()
    x, y = x - mx, y - my
    return len(x), x0 + mx, y0 + my, x @ x, y @ y, x @ y


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The moments of two sets of rows together, by pair. Equal means stay as they are, to the last bit."""
    n, more, fewer = a[0] + b[0], np.where(a[0] >= b[0], a, b), np.where(a[0] >= b[0], b, a)
    part = fewer[0] / np.maximum(n, 1)
    dx, dy = (np.where(fewer[0] > 0, fewer[i] - more[i], 0.0) for i in (1, 2))
    weight = more[0] * part
    return np.array([n, more[1] + dx * part, more[2] + dy * part, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight])


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Absolute Pearson correlation of every pair of numeric columns, rows with a null in the pair left out.

    Each batch of rows gives one set of moments a pair (all pairs by one matrix product where no value is missing); a task
    keeps the sets of its batches, and the sets of all tasks meet by pair. A constant column has no correlation.
    """
    names = [n for n in (columns or df.columns) if is_numeric(df, n)]
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    kind = "pair int, n double, mx double, my double, xx double, yy double, xy double"

    def run(batches):
        held = np.zeros((6, len(pairs)))
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                if np.isnan(x).any():
                    new, known = np.zeros((6, len(pairs))), ~np.isnan(x)
                    for k, (i, j) in enumerate(pairs):
                        both = known[:, i] & known[:, j]
                        if both.any():
                            new[:, k] = _moments(x[both, i], x[both, j])
                else:
                    first = x[0].copy()
                    x -= first
                    mean = x.mean(axis=0)
                    x -= mean
                    products, at = x.T @ x, first + mean
                    i, j = np.array(pairs).T
                    new = np.array([np.full(len(pairs), float(len(x))), at[i], at[j], products[i, i], products[j, j], products[i, j]])
                held = _merged(held, new)
        some = np.flatnonzero(held[0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(row[some]) for row in held)], names=["pair", "n", "mx", "my", "xx", "yy", "xy"])

    sets = df.select(*[number(df, n).alias(f"x{i}") for i, n in enumerate(names)]).mapInArrow(run, kind)
    # Means are taken from the least one on, so that equal means stay equal to the last bit.
    whole = Window.partitionBy("pair")
    for m in ("mx", "my"):
        sets = sets.withColumn(m, F.col(m) - F.min(m).over(whole))
        sets = sets.withColumn(f"d{m}", F.col(m) - F.sum(F.col("n") * F.col(m)).over(whole) / F.sum("n").over(whole))
    n, dx, dy = F.col("n"), F.col("dmx"), F.col("dmy")
    total = sets.groupBy("pair").agg(F.sum(F.col("xx") + n * dx * dx).alias("xx"), F.sum(F.col("yy") + n * dy * dy).alias("yy"), F.sum(F.col("xy") + n * dx * dy).alias("xy"))
    found = total.where((F.col("xx") != 0) & (F.col("yy") != 0))
    named = F.array(*[F.struct(F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b")) for i, j in pairs])
    at = F.get(named, F.col("pair"))
    return found.select(at["a"].alias("feature_a"), at["b"].alias("feature_b"), (F.abs("xy") / F.sqrt("xx") / F.sqrt("yy")).alias("abs_correlation"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width counts between the extremes; the last bin includes the maximum. Empty bins are kept."""
    x = number(df, column)
    span = one_row(df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")))
    lo, hi = F.col("span.lo"), F.col("span.hi")
    width = F.try_divide(hi - lo, F.lit(float(bins)))
    at = F.least(F.floor(F.coalesce(F.try_divide(F.col("x") - lo, width), F.lit(0.0))), F.lit(bins - 1))
    counted = (
        df.select(x.alias("x")).where(F.col("x").isNotNull())
        .withColumn("span", span)
        .groupBy(at.alias("bin_id")).agg(F.count("*").alias("n"))
    )
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin_id").withColumn("span", span)
    return grid.join(counted, "bin_id", "left").select(
        "bin_id",
        (lo + width * F.col("bin_id")).alias("bin_start"),
        (lo + width * (F.col("bin_id") + 1)).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def lift_table(df: DataFrame, feature: str, target: str = TARGET, min_count: int = 50) -> DataFrame:
    """Count of known targets, event count, rate and lift per value (null is a value)."""
    y = number(df, target)
    grouped = df.groupBy(F.col(feature).alias("value")).agg(F.count(y).alias("count"), F.sum(y).alias("fraud_count"))
    total = one_row(grouped.agg(F.sum("count").alias("n"), F.sum("fraud_count").alias("s")))
    rate = share(F.col("fraud_count"), F.col("count"))
    return (
        grouped.withColumn("total", total)
        .where(F.col("count") >= min_count)
        .select(
            "value", "count", "fraud_count", rate.alias("fraud_rate"),
            F.try_divide(rate, share(F.col("total.s"), F.col("total.n"))).alias("lift"),
        )
    )


def decile_lift_table(df: DataFrame, column: str, target: str = TARGET, bins: int = 10, method: str = "exact") -> DataFrame:
    """``lift_table`` over quantile bins of a numeric column with at least 3 distinct values.

    A column has three distinct values if one lies between its extremes, so none are counted.
    """
    require_columns(df, column, target)
    x = number(df, column)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    several = lo is not None and not df.where((x > lo) & (x < hi)).isEmpty()
    edges = quantiles(df, {"x": x}, [i / bins for i in range(bins + 1)], method)["x"] if several else []
    edges = sorted({e for e in edges if e is not None})
    kept = df.where(x.isNotNull() & F.lit(several))
    index = bin_index(x, edges) if len(edges) > 1 else F.lit(0)
    return lift_table(kept.select(index.cast("bigint").alias("bin_id"), target), "bin_id", target, 1).withColumnRenamed("value", "bin_id")


def class_ratio(df: DataFrame, target: str = TARGET, split: str = "split") -> DataFrame:
    """Share of each target value within its split."""
    grouped = df.groupBy(split, target).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(split))
    return grouped.select(split, target, "count", share(F.col("count"), total).alias("ratio"))
