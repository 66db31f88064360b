import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import bins, order_stats, scalars


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 values, a third of them equal, with nulls."""
    rng = np.random.default_rng(7)
    values = [None if i % 50 == 0 else 3.25 if i % 3 == 0 else float(round(rng.normal(), 4)) for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    return df, pd.Series(values, dtype=float).dropna()


@pytest.mark.parametrize("limit,accuracy", [(10**6, 10_000), (40, 50)])
def test_quantiles_equal_pandas_with_and_without_narrowing(skewed, limit, accuracy):
    df, values = skewed
    probs = [0.0, 0.05, 0.1, 0.5, 0.66, 0.9, 0.999, 1.0]
    got = order_stats.quantiles(df, {"x": F.col("x")}, probs, resolve_limit=limit, accuracy=accuracy)["x"]
    assert got == pytest.approx([values.quantile(q) for q in probs], abs=1e-12)


def test_order_statistics_of_several_columns(skewed):
    df, values = skewed
    ordered = sorted(values)
    columns = {"x": F.col("x"), "minus": -F.col("x"), "none": F.lit(None).cast("double")}
    counts, found = order_stats.order_statistics(df, columns, lambda _, n: [0, n // 3, n - 1], accuracy=50, resolve_limit=30)
    n = len(ordered)
    assert counts == {"x": n, "minus": n, "none": 0}
    assert found["x"] == {k: (ordered[k], ordered.index(ordered[k])) for k in (0, n // 3, n - 1)}
    assert {k: f.value for k, f in found["minus"].items()} == {k: -ordered[n - 1 - k] for k in (0, n // 3, n - 1)}
    assert found["none"] == {}


def test_approximate_quantiles_stay_close(skewed):
    df, values = skewed
    got = order_stats.quantiles(df, {"x": F.col("x")}, [0.5], "approx")["x"][0]
    assert got == pytest.approx(values.median(), abs=0.01)


def test_pick_closes_bins_on_the_right(spark):
    x = [None, -5.0, 0.2, 0.2000001, 0.5, 0.8, 0.9]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = [r[0] for r in df.select(bins.pick(F.col("x"), [0.2, 0.5, 0.8], ["low", "medium", "high", "very_high"])).collect()]
    cut = pd.cut(pd.Series(x), [-np.inf, 0.2, 0.5, 0.8, np.inf], labels=["low", "medium", "high", "very_high"])
    assert got == [None if pd.isna(v) else v for v in cut]


def test_bin_index_includes_the_lowest_edge_and_drops_outsiders(spark):
    df = spark.createDataFrame([(v,) for v in [0.9, 1.0, 2.0, 2.1, 5.0, 5.1]], "x double")
    got = [r[0] for r in df.select(bins.bin_index(F.col("x"), [1, 2, 5])).collect()]
    assert got == [None, 0, 0, 1, 1, None]


def test_reached_and_segment_index(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.1, 0.15, 0.2, 0.9]], "x double")
    rows = df.select(bins.reached(F.col("x"), [0.1, 0.2]), bins.segment_index(F.col("x"), [0.1, 0.2])).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 1), (1, 2), (2, 3), (2, 4)]


@pytest.mark.parametrize("edges", [[0.1234567, 0.5, 12.3456, 100.0], [1.00001, 1.00002, 7.0], [-math.inf, 0.393, 2.0, math.inf]])
def test_bin_labels_follow_pandas(edges):
    middle = [(a + b) / 2 for a, b in zip(edges[:-1], edges[1:]) if math.isfinite(a + b)] or [1.0]
    want = pd.cut(pd.Series(middle), edges, include_lowest=True).cat.categories.astype(str).tolist()
    assert bins.bin_labels(edges) == want


def test_equal_width_edges_follow_pandas():
    values = pd.Series([1.0, 4.0, 9.0])
    _, want = pd.cut(values, 4, retbins=True)
    assert bins.equal_width_edges(1.0, 9.0, 4) == pytest.approx(list(want))


def test_number_keeps_only_usable_numbers(spark):
    rows = [("abc", math.nan), (" 1.5 ", 2.0), ("1.5d", None), ("nan", 1.0), ("1e3", 0.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "t string, x double")
    got = [tuple(r) for r in df.select(scalars.number(df, "t"), scalars.number(df, "x"), scalars.number(df, "absent")).collect()]
    assert got == [(None, None, None), (1.5, 2.0, None), (None, None, None), (None, 1.0, None), (1000.0, 0.0, None), (None, 3.0, None)]


def test_flag_ratio_and_log_handle_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (3.0, -1.0), (-2.0, 1.0)], "a double, b double")
    got = df.select(scalars.flag(F.col("a") > 1), scalars.damped_ratio(F.col("a"), F.col("b")), scalars.log1p_clipped(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(0, None, None), (1, None, math.log1p(3)), (0, -1.0, 0.0)]


def test_clock_micros_orders_zone_less_times(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-02 00:00:01.000002' AS t")
    assert df.select(scalars.clock_micros(F.col("t"))).first()[0] == 86_401_000_002


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_grouped_quantiles_equal_pandas(spark, accuracy):
    """A hot group of a third of all rows, a null group, a group of one row, a column without a value in one group."""
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", None if i % 11 == 0 else float(round(rng.normal(), 2)), float(i % 5)) for i in range(4000)]
    rows += [(None, 1.0, 2.0), (None, 4.0, 2.0), ("lone", 7.5, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.feature): r.quantiles for r in order_stats.grouped_quantiles(df, "g", {"x": F.col("x"), "y": F.col("y")}, probs, accuracy).collect()}
    frame = pd.DataFrame(rows, columns=["g", "x", "y"])
    wanted = {}
    for g, part in frame.groupby("g", dropna=False):
        for c in "xy":
            if part[c].notna().any():
                wanted[None if pd.isna(g) else g, c] = pytest.approx([part[c].dropna().quantile(q) for q in probs], abs=1e-12)
    assert got == wanted and ("lone", "y") not in got
    assert order_stats.grouped_quantiles(df.limit(0), "g", {"x": F.col("x")}, probs).count() == 0
