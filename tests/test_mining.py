import random
from itertools import combinations as choose

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import combinations, rates, rules, segments, stability


@pytest.fixture(scope="module")
def flags(spark):
    rng = random.Random(3)
    data = [tuple(int(rng.random() < p) for p in (0.5, 0.3, 0.6, 0.05, 0.4)) for _ in range(600)]
    rows = [(*r, 1 if (r[0] and r[2] and rng.random() < 0.5) else 0) for r in data]
    names = ["a_flag", "b_flag", "c_x_d", "rare_flag", "e_flag"]
    return spark.createDataFrame(rows, ", ".join(f"{n} int" for n in [*names, "fraud"])), pd.DataFrame(rows, columns=[*names, "fraud"]), names


@pytest.mark.parametrize("order", [2, 3, 4])
def test_flag_combinations_equal_brute_force(flags, order):
    df, pdf, names = flags
    want = {}
    for k in range(2, order + 1):
        for cols in choose(names, k):
            hit = pdf[(pdf[list(cols)] == 1).all(axis=1)]
            if len(hit) >= 20:
                want[" AND ".join(cols)] = (len(hit), int(hit.fraud.sum()), k)
    got = {r["rule"]: (r["support"], r["fraud_count"], r["order"]) for r in combinations.flag_combinations(df, min_support=20, max_order=order).collect()}
    assert got == want


def test_more_flags_than_one_mask_holds(spark):
    names = [f"f{i}_flag" for i in range(70)]
    df = spark.createDataFrame([tuple(int(i in (0, 65, 69)) for i in range(70)) + (1,)] * 3, ", ".join(f"{n} int" for n in [*names, "fraud"]))
    got = {r["rule"] for r in combinations.flag_combinations(df, names, min_support=3).collect()}
    assert got == {"f0_flag AND f65_flag", "f0_flag AND f69_flag", "f65_flag AND f69_flag", "f0_flag AND f65_flag AND f69_flag"}


def test_null_is_a_value_and_unknown_targets_do_not_count(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1), (None, None), ("b", 0)], "k string, fraud int")
    got = {r["value"]: (r["count"], r["fraud_count"], r["lift"]) for r in rates.category_rate(df, "k", min_count=1).collect()}
    assert got == {"a": (2, 1, 1.0), None: (1, 1, 2.0), "b": (1, 0, 0.0)}
    assert rates.global_rate(df) == 0.5
    with pytest.raises(ValueError):
        rates.global_rate(df.where("fraud IS NULL"))


def test_least_count(spark):
    row = spark.range(1).select(rates.least_count(F.lit(70000)), rates.least_count(F.lit(15000), default=50), rates.least_count(F.lit(10)), rates.least_count(F.lit(10), 3)).first()
    assert tuple(row) == (350, 75, 100, 3)


def test_bins_of_repeated_and_constant_values(spark):
    df = spark.createDataFrame([(0.0 if i < 70 else float(i), 1.0, i % 2) for i in range(100)], "x double, c double, fraud int")
    edges = rates.numeric_edges(df, ["x", "c"])
    assert "c" not in edges
    want = pd.qcut(pd.Series([0.0 if i < 70 else float(i) for i in range(100)]), 10, duplicates="drop", retbins=True)
    assert edges["x"] == pytest.approx(list(want[1]))
    got = {r["bin"]: r["count"] for r in rates.bin_rate(df, "x", min_count=1).collect()}
    assert got == {str(k): v for k, v in want[0].value_counts().items()}
    assert rates.bin_rate(df, "c", min_count=1).count() == 0


def test_empty_segment_and_rule(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0)], "x double, fraud int")
    seg = segments.evaluate_conditions(df, {"none": F.col("x") > 9}, name="segment_name").first()
    rule = segments.evaluate_conditions(df, {"none": F.col("x") > 9}).first()
    assert (seg["support"], seg["lift"], seg["fraud_rate_diff"]) == (0, 0.0, -0.5)
    assert (rule["support"], rule["lift"], rule["fraud_rate_diff"]) == (0, 0.0, 0.0)


def test_one_class_target_has_no_lift(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, fraud int")
    assert {r["lift"] for r in rates.category_rate(df, "k", min_count=1).collect()} == {None}


def test_strength_and_meaning(spark):
    rows = [("r", 0.2, 6.0, 10), ("low_mcc_entropy AND low_night_ratio", 0.2, 6.0, 100), ("card_not_present", 0.08, 3.5, 100), ("x", 0.05, 2.0, 50), ("x", 0.01, 1.6, 50), ("x", 0.5, 1.0, 50), ("x", None, None, None)]
    out = rules.interpret(spark.createDataFrame(rows, "rule string, fraud_rate double, lift double, support long"))
    assert [r["strength"] for r in out.collect()] == ["WEAK_SUPPORT", "VERY_STRONG", "STRONG", "MEDIUM", "WEAK", "LOW_SIGNAL", "WEAK_SUPPORT"]
    assert out.first()["business_interpretation"] == rules.NO_MEANING


def test_stability_matches_null_keys(spark):
    schema = "feature string, value string, count long, fraud_rate double, lift double"
    train = spark.createDataFrame([("k", None, 100, 0.4, 2.0), ("k", "a", 60, 0.2, 1.0)], schema)
    valid = spark.createDataFrame([("k", None, 40, 0.3, 1.8), ("k", "z", 60, 0.2, 1.0)], schema)
    out = stability.compare_reports(train, valid, ["feature", "value"])
    row = out.first()
    assert out.count() == 1 and row["value"] is None
    assert row["lift_ratio_valid_train"] == pytest.approx(0.9) and row["lift_diff_valid_train"] == pytest.approx(-0.2)
    assert stability.stable_patterns(out).count() == 1
    assert stability.stable_patterns(out, min_support_valid=50).count() == 0
