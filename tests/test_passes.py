"""Steps that several passes or several parts of a plan read are run once."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.catalog import common
from riskloom.functions import order_stats
from riskloom.operators import cleaning, combinations, features, models, profile, rates

EVENTS = [(i, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00:00", i % 7, "error" if i % 5 == 0 else "view", 1.5 * (i % 40), f'{{"k": {i % 50}}}') for i in range(300)]


@pytest.fixture
def fixed_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_joined_once_for_a_fit(spark, tmp_path):
    rows = spark.createDataFrame(EVENTS, "event_id long, ts string, user_id long, event_type string, value double, props string")
    rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    table, thresholds = common.featured(spark, str(tmp_path))
    assert "Window" not in plan(table) and "Join" not in plan(table)
    assert table.count() == 300 and thresholds["high_ip_score_q90"] is not None


def test_copies_are_counted_once(spark, fixed_plans):
    rows = spark.createDataFrame([(1.0, " x"), (1.0, "x"), (None, "nan"), (-2.0, "y")], "amount double, label string")
    cleaned = cleaning.clean_raw(rows)
    assert "ReusedExchange" in plan(cleaned)
    got = cleaning.cleaning_summary(rows, cleaned).first().asDict()
    assert got == {
        "raw_rows": 4, "raw_columns": 2, "cleaned_rows": 4, "cleaned_columns": 4, "new_columns_added": 2,
        "raw_missing_values": 1, "cleaned_missing_values": 2, "duplicate_rows": 1, "invalid_amount_rows": 2,
    }
    assert cleaning.cleaning_summary(rows.limit(0), cleaning.clean_raw(rows.limit(0))).first()["cleaned_missing_values"] == 0


def test_totals_come_from_the_groups_of_the_report(spark, fixed_plans):
    rows = spark.createDataFrame([("a", "p", 1.0, 1), ("a", None, 2.0, 0), (None, "q", None, 1), ("a", "p", 4.0, None)], "x string, z string, v double, fraud int")
    by_value = rates.categorical_report(rows, ["x", "z"], min_count=1)
    by_bin = rates.numeric_report(rows, {"v": [0.0, 2.0, 5.0]}, min_count=1)
    pairs = combinations.categorical_pairs(rows, [("x", "z"), ("z", "x")], min_support=1)
    for report in (by_value, pairs):
        assert "ReusedExchange" in plan(report)
    got = {(r["feature"], r["value"]): (r["count"], r["fraud_count"], r["global_fraud_rate"]) for r in by_value.collect()}
    assert got == {("x", "a"): (2, 1, 2 / 3), ("x", None): (1, 1, 2 / 3), ("z", "p"): (1, 1, 2 / 3), ("z", None): (1, 0, 2 / 3), ("z", "q"): (1, 1, 2 / 3)}
    assert {(r["bin_id"], r["count"], r["global_fraud_rate"]) for r in by_bin.collect()} == {(0, 2, 2 / 3)}
    assert {(r["rule"], r["support"], r["global_fraud_rate"]) for r in pairs.collect()} == {
        (rule, 1, 2 / 3) for rule in ("x=a AND z=p", "x=a AND z=nan", "x=nan AND z=q", "z=p AND x=a", "z=nan AND x=a", "z=q AND x=nan")
    }


def test_distinct_counts_shuffle_single_values(spark, fixed_plans):
    rows = spark.createDataFrame([(1, 0.0, "a", 5, None), (1, -0.0, "b", 6, None), (2, math.nan, None, 5, None), (None, 2.0, "a", 5, None)], "i long, `d.x` double, s string, j long, e string")
    report = profile.column_types(rows)
    assert not any("Expand" in line and all(f"{c}#" in line for c in ("i", "s", "j")) for line in plan(report).split("\n"))
    got = {r["column"]: (r["non_null_count"], r["null_count"], r["unique_count"]) for r in report.collect()}
    assert got == {"i": (3, 1, 2), "d.x": (3, 1, 2), "s": (3, 1, 2), "j": (4, 0, 2), "e": (0, 4, 0)}


def test_fits_read_parsed_train_rows_once(spark, tmp_path):
    rows = spark.createDataFrame(EVENTS, "event_id long, ts string, user_id long, event_type string, value double, props string")
    rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    whole, limits = common.featured(spark, str(tmp_path))
    for train in (True, False):
        table, thresholds = common.fit_rows(spark, str(tmp_path), train)
        assert thresholds == limits and "from_json" not in plan(table)
        chosen, known = features.resolve_feature_set(table), features.resolve_feature_set(whole)
        assert chosen.all_model_features == known.all_model_features
        got, wanted = (sorted(map(str, features.select_model_columns(t, known, ("event_id", "split")).collect())) for t in (table, common.train_rows(whole) if train else whole))
        assert got == wanted


def test_sketches_of_many_partitions_are_merged_in_bounded_number(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda df, n, plain=type(spark.range(1)).coalesce: seen.append(n) or plain(df, n))
    rows = spark.range(2000).select((F.col("id") % 501).cast("double").alias("x")).repartition(64)
    assert order_stats.quantiles(rows, {"x": F.col("x")}, [0.0, 0.5, 1.0], resolve_limit=100)["x"] == [0.0, 249.5, 500.0]
    assert seen and max(seen) <= max(order_stats.SKETCHES, spark.sparkContext.defaultParallelism)


def test_fit_encodes_rows_once(spark, monkeypatch):
    rows = spark.range(400).selectExpr("cast(id % 37 as double) AS x", "cast(id % 3 as string) AS kind", "cast(id % 37 > 20 as int) AS fraud")
    asked = []
    for kind in ("LogisticRegression", "RandomForestClassifier"):
        fit = getattr(models, kind).fit
        monkeypatch.setattr(getattr(models, kind), "fit", lambda self, df, params=None, fit=fit: asked.append((plan(df), df.storageLevel.useMemory)) or fit(self, df))
    chosen = features.FeatureSet("fraud", ["x"], ["kind"], [], [])
    models.fit_model(rows, chosen, "lr", {"max_iter": 5}, min_frequency=5)
    forest = models.fit_model(rows, chosen, "rf", {"n_estimators": 3, "max_depth": 3}, min_frequency=5)
    assert "UDF" not in asked[0][0] and asked[1][1] and forest.classifier.getCacheNodeIds()
