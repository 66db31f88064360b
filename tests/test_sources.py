import pytest
from pyspark.sql import functions as F

from riskloom.operators import features
from riskloom.sources import ledger, tables

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_csv_parquet_and_splits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,\"b\"", "train"), (2, None, "test")], "id long, t string, split string")
    for suffix in ("csv", "parquet"):
        path = str(tmp_path / f"t.{suffix}")
        tables.save_cleaned(df, path)
        assert sorted(map(tuple, tables.load_cleaned(spark, path, df.schema if suffix == "csv" else None).select("id", "split").collect())) == [(1, "train"), (2, "test")]
    with pytest.raises(ValueError):
        tables.save_cleaned(df, str(tmp_path / "t.xlsx"))
    tables.save_splits(df, str(tmp_path / "splits"))
    one = tables.load_split(spark, str(tmp_path / "splits"), "test")
    assert [r["id"] for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        tables.require_columns(df, "fraud")


def test_report_and_metadata(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "id long, lift double")
    tables.save_report(df, str(tmp_path / "r"), preview_rows=2, order_by=[F.desc("lift")])
    assert [r["id"] for r in spark.read.option("header", True).csv(str(tmp_path / "r")).collect()] == ["4", "3"]
    chosen = features.FeatureSet("fraud", ["hour"], ["mcc"], [], [], ["ip_risk"], {"low": 0.5})
    features.save_feature_set(spark, chosen, str(tmp_path / "f"))
    assert features.load_feature_set(spark, str(tmp_path / "f")) == chosen


def test_history_counts_only_earlier_days(spark):
    day = "2024-01-0{} 12:00:00"
    rows = [(i, day.format(d), u, "view", v, '{"k": 10}') for i, (d, u, v) in enumerate([(1, 7, 10.0), (1, 7, 20.0), (2, 7, 90.0), (3, 8, 5.0)])]
    events = spark.createDataFrame(rows, EVENTS.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r["event_id"]: (r["txn_counts"], r["mean_amount_30d"], r["max_amount_30d"]) for r in ledger.transactions(events).collect()}
    assert got == {0: ("(0, 0)", None, None), 1: ("(0, 0)", None, None), 2: ("(2, 2)", 15.0, 20.0), 3: ("(0, 0)", None, None)}


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(0.5, 1)], "ip_score double, fraud int")
    out = features.build_features(df, features.fit_thresholds(df))
    assert out.first()["high_ip_score_flag"] == 1 and "amount_z_30d" not in out.columns
    assert features.resolve_feature_set(out).numeric_features == ["ip_score"]
