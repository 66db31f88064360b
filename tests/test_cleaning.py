from pyspark.sql import functions as F

from riskloom.operators import cleaning, parsing, profile, timing


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_text_booleans_and_numbers(spark):
    rows = [(" yes ", "1", "abc"), ("NO", "", " 2.5"), ("None", "0", "nan"), (None, "1", "7")]
    df = spark.createDataFrame(rows, "Is Ok string, n string, amount string".replace("Is Ok", "`Is Ok`"))
    out = cleaning.convert_numbers(cleaning.convert_booleans(cleaning.clean_text(cleaning.normalize_names(df))))
    assert out.columns == ["is_ok", "n", "amount"]
    assert values(out, "is_ok", "n", "amount") == [(1, 1, None), (0, None, 2.5), (None, 0, None), (None, 1, 7.0)]


def test_all_null_text_is_not_boolean(spark):
    df = spark.createDataFrame([(None, "x"), (None, "1")], "a string, b string")
    assert cleaning.boolean_like_columns(df) == []


def test_duplicates_of_a_hot_row_are_written_back_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "COPIES_PER_PIECE", 7)
    rows = [("hot", None)] * 50 + [("b", 1.0)] * 2 + [("c", 2.0)]
    out = cleaning.flag_duplicates(spark.createDataFrame(rows, "k string, v double"))
    counted = {(r["k"], r["duplicate_row_flag"]): r["count"] for r in out.groupBy("k", "duplicate_row_flag").count().collect()}
    assert counted == {("hot", 0): 1, ("hot", 1): 49, ("b", 0): 1, ("b", 1): 1, ("c", 0): 1}
    assert cleaning.flag_duplicates(spark.createDataFrame(rows, "k string, v double"), drop=True).count() == 3


def test_parse_edges(spark):
    rows = [
        ("{'ip': '172.16.0.1', 'score': 0.2}", "(13, 21)"),
        ("{'ip': '172.32.0.1', 'score': None}", "(13,)"),
        ("not a dict", ""),
        (None, None),
        ("{'ip': '192.168.1.1', 'score': 'x'}", "['5', 'y']"),
    ]
    out = parsing.parse_nested(spark.createDataFrame(rows, "ip_risk string, txn_counts string"))
    assert values(out, "ip_address", "ip_score", "ip_is_private", "ip_score_bin") == [
        ("172.16.0.1", 0.2, 1, "low"), ("172.32.0.1", None, 0, None), (None, None, 0, None), (None, None, 0, None), ("192.168.1.1", None, 1, None),
    ]
    assert values(out, "txn_count_7d", "txn_count_30d", "txn_count_ratio_7d_30d") == [
        (13.0, 21.0, 13 / 22), (None, None, None), (None, None, None), (None, None, None), (5.0, None, None),
    ]


def test_time_edges(spark):
    hours = [("2024-01-06 05:59:59",), ("2024-01-07 06:00:00",), ("2024-01-08 21:00:00",), ("2024-01-08 22:00:00",), ("2024-01-08 23:30:00",), ("later",)]
    out = timing.time_features(spark.createDataFrame(hours, "local_timestamp string"))
    assert values(out, "hour", "day_of_week", "is_weekend", "is_night_txn", "time_period") == [
        (5, 5, 1, 1, "night"), (6, 6, 1, 0, "morning"), (21, 0, 0, 0, "evening"), (22, 0, 0, 1, "late_evening"), (23, 0, 0, 1, "late_evening"), (None, None, 0, 0, None),
    ]


def test_overview_counts_copies_and_nan_as_missing(spark):
    df = spark.createDataFrame([("a", float("nan"), 1), ("a", float("nan"), 1), ("b", 2.0, 0)], "k string, x double, fraud int")
    row = profile.dataset_overview(df).first()
    assert (row["num_rows"], row["duplicate_rows"], row["total_missing_values"], row["fraud_count"], row["non_fraud_count"]) == (3, 1, 2, 2, 1)
    missing = {r["column"]: r["missing_count"] for r in profile.missing_report(df).collect()}
    assert missing == {"k": 0, "x": 2, "fraud": 0}


def test_constant_column_has_no_correlation_or_deciles(spark):
    df = spark.createDataFrame([(1.0, float(i), i % 2) for i in range(10)], "c double, x double, fraud int")
    pairs = {(r["feature_a"], r["feature_b"]) for r in profile.correlation_pairs(df).collect()}
    assert pairs == {("x", "fraud")}
    assert profile.decile_lift_table(df, "c").count() == 0
    h = profile.histogram(df.withColumn("x", F.col("x")), "x", 3).orderBy("bin_id").collect()
    assert [r["count"] for r in h] == [3, 3, 4]
