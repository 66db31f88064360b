import pytest
from pyspark.sql import functions as F

from riskloom.operators import splitting


def rows(n, hot=0.0):
    """Times in seconds; a share of the rows sits on one second in the middle."""
    return [(i, f"2024-01-01 00:{30 if i % 10 < hot * 10 else i % 60:02d}:00", int(i % 7 == 0)) for i in range(n)]


@pytest.mark.parametrize("hot,limit", [(0.0, 10**6), (0.4, 10**6), (0.7, 10), (1.0, 10)])
def test_time_split_is_exact_under_ties(spark, hot, limit):
    data = rows(403, hot)
    df = spark.createDataFrame(data, "id long, local_timestamp string, fraud int").repartition(5)
    out = splitting.time_split(df, "id", resolve_limit=limit)
    got = {r["id"]: r["split"] for r in out.collect()}
    ordered = [i for _, i in sorted((t, i) for i, t, _ in data)]
    a, b = int(403 * 0.70), int(403 * (0.70 + 0.15))
    want = {i: "train" if k < a else "validation" if k < b else "test" for k, i in enumerate(ordered)}
    assert got == want


def test_time_split_drops_unparsable_times_and_checks_sizes(spark):
    df = spark.createDataFrame([(1, "x", 0), (2, "2024-01-01 00:00:00", 1), (3, None, 0)], "id long, local_timestamp string, fraud int")
    assert [r["id"] for r in splitting.time_split(df, "id").collect()] == [2]
    with pytest.raises(ValueError):
        splitting.time_split(df, "id", train=0.5)
    with pytest.raises(ValueError):
        splitting.time_split(df.drop("local_timestamp"), "id")


def test_stratified_sizes_and_repeatability(spark):
    df = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(1001)], "id long, fraud int")
    one, two = (splitting.stratified_split(df.repartition(n), "id") for n in (2, 7))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    sizes = {(r["split"], r["fraud"]): r["count"] for r in one.groupBy("split", "fraud").count().collect()}
    assert sum(v for (s, _), v in sizes.items() if s == "train") == 700
    assert sizes[("train", 1)] == 88 and sizes[("validation", 1)] + sizes[("test", 1)] == 126 - 88


def test_auto_falls_back_when_a_split_has_few_events(spark):
    late = spark.createDataFrame([(i, f"2024-01-01 00:00:{i % 60:02d}", int(i < 5)) for i in range(60)], "id long, local_timestamp string, fraud int")
    _, summary = splitting.split_table(late, "id", "auto", min_events=1)
    assert {r["split_strategy"] for r in summary.collect()} == {"stratified"}
    _, summary = splitting.split_table(late, "id", "time")
    assert {r["split"]: r["rows"] for r in summary.collect()} == {"train": 42, "validation": 9, "test": 9}
    with pytest.raises(ValueError):
        splitting.split_table(late, "id", "random")
    assert late.where(F.col("id") < 0).count() == 0
