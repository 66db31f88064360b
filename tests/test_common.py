"""The form in which results are compared."""

import math

from riskloom.catalog import common
from riskloom.catalog.common import plain


def test_plain_keeps_nan_and_large_numbers(spark):
    rows = [(float("nan"),), (1e13,), (-2.5e15,), (float("inf"),), (None,), (0.1234565,), (-0.1234564,)]
    got = [r.x for r in plain(spark.createDataFrame(rows, "x double")).collect()]
    assert math.isnan(got[0]) and got[1:5] == [1e13, -2.5e15, float("inf"), None]
    assert got[5:] == [0.123457, -0.123456]


def test_transactions_leave_no_method_that_the_virtual_machine_interprets(spark, tmp_path):
    """Generated methods over 8000 bytes aren't compiled: the wide projections run as small ones, unless the session says otherwise."""
    rows = [(i, f"2024-01-{1 + i % 28:02d} 03:04:05", i % 5, "error" if i % 3 else "ok", i * 1.25, f'{{"k": {i % 50}}}') for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    name, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set(name, "65535")
        quick = sorted(map(str, common.raw_transactions(spark, str(tmp_path)).collect()))
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "65535")
        common.prepared(spark, str(tmp_path), split=True)
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "60000")
        assert sorted(map(str, common.raw_transactions(spark, str(tmp_path)).collect())) == quick and len(quick) == 60
        assert spark.conf.get(name) == "60000"
    finally:
        spark.conf.set(name, before)
