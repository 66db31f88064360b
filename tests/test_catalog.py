"""Registered queries against DuckDB at the smallest scale."""

import pytest

from riskloom.catalog import check, registry

SF = "/root/testdata/sf0.001"
# Long plans over the same feature table: left to ``python -m riskloom.catalog.check``, which runs every query.
SLOW = (
    "train_", "prepare_", "explain_", "error_numeric", "error_categorical", "error_false", "feature_report", "behavior_risk", "behavior_features",
    "insight_", "mining_patterns", "mining_actionable", "mining_rule_interpretation", "mining_recommended", "mining_strong", "clean_summary",
    "clean_raw", "sink_", "profile_correlation", "interaction_",
)


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


def test_every_check_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", [n for n in registry.oracle_sql() if not n.startswith(SLOW)])
def test_query_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    assert check.compare(got, duck.execute(registry.oracle_sql()[name]).fetchdf()) == ""
