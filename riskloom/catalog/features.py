"""Feature and split queries over transactions derived from events, and over labelled documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.catalog.common import CHAIN, big, chain, featured, plain, prepared, r6, real, split_events, train_rows
from riskloom.catalog.cleaning import _boolean_text
from riskloom.fixed_values import (
    BINARY_FEATURES,
    CATEGORICAL_FEATURES,
    INTERACTION_FEATURES,
    INTERACTIONS,
    NUMERIC_FEATURES,
    RISK_GROUPS,
    THRESHOLDS,
)
from riskloom.functions.scalars import flag, says_false, says_true
from riskloom.operators import features, splitting, timing
from riskloom.sources.tables import load_table

QUERIES, SQL = {}, {}


def _select(source: str, reals=(), ints=(), texts=(), where: str = "") -> str:
    parts = ["event_id", *[r6(c, c) for c in reals], *[big(c, c) for c in ints], *texts]
    return chain(f"SELECT {', '.join(parts)} FROM {source} {where}")


# A1-A5
_AMOUNT_REALS = ["log_amount", "log_mean_amount_30d", "amount_to_mean_30d", "log_amount_to_mean_30d", "log_max_amount_30d", "amount_to_max_30d", "log_amount_to_max_30d", "amount_z_30d", "amount_to_std_30d"]
_AMOUNT_FLAGS = [
    "amount_missing_flag", "amount_invalid_flag", "mean_amount_30d_missing_flag", "mean_amount_30d_zero_flag", "max_amount_30d_missing_flag",
    "max_amount_30d_zero_flag", "std_amount_30d_missing_flag", "std_amount_30d_zero_flag", "is_amount_above_mean", "is_amount_2x_mean",
    "is_amount_5x_mean", "is_amount_near_max", "is_amount_above_max",
]
QUERIES["amount_features"] = lambda s, d: plain(features.amount_features(prepared(s, d)).select("event_id", *_AMOUNT_REALS, *_AMOUNT_FLAGS))
SQL["amount_features"] = _select("amt", _AMOUNT_REALS, _AMOUNT_FLAGS)

# B1
QUERIES["behavior_thresholds"] = lambda s, d: plain(features.thresholds_frame(s, features.fit_thresholds(train_rows(prepared(s, d, split=True)))))
SQL["behavior_thresholds"] = chain("SELECT " + ", ".join(r6(n, n) for n in THRESHOLDS) + " FROM thr")
QUERIES["behavior_thresholds_approximate"] = lambda s, d: plain(features.thresholds_frame(s, features.fit_thresholds(train_rows(prepared(s, d, split=True)), "approx")))

# B2
_GROUPS = [g for g, _, _ in RISK_GROUPS.values()]
QUERIES["behavior_risk_groups"] = lambda s, d: plain(features.risk_groups(features.amount_features(prepared(s, d))).select("event_id", *_GROUPS))
SQL["behavior_risk_groups"] = _select("feat", texts=_GROUPS)

# B3, B4
_FLAGS = [f for *_, f in THRESHOLDS.values()] + ["night_transaction_flag", "card_not_present_flag", "cross_border_flag", "tokenised_flag"]


def _flags(s, d):
    t = prepared(s, d, split=True)
    return features.behavior_flags(t, features.fit_thresholds(train_rows(t))).select("event_id", *_FLAGS)


QUERIES["behavior_flags"] = lambda s, d: plain(_flags(s, d))
SQL["behavior_flags"] = _select("feat", ints=_FLAGS)


# B5
def _said(s, d):
    t = _boolean_text(s, d)
    return t.select("o_orderkey", flag(says_true(t, "answer")).alias("yes"), flag(says_false(t, "answer")).alias("no"), flag(says_true(t, "absent")).alias("absent"))


QUERIES["boolean_texts"] = lambda s, d: plain(_said(s, d))
SQL["boolean_texts"] = f"SELECT o_orderkey, {big('o_orderkey % 5 IN (0, 2)', 'yes')}, {big('o_orderkey % 5 IN (1, 3)', 'no')}, CAST(0 AS BIGINT) AS absent FROM orders"

# B6
QUERIES["behavior_night_habit"] = lambda s, d: plain(timing.night_habit(prepared(s, d)).select("event_id", "night_unusual_score", "night_unusual_group"))
SQL["behavior_night_habit"] = _select("insight", ["night_unusual_score"], texts=["night_unusual_group"])

# B7
_BEHAVIOR = ["night_unusual_group", *[g for g in _GROUPS if not g.startswith("amount")]]
QUERIES["behavior_features"] = lambda s, d: plain(features.behavior_features(prepared(s, d, passes=True)).select("event_id", "night_unusual_score", *_FLAGS, *_BEHAVIOR))
SQL["behavior_features"] = _select("insight", ["night_unusual_score"], _FLAGS, _BEHAVIOR)


# I1
def _interactions(s, d):
    t = prepared(s, d, split=True)
    return features.interaction_features(features.behavior_flags(t, features.fit_thresholds(train_rows(t)))).select("event_id", *INTERACTIONS)


QUERIES["interaction_features"] = lambda s, d: plain(_interactions(s, d))
SQL["interaction_features"] = _select("feat", ints=list(INTERACTIONS))

# I2
QUERIES["insight_features"] = lambda s, d: plain(features.insight_features(prepared(s, d, passes=True)).select("event_id", *_FLAGS, *INTERACTIONS))
SQL["insight_features"] = _select("insight", ints=[*_FLAGS, *INTERACTIONS])

# the model-ready table, every column compared
_INTS = BINARY_FEATURES + INTERACTION_FEATURES


def _model_table(s, d):
    table, thresholds = featured(s, d)
    chosen = features.resolve_feature_set(table, thresholds)
    return features.select_model_columns(table, chosen, ("event_id", "split"))


QUERIES["feature_model_table"] = lambda s, d: plain(_model_table(s, d))
SQL["feature_model_table"] = chain(
    f"SELECT event_id, split, {', '.join(r6(c, c) for c in NUMERIC_FEATURES)}, {', '.join(big(c, c) for c in _INTS)}, "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'missing') AS {c}" for c in CATEGORICAL_FEATURES)
    + f", {big('fraud', 'fraud')} FROM feat"
)


# F3
def _feature_set(s, d):
    table, thresholds = featured(s, d)
    chosen = features.resolve_feature_set(table, thresholds)
    path = _scratch(s)
    features.save_feature_set(s, chosen, path)
    row = features.load_feature_set(s, path)
    kinds = {"numeric": row.numeric_features, "categorical": row.categorical_features, "binary": row.binary_features, "interaction": row.interaction_features}
    listed = [(k, i, n) for k, names in kinds.items() for i, n in enumerate(names)]
    return s.createDataFrame(listed, "kind string, position bigint, feature string").unionByName(
        s.createDataFrame([("threshold", i, f"{n}={v:.6f}") for i, (n, v) in enumerate(row.thresholds.items())], "kind string, position bigint, feature string")
    )


def _scratch(s):
    from riskloom.catalog.common import scratch

    return scratch(s)


QUERIES["feature_set_record"] = lambda s, d: plain(_feature_set(s, d))

# F5
QUERIES["feature_report"] = lambda s, d: plain((lambda t: features.feature_report(t[0], features.resolve_feature_set(*t)))(featured(s, d)))
SQL["feature_report"] = chain(
    f"""SELECT split, count(*) AS rows, CAST(114 AS BIGINT) AS columns, CAST(19 AS BIGINT) AS numeric_features, CAST(21 AS BIGINT) AS categorical_features,
  CAST(10 AS BIGINT) AS binary_features, CAST(8 AS BIGINT) AS interaction_features, CAST(58 AS BIGINT) AS all_model_features,
  'fraud' AS target_col, {big('sum(fraud)', 'fraud_count')}, {r6('avg(fraud)', 'fraud_rate')} FROM sev GROUP BY split"""
)

# ------------------------------------------------------------------ splits

# D1
QUERIES["split_by_time"] = lambda s, d: plain(split_events(s, d).select("event_id", "split"))
SQL["split_by_time"] = chain("SELECT event_id, split FROM sev")


# D1 with a hot timestamp: line items share ship days, so the cut falls inside a day
def _shipped(s, d):
    li = load_table(s, d, "lineitem")
    key = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")
    # Repeated keys get a number by ship day, which makes the tie key unique; every line item stays.
    copy = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber", "l_partkey").orderBy("l_shipdate"))
    rows = li.select((key * 1000 + copy).alias("line_id"), "l_shipdate", flag(F.col("l_returnflag") == "R").alias("fraud"))
    return splitting.time_split(rows, "line_id", timestamp="l_shipdate").select("line_id", "split")


QUERIES["split_by_time_ties"] = lambda s, d: plain(_shipped(s, d))
SQL["split_by_time_ties"] = """
WITH t AS (SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_shipdate) AS line_id, l_shipdate FROM lineitem),
r AS (SELECT line_id, row_number() OVER (ORDER BY l_shipdate, line_id) - 1 AS pos, count(*) OVER () AS n FROM t)
SELECT line_id, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM r"""


# D2: which rows are drawn depends on the hash, how many per class does not
def _documents(s, d):
    return load_table(s, d, "documents").select("doc_id", "lang").join(load_table(s, d, "labels"), "doc_id").withColumnRenamed("toxic", "fraud")


def _drawn(s, d):
    return splitting.stratified_split(_documents(s, d), "doc_id").groupBy("split", "fraud").agg(F.count("*").alias("rows"))


QUERIES["split_stratified"] = lambda s, d: plain(_drawn(s, d))
SQL["split_stratified"] = f"""
WITH c AS (SELECT toxic AS y, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1),
t AS (SELECT y, n, n * floor(sum(n) OVER () * 0.7::DOUBLE) / sum(n) OVER () AS ideal, floor(sum(n) OVER () * 0.7::DOUBLE) AS draws FROM c),
a AS (SELECT y, n, floor(ideal) + CAST(row_number() OVER (ORDER BY ideal - floor(ideal) DESC, y) <= draws - sum(floor(ideal)) OVER () AS INT) AS train FROM t),
u AS (SELECT y, n, train, n - train AS rest, (n - train) * floor(sum(n - train) OVER () * 0.5::DOUBLE) / sum(n - train) OVER () AS ideal, floor(sum(n - train) OVER () * 0.5::DOUBLE) AS draws FROM a),
b AS (SELECT y, n, train, rest, floor(ideal) + CAST(row_number() OVER (ORDER BY ideal - floor(ideal) DESC, y) <= draws - sum(floor(ideal)) OVER () AS INT) AS valid FROM u)
SELECT 'train' AS split, {big('y', 'fraud')}, {big('train', 'rows')} FROM b UNION ALL
SELECT 'validation', CAST(y AS BIGINT), CAST(valid AS BIGINT) FROM b UNION ALL
SELECT 'test', CAST(y AS BIGINT), CAST(rest - valid AS BIGINT) FROM b"""


# D3
def _auto(s, d):
    events = load_table(s, d, "events").withColumn("fraud", flag(F.col("event_type") == "error"))
    _, summary = splitting.split_table(events, "event_id", "auto", timestamp="ts", min_events=5)
    return summary.select("split", "rows", "split_strategy")


QUERIES["split_auto"] = lambda s, d: plain(_auto(s, d))
SQL["split_auto"] = chain("SELECT split, count(*) AS rows, 'time' AS split_strategy FROM sev GROUP BY split")


def _auto_fallback(s, d):
    _, summary = splitting.split_table(_documents(s, d), "doc_id", "auto")
    return summary.select("split", "rows", "split_strategy")


QUERIES["split_auto_fallback"] = lambda s, d: plain(_auto_fallback(s, d))
SQL["split_auto_fallback"] = """
WITH n AS (SELECT count(*) AS n, count(*) - floor(count(*) * 0.7::DOUBLE) AS rest FROM labels JOIN documents USING (doc_id))
SELECT 'train' AS split, CAST(n - rest AS BIGINT) AS rows, 'stratified' AS split_strategy FROM n UNION ALL
SELECT 'validation', CAST(floor(rest * 0.5) AS BIGINT), 'stratified' FROM n UNION ALL
SELECT 'test', CAST(rest - floor(rest * 0.5) AS BIGINT), 'stratified' FROM n"""

# D4
QUERIES["split_summary"] = lambda s, d: plain(splitting.split_summary(split_events(s, d), timestamp="ts", strategy="time"))
SQL["split_summary"] = chain(
    f"""SELECT split, count(*) AS rows, {big('sum(fraud)', 'fraud_count')}, {big('sum(1 - fraud)', 'non_fraud_count')}, {r6('avg(fraud)', 'fraud_rate')},
  min(ts) AS start_time, max(ts) AS end_time, 'time' AS split_strategy FROM sev GROUP BY split"""
)


# D5
def _fallback_time(s, d):
    e = load_table(s, d, "events")
    text = F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return splitting.ensure_datetime(e.select("event_id", text.alias("local_timestamp"))).select("event_id", "transaction_datetime")


QUERIES["split_ensure_datetime"] = lambda s, d: plain(_fallback_time(s, d))
SQL["split_ensure_datetime"] = chain("SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN transaction_datetime END AS transaction_datetime FROM p0")
