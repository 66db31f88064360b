"""Pattern mining and stability queries over lineitem and transactions derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.common import CHAIN, LINEITEM, big, chain, featured, lineitem, plain, prepared, r6
from riskloom.fixed_values import INTERACTIONS, MINED_CATEGORICAL, MINED_NUMERIC, MINED_PAIRS, PRIORITY_RULES, SEGMENTS, THRESHOLDS
from riskloom.operators import combinations, features, rates, rules, segments, stability
from riskloom.plans import stages

QUERIES, SQL = {}, {}

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
LINE_VALUES = ["l_linestatus", "l_linenumber", "l_tax", "segment"]
BASE_FLAGS = [f for *_, f in THRESHOLDS.values()] + ["night_transaction_flag", "card_not_present_flag", "cross_border_flag", "tokenised_flag"]


def _lines(s, d):
    """Line items with a column that has nulls, and a target unknown on some rows."""
    li = lineitem(s, d)
    seg = F.when(F.col("l_suppkey") % 4 > 0, F.concat(F.lit("s"), F.col("l_suppkey") % 4))
    price = F.when(F.col("l_orderkey") % 10 > 0, F.col("l_extendedprice"))
    return li.withColumns({"segment": seg, "l_extendedprice": price, "fraud": F.when(F.col("l_partkey") % 50 > 0, F.col("fraud"))})


CHAIN["lines"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate,
  CASE WHEN l_orderkey % 10 > 0 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN l_suppkey % 4 > 0 THEN 's' || (l_suppkey % 4) END AS segment,
  CASE WHEN l_partkey % 50 > 0 THEN CAST(l_returnflag = 'R' AS INT) END AS fraud FROM lineitem"""
CHAIN["lg"] = "SELECT count(*) AS rows, count(fraud) AS n, avg(fraud) AS g FROM lines"

_RATE = f"{r6('rate', 'fraud_rate')}, {r6('g', 'global_fraud_rate')}, {r6('rate - g', 'fraud_rate_diff')}, {r6('rate / g', 'lift')}"


def _least(default: int = 100) -> str:
    return f"greatest({default}, floor(rows * 0.005::DOUBLE))"


# M1, M2
QUERIES["mining_global_summary"] = lambda s, d: plain(rates.global_summary(_lines(s, d)))
SQL["mining_global_summary"] = chain(
    f"SELECT rows, {r6('(SELECT CAST(sum(fraud) AS DOUBLE) FROM lines)', 'fraud_count')}, {r6('g', 'global_fraud_rate')}, {big(_least(), 'min_count')} FROM lg"
)

# M3, M4 (flagship)
QUERIES["mining_rate_by_category"] = lambda s, d: plain(rates.category_rate(_lines(s, d), "segment"))


def _value_report(source: str, totals: str, feature: str, where: str = "", default: int = 100, typed: bool = False) -> str:
    value = feature if typed else f"CAST({feature} AS VARCHAR)"
    return f"""SELECT '{feature}' AS feature, value, count, {big('s', 'fraud_count')}, {_RATE} FROM (
  SELECT {value} AS value, count(fraud) AS count, coalesce(sum(fraud), 0) AS s, avg(fraud) AS rate FROM {source} {where} GROUP BY 1) q, {totals}
  WHERE count > 0 AND count >= {_least(default)}"""


SQL["mining_rate_by_category"] = chain(_value_report("lines", "lg", "segment"))

# M7
QUERIES["mining_many_categories"] = lambda s, d: plain(rates.categorical_report(_lines(s, d), [*LINE_VALUES, "absent"]))
SQL["mining_many_categories"] = chain("\nUNION ALL ".join(_value_report("lines", "lg", f) for f in LINE_VALUES))


# M5
def _edges(s, d, method):
    found = rates.numeric_edges(_lines(s, d), LINE_NUMBERS, 10, method)
    rows = [(f, i, e) for f, edges in found.items() for i, e in enumerate(edges)]
    return s.createDataFrame(rows, "feature string, position bigint, edge double")


_PROBS = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"


def _quantile_edges(source: str, f: str, where: str = "") -> str:
    return f"SELECT list_sort(list_distinct(quantile_cont(CAST({f} AS DOUBLE), {_PROBS}))) AS e FROM {source} {where}"


QUERIES["mining_quantile_edges"] = lambda s, d: plain(_edges(s, d, "quantile"))
SQL["mining_quantile_edges"] = chain(
    "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(p - 1 AS BIGINT) AS position, {r6('e[p]', 'edge')} FROM ({_quantile_edges('lines', f)}), range(1, 12) r(p) WHERE p <= len(e)"
        for f in LINE_NUMBERS
    )
)
QUERIES["mining_equal_width_edges"] = lambda s, d: plain(_edges(s, d, "equal_width"))
SQL["mining_equal_width_edges"] = chain(
    "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, p AS position, {r6('CASE WHEN p = 0 THEN lo - (hi - lo) * 0.001 ELSE lo + (hi - lo) * p / 10 END', 'edge')} "
        f"FROM (SELECT CAST(min({f}) AS DOUBLE) AS lo, CAST(max({f}) AS DOUBLE) AS hi FROM lines), range(11) r(p)"
        for f in LINE_NUMBERS
    )
)


# M6, M8
def _bin_report(source: str, totals: str, f: str, edges: str, where: str = "", default: int = 100, inner_only: bool = False) -> str:
    """Bins ``(e[i], e[i+1]]``, the lowest edge included; values beyond the edges count into the outer bins."""
    below = f"len(list_filter(e[2:len(e) - 1], lambda x: x < {f}))"
    return f"""SELECT '{f}' AS feature, bin_id, count, {big('s', 'fraud_count')}, {_RATE}, {r6('lo', 'min_value')}, {r6('hi', 'max_value')}, {r6('mean', 'mean_value')} FROM (
  SELECT CAST({below} AS BIGINT) AS bin_id, count(fraud) AS count, coalesce(sum(fraud), 0) AS s, avg(fraud) AS rate,
    CAST(min({f}) FILTER (fraud IS NOT NULL) AS DOUBLE) AS lo, CAST(max({f}) FILTER (fraud IS NOT NULL) AS DOUBLE) AS hi, avg({f}) FILTER (fraud IS NOT NULL) AS mean
  FROM {source}, ({edges}) WHERE {f} IS NOT NULL {where} GROUP BY 1) q, {totals} WHERE count > 0 AND count >= {_least(default)}"""


_KNOWN = "WHERE fraud IS NOT NULL"
QUERIES["mining_rate_by_bin"] = lambda s, d: plain(rates.bin_rate(_lines(s, d), "l_extendedprice").drop("bin"))
SQL["mining_rate_by_bin"] = chain(_bin_report("lines", "lg", "l_extendedprice", _quantile_edges("lines", "l_extendedprice", _KNOWN)))
QUERIES["mining_rate_by_custom_bin"] = lambda s, d: plain(rates.bin_rate(_lines(s, d), "l_quantity", bins=[1, 10, 20, 30], method="custom").drop("bin"))
SQL["mining_rate_by_custom_bin"] = chain(_bin_report("lines", "lg", "l_quantity", "SELECT [1, 10, 20, 30] AS e", "AND l_quantity BETWEEN 1 AND 30"))
QUERIES["mining_many_bins"] = lambda s, d: plain(rates.many_bin_rates(_lines(s, d), LINE_NUMBERS).drop("bin"))
SQL["mining_many_bins"] = chain("\nUNION ALL ".join(_bin_report("lines", "lg", f, _quantile_edges("lines", f, _KNOWN)) for f in LINE_NUMBERS))

# M9
QUERIES["mining_strong_bins"] = lambda s, d: plain(rates.strong_patterns(rates.many_bin_rates(_lines(s, d), LINE_NUMBERS), 1.005, 0.3, 150).drop("bin"))
SQL["mining_strong_bins"] = f"SELECT * FROM ({SQL['mining_many_bins']}) WHERE lift >= 1.005 AND fraud_rate >= 0.3 AND count >= 150"
QUERIES["mining_strong_categories"] = lambda s, d: plain(rates.strong_patterns(rates.categorical_report(_lines(s, d), LINE_VALUES), 1.0, None, 100))
SQL["mining_strong_categories"] = f"SELECT * FROM ({SQL['mining_many_categories']}) WHERE lift >= 1.0 AND count >= 100"

# M10
CHAIN["ig"] = "SELECT count(*) AS rows, count(fraud) AS n, avg(fraud) AS g FROM insight"
_PM_CATEGORIES, _PM_NUMBERS = ["payment_channel", "card_present", "mcc"], ["amount", "mcc_entropy_30d", "night_ratio_30d"]
_PM_AUTO = [
    "ip_score_risk_group", "decline_rate_risk_group", "credit_util_risk_group", "txn_count_7d_group", "txn_velocity_group", "night_ratio_group",
    "night_unusual_group", "low_mcc_entropy_x_low_night_ratio", "low_mcc_entropy_x_high_max_amount_30d", "low_mcc_entropy_x_low_spending_trend",
    "low_mcc_entropy_x_card_not_present", "low_night_ratio_x_high_max_amount_30d", "cross_border_x_low_country_diversity", "high_ip_score_x_card_not_present",
]


def _mined(s, d):
    return stages.mine_patterns(prepared(s, d, passes=True), _PM_CATEGORIES, _PM_NUMBERS)


QUERIES["mining_patterns_categorical"] = lambda s, d: plain(_mined(s, d).categorical)
SQL["mining_patterns_categorical"] = chain("\nUNION ALL ".join(_value_report("insight", "ig", f) for f in _PM_CATEGORIES + _PM_AUTO))
QUERIES["mining_patterns_numeric"] = lambda s, d: plain(_mined(s, d).numeric.drop("bin"))
SQL["mining_patterns_numeric"] = chain("\nUNION ALL ".join(_bin_report("insight", "ig", f, _quantile_edges("insight", f)) for f in [*_PM_NUMBERS, "night_unusual_score"]))

# M11, M12
CHAIN["ag"] = "SELECT count(*) AS n, avg(fraud) AS g FROM amt"


def _condition_sql(name: str, condition: str, source: str, key: str, empty_diff: str) -> str:
    return f"""SELECT '{name}' AS {key}, support, {r6('CASE WHEN support = 0 THEN 0 ELSE support / n END', 'support_rate')}, {big('s', 'fraud_count')},
  {r6('CASE WHEN support = 0 THEN 0 ELSE s / support END', 'fraud_rate')}, {r6('g', 'global_fraud_rate')},
  {r6(f'CASE WHEN support = 0 THEN {empty_diff} ELSE s / support - g END', 'fraud_rate_diff')}, {r6('CASE WHEN support = 0 THEN 0 ELSE s / support / g END', 'lift')}
  FROM (SELECT count(*) FILTER (c) AS support, coalesce(sum(fraud) FILTER (c), 0) AS s, count(*) AS n, avg(fraud) AS g FROM (SELECT fraud, coalesce({condition}, false) AS c FROM {source} WHERE fraud IS NOT NULL))"""


def _quantile_segments(s, d):
    df = _lines(s, d)
    low, high = (rates.quantiles(df, {"x": F.col("l_extendedprice")}, [q])["x"][0] for q in (0.1, 0.9))
    x = F.col("l_extendedprice")
    conditions = {"low_price": x <= low, "high_price": x >= high, "flagged": F.col("l_linestatus") == "F", "nothing": x < 0}
    return segments.evaluate_conditions(df, conditions, name="segment_name")


_Q = "(SELECT quantile_cont(l_extendedprice, {}) FROM lines)"
QUERIES["mining_quantile_segments"] = lambda s, d: plain(_quantile_segments(s, d))
SQL["mining_quantile_segments"] = chain(
    "\nUNION ALL ".join(
        _condition_sql(n, c, "lines", "segment_name", "-g")
        for n, c in {
            "low_price": f"l_extendedprice <= {_Q.format(0.1)}", "high_price": f"l_extendedprice >= {_Q.format(0.9)}",
            "flagged": "l_linestatus = 'F'", "nothing": "l_extendedprice < 0",
        }.items()
    )
)

# M13
_ORIGIN = {"spending": "spending_trend"}


def _segment_sql(parts) -> str:
    out = []
    for kind, source, argument in parts:
        c = _ORIGIN.get(source, source)
        q = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {argument}) FROM amt)"
        out.append({"low": f"{c} <= {q}", "high": f"{c} >= {q}", "equals": f"{c} = {argument}", "positive": f"{c} > 0", "true": c, "false": f"NOT {c}"}[kind])
    return " AND ".join(out)


QUERIES["mining_business_segments"] = lambda s, d: plain(segments.segment_report(features.amount_features(prepared(s, d, passes=True))).drop("description"))
SQL["mining_business_segments"] = chain("\nUNION ALL ".join(_condition_sql(n, _segment_sql(parts), "amt", "segment_name", "-g") for n, (_, parts) in SEGMENTS.items()))


# M14
def _rule(s, d):
    return segments.evaluate_conditions(_lines(s, d), {"cheap AND late": (F.col("l_quantity") <= 10) & (F.col("l_shipdate") >= "2000-01-01"), "never": F.lit(False)})


QUERIES["mining_rule_condition"] = lambda s, d: plain(_rule(s, d))
SQL["mining_rule_condition"] = chain(
    _condition_sql("cheap AND late", "l_quantity <= 10 AND l_shipdate >= DATE '2000-01-01'", "lines", "rule", "0")
    + "\nUNION ALL " + _condition_sql("never", "false", "lines", "rule", "0")
)

# M15
CHAIN["fg"] = "SELECT count(*) AS rows, count(fraud) AS n, avg(fraud) AS g FROM feat"
_RULE = f"{r6('support / n', 'support_rate')}, {big('s', 'fraud_count')}, {r6('s / support', 'fraud_rate')}, {r6('g', 'global_fraud_rate')}, {r6('s / support - g', 'fraud_rate_diff')}, {r6('s / support / g', 'lift')}"


def _combos(flags: list[str], least: int, where: str = "") -> str:
    """All combinations through a self-join of (row, flag) pairs: simple, and not how the query works."""
    positions = "[" + ", ".join(f"'{f}'" for f in flags) + "]"
    unpivot = f"SELECT event_id, fraud, i FROM (SELECT event_id, fraud, unnest([{', '.join(flags)}]) AS v, unnest(range({len(flags)})) AS i FROM feat) WHERE v = 1 {where}"
    name = "({0})[{1}.i + 1]"
    pair = f"{name.format(positions, 'a')} || ' AND ' || {name.format(positions, 'b')}"
    triple = f"{pair} || ' AND ' || {name.format(positions, 'c')}"
    return f"""
SELECT rule, support, {_RULE}, "order" FROM (
  SELECT {pair} AS rule, count(*) AS support, sum(a.fraud) AS s, CAST(2 AS BIGINT) AS "order" FROM up a JOIN up b ON a.event_id = b.event_id AND a.i < b.i GROUP BY 1
  UNION ALL
  SELECT {triple}, count(*), sum(a.fraud), 3 FROM up a JOIN up b ON a.event_id = b.event_id AND a.i < b.i JOIN up c ON b.event_id = c.event_id AND b.i < c.i GROUP BY 1) q, fg
WHERE support >= {least}""", unpivot


AMOUNT_FLAGS = ["amount_missing_flag", "amount_invalid_flag"] + [f"{c}_{k}_flag" for c in ("mean_amount_30d", "max_amount_30d", "std_amount_30d") for k in ("missing", "zero")]
ALL_FLAGS = AMOUNT_FLAGS + BASE_FLAGS + list(INTERACTIONS)


def _flag_rules(s, d):
    return combinations.flag_combinations(featured(s, d)[0], ALL_FLAGS)


QUERIES["mining_flag_combinations"] = lambda s, d: plain(_flag_rules(s, d))
_query, _pairs = _combos(ALL_FLAGS, 50)
SQL["mining_flag_combinations"] = chain(_query, up=_pairs)


# M16
def _pair_sql(a: str, b: str, least: int, source: str = "feat", totals: str = "fg") -> str:
    return f"""SELECT '{a}=' || coalesce(va, 'nan') || ' AND {b}=' || coalesce(vb, 'nan') AS rule, '{a}' AS feature_a, va AS value_a, '{b}' AS feature_b, vb AS value_b,
  support, {_RULE}, CAST(2 AS BIGINT) AS "order" FROM (SELECT CAST({a} AS VARCHAR) AS va, CAST({b} AS VARCHAR) AS vb, count(*) AS support, sum(fraud) AS s FROM {source} WHERE fraud IS NOT NULL GROUP BY 1, 2) q, {totals}
  WHERE support >= {least}"""


CHAIN["pg"] = "SELECT count(*) AS rows, count(fraud) AS n, avg(fraud) AS g FROM prep"
QUERIES["mining_category_pairs"] = lambda s, d: plain(combinations.categorical_pairs(prepared(s, d)))
SQL["mining_category_pairs"] = chain("\nUNION ALL ".join(_pair_sql(a, b, 50, "prep", "pg") for a, b in MINED_PAIRS))

# M17
QUERIES["mining_priority_rules"] = lambda s, d: plain(segments.priority_rules(featured(s, d)[0]))


def _priority(least: int = 30, source: str = "feat") -> str:
    return "\nUNION ALL ".join(
        f"SELECT *, CAST({len(flags)} AS BIGINT) AS \"order\" FROM ({_condition_sql(name, ' AND '.join(f'{x} = 1' for x in flags), source, 'rule', '0')}) WHERE support >= {least}"
        for name, flags in PRIORITY_RULES.items()
    )


SQL["mining_priority_rules"] = chain(_priority())

# M18
QUERIES["mining_recommended_interactions"] = lambda s, d: plain(rules.recommended_interactions(segments.priority_rules(featured(s, d)[0]), 1.0, 40))
SQL["mining_recommended_interactions"] = chain(
    f"SELECT *, '{rules.RECOMMENDATION}' AS feature_recommendation FROM ({_priority()}) WHERE lift >= 1.0 AND support >= 40"
)

# M19, M20
_STRENGTH = """CASE WHEN support < 30 THEN 'WEAK_SUPPORT' WHEN lift >= 5 AND fraud_rate >= 0.10 THEN 'VERY_STRONG'
  WHEN lift >= 3 AND fraud_rate >= 0.07 THEN 'STRONG' WHEN lift >= 2 AND fraud_rate >= 0.05 THEN 'MEDIUM' WHEN lift >= 1.5 THEN 'WEAK' ELSE 'LOW_SIGNAL' END AS strength"""
_MEANING = (
    "CASE "
    + " ".join(f"WHEN {' AND '.join(f'contains(lower(rule), {chr(39)}{p}{chr(39)})' for p in parts)} THEN '{text}'" for parts, text in rules.MEANINGS)
    + f" ELSE '{rules.NO_MEANING}' END AS business_interpretation"
)
QUERIES["mining_rule_interpretation"] = lambda s, d: plain(rules.interpret(_flag_rules(s, d)))
SQL["mining_rule_interpretation"] = chain(f"SELECT *, {_STRENGTH}, {_MEANING} FROM ({_query})", up=_pairs)


# M21
def _actionable(s, d):
    table = featured(s, d)[0]
    every = rules.rule_union(combinations.flag_combinations(table, ALL_FLAGS), segments.priority_rules(table), combinations.categorical_pairs(table))
    return rules.actionable_rules(every, 1.2, 50, 0.2)


_NO_PAIR = "NULL::VARCHAR AS feature_a, NULL::VARCHAR AS value_a, NULL::VARCHAR AS feature_b, NULL::VARCHAR AS value_b"
QUERIES["mining_actionable_rules"] = lambda s, d: plain(_actionable(s, d))
SQL["mining_actionable_rules"] = chain(
    f"""SELECT *, {_STRENGTH}, {_MEANING} FROM (
  SELECT *, {_NO_PAIR} FROM ({_query}) UNION ALL BY NAME SELECT *, {_NO_PAIR} FROM ({_priority()}) UNION ALL BY NAME
  SELECT * FROM ({chr(10).join(['UNION ALL '.join(_pair_sql(a, b, 50) + chr(10) for a, b in MINED_PAIRS)])}))
  WHERE support >= 50 AND lift >= 1.2 AND fraud_rate >= 0.2""",
    up=_pairs,
)

# ------------------------------------------------------------------ stability: first and later line items

_TRAIN, _VALID = "l_shipdate < DATE '2000-01-01'", "l_shipdate >= DATE '2000-01-01'"
CHAIN["lt"] = f"SELECT * FROM lines WHERE {_TRAIN}"
CHAIN["lv"] = f"SELECT * FROM lines WHERE {_VALID}"
CHAIN["ltg"] = "SELECT count(*) AS rows, count(fraud) AS n, avg(fraud) AS g FROM lt"
CHAIN["lvg"] = "SELECT count(*) AS rows, count(fraud) AS n, avg(fraud) AS g FROM lv"


def _parts(s, d):
    df = _lines(s, d)
    return df.where(F.col("l_shipdate") < "2000-01-01"), df.where(F.col("l_shipdate") >= "2000-01-01")


# K1
def _train_edges(s, d):
    edges = stability.train_edges(_parts(s, d)[0], LINE_NUMBERS)
    rows = [(f, i, e) for f, line in edges.items() for i, e in enumerate(line[1:-1])]
    return s.createDataFrame(rows, "feature string, position bigint, inner_edge double")


QUERIES["stability_train_edges"] = lambda s, d: plain(_train_edges(s, d))
SQL["stability_train_edges"] = chain(
    "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(p - 2 AS BIGINT) AS position, {r6('e[p]', 'inner_edge')} FROM ({_quantile_edges('lt', f)}), range(2, 11) r(p) WHERE p < len(e)"
        for f in LINE_NUMBERS
    )
)


# K2, K3, K4
def _both_reports(s, d):
    train, valid = _parts(s, d)
    edges = stability.train_edges(train, LINE_NUMBERS)
    return stability.report_with_edges(train, edges), stability.report_with_edges(valid, edges, default=50)


QUERIES["stability_report_with_train_bins"] = lambda s, d: plain(_both_reports(s, d)[1].drop("bin"))
_TRAIN_BINS = "\nUNION ALL ".join(_bin_report("lt", "ltg", f, _quantile_edges("lt", f)) for f in LINE_NUMBERS)
_VALID_BINS = "\nUNION ALL ".join(_bin_report("lv", "lvg", f, _quantile_edges("lt", f), default=50) for f in LINE_NUMBERS)
SQL["stability_report_with_train_bins"] = chain(_VALID_BINS)

_M = ["count", "fraud_count", "fraud_rate", "global_fraud_rate", "fraud_rate_diff", "lift"]


def _raw(report: str) -> str:
    """The report without rounding: differences and ratios are taken of the exact figures."""
    import re

    return re.sub(r"floor\(\((.*?)\) \* 1e6 \+ 0\.5\) / 1e6 AS (\w+)", r"\1 AS \2", report)


def _compare(keys: list[str], measures: list[str] = _M) -> str:
    sides = ", ".join(
        (big(f"{x}.{m}", f"{m}_{n}") if m in ("count", "support", "fraud_count") else r6(f"{x}.{m}", f"{m}_{n}")) for m in measures for x, n in (("t", "train"), ("v", "valid"))
    )
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM v.{k}" for k in keys)
    return f"""SELECT {', '.join(f't.{k} AS {k}' for k in keys)}, {sides}, {r6('v.lift - t.lift', 'lift_diff_valid_train')}, {r6('v.lift / (t.lift + 1e-9)', 'lift_ratio_valid_train')},
  {r6('v.fraud_rate - t.fraud_rate', 'fraud_rate_diff_valid_train')} FROM tr t JOIN vr v ON {on}"""


def _compared_bins(s, d):
    train, valid = _both_reports(s, d)
    return stability.compare_reports(train, valid, ["feature", "bin_id"])


QUERIES["stability_compare_bins"] = lambda s, d: plain(_compared_bins(s, d))
SQL["stability_compare_bins"] = chain(_compare(["feature", "bin_id"]), tr=_raw(_TRAIN_BINS), vr=_raw(_VALID_BINS))


def _compared_values(s, d):
    train, valid = _parts(s, d)
    return stability.compare_reports(rates.categorical_report(train, LINE_VALUES), rates.categorical_report(valid, LINE_VALUES, default=50), ["feature", "value"])


_TRAIN_VALUES = "\nUNION ALL ".join(_value_report("lt", "ltg", f) for f in LINE_VALUES)
_VALID_VALUES = "\nUNION ALL ".join(_value_report("lv", "lvg", f, default=50) for f in LINE_VALUES)
QUERIES["stability_compare_categories"] = lambda s, d: plain(_compared_values(s, d))
SQL["stability_compare_categories"] = chain(_compare(["feature", "value"]), tr=_raw(_TRAIN_VALUES), vr=_raw(_VALID_VALUES))
QUERIES["stability_stable_patterns"] = lambda s, d: plain(stability.stable_patterns(_compared_values(s, d), 0.98, 0.97, 60, 40, 0.04))
SQL["stability_stable_patterns"] = chain(
    f"SELECT * FROM ({_compare(['feature', 'value'])}) WHERE lift_train >= 0.98 AND lift_valid >= 0.97 AND count_train >= 60 AND count_valid >= 40 AND lift_ratio_valid_train BETWEEN 0.96 AND 1.04",
    tr=_raw(_TRAIN_VALUES),
    vr=_raw(_VALID_VALUES),
)


# The whole stage on transactions: compared segments between train and validation
def _stage(s, d, kind):
    clean = prepared(s, d, passes=True)
    found = stages.stable_insights(clean, "event_id")
    return found.compared[kind]


QUERIES["stage_stable_insights_priority"] = lambda s, d: plain(_stage(s, d, "priority"))
QUERIES["stage_stable_insights_pairs"] = lambda s, d: plain(_stage(s, d, "pairs"))
