"""Evaluation, threshold, policy, decision and error queries on deterministically scored events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.common import CHAIN, big, chain, featured, plain, r6, real, scored_events, scratch
from riskloom.fixed_values import CATEGORICAL_FEATURES, ERROR_CATEGORICAL, ERROR_NUMERIC, NUMERIC_FEATURES, REVIEW_CAPACITIES
from riskloom.operators import decisions, errors, evaluation, experiments, explain

QUERIES, SQL = {}, {}

THRESHOLD = 0.6


def _part(s, d, split):
    return scored_events(s, d).where(F.col("split") == split)


# V1, V6
QUERIES["eval_predictions"] = lambda s, d: plain(evaluation.predictions(scored_events(s, d), THRESHOLD, ("event_id",)))
SQL["eval_predictions"] = chain(
    f"SELECT event_id, {big('y_true', 'y_true')}, {r6('fraud_probability', 'fraud_probability')}, {big('fraud_probability >= 0.6', 'y_pred')}, {r6('0.6', 'threshold')} FROM sc"
)

# V3, V4: per group, over distinct scores
CHAIN["cv"] = """
SELECT split, p, pos, neg, sum(pos) OVER (PARTITION BY split ORDER BY p DESC) AS tp, sum(neg) OVER (PARTITION BY split ORDER BY p DESC) AS fp,
  sum(pos) OVER (PARTITION BY split) AS np, sum(neg) OVER (PARTITION BY split) AS nn
FROM (SELECT split, fraud_probability AS p, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM sc GROUP BY 1, 2)"""
CHAIN["areas"] = """
SELECT split, sum(neg * (tp - pos / 2)) / any_value(np * nn) AS roc_auc, sum(pos * tp / (tp + fp)) / any_value(np) AS pr_auc FROM cv GROUP BY split"""
QUERIES["eval_curve_areas"] = lambda s, d: plain(evaluation.curve_areas(scored_events(s, d), ["split"]))
SQL["eval_curve_areas"] = chain(f"SELECT split, {r6('roc_auc', 'roc_auc')}, {r6('pr_auc', 'pr_auc')} FROM areas")

# V2
_COUNTS = """count(*) AS rows, count(*) FILTER (y_true = 1 AND fraud_probability >= {t}) AS tp, count(*) FILTER (y_true = 0 AND fraud_probability >= {t}) AS fp,
  count(*) FILTER (y_true = 1 AND fraud_probability < {t}) AS fn, count(*) FILTER (y_true = 0 AND fraud_probability < {t}) AS tn"""


def _ratio(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif({b}, 0), 0)"


RATIOS = {
    "fraud_rate": _ratio("tp + fn", "rows"), "precision": _ratio("tp", "tp + fp"), "recall": _ratio("tp", "tp + fn"),
    "f1": _ratio("2 * tp", "2 * tp + fp + fn"), "f2": _ratio("5 * tp", "5 * tp + 4 * fn + fp"),
    "balanced_accuracy": "(tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2", "review_rate": _ratio("tp + fp", "rows"),
}
_RATIOS = ", ".join(r6(e, n) for n, e in RATIOS.items())
_METRICS = f"rows, {big('tp + fn', 'fraud_count')}, {r6('roc_auc', 'roc_auc')}, {r6('pr_auc', 'pr_auc')}, {_RATIOS}, {big('tp + fp', 'predicted_positive')}, tn, fp, fn, tp"
QUERIES["eval_metrics"] = lambda s, d: plain(evaluation.evaluate(scored_events(s, d), THRESHOLD, ["split"]))
SQL["eval_metrics"] = chain(
    f"SELECT split, {r6('0.6', 'threshold')}, {_METRICS} FROM (SELECT split, {_COUNTS.format(t=0.6)} FROM sc GROUP BY split) JOIN areas USING (split)"
)

# V5
QUERIES["eval_confusion_matrix"] = lambda s, d: plain(evaluation.confusion_matrix(_part(s, d, "test"), THRESHOLD))
SQL["eval_confusion_matrix"] = chain(
    f"""WITH c AS (SELECT {_COUNTS.format(t=0.6)} FROM sc WHERE split = 'test')
SELECT 'actual_non_fraud' AS actual, tn AS pred_non_fraud, fp AS pred_fraud FROM c UNION ALL SELECT 'actual_fraud', fn, tp FROM c""".replace("WITH c AS (", "SELECT * FROM (WITH c AS (", 1)
    + ")"
)

# V7
CHAIN["ts"] = f"""
SELECT sc.split, i / 100::DOUBLE AS t, {_COUNTS.format(t='(i / 100::DOUBLE)')} FROM sc, range(1, 100) r(i) GROUP BY sc.split, i"""
QUERIES["eval_threshold_search"] = lambda s, d: plain(evaluation.search_thresholds(scored_events(s, d), by=["split"]))
SQL["eval_threshold_search"] = chain(f"SELECT split, {r6('t', 'threshold')}, {_METRICS} FROM ts JOIN areas USING (split)")

# V8
CHAIN["tr_report"] = "SELECT split, t, rows, tp, fp, fn, tn, " + ", ".join(f"{e} AS {n}" for n, e in RATIOS.items()) + " FROM ts"


def _best(s, d, **limits):
    report = evaluation.search_thresholds(scored_events(s, d), by=["split"], areas=False)
    return evaluation.best_threshold(report, by=["split"], **limits).select("split", "threshold", "precision", "recall", "f2", "review_rate")


def _best_sql(eligible: str) -> str:
    shown = ", ".join(r6(c, c) for c in ("precision", "recall", "f2", "review_rate"))
    return chain(
        f"""SELECT split, {r6('t', 'threshold')}, {shown} FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY {eligible} DESC, f2 DESC, recall DESC, precision DESC, t) AS rn FROM tr_report) WHERE rn = 1"""
    )


QUERIES["eval_best_threshold"] = lambda s, d: plain(_best(s, d, max_review_rate=0.2))
SQL["eval_best_threshold"] = _best_sql("(review_rate <= 0.2)")
QUERIES["eval_best_threshold_fallback"] = lambda s, d: plain(_best(s, d, min_precision=0.99, min_recall=0.5))
SQL["eval_best_threshold_fallback"] = _best_sql("(precision >= 0.99 AND recall >= 0.5)")


# V9
def _policy(s, d):
    report = evaluation.search_thresholds(scored_events(s, d), by=["split"], areas=False)
    parts = [report.where(F.col("split") == p).drop("split") for p in ("validation", "test")]
    return evaluation.capacity_policy(*parts)


_CAPS = ", ".join(f"({c}::DOUBLE)" for c in REVIEW_CAPACITIES)
QUERIES["policy_review_capacity"] = lambda s, d: plain(_policy(s, d))
SQL["policy_review_capacity"] = chain(
    f"""SELECT {r6('cap', 'review_capacity')}, {r6('v.t', 'selected_threshold_from_validation')}, {', '.join(r6(f'v.{c}', f'validation_{c}') for c in ('precision', 'recall', 'f2', 'review_rate'))},
  {', '.join(r6(f'x.{c}', f'test_{c}') for c in ('precision', 'recall', 'f1', 'f2', 'review_rate'))}, {', '.join(f'x.{c} AS test_{c}' for c in ('tp', 'fp', 'fn', 'tn'))}
FROM (SELECT *, row_number() OVER (PARTITION BY cap ORDER BY (review_rate <= cap) DESC, f2 DESC, recall DESC, precision DESC, t) AS rn
  FROM tr_report, (VALUES {_CAPS}) c(cap) WHERE split = 'validation') v
JOIN (SELECT * FROM tr_report WHERE split = 'test') x ON x.t = v.t WHERE rn = 1"""
)

# Z2
QUERIES["decision_policy"] = lambda s, d: plain(decisions.decide(scored_events(s, d).select("event_id", "fraud_probability"), THRESHOLD))
SQL["decision_policy"] = chain(
    f"""SELECT event_id, {r6('fraud_probability', 'fraud_probability')}, {big('fraud_probability >= 0.6', 'prediction')}, {r6('0.6', 'threshold')},
  CASE WHEN fraud_probability < 0.3 THEN 'LOW' WHEN fraud_probability < 0.6 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  CASE WHEN fraud_probability < 0.3 THEN 'APPROVE' WHEN fraud_probability < 0.6 THEN 'MANUAL_REVIEW' ELSE 'FRAUD_ALERT' END AS decision,
  CASE WHEN fraud_probability < 0.3 THEN 'probability below 0.30' WHEN fraud_probability < 0.6 THEN 'probability between 0.30 and the threshold 0.60'
    ELSE 'probability at or above the threshold 0.60' END AS reason FROM sc"""
)


# R1, R2
def _errors(s, d):
    predicted = evaluation.predictions(scored_events(s, d), THRESHOLD, ("event_id",))
    return errors.with_error_type(errors.attach_predictions(featured(s, d)[0], predicted, "event_id"))


_KIND = """CASE WHEN y_true = 1 AND fraud_probability >= 0.6 THEN 'TP' WHEN y_true = 0 AND fraud_probability >= 0.6 THEN 'FP'
  WHEN y_true = 1 THEN 'FN' ELSE 'TN' END AS error_type"""
CHAIN["err"] = f"SELECT feat.*, {_KIND} FROM feat JOIN (SELECT event_id, y_true, fraud_probability FROM sc) USING (event_id)"
QUERIES["error_counts"] = lambda s, d: plain(errors.error_counts(errors.with_error_type(evaluation.predictions(scored_events(s, d), THRESHOLD))))
SQL["error_counts"] = chain(f"SELECT error_type, count(*) AS count, {r6('count(*) / sum(count(*)) OVER ()', 'ratio')} FROM (SELECT {_KIND} FROM sc) GROUP BY 1")
QUERIES["error_false_negatives"] = lambda s, d: plain(errors.error_rows(_errors(s, d), "FN").select("event_id", "split", "y_true", "y_pred", "night_ratio_group"))
SQL["error_false_negatives"] = chain(f"SELECT event_id, split, CAST(1 AS BIGINT) AS y_true, CAST(0 AS BIGINT) AS y_pred, coalesce(night_ratio_group, 'missing') AS night_ratio_group FROM err WHERE error_type = 'FN'")

# R3
def _error_numbers(s, d):
    """The joined table is read by three passes: its narrow columns are written once."""
    path = scratch(s)
    _errors(s, d).select("error_type", *ERROR_NUMERIC).write.parquet(path)
    return errors.numeric_by_error_type(s.read.parquet(path))


QUERIES["error_numeric_summary"] = lambda s, d: plain(_error_numbers(s, d))
SQL["error_numeric_summary"] = chain(
    "SELECT error_type, count(*) AS rows, "
    + ", ".join(
        f"{r6(f'avg({c})', f'{c}_mean')}, {r6(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', f'{c}_median')}, {r6(f'quantile_cont(CAST({c} AS DOUBLE), 0.9)', f'{c}_p90')}"
        for c in ERROR_NUMERIC
    )
    + " FROM err GROUP BY error_type"
)

# R4
QUERIES["error_categorical_summary"] = lambda s, d: plain(errors.categories_by_error_type(_errors(s, d)))
SQL["error_categorical_summary"] = chain(
    "\nUNION ALL ".join(
        f"""SELECT error_type, '{c}' AS feature, v AS value, {r6('n / total', 'ratio')}, n AS count FROM (
  SELECT error_type, v, n, sum(n) OVER (PARTITION BY error_type) AS total, row_number() OVER (PARTITION BY error_type ORDER BY n DESC, v) AS rn
  FROM (SELECT error_type, coalesce(CAST({c} AS VARCHAR), 'missing') AS v, count(*) AS n FROM err GROUP BY 1, 2)) WHERE rn <= 10"""
        for c in ERROR_CATEGORICAL
    )
)

# ---------------------------------------------------------------- comparison and explanation tables

# V12, V11 ranking, H6: two experiments per source; a score formula stands for a model
FORMULAS = {"steep": 20.0, "flat": 80.0}
SOURCES = {"search": ["steep", "flat"], "tuning": ["flat"]}


def _experiment(s, d, name):
    e = scored_events(s, d).where(F.col("split") == "test")
    p = F.col("fraud_probability")
    x = 50.0 * p / (1.0 - p)
    report = evaluation.evaluate(e.withColumn("fraud_probability", x / (x + FORMULAS[name])), 0.5)
    return report.select(F.lit(f"lr_{name}").alias("experiment_name"), F.col("f2").alias("test_f2"), F.col("pr_auc").alias("test_pr_auc"), F.col("tp").alias("test_tp"))


def _compared(s, d):
    tables = {source: reduce(DataFrame.unionByName, [_experiment(s, d, n) for n in names]) for source, names in SOURCES.items()}
    return experiments.compare_sources(tables)


# The formulas keep the order of the scores, so each has the areas of the scores themselves.
_EXPERIMENTS = "\nUNION ALL ".join(
    f"""SELECT 'lr_{n}' AS experiment_name, {RATIOS['f2']} AS f2, (SELECT pr_auc FROM areas WHERE split = 'test') AS pr_auc, tp AS test_tp, '{source}' AS source FROM (
  SELECT count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp, count(*) FILTER (y = 1 AND p < 0.5) AS fn FROM (
    SELECT y_true AS y, (50 * fraud_probability / (1 - fraud_probability)) / (50 * fraud_probability / (1 - fraud_probability) + {FORMULAS[n]}) AS p FROM sc WHERE split = 'test'))"""
    for source, names in SOURCES.items()
    for n in names
)
QUERIES["experiment_source_comparison"] = lambda s, d: plain(experiments.ranked(_compared(s, d)))
SQL["experiment_source_comparison"] = chain(f"SELECT experiment_name, {r6('f2', 'test_f2')}, {r6('pr_auc', 'test_pr_auc')}, test_tp, source FROM ({_EXPERIMENTS})")
QUERIES["experiment_final_choice"] = lambda s, d: plain(explain.final_experiment(_compared(s, d).where(F.col("source") == "search"), "absent"))
SQL["experiment_final_choice"] = chain(
    f"SELECT experiment_name, {r6('f2', 'test_f2')}, {r6('pr_auc', 'test_pr_auc')}, test_tp, source FROM ({_EXPERIMENTS}) WHERE source = 'search' ORDER BY f2 DESC, pr_auc DESC, experiment_name LIMIT 1"
)


# V13
def _gap(s, d):
    scored = scored_events(s, d)
    halves = evaluation.evaluate(scored, 0.5, ["split"])
    name = F.when(F.col("split") == "train", "train_threshold_05").when(F.col("split") == "validation", "validation_best_threshold").otherwise("test")
    return experiments.gap_table(halves.withColumn("split", name))


QUERIES["experiment_gap_table"] = lambda s, d: plain(_gap(s, d))
SQL["experiment_gap_table"] = chain(
    f"""SELECT CASE split WHEN 'train' THEN 'train_threshold_0.5' WHEN 'validation' THEN 'validation_best_threshold' ELSE 'test' END AS split, {r6('0.5', 'threshold')},
  {r6('pr_auc', 'pr_auc')}, {', '.join(r6(RATIOS[m], m) for m in ('precision', 'recall', 'f1', 'f2', 'review_rate'))}
FROM (SELECT split, {_COUNTS.format(t=0.5)} FROM sc GROUP BY split) JOIN areas USING (split)"""
)


# H1-H5, H7: rate differences of encoded features stand for coefficients
ENCODED = {"categorical": CATEGORICAL_FEATURES, "numeric": NUMERIC_FEATURES}


def _weights(s, d):
    """One row per encoded feature: the event rate of the rows that have it, less the overall rate."""
    table = featured(s, d)[0]
    cats = [F.struct(F.concat(F.lit(f"categorical__{c}_"), F.col(c)).alias("feature"), F.lit(True).alias("on")) for c in ENCODED["categorical"]]
    nums = [F.struct(F.lit(f"numeric__{c}").alias("feature"), (F.col(c) > 1).alias("on")) for c in ENCODED["numeric"]]
    rows = table.select("fraud", F.inline(F.array(*cats, *nums)))
    both = rows.groupBy("feature").agg(F.avg(F.when(F.col("on"), F.col("fraud"))).alias("rate"))
    overall = table.agg(F.avg("fraud").alias("g")).scalar()
    c = F.col("coefficient")
    return (
        both.where(F.col("rate").isNotNull())
        .select("feature", (F.col("rate") - overall).alias("coefficient"))
        .withColumns({"abs_coefficient": F.abs(c), "direction": F.when(c >= 0, "increase_risk").otherwise("decrease_risk")})
    )


CHAIN["weights"] = (
    "SELECT feature, rate - g AS c FROM ("
    + "\nUNION ALL ".join(
        [f"SELECT 'categorical__{c}_' || coalesce(CAST({c} AS VARCHAR), 'missing') AS feature, avg(fraud) AS rate FROM feat GROUP BY 1" for c in ENCODED["categorical"]]
        + [f"SELECT 'numeric__{c}', avg(fraud) FILTER ({c} > 1) FROM feat" for c in ENCODED["numeric"]]
    )
    + ") q, (SELECT avg(fraud) AS g FROM feat) WHERE rate IS NOT NULL"
)
_DIRECTION = "CASE WHEN c >= 0 THEN 'increase_risk' ELSE 'decrease_risk' END AS direction"
QUERIES["explain_coefficients_without_codes"] = lambda s, d: plain(explain.coefficients_without(_weights(s, d)))
SQL["explain_coefficients_without_codes"] = chain(f"SELECT feature, {r6('c', 'coefficient')}, {r6('abs(c)', 'abs_coefficient')}, {_DIRECTION} FROM weights WHERE NOT starts_with(feature, 'categorical__mcc_')")


def _grouped(groups: dict, other: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(feature), '{p}')" for p in parts) + f" THEN '{name}'" for name, parts in groups.items()) + f" ELSE '{other}' END"


_CGROUP = _grouped(explain.COEFFICIENT_GROUPS, explain.COEFFICIENT_OTHER)
_READABLE = (
    "CASE WHEN starts_with(feature, 'numeric__') THEN substr(feature, 10) "
    + " ".join(f"WHEN starts_with(feature, 'categorical__{c}_') THEN '{c}=' || substr(feature, {len('categorical__' + c + '_') + 1})" for c in ENCODED["categorical"] if c != "mcc")
    + " ELSE substr(feature, 14) END AS readable_feature"
)
QUERIES["explain_coefficients"] = lambda s, d: plain(explain.explain_coefficients(_weights(s, d)).drop("business_meaning", "expected_direction"))
SQL["explain_coefficients"] = chain(
    f"""SELECT feature, {_READABLE}, {r6('c', 'coefficient')}, {r6('abs(c)', 'abs_coefficient')}, {_DIRECTION},
  CASE WHEN c > 0 THEN 'raises the log-odds' WHEN c < 0 THEN 'lowers the log-odds' ELSE 'no clear linear effect' END AS coefficient_meaning, {_CGROUP} AS insight_group FROM weights"""
)
QUERIES["explain_group_summary"] = lambda s, d: plain(explain.group_summary(explain.explain_coefficients(_weights(s, d))))
SQL["explain_group_summary"] = chain(
    f"""SELECT {_CGROUP} AS insight_group, count(*) AS feature_count, {r6('sum(abs(c))', 'total_abs_coefficient')}, {r6('avg(abs(c))', 'mean_abs_coefficient')},
  {r6('max(abs(c))', 'max_abs_coefficient')} FROM weights GROUP BY 1"""
)
QUERIES["explain_importance_summary"] = lambda s, d: plain(explain.importance_summary(_weights(s, d).select("feature", F.col("abs_coefficient").alias("importance"))))
SQL["explain_importance_summary"] = chain(f"SELECT {_grouped(explain.IMPORTANCE_GROUPS, explain.IMPORTANCE_OTHER)} AS insight_group, {r6('sum(abs(c))', 'importance')} FROM weights GROUP BY 1")
QUERIES["explain_top_raising"] = lambda s, d: plain(explain.top_coefficients(_weights(s, d), 10))
SQL["explain_top_raising"] = chain(f"SELECT feature, {r6('c', 'coefficient')}, {r6('abs(c)', 'abs_coefficient')}, {_DIRECTION} FROM weights WHERE c > 0 ORDER BY c DESC, feature LIMIT 10")
QUERIES["explain_top_lowering"] = lambda s, d: plain(explain.top_coefficients(_weights(s, d), 10, raising=False))
SQL["explain_top_lowering"] = chain(f"SELECT feature, {r6('c', 'coefficient')}, {r6('abs(c)', 'abs_coefficient')}, {_DIRECTION} FROM weights WHERE c < 0 ORDER BY c, feature LIMIT 10")
