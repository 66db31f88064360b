"""Preparation, training and scoring queries on the feature table of transactions derived from events."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from riskloom.catalog.common import big, chain, featured, fit_rows, plain, r6, raw_transactions, real, scratch, train_rows
from riskloom.fixed_values import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from riskloom.operators import decisions, experiments, explain, features, models, preprocessing
from riskloom.sources import tables

QUERIES, SQL = {}, {}


def _table(s, d):
    """The model-ready table with ids and splits. Fits scan it many times, so it is written once and read back."""
    table, thresholds = fit_rows(s, d)
    chosen = features.resolve_feature_set(table, thresholds)
    path = scratch(s)
    features.select_model_columns(table, chosen, ("event_id", "split")).write.partitionBy("split").parquet(path)
    return s.read.parquet(path), chosen


def _train_table(s, d):
    """The train rows of the model-ready table, for queries that read no others."""
    table, thresholds = fit_rows(s, d, train=True)
    chosen = features.resolve_feature_set(table, thresholds)
    return tables.written_once(features.select_model_columns(table, chosen, ("event_id", "split"))), chosen


# E1
def _categories(s, d):
    table, _ = featured(s, d)
    found = preprocessing.frequent_categories(train_rows(table), CATEGORICAL_FEATURES, 150)
    rows = [(c, v) for c, (frequent, rare) in found.items() for v in [*frequent, *([preprocessing.RARE] if rare else [])]]
    return s.createDataFrame(rows, "feature string, category string")


QUERIES["prepare_frequent_categories"] = lambda s, d: plain(_categories(s, d))
SQL["prepare_frequent_categories"] = chain(
    "\nUNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS feature, CASE WHEN n >= 150 THEN v ELSE 'infrequent_sklearn' END AS category FROM (
  SELECT coalesce(CAST({c} AS VARCHAR), 'missing') AS v, count(*) AS n FROM feat WHERE split = 'train' GROUP BY 1)"""
        for c in CATEGORICAL_FEATURES
    )
)


# E2, E3
def _scales(s, d):
    table, _ = featured(s, d)
    found = preprocessing.scaling(tables.written_once(train_rows(table).select(*NUMERIC_FEATURES)), NUMERIC_FEATURES, True)
    return s.createDataFrame([(c, *v) for c, v in found.items()], "feature string, median double, mean double, deviation double")


QUERIES["prepare_scaling"] = lambda s, d: plain(_scales(s, d))
SQL["prepare_scaling"] = chain(
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r6('m', 'median')}, {r6(f'avg(coalesce({c}, m))', 'mean')}, {r6(f'coalesce(nullif(stddev_pop(coalesce({c}, m)), 0), 1)', 'deviation')}
  FROM feat, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m FROM feat WHERE split = 'train') WHERE split = 'train' GROUP BY m"""
        for c in NUMERIC_FEATURES
    )
)

# L5
QUERIES["train_class_weights"] = lambda s, d: plain(_weights(s, d))


def _weights(s, d):
    table, _ = featured(s, d)
    n, p = models.class_counts(train_rows(table), "fraud")
    w = models.balanced_weights(n, p)
    return s.createDataFrame([(n, p, w[0], w[1], models.scale_pos_weight(n, p))], "negatives bigint, positives bigint, weight_0 double, weight_1 double, scale_pos_weight double")


SQL["train_class_weights"] = chain(
    f"""SELECT n AS negatives, p AS positives, {r6('(n + p) / (2 * n)', 'weight_0')}, {r6('(n + p) / (2 * p)', 'weight_1')}, {r6('n / p', 'scale_pos_weight')}
FROM (SELECT count(*) FILTER (fraud = 0) AS n, count(*) FILTER (fraud = 1) AS p FROM sev WHERE split = 'train')"""
)


# E4, L1, L4, L8, Z1, H1
def _logistic(s, d):
    table, chosen = _train_table(s, d)
    return table, models.fit_model(train_rows(table), chosen, "lr")


QUERIES["train_logistic_coefficients"] = lambda s, d: plain(explain.explain_coefficients(models.coefficients(s, _logistic(s, d)[1])))


def _coefficients(s, d):
    return models.coefficients(s, _logistic(s, d)[1])


# H3-H5, H7 on the fitted coefficients of all encoded features
QUERIES["train_logistic_without_codes"] = lambda s, d: plain(explain.coefficients_without(_coefficients(s, d)))
QUERIES["train_logistic_group_summary"] = lambda s, d: plain(explain.group_summary(explain.explain_coefficients(_coefficients(s, d))))
QUERIES["train_logistic_importance_summary"] = lambda s, d: plain(explain.importance_summary(_coefficients(s, d).select("feature", F.col("abs_coefficient").alias("importance"))))
QUERIES["train_logistic_top_raising"] = lambda s, d: plain(explain.top_coefficients(_coefficients(s, d), 10))
QUERIES["train_logistic_top_lowering"] = lambda s, d: plain(explain.top_coefficients(_coefficients(s, d), 10, raising=False))


def _decided(s, d):
    table, chosen = _table(s, d)
    model = models.fit_model(train_rows(table), chosen, "lr")
    path = scratch(s)
    models.save_model(model, path)
    return decisions.decide(models.score(models.load_model(s, path), table, ("event_id", "split")), 0.5)


QUERIES["score_and_decide"] = lambda s, d: plain(_decided(s, d))


# L2, H2
def _forest(s, d):
    table, chosen = _table(s, d)
    model = models.fit_model(train_rows(table), chosen, "rf")
    return models.importances(s, model)


QUERIES["train_forest_importances"] = lambda s, d: plain(_forest(s, d))


# L3, V10
def _boosted(s, d):
    table, chosen = _table(s, d)
    config = next(c for c in experiments.boosting_configs() if c.experiment_name == "cat_gpu_mcc_minfreq_100_no_interactions")
    config = dataclasses.replace(config, experiment_name="boosted")
    return experiments.run_experiment(table, chosen, config, "event_id").metrics


QUERIES["experiment_boosted_metrics"] = lambda s, d: plain(_boosted(s, d))


# V11
def _grid(s, d):
    table, chosen = _table(s, d)
    return experiments.run_grid(table, chosen, experiments.logistic_configs(), "event_id").drop("elapsed_seconds")


def _boosting_grid(s, d):
    table, chosen = _table(s, d)
    return experiments.run_grid(table, chosen, experiments.boosting_configs(), "event_id").drop("elapsed_seconds")


def _tuning_grid(s, d):
    table, chosen = _table(s, d)
    return experiments.run_grid(table, chosen, experiments.tuning_configs(), "event_id").drop("elapsed_seconds")


def _gains(s, d):
    table, chosen = _table(s, d)
    config = next(c for c in experiments.tuning_configs() if c.experiment_name == "cat_tune_depth7_l2_8_lr003_iter700")
    used = chosen.narrowed(config.drop_categorical_features, config.drop_interaction_features)
    return models.importances(s, models.fit_model(train_rows(table), used, config.model_name, config.model_params, True, config.min_frequency))


QUERIES["experiment_boosting_grid"] = lambda s, d: plain(_boosting_grid(s, d))
QUERIES["experiment_tuning_grid"] = lambda s, d: plain(_tuning_grid(s, d))
QUERIES["train_boosted_gains"] = lambda s, d: plain(_gains(s, d))
QUERIES["experiment_logistic_grid"] = lambda s, d: plain(_grid(s, d))


# S3, S4: written partitioned by split, one split read back
def _written(s, d):
    table, _ = _table(s, d)
    return table.where(F.col("split") == "validation").select("event_id", "split", "fraud")


QUERIES["sink_split_dataset"] = lambda s, d: plain(_written(s, d))
SQL["sink_split_dataset"] = chain(f"SELECT event_id, split, {big('fraud', 'fraud')} FROM sev WHERE split = 'validation'")


# S1, S2, S5: the raw table as CSV with a header, read back under its declared schema
def _csv(s, d):
    path = scratch(s) + ".csv"
    raw = raw_transactions(s, d)
    tables.save_cleaned(raw, path)
    return tables.load_transactions(s, path, raw.schema)


_RAW_TEXTS = ["currency", "local_timestamp", "payment_channel", "merchant_country", "card_entry_mode", "auth_result", "pin_verif_method", "recurring_flag", "auth_characteristics", "message_type", "term_location", "ip_risk", "txn_counts", "device_id", "merchant_id"]
_RAW_REALS = ["amount", "mean_amount_30d", "std_amount_30d", "max_amount_30d", "online_share_7d", "night_ratio_30d", "decline_rate_30d", "mcc_entropy_30d", "credit_util_today", "spending_trend"]
_RAW_INTS = ["mcc", "card_activation_age", "distinct_merchants_7d", "distinct_countries_30d", "chargebacks_365d", "device_diversity_30d", "fraud"]
QUERIES["source_csv_transactions"] = lambda s, d: plain(_csv(s, d), "days_since_last_txn")
SQL["source_csv_transactions"] = chain(
    f"SELECT event_id, {', '.join(_RAW_TEXTS)}, card_present, tokenised, cross_border, {', '.join(r6(c, c) for c in _RAW_REALS)}, "
    f"{', '.join(big(c, c) for c in _RAW_INTS)}, {real('days_since_last_txn', 'days_since_last_txn')} FROM txn"
)
