"""Feature derivation: amounts, risk groups, fitted flags, interactions and the model feature set.

Everything after the fit is a narrow projection. The fit reads nine quantiles of the training rows and
returns them as plain numbers, so applying them adds literals to the plan and no join.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.fixed_values import (
    BINARY_FEATURES,
    CATEGORICAL_FEATURES,
    DROPPED_COLUMNS,
    INTERACTION_FEATURES,
    INTERACTIONS,
    NUMERIC_FEATURES,
    RISK_GROUPS,
    SPENDING_COLUMNS,
    TARGET,
    THRESHOLDS,
)
from riskloom.functions.bins import pick
from riskloom.functions.order_stats import quantiles
from riskloom.functions.scalars import damped_ratio, flag, log1p_clipped, number, says_false, says_true
from riskloom.operators.timing import night_habit
from riskloom.sources.tables import load_record, save_record, written_once

Thresholds = dict[str, "float | None"]


# ------------------------------------------------------------------ amounts


def amount_features(df: DataFrame) -> DataFrame:
    """Log amounts, missing / zero flags, ratios to the 30-day history and the flags drawn from them."""
    if "amount" not in df.columns:
        return df
    history = [c for c in ("mean_amount_30d", "max_amount_30d", "std_amount_30d") if c in df.columns]
    if "mean_amount_30d" not in history and "std_amount_30d" in history:
        history.remove("std_amount_30d")
    out = df.withColumns({c: number(df, c) for c in ["amount", *history]})
    a = F.col("amount")
    new = {
        "log_amount": log1p_clipped(a),
        "amount_missing_flag": flag(a.isNull()),
        "amount_invalid_flag": flag(a.isNull() | (a <= 0)),
    }
    for c in history:
        x = F.col(c)
        new[f"{c}_missing_flag"] = flag(x.isNull())
        new[f"{c}_zero_flag"] = flag(F.coalesce(x, F.lit(0.0)) == 0)
        if c == "std_amount_30d":
            new["amount_z_30d"] = F.try_divide(a - F.col("mean_amount_30d"), x + 1)
            new["amount_to_std_30d"] = damped_ratio(a, x)
        else:
            new[f"log_{c}"] = log1p_clipped(x)
            new[f"amount_to_{c[:-11]}_30d"] = damped_ratio(a, x)
    out = out.withColumns(new)
    then = {}
    if "mean_amount_30d" in history:
        r = F.col("amount_to_mean_30d")
        then["log_amount_to_mean_30d"] = log1p_clipped(r)
        then["is_amount_above_mean"] = flag(r > 1)
        then["is_amount_2x_mean"] = flag(r > 2)
        then["is_amount_5x_mean"] = flag(r > 5)
    if "max_amount_30d" in history:
        r = F.col("amount_to_max_30d")
        then["log_amount_to_max_30d"] = log1p_clipped(r)
        then["is_amount_near_max"] = flag(r >= 0.8)
        then["is_amount_above_max"] = flag(r > 1)
    return out.withColumns(then) if then else out


# ------------------------------------------------------------------ behaviour


def _source_column(df: DataFrame, name: str) -> str | None:
    candidates = SPENDING_COLUMNS if name == "spending" else [name]
    return next((c for c in candidates if c in df.columns), None)


def fit_thresholds(train: DataFrame, method: str = "exact") -> Thresholds:
    """The nine train quantiles; NULL where the column is absent or empty."""
    sources = {name: _source_column(train, spec[0]) for name, spec in THRESHOLDS.items()}
    probs: dict[str, list[float]] = {}
    for name, column in sources.items():
        if column:
            probs.setdefault(column, []).append(THRESHOLDS[name][1])
    columns = {c: number(train, c) for c in probs}
    if method == "exact" and probs:  # several passes over columns that were derived
        train = written_once(train.select(*[x.alias(c) for c, x in columns.items()]))
        columns = {c: F.col(c) for c in probs}
    values = quantiles(train, columns, probs, method)
    return {
        name: values[column][probs[column].index(THRESHOLDS[name][1])] if column else None
        for name, column in sources.items()
    }


def thresholds_frame(spark: SparkSession, thresholds: Thresholds) -> DataFrame:
    return spark.createDataFrame([tuple(thresholds[n] for n in THRESHOLDS)], ", ".join(f"{n} double" for n in THRESHOLDS))


def risk_groups(df: DataFrame) -> DataFrame:
    new = {
        name: pick(number(df, column), uppers, labels)
        for column, (name, uppers, labels) in RISK_GROUPS.items()
        if column in df.columns
    }
    return df.withColumns(new) if new else df


def behavior_flags(df: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Flags from the fitted thresholds and the four direct ones."""
    new = {}
    for name, (source, _, side, flag_name) in THRESHOLDS.items():
        column, limit = _source_column(df, source), thresholds.get(name)
        if column is None or limit is None:
            continue
        x = number(df, column)
        new[flag_name] = flag(x <= F.lit(limit)) if side == "low" else flag(x >= F.lit(limit))
    if "is_night_txn" in df.columns:
        new["night_transaction_flag"] = flag(number(df, "is_night_txn") == 1)
    if "card_present" in df.columns:
        new["card_not_present_flag"] = flag(says_false(df, "card_present"))
    if "cross_border" in df.columns:
        new["cross_border_flag"] = flag(says_true(df, "cross_border"))
    if "tokenised" in df.columns:
        new["tokenised_flag"] = flag(says_true(df, "tokenised"))
    return df.withColumns(new) if new else df


def behavior_features(df: DataFrame, thresholds: Thresholds | None = None) -> DataFrame:
    """Risk groups, flags and the night habit; without thresholds they are fitted on the frame itself."""
    used = fit_thresholds(df) if thresholds is None else thresholds
    return night_habit(behavior_flags(risk_groups(df), used))


def interaction_features(df: DataFrame) -> DataFrame:
    """Products of 0/1 flags; an absent flag counts as 0."""

    def bit(name: str):
        return F.coalesce(number(df, name), F.lit(0.0)).cast("int") if name in df.columns else F.lit(0)

    new = {}
    for name, flags in INTERACTIONS.items():
        product = bit(flags[0])
        for other in flags[1:]:
            product = product * bit(other)
        new[name] = product
    return df.withColumns(new)


def insight_features(df: DataFrame) -> DataFrame:
    """Behaviour and interactions with thresholds fitted on the frame itself: for quick looks only."""
    return interaction_features(behavior_features(df))


# ------------------------------------------------------------------ model feature set


@dataclass
class FeatureSet:
    """Names of the model features by kind, the target and the thresholds they were built with."""

    target_col: str
    numeric_features: list[str]
    categorical_features: list[str]
    binary_features: list[str]
    interaction_features: list[str]
    dropped_columns: list[str] = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)

    @property
    def all_model_features(self) -> list[str]:
        return self.numeric_features + self.categorical_features + self.binary_features + self.interaction_features

    def narrowed(self, drop_categorical=(), drop_interactions: bool = False) -> "FeatureSet":
        return FeatureSet(
            self.target_col,
            self.numeric_features,
            [c for c in self.categorical_features if c not in set(drop_categorical)],
            self.binary_features,
            [] if drop_interactions else self.interaction_features,
            self.dropped_columns,
            self.thresholds,
        )


FEATURE_SET_SCHEMA = (
    "target_col string, numeric_features array<string>, categorical_features array<string>, "
    "binary_features array<string>, interaction_features array<string>, dropped_columns array<string>, "
    "thresholds map<string,double>, all_model_features array<string>"
)


def normalize_model_columns(df: DataFrame) -> DataFrame:
    """Numbers as double, flags as 0/1 integers, missing categories as ``missing``."""
    new = {c: number(df, c) for c in NUMERIC_FEATURES if c in df.columns}
    for c in BINARY_FEATURES + INTERACTION_FEATURES:
        if c in df.columns:
            new[c] = F.coalesce(number(df, c), F.lit(0.0)).cast("int")
    for c in CATEGORICAL_FEATURES:
        if c in df.columns:
            new[c] = F.coalesce(F.col(c).cast("string"), F.lit("missing"))
    return df.withColumns(new) if new else df


def build_features(df: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The feature stage for any split: amounts, behaviour, interactions, types."""
    out = behavior_features(amount_features(df), thresholds)
    return normalize_model_columns(interaction_features(out))


def resolve_feature_set(df: DataFrame, thresholds: Thresholds | None = None, target: str = TARGET) -> FeatureSet:
    have = set(df.columns)
    present = [[c for c in group if c in have] for group in (NUMERIC_FEATURES, CATEGORICAL_FEATURES, BINARY_FEATURES, INTERACTION_FEATURES)]
    return FeatureSet(target, *present, [c for c in DROPPED_COLUMNS if c in have], dict(thresholds or {}))


def save_feature_set(spark: SparkSession, features: FeatureSet, path: str) -> None:
    save_record(spark, {**asdict(features), "all_model_features": features.all_model_features}, FEATURE_SET_SCHEMA, path)


def load_feature_set(spark: SparkSession, path: str) -> FeatureSet:
    record = load_record(spark, path, FEATURE_SET_SCHEMA)
    record.pop("all_model_features")
    return FeatureSet(**record)


def select_model_columns(df: DataFrame, features: FeatureSet, keep: tuple[str, ...] = ()) -> DataFrame:
    names = [c for c in [*keep, *features.all_model_features, features.target_col] if c in df.columns]
    return df.select(*dict.fromkeys(names))


def feature_report(df: DataFrame, features: FeatureSet, split: str = "split") -> DataFrame:
    """Rows, widths and target counts per split; the split column itself is not counted as a column."""
    y = number(df, features.target_col)

    def width(n: int):
        return F.lit(n).cast("bigint")

    return df.groupBy(split).agg(
        F.count("*").alias("rows"),
        width(len(df.columns) - 1).alias("columns"),
        width(len(features.numeric_features)).alias("numeric_features"),
        width(len(features.categorical_features)).alias("categorical_features"),
        width(len(features.binary_features)).alias("binary_features"),
        width(len(features.interaction_features)).alias("interaction_features"),
        width(len(features.all_model_features)).alias("all_model_features"),
        F.lit(features.target_col).alias("target_col"),
        F.sum(y).cast("bigint").alias("fraud_count"),
        F.avg(y).alias("fraud_rate"),
    )
