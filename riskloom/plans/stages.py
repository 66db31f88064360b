"""The stages of a full run: raw to clean, clean to stable patterns, splits to features, model to decisions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import (
    AUTO_CATEGORICAL,
    AUTO_NUMERIC,
    MINED_CATEGORICAL,
    MINED_NUMERIC,
    MINED_PAIRS,
    PRIORITY_RULES,
    SEGMENTS,
    SPENDING_COLUMNS,
    TARGET,
)
from riskloom.functions.scalars import is_text
from riskloom.operators import cleaning, combinations, features, profile, rates, rules, segments, splitting, stability
from riskloom.sources.tables import written_once


@dataclass
class PatternMining:
    """Features and reports of ``mine_patterns``."""

    table: DataFrame
    categorical: DataFrame
    numeric: DataFrame
    strong_categorical: DataFrame
    strong_numeric: DataFrame


def mine_patterns(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    target: str = TARGET,
    bins: int = 10,
    min_count: int | None = None,
) -> PatternMining:
    """Self-fitted insight features, then value and bin reports and their strong patterns.

    Derived groups and interactions are mined too, whether or not they were asked for.
    """
    table = features.insight_features(df)
    wanted_c = list(dict.fromkeys([*categorical, *[c for c in AUTO_CATEGORICAL if c in table.columns]]))
    wanted_n = list(dict.fromkeys([*numeric, *[c for c in AUTO_NUMERIC if c in table.columns]]))
    by_value = rates.categorical_report(table, wanted_c, target, min_count)
    by_bin = rates.many_bin_rates(table, wanted_n, target, bins, min_count=min_count)
    # Both reports hold only patterns of at least the resolved count, so only the lift is left to check.
    return PatternMining(table, by_value, by_bin, rates.strong_patterns(by_value, 1.5), rates.strong_patterns(by_bin, 2.0))


@dataclass
class StableInsights:
    split_summary: DataFrame
    thresholds: features.Thresholds
    compared: dict[str, DataFrame]
    stable: dict[str, DataFrame]
    actionable: DataFrame
    recommended: DataFrame


def stable_insights(clean: DataFrame, tie: str, target: str = TARGET, bins: int = 10) -> StableInsights:
    """Split by time, fit on train, mine train and validation alike, keep what holds on both.

    Segments compare with each part's own quantiles.
    """
    table, summary = splitting.split_table(features.amount_features(clean), tie, "time", target)
    thresholds = features.fit_thresholds(table.where(F.col("split") == "train"))
    # All reports read these rows, so they are derived once. Texts that no report reads are left out.
    full = features.interaction_features(features.behavior_features(table.where(F.col("split").isin("train", "validation")), thresholds))
    read = {target, "split", *MINED_CATEGORICAL, *[c for pair in MINED_PAIRS for c in pair], *[source for _, terms in SEGMENTS.values() for _, source, _ in terms]}
    read |= {*MINED_NUMERIC, *SPENDING_COLUMNS, *[f for rule in PRIORITY_RULES.values() for f in rule]}
    full = written_once(full.select(*[c for c in full.columns if c in read or not is_text(full, c)]))
    parts = {name: full.where(F.col("split") == split) for name, split in (("train", "train"), ("valid", "validation"))}
    train_sum, valid_sum = (rates.global_summary(p, target, default=d).first() for p, d in ((parts["train"], 100), (parts["valid"], 50)))
    least = {"train": train_sum["min_count"], "valid": valid_sum["min_count"]}
    edges = stability.train_edges(parts["train"], [c for c in MINED_NUMERIC if c in parts["train"].columns], bins)
    flags = combinations.flag_columns(parts["train"])

    def reports(name: str) -> dict[str, DataFrame]:
        part, n = parts[name], least[name]
        return {
            "numeric": stability.report_with_edges(part, edges, target, min_count=n),
            "categorical": rates.categorical_report(part, MINED_CATEGORICAL, target, n),
            "segments": segments.segment_report(part, target),
            "boolean": combinations.flag_combinations(part, flags, target, n),
            "priority": segments.priority_rules(part, target, 30),
            "pairs": combinations.categorical_pairs(part, target=target, min_support=n),
        }

    both = {name: reports(name) for name in parts}
    keys = {
        "numeric": ["feature", "bin"], "categorical": ["feature", "value"], "segments": ["segment_name"],
        "boolean": ["rule"], "priority": ["rule"], "pairs": ["rule"],
    }
    compared = {kind: stability.compare_reports(both["train"][kind], both["valid"][kind], k) for kind, k in keys.items()}
    lifts = {"categorical": (1.3, 1.2), "segments": (1.3, 1.2), "pairs": (1.3, 1.2)}
    supports = {"priority": (50, 30)}
    stable = {
        kind: stability.stable_patterns(c, *lifts.get(kind, (1.5, 1.3)), *supports.get(kind, (least["train"], least["valid"])))
        for kind, c in compared.items()
    }
    train_rules = rules.rule_union(*[both["train"][k] for k in ("boolean", "priority", "pairs")])
    actionable = rules.actionable_rules(train_rules, 2.0, least["train"], 2 * train_sum["global_fraud_rate"])
    return StableInsights(summary, thresholds, compared, stable, actionable, rules.recommended_interactions(both["train"]["priority"]))


def clean_and_profile(raw: DataFrame, target: str = TARGET) -> dict[str, DataFrame]:
    """The cleaned table and its profile reports."""
    cleaned = cleaning.clean_raw(raw)
    return {
        "cleaned": cleaned,
        "cleaning_summary": cleaning.cleaning_summary(raw, cleaned),
        "dataset_overview": profile.dataset_overview(cleaned, target),
        "target_distribution": profile.target_distribution(cleaned, target),
        "missing_report": profile.missing_report(cleaned),
        "column_overview": profile.column_overview(cleaned),
        "numeric_summary": profile.numeric_summary(cleaned),
        "categorical_summary": profile.categorical_summary(cleaned),
        "high_cardinality_report": profile.high_cardinality_report(cleaned, target=target),
    }


def feature_table(split: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, features.FeatureSet]:
    """All features, the model-ready columns and the feature set; thresholds come from the train part."""
    thresholds = features.fit_thresholds(split.where(F.col("split") == "train"))
    full = features.build_features(split, thresholds)
    chosen = features.resolve_feature_set(full, thresholds)
    return full, features.select_model_columns(full, chosen, (*keep, "split")), chosen
