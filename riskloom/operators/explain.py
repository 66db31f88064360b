"""Model explanation tables from coefficients and importances (one row per encoded feature)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import (
    COEFFICIENT_GROUPS,
    COEFFICIENT_OTHER,
    IMPORTANCE_GROUPS,
    IMPORTANCE_OTHER,
    READABLE_COLUMNS,
)

# What each coefficient group says, and which sign is expected.
GROUP_NOTES = {
    "MCC behavior anomaly": ("diversity of the merchant history", "a wide history lowers risk, low-diversity flags raise it"),
    "Time behavior anomaly": ("time of day against the usual nights", "habitual nights lower risk, unusual nights raise it"),
    "Amount anomaly": ("amount against the history", "amounts far above the history raise risk"),
    "Spending trend anomaly": ("spending going down", "a high trend lowers risk, the low-trend flag raises it"),
    "Country / cross-border behavior": ("countries against the history", "many usual countries lower risk, crossing from few raises it"),
    "Risk history / technical risk": ("earlier declines, chargebacks, devices and network risk", "weak alone, useful with behaviour"),
    "Payment / authentication context": ("channel, entry mode and authentication", "depends on the context"),
    "Transaction velocity": ("recent transaction counts", "unusual velocity may raise risk"),
    "Other context": ("other context", "no fixed expectation"),
}


def coefficients_without(df: DataFrame, prefix: str = "categorical__mcc_") -> DataFrame:
    return df.where(~F.col("feature").startswith(prefix))


def readable_feature(feature: Column) -> Column:
    """Drop the ``group__`` prefix and show an encoded category as ``column=value``."""
    raw = F.regexp_replace(feature, r"^.*?__", "")
    pattern = "^(" + "|".join(READABLE_COLUMNS) + ")_(.*)$"
    return F.regexp_replace(raw, pattern, "$1=$2")


def _group(feature: Column, groups: dict[str, list[str]], other: str) -> Column:
    text = F.lower(feature)
    chain = F
    for name, parts in groups.items():
        chain = chain.when(reduce(lambda a, b: a | b, [text.contains(p) for p in parts]), name)
    return chain.otherwise(other)


def coefficient_group(feature: Column) -> Column:
    return _group(feature, COEFFICIENT_GROUPS, COEFFICIENT_OTHER)


def importance_group(feature: Column) -> Column:
    return _group(feature, IMPORTANCE_GROUPS, IMPORTANCE_OTHER)


def explain_coefficients(df: DataFrame) -> DataFrame:
    c, group = F.col("coefficient"), F.col("insight_group")
    notes = [F.create_map(*[F.lit(x) for g, texts in GROUP_NOTES.items() for x in (g, texts[i])]) for i in (0, 1)]
    return (
        df.withColumn("readable_feature", readable_feature(F.col("feature")))
        .withColumn("coefficient_meaning", F.when(c > 0, "raises the log-odds").when(c < 0, "lowers the log-odds").otherwise("no clear linear effect"))
        .withColumn("insight_group", coefficient_group(F.col("feature")))
        .withColumns({"business_meaning": F.element_at(notes[0], group), "expected_direction": F.element_at(notes[1], group)})
    )


def group_summary(explained: DataFrame) -> DataFrame:
    a = F.col("abs_coefficient")
    return explained.groupBy("insight_group").agg(
        F.count("*").alias("feature_count"),
        F.sum(a).alias("total_abs_coefficient"),
        F.avg(a).alias("mean_abs_coefficient"),
        F.max(a).alias("max_abs_coefficient"),
    )


def importance_summary(importances: DataFrame) -> DataFrame:
    return importances.groupBy(importance_group(F.col("feature")).alias("insight_group")).agg(F.sum("importance").alias("importance"))


def final_experiment(comparison: DataFrame, preferred: str = "lr_no_mcc") -> DataFrame:
    """The preferred experiment if it is there, else the best by F2 and PR-AUC."""
    first = (F.col("experiment_name") == preferred).desc()
    return comparison.orderBy(first, F.desc("test_f2"), F.desc("test_pr_auc"), F.asc("experiment_name")).limit(1)


def top_coefficients(df: DataFrame, top: int = 20, raising: bool = True) -> DataFrame:
    c = F.col("coefficient")
    side = df.where(c > 0).orderBy(c.desc(), "feature") if raising else df.where(c < 0).orderBy(c.asc(), "feature")
    return side.limit(top)
