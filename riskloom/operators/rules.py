"""Reading rule reports: strength, meaning, selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import STRENGTH_MIN_SUPPORT, STRENGTHS

# What a rule says, tried in order: (substrings that must all occur, text). The last line of a group of
# alternatives repeats the text.
MEANINGS = [
    (["low_mcc_entropy", "low_night_ratio"], "Narrow merchant history and hardly any nights: together the clearest behaviour change."),
    (["low_mcc_entropy", "high_max_amount"], "Narrow merchant history with very large amounts."),
    (["low_mcc_entropy", "low_spending_trend"], "Narrow merchant history and falling spending; a transaction off that path is risky."),
    (["card_not_present"], "No physical card: look for a second unusual sign."),
    (["cross_border", "low_country_diversity"], "Across a border from a history in few countries."),
    (["cross_border"], "Across a border; depends on how many countries are usual."),
    (["high_ip_score"], "Risky network address; combine with behaviour."),
    (["device_diversity"], "Many devices lately: shared or taken-over account."),
    (["high_decline"], "Many recent declines."),
    (["amount_to_mean"], "Large amount against the history."),
    (["high_amount"], "Large amount against the history."),
    (["payment_channel", "merchant_country"], "Channel and merchant country with a rate above the average."),
]
NO_MEANING = "A statistical signal; check support, lift and rate before using it."
RECOMMENDATION = "Make it a binary interaction feature for a linear model."


def strength(rate: Column, lift: Column, support: Column) -> Column:
    rate, lift, support = (F.coalesce(c, F.lit(0)) for c in (rate, lift, support))
    chain = F.when(support < STRENGTH_MIN_SUPPORT, "WEAK_SUPPORT")
    for name, least_lift, least_rate in STRENGTHS:
        fits = lift >= least_lift
        chain = chain.when(fits if least_rate is None else fits & (rate >= least_rate), name)
    return chain.otherwise("LOW_SIGNAL")


def meaning(rule: Column) -> Column:
    text = F.lower(rule)
    chain = F
    for parts, words in MEANINGS:
        chain = chain.when(reduce(lambda a, b: a & b, [text.contains(p) for p in parts]), words)
    return chain.otherwise(NO_MEANING)


def interpret(report: DataFrame, rule: str = "rule") -> DataFrame:
    """Add ``strength`` and ``business_interpretation``; a report without the rule column stays as it is."""
    if rule not in report.columns:
        return report
    return report.withColumns(
        {"strength": strength(F.col("fraud_rate"), F.col("lift"), F.col("support")), "business_interpretation": meaning(F.col(rule))}
    )


def rule_union(*reports: DataFrame) -> DataFrame:
    """Rule reports of different kinds under one set of columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def actionable_rules(report: DataFrame, min_lift: float = 2.0, min_support: int = 50, min_rate: float = 0.05) -> DataFrame:
    keep = (F.col("support") >= min_support) & (F.col("lift") >= min_lift) & (F.col("fraud_rate") >= min_rate)
    return interpret(report.where(keep))


def recommended_interactions(report: DataFrame, min_lift: float = 2.0, min_support: int = 50) -> DataFrame:
    keep = (F.col("lift") >= min_lift) & (F.col("support") >= min_support)
    return report.where(keep).withColumn("feature_recommendation", F.lit(RECOMMENDATION))
