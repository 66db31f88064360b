"""Do patterns found on the training part hold on later data?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import TARGET
from riskloom.operators.rates import numeric_edges, numeric_report, open_ended

METRICS = ["count", "support", "fraud_count", "fraud_rate", "global_fraud_rate", "fraud_rate_diff", "lift"]


def train_edges(train: DataFrame, features: Sequence[str], bins: int = 10, method: str = "exact") -> dict[str, list[float]]:
    """Quantile edges of the training part with open ends."""
    return open_ended(numeric_edges(train, features, bins, "quantile", method))


def report_with_edges(df: DataFrame, edges: Mapping[str, Sequence[float]], target: str = TARGET, **least) -> DataFrame:
    return numeric_report(df, edges, target, **least)


def compare_reports(train: DataFrame, valid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Patterns present in both reports side by side; null keys match each other."""
    shared = [m for m in METRICS if m in train.columns and m in valid.columns]
    left = train.select(*keys, *[F.col(m).alias(f"{m}_train") for m in METRICS if m in train.columns])
    right = valid.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(m).alias(f"{m}_valid") for m in METRICS if m in valid.columns])
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = same if on is None else on & same
    out = left.join(right, on, "inner").drop(*[f"_{k}" for k in keys])
    if "lift" in shared:
        out = out.withColumns(
            {
                "lift_diff_valid_train": F.col("lift_valid") - F.col("lift_train"),
                "lift_ratio_valid_train": F.col("lift_valid") / (F.col("lift_train") + F.lit(1e-9)),
            }
        )
    if "fraud_rate" in shared:
        out = out.withColumn("fraud_rate_diff_valid_train", F.col("fraud_rate_valid") - F.col("fraud_rate_train"))
    return out


def stable_patterns(
    compared: DataFrame,
    min_lift_train: float = 1.5,
    min_lift_valid: float = 1.5,
    min_support_train: int = 50,
    min_support_valid: int = 30,
    max_ratio_gap: float = 0.75,
) -> DataFrame:
    """Compared patterns with enough lift and support on both sides and a lift ratio within ``1 +- gap``."""
    size = {s: f"support_{s}" if f"support_{s}" in compared.columns else f"count_{s}" for s in ("train", "valid")}
    ratio = F.col("lift_ratio_valid_train")
    return compared.where(
        (F.col("lift_train") >= min_lift_train)
        & (F.col("lift_valid") >= min_lift_valid)
        & (F.col(size["train"]) >= min_support_train)
        & (F.col(size["valid"]) >= min_support_valid)
        & ratio.between(max(0.0, 1 - max_ratio_gap), 1 + max_ratio_gap)
    )
