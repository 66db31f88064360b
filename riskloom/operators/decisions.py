"""From a probability to a decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import APPROVE_BELOW, DECISIONS
from riskloom.operators.evaluation import SCORE


def decide(df: DataFrame, threshold: float) -> DataFrame:
    """Prediction, risk level, decision and its reason for every scored row."""
    p = F.col(SCORE)

    def chain(low, medium, high):
        return F.when(p < APPROVE_BELOW, low).when(p < threshold, medium).otherwise(high)

    level, decision = zip(*(DECISIONS[k] for k in ("low", "medium", "high")))
    reasons = (
        f"probability below {APPROVE_BELOW:.2f}",
        f"probability between {APPROVE_BELOW:.2f} and the threshold {threshold:.2f}",
        f"probability at or above the threshold {threshold:.2f}",
    )
    return df.withColumns(
        {
            "prediction": (p >= threshold).cast("int"),
            "threshold": F.lit(float(threshold)),
            "risk_level": chain(*level),
            "decision": chain(*decision),
            "reason": chain(*reasons),
        }
    )
