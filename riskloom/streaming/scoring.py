"""Scoring and deciding on a stream: the batch projection on a streaming DataFrame.

There is no state and no watermark: every row is scored on its own, so lost executors only replay input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from riskloom.operators.decisions import decide
from riskloom.operators.models import FittedModel, score


def decision_stream(rows: DataFrame, model: FittedModel, threshold: float, row_id: str) -> DataFrame:
    """Feature rows (batch or ``readStream``) to decisions."""
    return decide(score(model, rows, (row_id,)), threshold)


def decision_writer(decisions: DataFrame, checkpoint: str, path: str) -> DataStreamWriter:
    """Append-only Parquet sink; ``checkpoint`` belongs in storage every executor can reach."""
    return decisions.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
