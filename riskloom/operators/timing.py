"""Features of the transaction time and of night habits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import NIGHT_UNUSUAL_GROUP, RAW_TIMESTAMP, TIME_PERIODS, TIMESTAMP
from riskloom.functions.bins import pick
from riskloom.functions.order_stats import quantiles
from riskloom.functions.scalars import flag, is_text, number


def parsed_time(df: DataFrame, column: str) -> Column:
    """Zone-less timestamp; text that does not parse is NULL."""
    return F.col(column).try_cast("timestamp_ntz") if is_text(df, column) else F.col(column).cast("timestamp_ntz")


def time_features(df: DataFrame, column: str = RAW_TIMESTAMP) -> DataFrame:
    if column not in df.columns:
        return df
    ts, hour, weekday = F.col(TIMESTAMP), F.col("hour"), F.col("day_of_week")
    period, uppers, labels = TIME_PERIODS
    return (
        df.withColumn(TIMESTAMP, parsed_time(df, column))
        .withColumns(
            {
                "hour": F.hour(ts),
                "day_of_week": F.weekday(ts),
                "day_name": F.date_format(ts, "EEEE"),
                "month": F.month(ts),
                "day": F.dayofmonth(ts),
                "year": F.year(ts),
            }
        )
        .withColumns(
            {
                "is_weekend": flag(weekday >= 5),
                "is_night_txn": flag((hour >= 22) | (hour < 6)),
                period: pick(hour, uppers, labels),
            }
        )
    )


def night_threshold(df: DataFrame, method: str = "exact") -> float | None:
    """10 % quantile of the night share. Fit it on the training part to keep later rows out of it."""
    return quantiles(df, {"x": number(df, "night_ratio_30d")}, [0.1], method)["x"][0]


def night_flags(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Night score and the unusual-night flag; without a threshold it is fitted on the frame itself."""
    if not {"is_night_txn", "night_ratio_30d"} <= set(df.columns):
        return df
    ratio, night = number(df, "night_ratio_30d"), F.col("is_night_txn")
    limit = night_threshold(df) if threshold is None else threshold
    return df.withColumns(
        {
            "night_unusual_score": night * (1 - ratio),
            "is_night_unusual": flag((night == 1) & (ratio <= F.lit(limit))),
        }
    )


def add_time_features(df: DataFrame, threshold: float | None = None) -> DataFrame:
    return night_flags(time_features(df), threshold)


def night_habit(df: DataFrame) -> DataFrame:
    """Feature-stage night score (nulls as 0) and its five groups."""
    if not {"is_night_txn", "night_ratio_30d"} <= set(df.columns):
        return df
    night = F.coalesce(number(df, "is_night_txn"), F.lit(0.0))
    ratio = F.coalesce(number(df, "night_ratio_30d"), F.lit(0.0))
    name, uppers, labels = NIGHT_UNUSUAL_GROUP
    scored = df.withColumn("night_unusual_score", night * (1 - ratio))
    return scored.withColumn(name, pick(F.col("night_unusual_score"), uppers, labels))
