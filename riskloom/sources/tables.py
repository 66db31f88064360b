"""Table scans, sinks and schema guards."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a raw transaction table, in file order.
RAW_SCHEMA = (
    "amount double, currency string, local_timestamp string, mcc bigint, card_present boolean, "
    "payment_channel string, merchant_country string, card_entry_mode string, auth_result string, "
    "pin_verif_method string, recurring_flag string, tokenised boolean, cross_border boolean, "
    "auth_characteristics string, message_type string, term_location string, ip_risk string, "
    "txn_counts string, device_id string, merchant_id string, card_activation_age bigint, "
    "mean_amount_30d double, std_amount_30d double, max_amount_30d double, distinct_merchants_7d bigint, "
    "distinct_countries_30d bigint, online_share_7d double, night_ratio_30d double, "
    "decline_rate_30d double, mcc_entropy_30d double, days_since_last_txn bigint, "
    "chargebacks_365d bigint, device_diversity_30d bigint, credit_util_today double, "
    "spending_trend double, fraud int"
)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder the cluster names, or a temporary one where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared or tempfile.mkdtemp(prefix='run-')}/{uuid.uuid4().hex}"


def written_once(df: DataFrame) -> DataFrame:
    """``df`` written to scratch and read back: steps that scan it several times don't derive it each time."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_transactions(spark: SparkSession, path: str, schema: T.StructType | str | None = RAW_SCHEMA) -> DataFrame:
    """CSV scan with a declared schema; ``schema=None`` pays one more pass to infer it."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("inferSchema", True).csv(path) if schema is None else reader.schema(schema).csv(path)


def _format_of(path: str) -> str:
    for suffix in ("parquet", "csv"):
        if path.rstrip("/").endswith("." + suffix):
            return suffix
    raise ValueError(f"path must end in .parquet or .csv: {path}")


def save_cleaned(df: DataFrame, path: str) -> None:
    kind = _format_of(path)
    writer = df.write.mode("overwrite")
    writer.parquet(path) if kind == "parquet" else writer.option("header", True).csv(path)


def load_cleaned(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    if _format_of(path) == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    return reader.option("inferSchema", True).csv(path) if schema is None else reader.schema(schema).csv(path)


def save_splits(df: DataFrame, path: str) -> None:
    """One dataset, one directory per split, so a reader of one split prunes the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def save_features(features: DataFrame, model_ready: DataFrame, path: str) -> None:
    features.write.mode("overwrite").partitionBy("split").parquet(f"{path}/features")
    model_ready.write.mode("overwrite").partitionBy("split").parquet(f"{path}/model_features")


def load_features(spark: SparkSession, path: str, model_ready: bool = True) -> DataFrame:
    return spark.read.parquet(f"{path}/{'model_features' if model_ready else 'features'}")


def save_report(df: DataFrame, path: str, preview_rows: int | None = None, order_by: Sequence = ()) -> None:
    """CSV report; the order is applied here, at the sink, and a preview needs one to be repeatable."""
    out = df.orderBy(*order_by) if order_by else df
    if preview_rows is not None:
        out = out.limit(preview_rows)
    out.write.mode("overwrite").option("header", True).csv(path)


def save_record(spark: SparkSession, record: dict[str, Any], schema: T.StructType | str, path: str) -> None:
    """Metadata as one JSON line."""
    spark.createDataFrame([record], schema).coalesce(1).write.mode("overwrite").json(path)


def load_record(spark: SparkSession, path: str, schema: T.StructType | str) -> dict[str, Any]:
    rows = spark.read.schema(schema).json(path).take(1)
    if not rows:
        raise FileNotFoundError(f"no record in {path}")
    return rows[0].asDict(recursive=True)


def preview(df: DataFrame, n: int = 5, order_by: Sequence = ()) -> DataFrame:
    """First ``n`` rows of an explicit order (Spark plans a top-n, not a full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
