"""Nested text columns: Python-literal dicts and tuples, IP addresses and risk scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import IP_SCORE_BIN
from riskloom.functions.bins import pick
from riskloom.functions.scalars import damped_ratio, flag, null_if_nan, number

# Fixed value: address ranges reserved for private networks (10/8, 192.168/16, 172.16/12).
PRIVATE_IP = r"^(10\.|192\.168\.|172\.0*(1[6-9]|2[0-9]|3[01])\.)"


def _as_json(text: Column) -> Column:
    """Bare None/True/False and a trailing comma are the literals JSON does not share with Python.

    Both are rare, so the replacements run only on texts that hold one.
    """
    words = text
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        words = F.regexp_replace(words, rf"(?<=[\[{{(:,\s]){word}(?=\s*[,}}\])])", json)
    held = text.contains("None") | text.contains("True") | text.contains("False")
    out = F.when(held, words).otherwise(text)
    return F.when(out.rlike(r",\s*[\])}]"), F.regexp_replace(out, r",\s*([\])}])", "$1")).otherwise(out)


def _enclosed(text: Column, start: str, end: str) -> Column:
    return text.startswith(start) & text.endswith(end)


def literal_dict(text: Column) -> Column:
    """Dict text as map<string,string>; NULL for anything else."""
    t = F.btrim(text)
    return F.when(_enclosed(t, "{", "}"), F.from_json(_as_json(t), "map<string,string>"))


def literal_items(text: Column) -> Column:
    """List or tuple text as array<string>; NULL for anything else."""
    t = F.btrim(text)
    as_list = F.concat(F.lit("["), F.substring(t, F.lit(2), F.length(t) - 2), F.lit("]"))
    listed = _enclosed(t, "[", "]") | _enclosed(t, "(", ")")
    return F.when(listed, F.from_json(_as_json(as_list), "array<string>"))


def _score(text: Column) -> Column:
    return null_if_nan(text.try_cast("double"))


def parse_ip_risk(df: DataFrame, column: str = "ip_risk") -> DataFrame:
    if column not in df.columns:
        return df
    t = F.btrim(F.col(column))
    parsed = F.when(_enclosed(t, "{", "}"), F.from_json(_as_json(t), "ip string, score string"))
    return (
        df.withColumn("_risk", parsed)
        .withColumns({"ip_address": F.col("_risk.ip"), "ip_score": _score(F.col("_risk.score"))})
        .drop("_risk")
    )


def parse_txn_counts(df: DataFrame, column: str = "txn_counts") -> DataFrame:
    if column not in df.columns:
        return df
    items = literal_items(F.col(column))
    full = F.size("_items") >= 2
    return (
        df.withColumn("_items", items)
        .withColumns(
            {
                "txn_count_7d": F.when(full, _score(F.get("_items", 0))),
                "txn_count_30d": F.when(full, _score(F.get("_items", 1))),
            }
        )
        .withColumn("txn_count_ratio_7d_30d", damped_ratio(F.col("txn_count_7d"), F.col("txn_count_30d")))
        .drop("_items")
    )


def is_private_ip(address: Column) -> Column:
    return flag(address.rlike(PRIVATE_IP))


def ip_features(df: DataFrame) -> DataFrame:
    new = {}
    if "ip_address" in df.columns:
        new["ip_is_private"] = is_private_ip(F.col("ip_address"))
    if "ip_score" in df.columns:
        name, uppers, labels = IP_SCORE_BIN
        new[name] = pick(number(df, "ip_score"), uppers, labels)
    return df.withColumns(new) if new else df


def parse_nested(df: DataFrame) -> DataFrame:
    return df.transform(parse_ip_risk).transform(parse_txn_counts).transform(ip_features)
