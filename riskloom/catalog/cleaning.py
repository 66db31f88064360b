"""Cleaning and parsing queries over customer, orders and transactions derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.common import CHAIN, big, chain, groups, plain, r6, raw_transactions, real
from riskloom.operators import cleaning, parsing, timing
from riskloom.sources import ledger
from riskloom.sources.tables import load_table

QUERIES, SQL = {}, {}

# C1
MESSY = {"c_custkey": " C CustKey ", "c_name": "C-Name", "c_nationkey": "C NationKey", "c_acctbal": "c_acctbal", "c_mktsegment": "C Mkt-Segment"}
QUERIES["clean_names"] = lambda s, d: plain(cleaning.normalize_names(load_table(s, d, "customer").toDF(*MESSY.values())))
SQL["clean_names"] = f"SELECT c_custkey AS c_custkey, c_name AS c_name, {big('c_nationkey', 'c_nationkey')}, {r6('c_acctbal', 'c_acctbal')}, c_mktsegment AS c_mkt_segment FROM customer"


# C2
def _messy_text(s, d):
    c, key = load_table(s, d, "customer"), F.col("c_custkey")
    return c.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" \t")).alias("name"),
        F.when(key % 5 == 0, "  ").when(key % 5 == 1, " nan").when(key % 5 == 2, "None ").when(key % 5 == 3, F.col("c_mktsegment")).alias("segment"),
    )


QUERIES["clean_text"] = lambda s, d: plain(cleaning.clean_text(_messy_text(s, d)))
SQL["clean_text"] = "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 5 = 3 THEN c_mktsegment END AS segment FROM customer"


# C3
def _boolean_text(s, d):
    o, key = load_table(s, d, "orders"), F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(key % 5 == 0, " Yes").when(key % 5 == 1, "NO").when(key % 5 == 2, "1").when(key % 5 == 3, "false ").alias("answer"),
        F.when(key % 2 == 0, "y").otherwise("maybe").alias("open_answer"),
        "o_orderstatus",
    )


QUERIES["clean_booleans"] = lambda s, d: plain(cleaning.convert_booleans(_boolean_text(s, d)), "answer")
SQL["clean_booleans"] = f"""
SELECT o_orderkey, {real('CASE WHEN o_orderkey % 5 IN (0, 2) THEN 1 WHEN o_orderkey % 5 IN (1, 3) THEN 0 END', 'answer')},
  CASE WHEN o_orderkey % 2 = 0 THEN 'y' ELSE 'maybe' END AS open_answer, o_orderstatus FROM orders"""


# C4
def _number_text(s, d):
    e, key = load_table(s, d, "events"), F.col("event_id")
    return e.select(
        "event_id",
        F.when(key % 4 == 0, "abc").when(key % 4 == 1, F.concat(F.lit(" "), F.col("value"), F.lit(" "))).when(key % 4 == 2, F.col("value").cast("string")).alias("amount"),
        F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("mean_amount_30d"),
        F.lit("7").alias("other"),
    )


QUERIES["clean_numbers"] = lambda s, d: plain(cleaning.convert_numbers(_number_text(s, d)))
SQL["clean_numbers"] = f"""
SELECT event_id, {r6('CASE WHEN event_id % 4 IN (1, 2) THEN value END', 'amount')},
  {r6('CASE WHEN event_id % 3 <> 0 THEN value END', 'mean_amount_30d')}, '7' AS other FROM events"""


# C5
def _invalid(s, d):
    e, x = load_table(s, d, "events"), F.col("value")
    return e.select(
        "event_id",
        F.when(x > 5, x - 10).alias("amount"),
        F.when(F.col("event_id") % 3 == 0, 0.0).when(F.col("event_id") % 3 == 1, x).alias("std_amount_30d"),
        x.alias("mean_amount_30d"),
    )


_FLAGS = ["event_id", "amount_invalid_flag", "std_amount_30d_zero_flag", "mean_amount_30d_zero_flag"]
QUERIES["clean_invalid_flags"] = lambda s, d: plain(cleaning.invalid_flags(_invalid(s, d)).select(*_FLAGS))
SQL["clean_invalid_flags"] = f"""
SELECT event_id, {big('CASE WHEN value > 5 AND value - 10 > 0 THEN 0 ELSE 1 END', 'amount_invalid_flag')},
  {big('CASE WHEN event_id % 3 = 1 AND value <> 0 THEN 0 ELSE 1 END', 'std_amount_30d_zero_flag')},
  {big('CASE WHEN value = 0 THEN 1 ELSE 0 END', 'mean_amount_30d_zero_flag')} FROM events"""


# C6
def _copies(s, d):
    li = load_table(s, d, "lineitem")
    return li.select("l_returnflag", "l_linestatus", "l_linenumber", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"))


_COPIES = "SELECT l_returnflag, l_linestatus, l_linenumber, CASE WHEN l_tax > 0 THEN l_tax END AS tax FROM lineitem"
QUERIES["clean_flag_duplicates"] = lambda s, d: plain(cleaning.flag_duplicates(_copies(s, d)))
SQL["clean_flag_duplicates"] = f"""
WITH t AS ({_COPIES}),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber, tax) AS rn FROM t)
SELECT l_returnflag, l_linestatus, {big('l_linenumber', 'l_linenumber')}, {r6('tax', 'tax')}, {big('rn > 1', 'duplicate_row_flag')} FROM r"""
QUERIES["clean_drop_duplicates"] = lambda s, d: plain(cleaning.flag_duplicates(_copies(s, d), drop=True))
SQL["clean_drop_duplicates"] = f"""
WITH t AS (SELECT DISTINCT * FROM ({_COPIES}))
SELECT l_returnflag, l_linestatus, {big('l_linenumber', 'l_linenumber')}, {r6('tax', 'tax')}, CAST(0 AS BIGINT) AS duplicate_row_flag FROM t"""


# X1
def _literals(s, d):
    t = raw_transactions(s, d)
    key = F.col("event_id")
    mixed = F.when(key % 5 == 0, "not a literal").when(key % 5 == 1, "(7,)").when(key % 5 == 2, "").otherwise(F.col("txn_counts"))
    items, pairs = parsing.literal_items(mixed), parsing.literal_dict(F.col("ip_risk"))
    return t.select(
        "event_id",
        F.when(items.isNotNull(), F.size(items)).alias("items"),
        F.get(items, 0).alias("first_item"),
        F.element_at(pairs, "ip").alias("ip"),
        parsing.literal_dict(F.col("txn_counts")).isNull().alias("no_dict"),
    )


QUERIES["parse_literals"] = lambda s, d: plain(_literals(s, d), "items")
SQL["parse_literals"] = chain(
    f"""
SELECT event_id, {real('CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 1 WHEN 2 THEN NULL ELSE 2 END', 'items')},
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '7' WHEN 2 THEN NULL ELSE regexp_extract(txn_counts, '(\\d+)', 1) END AS first_item,
  ip_address AS ip, true AS no_dict FROM p0"""
)


# X2
def _risks(s, d):
    key = F.col("event_id")
    text = F.when(key % 7 == 0, "{'ip': '10.0.0.1'}").when(key % 7 == 1, "[1, 2]").when(key % 7 == 2, "{'ip': None, 'score': '0.25'}").otherwise(F.col("ip_risk"))
    return raw_transactions(s, d).select("event_id", text.alias("ip_risk"))


QUERIES["parse_ip_risk"] = lambda s, d: plain(parsing.parse_ip_risk(_risks(s, d)).drop("ip_risk"))
SQL["parse_ip_risk"] = chain(
    f"""
SELECT event_id, CASE event_id % 7 WHEN 0 THEN '10.0.0.1' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE ip_address END AS ip_address,
  {r6('CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 0.25 ELSE ip_score END', 'ip_score')} FROM p0"""
)


# X3
def _counts(s, d):
    key = F.col("event_id")
    text = F.when(key % 6 == 0, "(5,)").when(key % 6 == 1, "oops").when(key % 6 == 2, "[4, 1]").when(key % 6 == 3, "(3, 'x')").otherwise(F.col("txn_counts"))
    return raw_transactions(s, d).select("event_id", text.alias("txn_counts"))


QUERIES["parse_txn_counts"] = lambda s, d: plain(parsing.parse_txn_counts(_counts(s, d)).drop("txn_counts"))
SQL["parse_txn_counts"] = chain(
    f"""
SELECT event_id, {r6('a', 'txn_count_7d')}, {r6('b', 'txn_count_30d')}, {r6('a / nullif(b + 1, 0)', 'txn_count_ratio_7d_30d')} FROM (
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 4 WHEN 3 THEN 3 ELSE txn_count_7d END AS a,
    CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 1 WHEN 3 THEN NULL ELSE txn_count_30d END AS b FROM p0)"""
)


# X4, X5
def _addresses(s, d):
    return parsing.ip_features(parsing.parse_ip_risk(_risks(s, d))).select("event_id", "ip_is_private", "ip_score_bin")


QUERIES["parse_ip_features"] = lambda s, d: plain(_addresses(s, d))
_SCORE = "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 0.25 ELSE ip_score END"
_BINS = groups("score", [0.2, 0.5, 0.8], ["low", "medium", "high", "very_high"])
SQL["parse_ip_features"] = chain(
    f"""
SELECT event_id, {big("coalesce(regexp_matches(ip, '^(10\\.|192\\.168\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.)'), false)", 'ip_is_private')}, {_BINS} AS ip_score_bin FROM (
  SELECT event_id, CASE event_id % 7 WHEN 0 THEN '10.0.0.1' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE ip_address END AS ip, {_SCORE} AS score FROM p0)"""
)

# X6
_PARSED = ["ip_address", "ip_score", "txn_count_7d", "txn_count_30d", "txn_count_ratio_7d_30d", "ip_is_private", "ip_score_bin"]
_REALS = {"ip_score", "txn_count_7d", "txn_count_30d", "txn_count_ratio_7d_30d"}
QUERIES["parse_nested"] = lambda s, d: plain(parsing.parse_nested(raw_transactions(s, d)).select("event_id", *_PARSED))
SQL["parse_nested"] = chain(
    "SELECT event_id, " + ", ".join(r6(c, c) if c in _REALS else big(c, c) if c == "ip_is_private" else c for c in _PARSED) + " FROM p1"
)

# C7: the whole chain on the raw transaction table, every column compared
RAW_TEXT = [
    "currency", "local_timestamp", "payment_channel", "merchant_country", "card_entry_mode", "auth_result", "pin_verif_method",
    "auth_characteristics", "message_type", "term_location", "ip_risk", "txn_counts", "device_id", "merchant_id",
    "ip_address", "ip_score_bin", "day_name", "time_period",
]
RAW_INTS = [
    "event_id", "mcc", "card_activation_age", "distinct_merchants_7d", "distinct_countries_30d",
    "chargebacks_365d", "device_diversity_30d", "fraud", "ip_is_private", "hour", "day_of_week", "month", "day", "year",
    "is_weekend", "is_night_txn",
]
RAW_REALS = [
    "amount", "mean_amount_30d", "std_amount_30d", "max_amount_30d", "online_share_7d", "night_ratio_30d", "decline_rate_30d",
    "mcc_entropy_30d", "credit_util_today", "spending_trend", "ip_score", "txn_count_7d", "txn_count_30d", "txn_count_ratio_7d_30d",
]
CHAIN["clean"] = f"""
SELECT {', '.join(RAW_TEXT)}, card_present, tokenised, cross_border, transaction_datetime,
  {', '.join(big(c, c) for c in RAW_INTS)}, {', '.join(r6(c, c) for c in RAW_REALS)},
  {big("recurring_flag = 'yes'", 'recurring_flag')}, {real('days_since_last_txn', 'days_since_last_txn')},
  {r6('is_night_txn * (1 - night_ratio_30d)', 'night_unusual_score')},
  {big('coalesce(is_night_txn = 1 AND night_ratio_30d <= (SELECT quantile_cont(night_ratio_30d, 0.1) FROM prep), false)', 'is_night_unusual')},
  {big('amount IS NULL OR amount <= 0', 'amount_invalid_flag')},
  {big('coalesce(std_amount_30d, 0) = 0', 'std_amount_30d_zero_flag')},
  {big('coalesce(mean_amount_30d, 0) = 0', 'mean_amount_30d_zero_flag')}, CAST(0 AS BIGINT) AS duplicate_row_flag FROM prep"""
QUERIES["clean_raw_table"] = lambda s, d: plain(cleaning.clean_raw(raw_transactions(s, d, passes=True)), "days_since_last_txn")
SQL["clean_raw_table"] = chain("SELECT * FROM clean")


# P15
def _summary(s, d):
    raw = raw_transactions(s, d, passes=True).drop("event_id", "device_id", "merchant_id")
    return cleaning.cleaning_summary(raw, cleaning.clean_raw(raw))


_RAW_MISSING = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in RAW_REALS[:10] + ["days_since_last_txn"] if c not in ("amount", "credit_util_today"))
QUERIES["clean_summary"] = lambda s, d: plain(_summary(s, d))
SQL["clean_summary"] = chain(
    f"""
SELECT count(*) AS raw_rows, CAST(34 AS BIGINT) AS raw_columns, count(*) AS cleaned_rows, CAST(57 AS BIGINT) AS cleaned_columns,
  CAST(23 AS BIGINT) AS new_columns_added, {big(_RAW_MISSING, 'raw_missing_values')},
  {big(_RAW_MISSING + ' + count(*) FILTER (night_ratio_30d IS NULL)', 'cleaned_missing_values')},
  CAST(0 AS BIGINT) AS duplicate_rows, {big('count(*) FILTER (amount IS NULL OR amount <= 0)', 'invalid_amount_rows')} FROM prep"""
)

# T1-T3, D5
_TIME = ["transaction_datetime", "hour", "day_of_week", "day_name", "is_weekend", "is_night_txn", "month", "day", "year", "time_period"]
_TEXT = {"transaction_datetime", "day_name", "time_period"}


def _times(s, d):
    events = ledger.event_rows(load_table(s, d, "events"))
    text = F.when(F.col("event_id") % 11 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return timing.time_features(events.select("event_id", text.alias("local_timestamp"))).select("event_id", *_TIME)


QUERIES["time_features"] = lambda s, d: plain(_times(s, d), "hour", "day_of_week", "month", "day", "year")
_known = "event_id % 11 <> 0"
SQL["time_features"] = chain(
    f"SELECT event_id, "
    + ", ".join(
        big(f"CASE WHEN {_known} THEN {c} ELSE 0 END", c) if c.startswith("is_")
        else (f"CASE WHEN {_known} THEN {c} END AS {c}" if c in _TEXT else real(f"CASE WHEN {_known} THEN {c} END", c))
        for c in _TIME
    )
    + " FROM prep"
)


# T4
def _nights(s, d):
    t = timing.time_features(raw_transactions(s, d, passes=True).select("event_id", "local_timestamp", "night_ratio_30d"))
    return timing.night_flags(t).select("event_id", "night_unusual_score", "is_night_unusual")


QUERIES["time_night_flags"] = lambda s, d: plain(_nights(s, d))
SQL["time_night_flags"] = chain("SELECT event_id, night_unusual_score, is_night_unusual FROM clean")
