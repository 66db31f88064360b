"""Shared inputs of the registered queries and of their checking SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.fixed_values import DROPPED_COLUMNS
from riskloom.operators import features, parsing, splitting, timing
from riskloom.sources import ledger
from riskloom.sources.tables import load_table, scratch, written_once  # noqa: F401 (scratch: for the other modules)


def plain(df: DataFrame, *sparse: str) -> DataFrame:
    """Doubles to 6 decimals and integers to bigint, the form in which results are compared.

    Integer columns that hold NULLs (``sparse``) become doubles, as data frames outside Spark show them.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in sparse:
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # NaN stays, and so does what is too large to have six decimals; floor() gives a bigint.
            c = F.when(F.isnan(c) | (F.abs(c) >= 1e12), c).otherwise(F.floor(c * 1e6 + 0.5) / 1e6)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the target ``fraud`` (returned or not)."""
    return load_table(spark, sf, "lineitem").withColumn("fraud", (F.col("l_returnflag") == "R").cast("int"))


def split_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with target and time split. The cut is made here, on the scan, so no history is computed for it."""
    events = load_table(spark, sf, "events").withColumn("fraud", (F.col("event_type") == "error").cast("int"))
    return splitting.time_split(events, "event_id", timestamp="ts")


def compiled_methods(spark: SparkSession) -> None:
    """Stages whose generated method the JVM wouldn't compile (8000 bytes) run as many small methods, where the session leaves Spark's limit.

    The projections of the transactions are that wide; the virtual machine interprets such a method for every row.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")


def raw_transactions(spark: SparkSession, sf: str, passes: bool = False, split: bool = False) -> DataFrame:
    """Raw transactions, with their split if asked. For a query of several ``passes`` the joined history, which all its columns are drawn from, is written once."""
    compiled_methods(spark)
    events, keep = (split_events(spark, sf), ["split"]) if split else (load_table(spark, sf, "events"), [])
    joined = ledger.with_history(events, keep)
    return ledger.transaction_columns(written_once(joined) if passes else joined, keep)


def prepared(spark: SparkSession, sf: str, split: bool = False, passes: bool = False) -> DataFrame:
    """Transactions with parsed columns and time features. Those with a split are there for fits, which take several passes."""
    return timing.time_features(parsing.parse_nested(raw_transactions(spark, sf, passes or split, split)))


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "train")


def featured(spark: SparkSession, sf: str) -> tuple[DataFrame, features.Thresholds]:
    """Split transactions with all features, thresholds fitted on the train rows."""
    table = prepared(spark, sf, split=True)
    thresholds = features.fit_thresholds(train_rows(features.amount_features(table)))
    return features.build_features(table, thresholds), thresholds


# Parsed columns that no model feature is drawn from.
UNREAD_COLUMNS = [
    "local_timestamp", "device_id", "merchant_id", "card_activation_age", "online_share_7d", "ip_is_private", "ip_score_bin", "day_of_week", "month", "day", "year", "is_weekend",
]


def fit_rows(spark: SparkSession, sf: str, train: bool = False) -> tuple[DataFrame, features.Thresholds]:
    """``featured`` for model fits, without the columns no model reads; of the ``train`` rows alone if the query uses no others.

    Thresholds and features both read the parsed columns, which are written as well as the joined history: rows are parsed once,
    and not in the stage of the join, which would be too large to compile.
    """
    table = prepared(spark, sf, split=True)
    table = written_once((train_rows(table) if train else table).drop(*DROPPED_COLUMNS, *UNREAD_COLUMNS))
    thresholds = features.fit_thresholds(train_rows(features.amount_features(table)))
    return features.build_features(table, thresholds), thresholds


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a deterministic probability ``value / (value + 50)``: a stand-in for model output."""
    x = F.col("value")
    return split_events(spark, sf).select(
        "event_id", "split", F.col("fraud").alias("y_true"), (x / (x + 50.0)).alias("fraud_probability")
    )


# ---------------------------------------------------------------- SQL


def r6(expression: str, name: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5) / 1e6 AS {name}"


def real(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


LINEITEM = "SELECT *, CAST(l_returnflag = 'R' AS INT) AS fraud FROM lineitem"


def groups(column: str, uppers: list, labels: list) -> str:
    whens = " ".join(f"WHEN {column} <= {u} THEN '{name}'" for u, name in zip(uppers, labels))
    return f"CASE WHEN {column} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


CHAIN: dict[str, str] = {}

CHAIN["ev"] = r"""
SELECT event_id, user_id, ts, value, CAST(event_type = 'error' AS INT) AS fraud,
  CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k,
  CAST(ts AS DATE) - DATE '1970-01-01' AS day,
  CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents,
  row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS total
FROM events"""

CHAIN["sev"] = """
SELECT *, CASE WHEN pos < floor(total * 0.7::DOUBLE) THEN 'train'
  WHEN pos < floor(total * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM ev"""

CHAIN["dd"] = """
SELECT user_id, day, count(*) AS n, sum(cents) AS s1, sum(cents * cents) AS s2, max(cents) AS top,
  count(*) FILTER (hour(ts) >= 22 OR hour(ts) < 6) AS nights,
  count(*) FILTER (k % 10 = 0) AS declines, count(*) FILTER (k % 5 = 0) AS online,
  count(*) FILTER (k % 25 = 0) AS chargebacks,
  bit_or(CAST(1 AS BIGINT) << CAST((user_id + k) % 6 AS INT)) AS countries,
  bit_or(CAST(1 AS BIGINT) << CAST(k % 8 AS INT)) AS devices,
  bit_or(CAST(1 AS BIGINT) << CAST(k % 50 AS INT)) AS merchants,
  count(*) FILTER (k % 4 = 0) AS mcc0, count(*) FILTER (k % 4 = 1) AS mcc1,
  count(*) FILTER (k % 4 = 2) AS mcc2, count(*) FILTER (k % 4 = 3) AS mcc3
FROM ev GROUP BY user_id, day"""

_MONTH = ", ".join(
    f"CAST(coalesce(sum({c}) OVER m, 0) AS DOUBLE) AS {c}"
    for c in ("n", "s1", "s2", "nights", "declines", "chargebacks", "mcc0", "mcc1", "mcc2", "mcc3")
)
CHAIN["hh"] = f"""
SELECT user_id AS hu, day AS hd, {_MONTH}, max(top) OVER m AS top,
  CAST(coalesce(sum(n) OVER w, 0) AS DOUBLE) AS n7, CAST(coalesce(sum(s1) OVER w, 0) AS DOUBLE) AS s7,
  CAST(coalesce(sum(online) OVER w, 0) AS DOUBLE) AS online7,
  coalesce(bit_count(bit_or(countries) OVER m), 0) AS countries,
  coalesce(bit_count(bit_or(devices) OVER m), 0) AS devices,
  coalesce(bit_count(bit_or(merchants) OVER w), 0) AS merchants,
  day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap
FROM dd
WINDOW m AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING),
  w AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING)"""


def _nth(values: list[str], index: str) -> str:
    return "['" + "', '".join(values) + f"'][CAST({index} AS INT) + 1]"


def _entropy() -> str:
    terms = " + ".join(f"coalesce(-(mcc{i} / n) * ln(nullif(mcc{i}, 0) / n), 0.0::DOUBLE)" for i in range(4))
    return f"0::DOUBLE + {terms}"


CHAIN["txn"] = rf"""
SELECT event_id, split, value AS amount,
  {_nth(ledger.CURRENCIES, 'k % 4')} AS currency,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS local_timestamp,
  5000 + (user_id * 7 + k) % 60 AS mcc,
  k % 3 = 0 AS card_present,
  {_nth(ledger.CHANNELS, 'k % 5')} AS payment_channel,
  'C' || ((user_id + k) % 6) AS merchant_country,
  {_nth(ledger.ENTRY_MODES, 'event_id % 3')} AS card_entry_mode,
  {_nth(ledger.AUTH_RESULTS, 'event_id % 4')} AS auth_result,
  {_nth(ledger.PIN_METHODS, '(event_id + k) % 3')} AS pin_verif_method,
  CASE WHEN k % 7 = 0 THEN 'yes' ELSE 'no' END AS recurring_flag,
  k % 2 = 0 AS tokenised,
  (user_id + k) % 6 <> user_id % 6 AS cross_border,
  CASE WHEN k % 10 < 6 THEN 'basic' ELSE '3ds' END AS auth_characteristics,
  {_nth(ledger.MESSAGE_TYPES, '(event_id + user_id) % 3')} AS message_type,
  'L' || (k % 9) AS term_location,
  '{{''ip'': ''' || ['10', '192', '172', '81'][CAST(k % 4 AS INT) + 1] || '.' ||
    (CASE WHEN k % 8 = 1 THEN 168 ELSE k % 40 END) || '.' || (user_id % 256) || '.' || (event_id % 256) ||
    ''', ''score'': ' || (((k * 37 + event_id) % 1000) / 1000::DOUBLE) || '}}' AS ip_risk,
  '(' || CAST(coalesce(n7, 0) AS BIGINT) || ', ' || CAST(coalesce(n, 0) AS BIGINT) || ')' AS txn_counts,
  'DEV-' || event_id AS device_id,
  'MID-' || (event_id * 3) AS merchant_id,
  user_id * 13 % 900 AS card_activation_age,
  floor(s1 * 100 / nullif(n, 0)) / 10000 AS mean_amount_30d,
  floor(sqrt((n * s2 - s1 * s1) / nullif(n * (n - 1), 0)) * 100) / 10000 AS std_amount_30d,
  top / 100::DOUBLE AS max_amount_30d,
  CAST(merchants AS BIGINT) AS distinct_merchants_7d,
  CAST(countries AS BIGINT) AS distinct_countries_30d,
  floor(online7 / nullif(n7, 0) * 10000) / 10000 AS online_share_7d,
  floor(nights / nullif(n, 0) * 10000) / 10000 AS night_ratio_30d,
  floor(declines / nullif(n, 0) * 10000) / 10000 AS decline_rate_30d,
  CASE WHEN n > 0 THEN floor(({_entropy()}) * 10000) / 10000 END AS mcc_entropy_30d,
  CAST(gap AS BIGINT) AS days_since_last_txn,
  CAST(chargebacks AS BIGINT) AS chargebacks_365d,
  CAST(devices AS BIGINT) AS device_diversity_30d,
  ((k * 11 + user_id) % 100) / 100::DOUBLE AS credit_util_today,
  floor(s7 * 30 / nullif(s1 * 7, 0) * 10000) / 10000 AS spending_trend,
  fraud
FROM sev JOIN hh ON user_id = hu AND day = hd"""

CHAIN["p0"] = r"""
SELECT *,
  regexp_extract(ip_risk, '''ip'': ''([^'']*)''', 1) AS ip_address,
  CAST(regexp_extract(ip_risk, '''score'': ([0-9.]+)', 1) AS DOUBLE) AS ip_score,
  CAST(regexp_extract(txn_counts, '\((\d+), (\d+)\)', 1) AS DOUBLE) AS txn_count_7d,
  CAST(regexp_extract(txn_counts, '\((\d+), (\d+)\)', 2) AS DOUBLE) AS txn_count_30d,
  CAST(local_timestamp AS TIMESTAMP) AS transaction_datetime
FROM txn"""

CHAIN["p1"] = f"""
SELECT *,
  txn_count_7d / (txn_count_30d + 1) AS txn_count_ratio_7d_30d,
  CAST(regexp_matches(ip_address, '^(10\\.|192\\.168\\.|172\\.0*(1[6-9]|2[0-9]|3[01])\\.)') AS INT) AS ip_is_private,
  {groups('ip_score', [0.2, 0.5, 0.8], ['low', 'medium', 'high', 'very_high'])} AS ip_score_bin,
  hour(transaction_datetime) AS hour, isodow(transaction_datetime) - 1 AS day_of_week,
  dayname(transaction_datetime) AS day_name, month(transaction_datetime) AS month,
  day(transaction_datetime) AS day, year(transaction_datetime) AS year
FROM p0"""

CHAIN["prep"] = f"""
SELECT *, CAST(day_of_week >= 5 AS INT) AS is_weekend, CAST(hour >= 22 OR hour < 6 AS INT) AS is_night_txn,
  {groups('hour', [5, 11, 17, 21], ['night', 'morning', 'afternoon', 'evening', 'late_evening'])} AS time_period
FROM p1"""


def _log(x: str) -> str:
    return f"ln(1 + CASE WHEN {x} < 0 THEN 0 ELSE {x} END)"


def _flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INT)"


CHAIN["a0"] = f"""
SELECT *, {_log('amount')} AS log_amount, {_flag('amount IS NULL')} AS amount_missing_flag,
  {_flag('amount IS NULL OR amount <= 0')} AS amount_invalid_flag,
  {_log('mean_amount_30d')} AS log_mean_amount_30d, {_flag('mean_amount_30d IS NULL')} AS mean_amount_30d_missing_flag,
  {_flag('coalesce(mean_amount_30d, 0) = 0')} AS mean_amount_30d_zero_flag,
  amount / (mean_amount_30d + 1) AS amount_to_mean_30d,
  {_log('max_amount_30d')} AS log_max_amount_30d, {_flag('max_amount_30d IS NULL')} AS max_amount_30d_missing_flag,
  {_flag('coalesce(max_amount_30d, 0) = 0')} AS max_amount_30d_zero_flag,
  amount / (max_amount_30d + 1) AS amount_to_max_30d,
  {_flag('std_amount_30d IS NULL')} AS std_amount_30d_missing_flag,
  {_flag('coalesce(std_amount_30d, 0) = 0')} AS std_amount_30d_zero_flag,
  (amount - mean_amount_30d) / (std_amount_30d + 1) AS amount_z_30d,
  amount / (std_amount_30d + 1) AS amount_to_std_30d
FROM prep"""

CHAIN["amt"] = f"""
SELECT *, {_log('amount_to_mean_30d')} AS log_amount_to_mean_30d,
  {_flag('amount_to_mean_30d > 1')} AS is_amount_above_mean, {_flag('amount_to_mean_30d > 2')} AS is_amount_2x_mean,
  {_flag('amount_to_mean_30d > 5')} AS is_amount_5x_mean,
  {_log('amount_to_max_30d')} AS log_amount_to_max_30d,
  {_flag('amount_to_max_30d >= 0.8')} AS is_amount_near_max, {_flag('amount_to_max_30d > 1')} AS is_amount_above_max
FROM a0"""

_THRESHOLDS = """
SELECT quantile_cont(mcc_entropy_30d, 0.05) AS very_low_mcc_entropy_q05,
  quantile_cont(mcc_entropy_30d, 0.10) AS low_mcc_entropy_q10,
  quantile_cont(night_ratio_30d, 0.10) AS low_night_ratio_q10,
  quantile_cont(max_amount_30d, 0.90) AS high_max_amount_q90,
  quantile_cont(spending_trend, 0.10) AS low_spending_trend_q10,
  quantile_cont(CAST(distinct_countries_30d AS DOUBLE), 0.10) AS low_country_diversity_q10,
  quantile_cont(CAST(device_diversity_30d AS DOUBLE), 0.90) AS high_device_diversity_q90,
  quantile_cont(decline_rate_30d, 0.90) AS high_decline_rate_q90,
  quantile_cont(ip_score, 0.90) AS high_ip_score_q90
FROM prep"""
CHAIN["thr"] = _THRESHOLDS + " WHERE split = 'train'"
CHAIN["thr_all"] = _THRESHOLDS


def _behavior(source: str, limits: str) -> str:
    from riskloom.fixed_values import RISK_GROUPS

    binned = ", ".join(f"{groups(c, u, names)} AS {g}" for c, (g, u, names) in RISK_GROUPS.items() if c != "amount_to_mean_30d" or source == "amt")
    if source == "prep":
        binned = ", ".join(f"{groups(c, u, names)} AS {g}" for c, (g, u, names) in RISK_GROUPS.items() if not c.startswith("amount"))
    return f"""
SELECT {source}.*, {binned},
  {_flag('mcc_entropy_30d <= very_low_mcc_entropy_q05')} AS very_low_mcc_entropy_flag,
  {_flag('mcc_entropy_30d <= low_mcc_entropy_q10')} AS low_mcc_entropy_flag,
  {_flag('night_ratio_30d <= low_night_ratio_q10')} AS low_night_ratio_flag,
  {_flag('max_amount_30d >= high_max_amount_q90')} AS high_max_amount_30d_flag,
  {_flag('spending_trend <= low_spending_trend_q10')} AS low_spending_trend_flag,
  {_flag('distinct_countries_30d <= low_country_diversity_q10')} AS low_country_diversity_flag,
  {_flag('device_diversity_30d >= high_device_diversity_q90')} AS high_device_diversity_flag,
  {_flag('decline_rate_30d >= high_decline_rate_q90')} AS high_decline_rate_flag,
  {_flag('ip_score >= high_ip_score_q90')} AS high_ip_score_flag,
  {_flag('is_night_txn = 1')} AS night_transaction_flag, {_flag('NOT card_present')} AS card_not_present_flag,
  {_flag('cross_border')} AS cross_border_flag, {_flag('tokenised')} AS tokenised_flag,
  is_night_txn * (1 - coalesce(night_ratio_30d, 0)) AS night_unusual_score
FROM {source}, {limits}"""


def _products(source: str) -> str:
    from riskloom.fixed_values import INTERACTIONS

    night = groups("night_unusual_score", [0, 0.3, 0.6, 0.9], ["not_night", "low", "medium", "high", "very_high"])
    products = ", ".join(f"{' * '.join(flags)} AS {name}" for name, flags in INTERACTIONS.items())
    return f"SELECT *, {night} AS night_unusual_group, {products} FROM {source}"


CHAIN["b0"] = _behavior("amt", "thr")
CHAIN["feat"] = _products("b0")
CHAIN["i0"] = _behavior("prep", "thr_all")
CHAIN["insight"] = _products("i0")
CHAIN["sc"] = """
SELECT event_id, split, fraud AS y_true, value / (value + 50) AS fraud_probability FROM sev"""


def chain(query: str, **extra: str) -> str:
    """A query over the named steps it reaches, directly or through other steps."""
    steps = {**CHAIN, **extra}
    needed: set[str] = set()
    todo = [query]
    while todo:
        text = todo.pop()
        for name, sql in steps.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(sql)
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in steps.items() if n in needed) + "\n" + query
