"""Adapter from an event stream table to the raw transaction schema.

The transaction columns with a ``_7d`` / ``_30d`` suffix are history the table is expected to bring along.
For event tables they are built here on day grain: events are first reduced to one row per user and day,
the window runs over those day rows only, and the result is joined back on (user, day). Only days strictly
before the event's own day count, so an event never sees itself or its future. A user that owns a third of
all events still has one row per day in the window, and its join keys spread over the days.

Amounts are summed as integer cents, so every history value comes from one exact division and does not
depend on the order in which tasks finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The texts this adapter derives from the event key.
CURRENCIES = ["USD", "EUR", "GBP", "VND"]
CHANNELS = ["web", "pos", "atm", "app", "moto"]
ENTRY_MODES = ["chip", "swipe", "manual"]
AUTH_RESULTS = ["approved", "declined", "referred", "timeout"]
PIN_METHODS = ["online", "offline", "none"]
AUTH_TRAITS = ["3ds", "basic"]
MESSAGE_TYPES = ["0100", "0200", "0400"]


def _nth(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _floor4(c: Column) -> Column:
    return F.floor(c * 10000) / 10000.0


def _bit(index: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), index.cast("int"))


def event_rows(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event with its integer key ``k``, cents, calendar day and the flags history needs."""
    k = F.regexp_extract("props", r"(\d+)", 1).try_cast("bigint")
    return (
        events.select(
            "event_id", "user_id", "ts", "value", (F.col("event_type") == "error").cast("int").alias("fraud"), k.alias("k"), *keep
        )
        .withColumn("day", F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")))
        .withColumn("cents", F.floor(F.col("value") * 100 + 0.5))
    )


def daily_history(rows: DataFrame) -> DataFrame:
    """Per user and day: the aggregates of the 30 (or 7) days before that day."""
    night = (F.hour("ts") >= 22) | (F.hour("ts") < 6)
    k = F.col("k")
    per_day = rows.groupBy("user_id", "day").agg(
        F.count("*").alias("n"),
        F.sum("cents").alias("s1"),
        F.sum(F.col("cents") * F.col("cents")).alias("s2"),
        F.max("cents").alias("top"),
        F.count_if(night).alias("nights"),
        F.count_if(k % 10 == 0).alias("declines"),
        F.count_if(k % 5 == 0).alias("online"),
        F.count_if(k % 25 == 0).alias("chargebacks"),
        F.bit_or(_bit((F.col("user_id") + k) % 6)).alias("countries"),
        F.bit_or(_bit(k % 8)).alias("devices"),
        F.bit_or(_bit(k % 50)).alias("merchants"),
        *[F.count_if(k % 4 == i).alias(f"mcc{i}") for i in range(4)],
    )
    user_days = Window.partitionBy("user_id").orderBy("day")
    month, week = user_days.rangeBetween(-30, -1), user_days.rangeBetween(-7, -1)
    sums = ["n", "s1", "s2", "nights", "declines", "chargebacks", "mcc0", "mcc1", "mcc2", "mcc3"]
    return per_day.select(
        "user_id",
        "day",
        *[F.coalesce(F.sum(c).over(month), F.lit(0)).alias(c) for c in sums],
        F.max("top").over(month).alias("top"),
        F.coalesce(F.sum("n").over(week), F.lit(0)).alias("n7"),
        F.coalesce(F.sum("s1").over(week), F.lit(0)).alias("s7"),
        F.coalesce(F.sum("online").over(week), F.lit(0)).alias("online7"),
        F.coalesce(F.bit_count(F.bit_or("countries").over(month)), F.lit(0)).alias("countries"),
        F.coalesce(F.bit_count(F.bit_or("devices").over(month)), F.lit(0)).alias("devices"),
        F.coalesce(F.bit_count(F.bit_or("merchants").over(week)), F.lit(0)).alias("merchants"),
        (F.col("day") - F.lag("day").over(user_days)).alias("gap"),
    )


def with_history(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of ``event_rows`` beside the history of their user and day: small numbers that every transaction column is drawn from."""
    rows = event_rows(events, keep)
    h = daily_history(rows).withColumnsRenamed({"user_id": "h_user", "day": "h_day"})
    joined = rows.join(h, (F.col("user_id") == F.col("h_user")) & (F.col("day") == F.col("h_day")), "left")
    return joined.drop("h_user", "h_day", "day", "cents")


def transactions(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``event_id``, the kept event columns and the 36 raw transaction columns; the target is ``event_type = 'error'``."""
    return transaction_columns(with_history(events, keep), keep)


def transaction_columns(t: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``transactions`` from the rows of ``with_history``."""
    k, n = F.col("k"), F.col("n")
    user, eid = F.col("user_id"), F.col("event_id")
    home, abroad = user % 6, (user + k) % 6
    spread = (n * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    entropy = sum(
        F.coalesce(-F.try_divide(F.col(f"mcc{i}"), n) * F.ln(F.try_divide(F.nullif(F.col(f"mcc{i}"), F.lit(0)), n)), F.lit(0.0))
        for i in range(4)
    )
    return t.select(
        "event_id",
        *keep,
        F.col("value").alias("amount"),
        _nth(CURRENCIES, k % 4).alias("currency"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("local_timestamp"),
        (5000 + (user * 7 + k) % 60).alias("mcc"),
        (k % 3 == 0).alias("card_present"),
        _nth(CHANNELS, k % 5).alias("payment_channel"),
        F.concat(F.lit("C"), abroad).alias("merchant_country"),
        _nth(ENTRY_MODES, eid % 3).alias("card_entry_mode"),
        _nth(AUTH_RESULTS, eid % 4).alias("auth_result"),
        _nth(PIN_METHODS, (eid + k) % 3).alias("pin_verif_method"),
        F.when(k % 7 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("recurring_flag"),
        (k % 2 == 0).alias("tokenised"),
        (abroad != home).alias("cross_border"),
        _nth(AUTH_TRAITS, (k % 10 < 6).cast("int")).alias("auth_characteristics"),
        _nth(MESSAGE_TYPES, (eid + user) % 3).alias("message_type"),
        F.concat(F.lit("L"), k % 9).alias("term_location"),
        F.concat(
            F.lit("{'ip': '"), F.element_at(F.array(F.lit("10"), F.lit("192"), F.lit("172"), F.lit("81")), (k % 4).cast("int") + 1),
            F.lit("."), F.when(k % 8 == 1, F.lit(168)).otherwise(k % 40), F.lit("."), user % 256, F.lit("."), eid % 256,
            F.lit("', 'score': "), ((k * 37 + eid) % 1000) / 1000.0, F.lit("}"),
        ).alias("ip_risk"),
        F.concat(F.lit("("), F.coalesce("n7", F.lit(0)), F.lit(", "), F.coalesce("n", F.lit(0)), F.lit(")")).alias("txn_counts"),
        F.concat(F.lit("DEV-"), eid).alias("device_id"),
        F.concat(F.lit("MID-"), eid * 3).alias("merchant_id"),
        (user * 13 % 900).alias("card_activation_age"),
        (F.floor(F.try_divide(F.col("s1") * 100.0, n)) / 10000.0).alias("mean_amount_30d"),
        (F.floor(F.sqrt(F.try_divide(spread, n * (n - 1))) * 100) / 10000.0).alias("std_amount_30d"),
        (F.col("top") / 100.0).alias("max_amount_30d"),
        F.col("merchants").cast("bigint").alias("distinct_merchants_7d"),
        F.col("countries").cast("bigint").alias("distinct_countries_30d"),
        _floor4(F.try_divide(F.col("online7"), F.col("n7"))).alias("online_share_7d"),
        _floor4(F.try_divide(F.col("nights"), n)).alias("night_ratio_30d"),
        _floor4(F.try_divide(F.col("declines"), n)).alias("decline_rate_30d"),
        F.when(n > 0, _floor4(entropy)).alias("mcc_entropy_30d"),
        F.col("gap").cast("bigint").alias("days_since_last_txn"),
        F.col("chargebacks").cast("bigint").alias("chargebacks_365d"),
        F.col("devices").cast("bigint").alias("device_diversity_30d"),
        (((k * 11 + user) % 100) / 100.0).alias("credit_util_today"),
        _floor4(F.try_divide(F.col("s7") * 30.0, F.col("s1") * 7.0)).alias("spending_trend"),
        "fraud",
    )
