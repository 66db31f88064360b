"""Null-safe scalar expressions.

Spark evaluates ``NaN > 1`` to true and raises on bad casts in ANSI mode. Every helper here follows
one rule instead: what is not a usable number is NULL, and a comparison with NULL counts as 0 in a flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that count as true and as false.
TRUE_TEXTS = ["true", "1", "yes", "y"]
FALSE_TEXTS = ["false", "0", "no", "n"]

NUMERIC_TYPES = (T.NumericType,)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), T.NumericType)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), (T.StringType, T.VarcharType, T.CharType))


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double: unparsable text, NaN and absent columns become NULL."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    c, kind = F.col(name), type_of(df, name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return null_if_nan(c.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    # Java accepts a trailing type letter ("1.5d"), which is not a number to a CSV reader.
    text = F.when(~c.cast("string").rlike(r"[0-9.][dDfF]\s*$"), c.cast("string"))
    return null_if_nan(text.try_cast("double"))


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def as_text(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string")))


def says_true(df: DataFrame, name: str) -> Column:
    return F.coalesce(as_text(F.col(name)).isin(TRUE_TEXTS), F.lit(False)) if name in df.columns else F.lit(False)


def says_false(df: DataFrame, name: str) -> Column:
    return F.coalesce(as_text(F.col(name)).isin(FALSE_TEXTS), F.lit(False)) if name in df.columns else F.lit(False)


def log1p_clipped(c: Column) -> Column:
    """``log(1 + max(c, 0))`` with NULL kept. ``greatest`` would turn NULL into 0."""
    return F.log1p(F.when(c < 0, F.lit(0.0)).otherwise(c))


def damped_ratio(a: Column, b: Column, damping: float = 1.0) -> Column:
    """``a / (b + damping)``; NULL when the denominator is 0."""
    return F.try_divide(a, b + F.lit(damping))


def share(a: Column, b: Column) -> Column:
    """``a / b`` as double; NULL when b is 0 or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def clock_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 read off the wall clock, as bigint.

    Works on zone-less timestamps without going through the session zone, so it is monotonic in them.
    """
    days = F.date_diff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint")
    micros = (F.extract(F.lit("SECOND"), c) * 1000000).cast("bigint")
    return (days * 86400 + seconds) * 1000000 + micros


def one_row(df: DataFrame) -> Column:
    """A one-row DataFrame as a struct-valued scalar subquery.

    Attach it once as a column and read its fields: the plan then holds a literal instead of a join,
    and Spark reuses the exchange when the row is aggregated from the same shuffle.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).scalar()
