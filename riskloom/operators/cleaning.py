"""Raw table cleaning: one lazy chain of projections; only boolean detection needs a pass of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.fixed_values import BOOLEAN_TEXTS, MISSING_TEXTS, NUMERIC_COLUMNS
from riskloom.functions.scalars import as_text, flag, is_text, number, one_row
from riskloom.operators.parsing import parse_nested
from riskloom.operators.profile import distinct_row_counts, present_cells
from riskloom.operators.timing import add_time_features

# Fixed value: the characters stripped from both ends of a text.
BLANKS = " \t\n\r\f\v"

# Copies of one row are written back in pieces of this many, spread over tasks.
COPIES_PER_PIECE = 100_000


def normalize_names(df: DataFrame) -> DataFrame:
    names = [n.strip().lower().replace(" ", "_").replace("-", "_") for n in df.columns]
    # A renaming to the same names would keep Spark from running the pass of ``flag_duplicates`` once for both its uses.
    return df if names == df.columns else df.toDF(*names)


def clean_text(df: DataFrame) -> DataFrame:
    """Strip text columns; empty, ``nan`` and ``None`` become NULL."""
    strip = {n: F.btrim(F.col(f"`{n}`"), F.lit(BLANKS)) for n in df.columns if is_text(df, n)}
    return df.withColumns({n: F.when(~c.isin(MISSING_TEXTS), c) for n, c in strip.items()}) if strip else df


def boolean_like_columns(df: DataFrame) -> list[str]:
    """Text columns whose every non-null value says true or false (one aggregation for all columns)."""
    names = [n for n in df.columns if is_text(df, n)]
    if not names:
        return []
    checks = [F.bool_and(as_text(F.col(f"`{n}`")).isin(list(BOOLEAN_TEXTS))).alias(f"b{i}") for i, n in enumerate(names)]
    row = df.agg(*checks).first()
    return [n for i, n in enumerate(names) if row[f"b{i}"]]


def convert_booleans(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Boolean-like text to 1/0; pass ``columns`` when they are known to save the detection pass."""
    names = boolean_like_columns(df) if columns is None else columns
    ones = [text for text, value in BOOLEAN_TEXTS.items() if value]
    zeros = [text for text, value in BOOLEAN_TEXTS.items() if not value]
    new = {}
    for n in names:
        text = as_text(F.col(f"`{n}`"))
        new[n] = F.when(text.isin(ones), 1).when(text.isin(zeros), 0)
    return df.withColumns(new) if new else df


def convert_numbers(df: DataFrame) -> DataFrame:
    """Named columns as numbers: bad text and NaN become NULL, integer columns stay as they are."""
    kinds = dict(df.dtypes)
    new = {n: number(df, n) for n in NUMERIC_COLUMNS if kinds.get(n) in ("string", "double", "float")}
    return df.withColumns(new) if new else df


def invalid_flags(df: DataFrame) -> DataFrame:
    new = {}
    if "amount" in df.columns:
        x = number(df, "amount")
        new["amount_invalid_flag"] = flag(x.isNull() | (x <= 0))
    for name in ("std_amount_30d", "mean_amount_30d"):
        if name in df.columns:
            new[f"{name}_zero_flag"] = flag(F.coalesce(number(df, name), F.lit(0.0)) == 0)
    return df.withColumns(new) if new else df


def flag_duplicates(df: DataFrame, drop: bool = False) -> DataFrame:
    """``duplicate_row_flag``: 0 on the first copy of a row, 1 on every further one; ``drop`` keeps the first.

    Copies are merged into one row with a count on the map side and written back from the count. Rows
    without copies go straight through; the copies of a hot row are cut into pieces that separate tasks
    expand, so no window ever holds all copies of one row.
    """
    counted = distinct_row_counts(df)
    if drop:
        return counted.drop("copies").withColumn("duplicate_row_flag", F.lit(0))
    single = counted.where(F.col("copies") == 1).drop("copies").withColumn("duplicate_row_flag", F.lit(0))
    step = F.lit(COPIES_PER_PIECE).cast("bigint")
    pieces = (
        counted.where(F.col("copies") > 1)
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / step))))
        .repartition("piece", *[F.col(f"`{n}`") for n in df.columns])
    )
    last = F.least(step, F.col("copies") - F.col("piece") * step)
    copies = (
        pieces.withColumn("at", F.explode(F.sequence(F.lit(1).cast("bigint"), last)))
        .withColumn("duplicate_row_flag", flag((F.col("piece") > 0) | (F.col("at") > 1)))
        .drop("copies", "piece", "at")
    )
    return single.unionByName(copies)


def clean_raw(
    df: DataFrame,
    drop_duplicates: bool = False,
    boolean_columns: list[str] | None = None,
    night_threshold: float | None = None,
) -> DataFrame:
    """The whole cleaning chain in its fixed order: names, text, booleans, numbers, nested text, time, flags, copies."""
    out = clean_text(normalize_names(df))
    out = convert_numbers(convert_booleans(out, boolean_columns))
    out = add_time_features(parse_nested(out), night_threshold)
    return flag_duplicates(invalid_flags(out), drop_duplicates)


def cleaning_summary(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Before/after rows, columns and missing cells, and the flagged rows, as one row. Each table is read by one aggregation."""

    def totals(df: DataFrame, extra: list) -> DataFrame:
        cells = df.agg(F.count("*").alias("rows"), present_cells(df).alias("present"), *extra)
        return cells.withColumn("missing", F.col("rows") * len(df.columns) - F.col("present"))

    flags = {"duplicate_row_flag": "duplicate_rows", "amount_invalid_flag": "invalid_amount_rows"}
    extra = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in flags.items() if c in cleaned.columns]
    before = one_row(totals(raw, []))
    return (
        totals(cleaned, extra)
        .withColumn("before", before)
        .select(
            F.col("before.rows").alias("raw_rows"),
            F.lit(len(raw.columns)).cast("bigint").alias("raw_columns"),
            F.col("rows").alias("cleaned_rows"),
            F.lit(len(cleaned.columns)).cast("bigint").alias("cleaned_columns"),
            F.lit(len(cleaned.columns) - len(raw.columns)).cast("bigint").alias("new_columns_added"),
            F.col("before.missing").alias("raw_missing_values"),
            F.col("missing").alias("cleaned_missing_values"),
            *[F.col(n) for c, n in flags.items() if c in cleaned.columns],
        )
    )
