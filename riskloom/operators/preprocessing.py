"""Fitted preprocessing as persistable Spark ML stages.

The fit reads three small results from the training rows: exact medians, mean and deviation of the
imputed numbers, and the categories frequent enough to get a column of their own. Numbers become literals of one
``SQLTransformer``; categories become the dictionaries of one indexer, which finds a category's slot by hash, so the
plan doesn't grow with their number. Transforming is a projection, and the whole pipeline can be saved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.order_stats import quantiles
from riskloom.functions.scalars import number
from riskloom.operators.features import FeatureSet

RARE = "infrequent_sklearn"  # Fixed value: the name of the shared column for rare categories.
#: Categories with a column of their own, over all columns: the coefficients of a model of so many are 16 MB.
MAX_CATEGORIES = 2_000_000


@dataclass
class Term:
    """One encoded feature: a scaled number, a category of a column (``value`` None: all others), or a flag."""

    kind: str
    column: str
    value: str | None = None
    median: float = 0.0
    mean: float = 0.0
    deviation: float = 1.0


@dataclass
class Preprocessing:
    stages: list
    feature_names: list[str]
    terms: list[Term]


def frequent_categories(train: DataFrame, columns: Sequence[str], min_frequency: int | None) -> dict[str, tuple[list[str], bool]]:
    """Per column the sorted categories with at least ``min_frequency`` rows, and whether others exist.

    Only frequent categories reach the driver; the rest is a flag. As each becomes a column of the model, more than
    ``MAX_CATEGORIES`` in all raise an error: none is dropped in silence.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias("v")) for c in columns])
    counted = train.select(F.inline(pairs)).groupBy("c", "v").agg(F.count("*").alias("n"))
    # One row for each frequent category, and one without a value for a column that has rare ones.
    frequent = F.when(F.col("n") >= (min_frequency or 1), F.col("v"))
    rows = counted.select("c", frequent.alias("v")).distinct().limit(MAX_CATEGORIES + len(columns) + 1).collect()
    found: dict[str, set] = {c: set() for c in columns}
    for r in rows:
        found[r["c"]].add(r["v"])
    if sum(len(v - {None}) for v in found.values()) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} frequent categories: raise min_frequency or leave columns out")
    return {c: (sorted(v - {None}), None in v) for c, v in found.items()}


def scaling(train: DataFrame, columns: Sequence[str], scale: bool, method: str = "exact") -> dict[str, tuple[float, float, float]]:
    """Median, mean and population deviation of the imputed column; mean 0 and deviation 1 without scaling."""
    if not columns:
        return {}
    medians = {c: (line[0] if line[0] is not None else 0.0) for c, line in quantiles(train, {c: number(train, c) for c in columns}, [0.5], method).items()}
    if not scale:
        return {c: (medians[c], 0.0, 1.0) for c in columns}
    filled = {c: F.coalesce(number(train, c), F.lit(medians[c])) for c in columns}
    row = train.agg(*[a for i, c in enumerate(columns) for a in (F.avg(filled[c]).alias(f"m{i}"), F.stddev_pop(filled[c]).alias(f"d{i}"))]).first()
    return {c: (medians[c], row[f"m{i}"], row[f"d{i}"] or 1.0) for i, c in enumerate(columns)}


def _double(x: float) -> str:
    return f"({float(x)!r}D)"


def _indexer(train: DataFrame, known: list[list[str]], inputs: list[str], outputs: list[str]) -> StringIndexerModel:
    """The places of the known categories, fitted on nothing but them: row k holds the k-th of each column."""
    longest = max(map(len, known))
    rows = [tuple(v[k] if k < len(v) else None for v in known) for k in range(longest)]
    listed = train.sparkSession.createDataFrame(rows, ", ".join(f"{c} string" for c in inputs))
    return StringIndexer(inputCols=inputs, outputCols=outputs, handleInvalid="keep", stringOrderType="alphabetAsc").fit(listed)


def fit_preprocessing(
    train: DataFrame,
    features: FeatureSet,
    scale: bool,
    group_rare: bool = True,
    min_frequency: int | None = 50,
    output: str = "features",
    method: str = "exact",
    constant: bool = False,
) -> Preprocessing:
    """Impute (and scale) numbers, one-hot categories with rare ones sharing a column, fill flags with 0.

    Without rare grouping, or when no category is rare, an unknown category gets no column at all. ``constant`` adds a
    last slot that is always 1 and has no name: a linear model that regularises its intercept learns it there.
    """
    numbers = scaling(train, features.numeric_features, scale, method)
    categories = frequent_categories(train, features.categorical_features, min_frequency if group_rare else None)
    flags = features.binary_features + features.interaction_features

    fields, names, terms = [], [], []
    for i, (c, (median, mean, deviation)) in enumerate(numbers.items()):
        fields.append(f"(coalesce(nanvl(try_cast(`{c}` AS double), NULL), {_double(median)}) - {_double(mean)}) / {_double(deviation)} AS _n{i}")
        names.append(f"numeric__{c}")
        terms.append(Term("number", c, None, median, mean, deviation))
    # The indexer gives unknown categories the place after the known ones. Where the training rows have rare categories that
    # place is the shared column; elsewhere the encoder drops it, which leaves all zeros.
    known, shared, apart = [], [], []  # known ones in the indexer's order, by UTF-16 units
    for i, (c, (frequent, has_rare)) in enumerate(categories.items()):
        fields.append(f"coalesce(cast(`{c}` AS string), 'missing') AS _t{i}")
        known.append(sorted(frequent if has_rare else (frequent or [RARE]), key=lambda v: v.encode("utf-16-be", "surrogatepass")))
        (shared if has_rare else apart).append(i)
        names += [f"categorical__{c}_{v}" for v in known[-1] + [RARE] * has_rare]
        terms += [Term("category", c, v) for v in known[-1] + [None] * has_rare]
    for i, c in enumerate(flags):
        fields.append(f"cast(coalesce(`{c}`, 0) AS double) AS _f{i}")
        names.append(f"{'binary' if i < len(features.binary_features) else 'interaction'}__{c}")
        terms.append(Term("flag", c))
    if constant:
        fields.append("1.0D AS _one")

    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(fields)} FROM __THIS__")]
    if known:
        texts = [f"_t{i}" for i in range(len(known))]
        stages.append(_indexer(train, known, texts, [f"_c{i}" for i in range(len(known))]))
    for places, drop in ((shared, False), (apart, True)):
        if places:
            stages.append(OneHotEncoder(inputCols=[f"_c{i}" for i in places], outputCols=[f"_v{i}" for i in places], dropLast=drop, handleInvalid="error"))
    inputs = [f"_n{i}" for i in range(len(numbers))] + [f"_v{i}" for i in range(len(known))] + [f"_f{i}" for i in range(len(flags))] + ["_one"] * constant
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return Preprocessing(stages, names, terms)
