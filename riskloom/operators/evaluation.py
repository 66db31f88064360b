"""Scored rows to metrics, curves, thresholds and review policies.

A scored frame has ``y_true`` (0/1) and ``fraud_probability``. ``by`` names columns (such as ``split``)
whose groups are evaluated separately in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.fixed_values import REVIEW_CAPACITIES, SEARCHED_THRESHOLDS
from riskloom.functions.bins import reached
from riskloom.functions.scalars import share

SCORE, TRUTH = "fraud_probability", "y_true"
#: Distinct scores that one task sums up in order.
RANGE_SCORES = 2_000_000


def predicted(threshold: float | Column) -> Column:
    return (F.col(SCORE) >= threshold).cast("int")


def predictions(df: DataFrame, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(TRUTH).cast("int").alias(TRUTH), SCORE, predicted(threshold).alias("y_pred"), F.lit(float(threshold)).alias("threshold"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(share(a, b), F.lit(0.0))


def with_ratios(counts: DataFrame) -> DataFrame:
    """Every metric that follows from tp / fp / fn / tn; undefined ones are 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = tp + fp + fn + tn
    # Balanced accuracy averages the recall of the classes that occur.
    recalls = F.array_compact(F.array(share(tp, tp + fn), share(tn, tn + fp)))
    balanced = F.try_divide(F.aggregate(recalls, F.lit(0.0), lambda a, x: a + x), F.size(recalls))
    return counts.withColumns(
        {
            "rows": rows,
            "fraud_count": tp + fn,
            "fraud_rate": _ratio(tp + fn, rows),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "f2": _ratio(5 * tp, 5 * tp + 4 * fn + fp),
            "balanced_accuracy": balanced,
            "review_rate": _ratio(tp + fp, rows),
            "predicted_positive": tp + fp,
        }
    )


def confusion_counts(df: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(TRUTH) == 1, F.col(SCORE) >= threshold
    counts = {"tp": y & p, "fp": ~y & p, "fn": y & ~p, "tn": ~y & ~p}
    return df.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def _score_buckets(df: DataFrame, buckets: int) -> Bucketizer:
    """Score ranges of about equal row counts. The cut points are literals, so a lost task recomputes the same ranges."""
    inner = []
    if buckets > 1:
        inner = df.agg(F.percentile_approx(SCORE, [i / buckets for i in range(1, buckets)], max(10_000, 4 * buckets))).first()[0] or []
    # A bucketizer needs at least one inner point.
    splits = [float("-inf"), *sorted(set(inner) or {0.5}), float("inf")]
    return Bucketizer(splits=splits, inputCol=SCORE, outputCol="bucket", handleInvalid="keep")


def curve_points(df: DataFrame, by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Per distinct score: rows of each class at it (``pos``, ``neg``) and at or above it (``tp``, ``fp``).

    Scores are grouped first, so ties cost one row. The running totals are taken inside score ranges that
    run in parallel, plus the totals of the ranges above; no window spans the whole table. Unless given, the number of
    ranges follows the distinct scores, about ``RANGE_SCORES`` each. The range totals have one row per group and range.
    """
    y = F.col(TRUTH) == 1
    scored = df.where(F.col(SCORE).isNotNull())
    n = buckets or -(-scored.agg(F.approx_count_distinct(SCORE)).first()[0] // RANGE_SCORES)
    grouped = scored.groupBy(*by, SCORE).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    bucketed = _score_buckets(scored, n).transform(grouped)
    above = Window.partitionBy(*by).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        bucketed.groupBy(*by, "bucket")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
        .select(*[F.col(c).alias(f"_{c}") for c in by], F.col("bucket").alias("_bucket"), F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p0"), F.coalesce(F.sum("q").over(above), F.lit(0)).alias("q0"))
    )
    on = F.col("bucket") == F.col("_bucket")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = Window.partitionBy(*by, "bucket").orderBy(F.desc(SCORE)).rowsBetween(Window.unboundedPreceding, 0)
    running = bucketed.withColumns({"tp_in": F.sum("pos").over(inside), "fp_in": F.sum("neg").over(inside)})
    return running.join(ranges, on).select(
        *by, SCORE, "pos", "neg", (F.col("p0") + F.col("tp_in")).alias("tp"), (F.col("q0") + F.col("fp_in")).alias("fp")
    )


def curve_areas(df: DataFrame, by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """``roc_auc`` (trapezoids over distinct scores, NULL with one class) and ``pr_auc`` (average precision)."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    sums = curve_points(df, by, buckets).groupBy(*by).agg(
        F.sum(neg * (tp - pos / 2)).alias("under"), F.sum(pos * tp / (tp + fp)).alias("precise"), F.sum(pos).alias("p"), F.sum(neg).alias("n")
    )
    return sums.select(
        *by,
        F.try_divide(F.col("under"), F.col("p") * F.col("n")).alias("roc_auc"),
        F.coalesce(F.try_divide(F.col("precise"), F.col("p")), F.lit(0.0)).alias("pr_auc"),
    )


METRIC_ORDER = [
    "threshold", "rows", "fraud_count", "fraud_rate", "roc_auc", "pr_auc", "precision", "recall", "f1", "f2",
    "balanced_accuracy", "review_rate", "predicted_positive", "tn", "fp", "fn", "tp",
]


def _with_areas(report: DataFrame, areas: DataFrame, by: Sequence[str]) -> DataFrame:
    """Reports and areas have one row per group; an empty ``by`` is one group."""
    keys = list(by) or ["_all"]
    if not by:
        report, areas = report.withColumn("_all", F.lit(0)), areas.withColumn("_all", F.lit(0))
    return report.join(areas, keys, "left")


def evaluate(df: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """All metrics at one threshold, one row per group."""
    counts = with_ratios(confusion_counts(df, threshold, by)).withColumn("threshold", F.lit(float(threshold)))
    return _with_areas(counts, curve_areas(df, by), by).select(*by, *METRIC_ORDER)


def confusion_matrix(df: DataFrame, threshold: float) -> DataFrame:
    rows = F.array(
        F.struct(F.lit("actual_non_fraud").alias("actual"), F.col("tn").alias("pred_non_fraud"), F.col("fp").alias("pred_fraud")),
        F.struct(F.lit("actual_fraud").alias("actual"), F.col("fn").alias("pred_non_fraud"), F.col("tp").alias("pred_fraud")),
    )
    return confusion_counts(df, threshold).select(F.inline(rows))


def search_thresholds(df: DataFrame, thresholds: Sequence[float] = SEARCHED_THRESHOLDS, by: Sequence[str] = (), areas: bool = True) -> DataFrame:
    """Metrics at every threshold from one pass: rows are counted per number of thresholds they reach."""
    levels = sorted(thresholds)
    y = F.col(TRUTH) == 1
    counted = (
        df.where(F.col(SCORE).isNotNull())
        .groupBy(*by, reached(F.col(SCORE), levels).alias("level"))
        .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    )
    # At most len(levels) + 1 rows per group from here on: one map a group. Levels nobody reached count nothing.
    entry = F.struct(F.col("level").cast("int"), F.struct("pos", "neg"))
    held = counted.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("held")).where(F.size("held") > 0)
    every = held.select(*by, "held", F.explode(F.sequence(F.lit(0), F.lit(len(levels)))).alias("level"))
    found = F.try_element_at("held", F.col("level"))
    full = every.select(*by, "level", *[F.coalesce(found[c], F.lit(0)).alias(c) for c in ("pos", "neg")])
    upward = Window.partitionBy(*by).orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    values = F.array(*[F.lit(t) for t in levels])
    counts = (
        full.withColumns(
            {
                "tp": F.sum("pos").over(upward), "fp": F.sum("neg").over(upward),
                "p": F.sum("pos").over(whole), "n": F.sum("neg").over(whole),
            }
        )
        .where(F.col("level") > 0)
        .select(*by, F.element_at(values, F.col("level")).alias("threshold"), "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"), (F.col("n") - F.col("fp")).alias("tn"))
    )
    report = with_ratios(counts)
    if not areas:
        return report.select(*by, *[c for c in METRIC_ORDER if c not in ("roc_auc", "pr_auc")])
    return _with_areas(report, curve_areas(df, by), by).select(*by, *METRIC_ORDER)


def _eligible(min_precision: float | None, min_recall: float | None, max_review_rate: float | Column | None) -> Column:
    keep = F.lit(True)
    if min_precision is not None:
        keep = keep & (F.col("precision") >= min_precision)
    if min_recall is not None:
        keep = keep & (F.col("recall") >= min_recall)
    if max_review_rate is not None:
        keep = keep & (F.col("review_rate") <= max_review_rate)
    return keep


def _best_first(eligible: Column, metric: str) -> list[Column]:
    # Rows that pass the limits come first; when none does, all compete, which is the fallback.
    return [eligible.desc(), F.desc(metric), F.desc("recall"), F.desc("precision"), F.asc("threshold")]


def best_threshold(report: DataFrame, metric: str = "f2", min_precision: float | None = None, min_recall: float | None = None, max_review_rate: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The best row of a threshold report (per group) under the limits, or of all rows when none passes."""
    if metric not in report.columns:
        raise ValueError(f"{metric} is not in the threshold report")
    rank = Window.partitionBy(*by).orderBy(*_best_first(_eligible(min_precision, min_recall, max_review_rate), metric))
    return report.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") == 1).drop("_rank")


def capacity_policy(validation: DataFrame, test: DataFrame, capacities: Sequence[float] = REVIEW_CAPACITIES, metric: str = "f2") -> DataFrame:
    """Best validation threshold per review capacity, with the test metrics at that threshold.

    Both inputs are threshold reports over the same thresholds.
    """
    cap = F.col("review_capacity")
    options = validation.withColumn("review_capacity", F.explode(F.array(*[F.lit(c) for c in capacities])))
    rank = Window.partitionBy("review_capacity").orderBy(*_best_first(_eligible(None, None, cap), metric))
    chosen = (
        options.withColumn("_rank", F.row_number().over(rank))
        .where(F.col("_rank") == 1)
        .select("review_capacity", F.col("threshold").alias("selected_threshold_from_validation"), *[F.col(c).alias(f"validation_{c}") for c in ("precision", "recall", "f2", "review_rate")])
    )
    tested = test.select(F.col("threshold").alias("_threshold"), *[F.col(c).alias(f"test_{c}") for c in ("precision", "recall", "f1", "f2", "review_rate", "tp", "fp", "fn", "tn")])
    return chosen.join(tested, F.col("selected_threshold_from_validation") == F.col("_threshold")).drop("_threshold")
