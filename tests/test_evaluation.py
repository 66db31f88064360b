import random

import pytest

from riskloom.operators import decisions, errors, evaluation


def frame(spark, rows):
    return spark.createDataFrame(rows, "y_true int, fraud_probability double").repartition(4)


def brute(rows):
    """Pair counting and the step sum over distinct scores."""
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted({p for _, p in rows}, reverse=True):
        tp, n = sum(p >= s for p in pos), sum(p >= s for _, p in rows)
        ap += sum(p == s for p in pos) / len(pos) * tp / n
    return auc, ap


@pytest.mark.parametrize("digits,buckets", [(1, 1), (2, 4), (6, 7)])
def test_areas_equal_brute_force_with_ties(spark, digits, buckets):
    rng = random.Random(digits)
    rows = [(int(rng.random() < 0.3), round(rng.random(), digits)) for _ in range(300)]
    rows += [(i % 2, 0.5) for i in range(150)]
    got = evaluation.curve_areas(frame(spark, rows), buckets=buckets).first()
    assert tuple(got) == pytest.approx(brute(rows))


def test_one_class_and_equal_scores(spark):
    one = evaluation.curve_areas(frame(spark, [(0, 0.1), (0, 0.9)])).first()
    assert one["roc_auc"] is None and one["pr_auc"] == 0.0
    same = evaluation.curve_areas(frame(spark, [(0, 0.5), (1, 0.5), (0, 0.5), (0, 0.5)])).first()
    assert tuple(same) == (0.5, 0.25)
    row = evaluation.evaluate(frame(spark, [(0, 0.1), (0, 0.9)]), 0.5).first()
    assert (row["precision"], row["recall"], row["f2"], row["balanced_accuracy"], row["review_rate"]) == (0.0, 0.0, 0.0, 0.5, 0.5)


def test_threshold_search_equals_single_evaluations(spark):
    rng = random.Random(1)
    df = frame(spark, [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(200)]).cache()
    report = {r["threshold"]: r for r in evaluation.search_thresholds(df).collect()}
    assert len(report) == 99
    for t in (0.01, 0.29, 0.57, 0.99):
        one = evaluation.evaluate(df, t).first()
        assert {k: one[k] for k in evaluation.METRIC_ORDER} == pytest.approx({k: report[t][k] for k in evaluation.METRIC_ORDER})


def test_best_threshold_limits_and_fallback(spark):
    schema = "threshold double, precision double, recall double, f2 double, review_rate double"
    report = spark.createDataFrame([(0.1, 0.2, 0.9, 0.6, 0.5), (0.5, 0.5, 0.6, 0.55, 0.1), (0.9, 0.9, 0.1, 0.2, 0.01)], schema)
    assert evaluation.best_threshold(report).first()["threshold"] == 0.1
    assert evaluation.best_threshold(report, max_review_rate=0.2).first()["threshold"] == 0.5
    assert evaluation.best_threshold(report, min_precision=0.95).first()["threshold"] == 0.1
    with pytest.raises(ValueError):
        evaluation.best_threshold(report, "accuracy")


def test_decisions_and_error_types(spark):
    rows = [(1, 0.1), (0, 0.3), (1, 0.7), (0, 0.69999)]
    out = decisions.decide(frame(spark, rows), 0.7)
    assert {(r["fraud_probability"], r["risk_level"], r["prediction"]) for r in out.collect()} == {
        (0.1, "LOW", 0), (0.3, "MEDIUM", 0), (0.7, "HIGH", 1), (0.69999, "MEDIUM", 0)
    }
    typed = errors.with_error_type(evaluation.predictions(frame(spark, rows), 0.3))
    assert {r["error_type"]: r["count"] for r in errors.error_counts(typed).collect()} == {"FN": 1, "FP": 2, "TP": 1}


def test_error_summaries(spark):
    rows = [("TP", 1.0, "a"), ("TP", 3.0, None), ("TP", None, "a"), ("FN", 5.0, "b")]
    df = spark.createDataFrame(rows, "error_type string, ip_score double, payment_channel string")
    got = {r["error_type"]: tuple(r)[1:] for r in errors.numeric_by_error_type(df).collect()}
    assert got == {"TP": (3, 2.0, 2.0, 2.8), "FN": (1, 5.0, 5.0, 5.0)}
    cats = {(r["error_type"], r["value"]): (r["count"], r["ratio"]) for r in errors.categories_by_error_type(df).collect()}
    assert cats == {("TP", "a"): (2, 2 / 3), ("TP", "missing"): (1, 1 / 3), ("FN", "b"): (1, 1.0)}
    with pytest.raises(ValueError):
        errors.attach_predictions(df.withColumnRenamed("ip_score", "id"), df.limit(1).withColumnRenamed("ip_score", "id"), "id")
