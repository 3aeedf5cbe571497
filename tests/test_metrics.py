"""Ranking, threshold, capacity and fairness metrics."""

import itertools

import pytest
from pyspark.sql import functions as F

from tabloom.operators.capacity import CURVE_FRACTIONS, capacity_metrics, lowest_scores
from tabloom.operators.fairness import fairness_by_group, fairness_gaps
from tabloom.operators.ranking import (
    classification_metrics,
    collapse_scores,
    confusion_matrix,
    f2_threshold,
    precision_recall_points,
    ranking_metrics,
    roc_points,
    score_curve,
)


def table(spark, y, p):
    return spark.createDataFrame([(i, a, float(b)) for i, (a, b) in enumerate(zip(y, p, strict=True))], "id int, y int, p double")


def brute_force(y, p):
    pairs = [(a, b) for a, b in itertools.product(range(len(y)), repeat=2) if y[a] == 1 and y[b] == 0]
    auc = sum((p[a] > p[b]) + 0.5 * (p[a] == p[b]) for a, b in pairs) / len(pairs)
    ap, recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        picked = [a for a, s in zip(y, p, strict=True) if s >= t]
        now = sum(picked) / sum(y)
        ap += (now - recall) * sum(picked) / len(picked)
        recall = now
    return ap, auc


CASES = [
    ([0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]),
    ([0, 1, 0, 1, 1, 0, 1, 0], [0.5, 0.5, 0.5, 0.7, 0.7, 0.2, 0.2, 0.9]),
    ([0, 1, 1, 0], [0.3, 0.3, 0.3, 0.3]),
]


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("y,p", CASES)
def test_average_precision_and_auc(spark, y, p, parts):
    row = ranking_metrics(score_curve(table(spark, y, p), "y", "p", parts=parts)).first()
    ap, auc = brute_force(y, p)
    assert row["average_precision"] == pytest.approx(ap)
    assert row["roc_auc"] == pytest.approx(auc)
    assert row["brier_score"] == pytest.approx(sum((b - a) ** 2 for a, b in zip(y, p, strict=True)) / len(y))


def test_one_class_has_no_ranking(spark):
    row = ranking_metrics(score_curve(table(spark, [1, 1], [0.2, 0.3]), "y", "p")).first()
    assert row["average_precision"] is None and row["roc_auc"] is None and row["positive_rate"] == 1.0


def test_f2_threshold(spark):
    assert f2_threshold(score_curve(table(spark, [0, 0, 1, 1], [0.05, 0.20, 0.55, 0.90]), "y", "p")) == 0.55
    assert f2_threshold(score_curve(table(spark, [], []), "y", "p")) == 0.5


def test_threshold_is_inclusive_and_zero_safe(spark):
    scores = collapse_scores(table(spark, [0, 1, 1], [0.2, 0.5, 0.4]), "y", "p")
    row = classification_metrics(scores, 0.5).first()
    assert (row["recall"], row["precision"]) == (0.5, 1.0)
    assert tuple(classification_metrics(scores, 0.95).first()) == (0.0, 0.0, 0.0, 0.0)


def test_capacity_example(spark):
    row = capacity_metrics(table(spark, [0, 0, 1, 1], [0.05, 0.10, 0.80, 0.90]), "id", "y", "p", [0.5]).first()
    assert tuple(row) == (0.5, 2, 0.5, 0.0, 0.5, 1.0)


@pytest.mark.parametrize("parts", [1, 4])
def test_capacity_cuts_inside_ties(spark, parts):
    y = [(i * 7) % 3 == 0 for i in range(90)]
    p = [0.4 if i % 3 else (i % 10) / 10 for i in range(90)]  # two thirds of the rows tie
    df = table(spark, [int(a) for a in y], p)
    order = sorted(range(90), key=lambda i: (p[i], i))
    for row in capacity_metrics(df, "id", "y", "p", CURVE_FRACTIONS, parts=parts).collect():
        k = max(1, round(90 * row["selection_fraction"]))
        assert row["selected_rows"] == k
        assert row["selected_rate"] == pytest.approx(sum(y[i] for i in order[:k]) / k)
    assert [r["id"] for r in lowest_scores(df, "id", "p", 5).collect()] == order[:5]


@pytest.mark.parametrize("fraction", [0, -0.1, 1.5])
def test_bad_fraction(spark, fraction):
    with pytest.raises(ValueError):
        capacity_metrics(table(spark, [0, 1], [0.1, 0.2]), "id", "y", "p", [fraction])


def test_capacity_without_positives_or_rows(spark):
    assert capacity_metrics(table(spark, [0, 0], [0.1, 0.2]), "id", "y", "p", [1.0]).first()["relative_reduction"] == 0.0
    assert capacity_metrics(table(spark, [], []), "id", "y", "p", [0.5]).collect() == []


def test_fairness_keeps_the_missing_group(spark):
    n = 60
    rows = [(i, i % 2, 0.05 + 0.90 * i / (n - 1), "Male" if i < 30 else None) for i in range(n)]
    rows += [(100 + i, 1, 0.5, "Rare") for i in range(29)]
    df = spark.createDataFrame(rows, "id int, y int, p double, gender string")
    for parts in (1, 4):
        audit = fairness_by_group(df, "y", "p", "gender", 0.5, parts=parts)
        assert [r["group"] for r in audit.collect()] == ["Male", "__MISSING__"]
    gaps = fairness_gaps(audit).first()
    assert gaps["max_predicted_positive_rate_gap"] == 1.0
    empty = fairness_by_group(df, "y", "p", "gender", 0.5, minimum_rows=1_000)
    assert tuple(fairness_gaps(empty).first()) == (None, None)


def test_one_class_group_has_no_average_precision(spark):
    df = table(spark, [1] * 30, [0.5] * 30).withColumn("g", F.lit("a"))
    assert fairness_by_group(df, "y", "p", "g", 0.4).first()["average_precision"] is None


def test_curves_and_confusion(spark):
    df = table(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    curve = score_curve(df, "y", "p")
    points = {(r["precision"], r["recall"]) for r in precision_recall_points(curve).collect()}
    assert (1.0, 0.0) in points and (1.0, 0.5) in points and (0.5, 1.0) in points
    assert {r["tpr"] for r in roc_points(curve).collect() if r["fpr"] == 0.0} == {0.0, 0.5}
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion_matrix(df, "y", "p", 0.95).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 2, (1, 1): 0}
