"""Ranking and threshold metrics of a binary score, exact with ties.

Every metric starts from one table with a row per distinct score (and group):
``positives`` and ``rows`` with that score, plus the running ``tp`` and
``predicted`` counts at or above it.  Ties collapse on the map side before any
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.clean import ratio
from tabloom.operators.prefix import part_count, running_totals, with_next
from tabloom.scratch import materialize

COUNTS = {"tp": "positives", "predicted": "rows"}


def collapse_scores(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Written table with one row per group and distinct score."""
    collapsed = df.groupBy(*groups, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        F.count("*").alias("rows"),
    )
    return materialize(collapsed, "scores")


@dataclass(frozen=True)
class ScoreCurve:
    """Counts at or above each distinct score, and the groups they belong to."""

    table: DataFrame
    groups: tuple[str, ...]


def score_curve(
    df: DataFrame,
    label: str,
    score: str,
    groups: Sequence[str] = (),
    parts: int | None = None,
) -> ScoreCurve:
    """Collapse scores and add the running counts from the highest score down."""
    collapsed = collapse_scores(df, label, score, groups)
    if parts is None:
        parts = part_count(collapsed.count())
    table = running_totals(collapsed, [F.col("score").desc()], COUNTS, groups, parts)
    # Written once: several metrics read the running counts.
    return ScoreCurve(materialize(table, "curve"), tuple(groups))


def ranking_aggregates() -> list[Column]:
    positives = F.sum("positives")
    negatives = F.sum(F.col("rows") - F.col("positives"))
    both = (positives > 0) & (negatives > 0)
    own_negatives = F.col("rows") - F.col("positives")
    false_positives = F.col("predicted") - F.col("tp")
    # Sum over scores of (recall step) x precision, with recall = tp / positives.
    precision_steps = F.sum(F.col("positives") * (F.col("tp") / F.col("predicted")))
    # Negatives ranked above a positive cost 1, ties cost 1/2.
    misranked = F.sum(F.col("positives") * (false_positives - own_negatives / F.lit(2.0)))
    squared = F.sum(
        F.col("positives") * F.pow(F.col("score") - 1, 2) + own_negatives * F.pow(F.col("score"), 2)
    )
    return [
        F.sum("rows").alias("rows"),
        (positives / F.sum("rows")).alias("positive_rate"),
        F.when(both, precision_steps / positives).alias("average_precision"),
        F.when(both, F.lit(1.0) - misranked / (positives.cast("double") * negatives)).alias("roc_auc"),
        (squared / F.sum("rows")).alias("brier_score"),
    ]


def ranking_metrics(curve: ScoreCurve) -> DataFrame:
    """Rows, positive rate, average precision, ROC-AUC and Brier score per group.

    Average precision is the step sum over distinct scores and ROC-AUC gives
    half credit for ties; both are NULL when a class is absent.
    """
    return curve.table.groupBy(*curve.groups).agg(*ranking_aggregates())


def threshold_aggregates(threshold: Column | float) -> list[Column]:
    """Recall, precision, F1 and F2 of ``score >= threshold``, 0 on empty denominators."""
    above = F.col("score") >= threshold
    tp = F.sum(F.when(above, F.col("positives")).otherwise(0))
    predicted = F.sum(F.when(above, F.col("rows")).otherwise(0))
    positives = F.sum("positives")
    return [
        ratio(tp, positives).alias("recall"),
        ratio(tp, predicted).alias("precision"),
        ratio(2 * tp, positives + predicted).alias("f1"),
        ratio(5 * tp, 4 * positives + predicted).alias("f2"),
    ]


def classification_metrics(
    table: DataFrame, threshold: Column | float, groups: Sequence[str] = ()
) -> DataFrame:
    """Threshold metrics from a collapsed score table (or a curve's table)."""
    return table.groupBy(*groups).agg(*threshold_aggregates(threshold))


def row_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Threshold metrics of scored rows, in one aggregate without a row per score."""
    counted = df.select(
        F.col(score).alias("score"), F.col(label).cast("bigint").alias("positives"), F.lit(1).alias("rows")
    )
    return counted.agg(*threshold_aggregates(threshold))


def f2_threshold(curve: ScoreCurve) -> float:
    """Score with the highest F2; the lowest such score on ties, 0.5 without rows."""
    if curve.groups:
        raise ValueError("f2_threshold takes an ungrouped curve")
    positives = curve.table.agg(F.sum("positives")).first()[0]
    if positives is None:
        return 0.5
    # F2 = 5PR / (4P + R) with P = tp / predicted and R = tp / positives.
    f2 = ratio(5 * F.col("tp"), 4 * F.lit(positives) + F.col("predicted"))
    best = curve.table.agg(F.max_by("score", F.struct(f2, -F.col("score")))).first()[0]
    return float(best)


def _totals(curve: ScoreCurve) -> tuple[int, int]:
    if curve.groups:
        raise ValueError("an ungrouped curve is needed")
    row = curve.table.agg(F.sum("rows"), F.sum("positives")).first()
    return (row[0] or 0, row[1] or 0)


def precision_recall_points(curve: ScoreCurve) -> DataFrame:
    """Precision and recall at each threshold, the closing point and the baseline rate."""
    rows, positives = _totals(curve)
    spark = curve.table.sparkSession
    points = curve.table.select(
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.lit(positives)).alias("recall"),
    )
    closing = spark.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    baseline = positives / rows if rows else 0.0
    return points.unionByName(closing).withColumn("baseline", F.lit(baseline))


def _corners(curve: ScoreCurve) -> DataFrame:
    """Points at which the curve's step changes, and both ends.

    A point's own counts are the step that leads to it, so only the step after
    it is looked up.
    """
    steps = with_next(curve.table, [F.col("score").desc()], {"__rows": "rows", "__positives": "positives"})
    changes = (F.col("__positives") != F.col("positives")) | (F.col("__rows") != F.col("rows"))
    ends = F.col("__rows").isNull() | (F.col("predicted") == F.col("rows"))
    return steps.where(ends | changes)


def roc_points(curve: ScoreCurve, every: bool = False) -> DataFrame:
    """False- and true-positive rate at each threshold, and the origin.

    Points between two equal steps lie on a line with their neighbours and are
    left out unless ``every`` is set.
    """
    rows, positives = _totals(curve)
    spark = curve.table.sparkSession
    points = (curve.table if every else _corners(curve)).select(
        F.col("score").alias("threshold"),
        ratio(F.col("predicted") - F.col("tp"), F.lit(rows - positives)).alias("fpr"),
        ratio(F.col("tp"), F.lit(positives)).alias("tpr"),
    )
    origin = spark.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """The four cells (actual, predicted, n); empty cells are kept."""
    predicted = (F.col(score) >= threshold).cast("int")
    cells = [(actual, guess) for actual in (0, 1) for guess in (0, 1)]
    wide = df.agg(
        *[
            F.count_if((F.col(label) == actual) & (predicted == guess)).alias(f"{actual}{guess}")
            for actual, guess in cells
        ]
    )
    tall = wide.unpivot([], [f"{actual}{guess}" for actual, guess in cells], "cell", "n")
    return tall.select(
        F.substring("cell", 1, 1).cast("int").alias("actual"),
        F.substring("cell", 2, 1).cast("int").alias("predicted"),
        "n",
    )


def brier_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Mean squared distance of score and label."""
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier_score"))
