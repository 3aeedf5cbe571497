"""Audit of a thresholded score by a protected group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.clean import group_label, ratio
from tabloom.operators.ranking import ranking_aggregates, score_curve


def fairness_by_group(
    df: DataFrame,
    label: str,
    score: str,
    group: str,
    threshold: float,
    minimum_rows: int = 30,
    parts: int | None = None,
) -> DataFrame:
    """Rates, recall and average precision per group; NULL is a group of its own.

    Groups below ``minimum_rows`` are left out, and average precision is NULL
    for a group with one class only.
    """
    keyed = df.withColumn("group", group_label(F.col(group)))
    curve = score_curve(keyed, label, score, ["group"], parts)
    above = F.col("score") >= threshold
    tp = F.sum(F.when(above, F.col("positives")).otherwise(0))
    predicted = F.sum(F.when(above, F.col("rows")).otherwise(0))
    rates = [
        (predicted / F.sum("rows")).alias("predicted_positive_rate"),
        ratio(tp, F.sum("positives")).alias("recall"),
    ]
    return (
        curve.table.groupBy("group")
        .agg(*ranking_aggregates(), *rates)
        .where(F.col("rows") >= minimum_rows)
        .select("group", "rows", "positive_rate", "predicted_positive_rate", "recall", "average_precision")
        .orderBy("group")
    )


def fairness_gaps(groups: DataFrame) -> DataFrame:
    """Largest difference between kept groups; NULL when none was kept."""
    return groups.agg(
        (F.max("recall") - F.min("recall")).alias("max_recall_gap"),
        (F.max("predicted_positive_rate") - F.min("predicted_positive_rate")).alias(
            "max_predicted_positive_rate_gap"
        ),
    )
