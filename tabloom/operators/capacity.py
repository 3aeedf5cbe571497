"""Selection of the rows with the lowest scores up to a capacity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.prefix import running_totals
from tabloom.operators.ranking import ScoreCurve, score_curve

CURVE_FRACTIONS = tuple(round(0.10 + 0.05 * step, 2) for step in range(19))

_SCHEMA = (
    "selection_fraction double, selected_rows bigint, baseline_rate double,"
    " selected_rate double, absolute_reduction double, relative_reduction double"
)


def _positives_among_first(
    df: DataFrame, identifier: str, label: str, score: str, wanted: dict[float, set[int]], parts: int | None
) -> dict[tuple[float, int], int]:
    """Positives among the first k rows, by identifier, of rows tied on a score."""
    tied = df.where(F.col(score).isin(*wanted)).select(
        F.col(score).alias("score"),
        F.col(identifier).alias("id"),
        F.col(label).cast("bigint").alias("y"),
        F.lit(1).cast("bigint").alias("one"),
    )
    ranked = running_totals(tied, [F.col("id")], {"place": "one", "positives": "y"}, ["score"], parts)
    is_cut = F.lit(False)
    for value, places in wanted.items():
        is_cut = is_cut | ((F.col("score") == F.lit(value)) & F.col("place").isin(*places))
    found = ranked.where(is_cut).select("score", "place", "positives").collect()  # one row per cut
    return {(row["score"], row["place"]): row["positives"] for row in found}


def capacity_metrics(
    df: DataFrame,
    identifier: str,
    label: str,
    score: str,
    fractions: Sequence[float],
    curve: ScoreCurve | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Positive rate among the k lowest scores against the rate of all rows.

    k is the half-even rounded share of the rows, at least 1; ties are taken in
    identifier order.  Only the tied score a capacity ends in is ranked by row.
    """
    for fraction in fractions:
        if not 0 < fraction <= 1:
            raise ValueError("a selected share lies above 0 and does not exceed 1")
    spark = df.sparkSession
    curve = curve or score_curve(df, label, score, parts=parts)
    rows, positives = curve.table.agg(F.sum("rows"), F.sum("positives")).first()
    if not rows:
        return spark.createDataFrame([], _SCHEMA)

    capacity = {float(fraction): max(1, round(rows * fraction)) for fraction in fractions}
    below = F.lit(rows) - F.col("predicted")
    cut = F.explode(
        F.filter(
            F.array(*[F.lit(k).cast("bigint") for k in sorted(set(capacity.values()))]),
            lambda k: (k > below) & (k <= below + F.col("rows")),
        )
    )
    cuts = {
        row["k"]: row
        for row in curve.table.select(
            cut.alias("k"),
            "score",
            "rows",
            "positives",
            below.alias("rows_below"),
            (F.lit(positives) - F.col("tp")).alias("positives_below"),
        ).collect()  # one row per capacity
    }
    ties: dict[float, set[int]] = {}
    for k, row in cuts.items():
        if k < row["rows_below"] + row["rows"]:
            ties.setdefault(row["score"], set()).add(k - row["rows_below"])
    first = _positives_among_first(df, identifier, label, score, ties, parts) if ties else {}

    baseline = positives / rows
    report = []
    for fraction, k in capacity.items():
        row = cuts[k]
        inside = first.get((row["score"], k - row["rows_below"]), row["positives"])
        rate = (row["positives_below"] + inside) / k
        reduction = baseline - rate
        relative = reduction / baseline if baseline else 0.0
        report.append((fraction, k, baseline, rate, reduction, relative))
    return spark.createDataFrame(report, _SCHEMA)


def lowest_scores(df: DataFrame, identifier: str, score: str, k: int) -> DataFrame:
    """The k rows with the lowest scores, ties in identifier order."""
    return df.orderBy(score, identifier).limit(k)
