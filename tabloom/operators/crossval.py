"""Leakage-safe cross-validation with out-of-fold scores."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.contracts import ContractError, TableContract
from tabloom.operators.features import FitCounts, encoder_pipeline, fit_counts, fit_encoder
from tabloom.operators.learners import (
    build_estimator,
    class_weight,
    positive_probability,
    preprocessing_from_params,
)
from tabloom.operators.ranking import classification_metrics, f2_threshold, ranking_metrics, score_curve
from tabloom.operators.split import stratified_folds
from tabloom.scratch import materialize, spread

TRAIN, VALIDATION = "train", "validation"


def fold_counts(folded: DataFrame, label: str, fold: str = "fold") -> dict[int, tuple[int, int]]:
    """Rows and positive rows per fold."""
    rows = folded.groupBy(fold).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    return {row[fold]: (row["n"], row["positives"]) for row in rows.collect()}  # one row per fold


def prior_scores(folded: DataFrame, label: str, fold: str = "fold", score: str = "p") -> DataFrame:
    """Constant baseline: each row scored with the positive rate of the other folds."""
    counts = fold_counts(folded, label, fold)
    rows = sum(n for n, _ in counts.values())
    positives = sum(p for _, p in counts.values())
    prior = F.lit(None).cast("double")
    for number, (n, p) in counts.items():
        prior = F.when(F.col(fold) == number, F.lit((positives - p) / (rows - n))).otherwise(prior)
    return folded.withColumn(score, prior)


def balanced_weight(label: str, rows: int, positives: int) -> Column:
    """Balanced class weights as literals."""
    return F.when(F.col(label) == 1, F.lit(rows / (2 * positives))).otherwise(
        F.lit(rows / (2 * (rows - positives)))
    )


def assemble_oof(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of the out-of-fold predictions of all folds."""
    return reduce(DataFrame.unionByName, parts)


def oof_coverage(development: DataFrame, predictions: DataFrame, identifier: str, score: str = "p") -> DataFrame:
    """Rows that were predicted not at all, or more than once, or without a score."""
    wanted = development.select(
        F.col(identifier).alias("id"), F.lit(1).alias("wanted"), F.lit(0).alias("scored"), F.lit(0).alias("bare")
    )
    found = predictions.select(
        F.col(identifier).alias("id"),
        F.lit(0).alias("wanted"),
        F.lit(1).alias("scored"),
        F.col(score).isNull().cast("int").alias("bare"),
    )
    per_id = wanted.unionByName(found).groupBy("id").agg(
        F.sum("wanted").alias("wanted"), F.sum("scored").alias("scored"), F.sum("bare").alias("bare")
    )
    return per_id.agg(
        F.coalesce(F.sum("wanted"), F.lit(0)).alias("development_rows"),
        F.count_if((F.col("wanted") > 0) & (F.col("scored") == 0)).alias("unpredicted"),
        F.count_if(F.col("scored") > 1).alias("predicted_twice"),
        F.count_if((F.col("wanted") == 0) & (F.col("scored") > 0)).alias("unexpected"),
        F.coalesce(F.sum("bare"), F.lit(0)).alias("without_score"),
    )


def require_full_coverage(coverage: DataFrame) -> None:
    """Raise unless every development row was predicted exactly once."""
    row = coverage.first()
    broken = [name for name in coverage.columns if name != "development_rows" and row[name]]
    if broken:
        raise ContractError("cross-validation did not predict every row once: " + ", ".join(broken))


@dataclass(frozen=True)
class CrossValidation:
    """Fold metrics, one summary row and the out-of-fold scores."""

    folds: DataFrame
    summary: DataFrame
    scores: DataFrame
    threshold: float

    def metrics(self) -> dict[str, float]:
        """The summary as a plain map."""
        return {name: value for name, value in self.summary.first().asDict().items()}


def fold_metrics(scores: DataFrame, label: str, score: str = "p", parts: int | None = None) -> DataFrame:
    """Metrics per fold from scores with columns ``fold`` and ``part``."""
    curve = score_curve(scores, label, score, ["fold", "part"], parts)
    metrics = ranking_metrics(curve)

    def only(part: str, name: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(name)))

    return metrics.groupBy("fold").agg(
        only(TRAIN, "rows").alias("train_rows"),
        only(VALIDATION, "rows").alias("validation_rows"),
        only(TRAIN, "average_precision").alias("train_average_precision"),
        only(VALIDATION, "average_precision").alias("validation_average_precision"),
        only(VALIDATION, "roc_auc").alias("validation_roc_auc"),
        only(VALIDATION, "brier_score").alias("validation_brier_score"),
    )


def fold_summary(folds: DataFrame) -> DataFrame:
    """Means, sample deviations and the train-validation gap over folds."""
    return folds.agg(
        F.count("*").alias("cv_folds"),
        F.sum("validation_rows").alias("development_rows"),
        F.avg("validation_average_precision").alias("validation_average_precision_mean"),
        F.stddev_samp("validation_average_precision").alias("validation_average_precision_std"),
        F.avg("train_average_precision").alias("train_average_precision_mean"),
        (F.avg("train_average_precision") - F.avg("validation_average_precision")).alias(
            "average_precision_gap"
        ),
        F.avg("validation_roc_auc").alias("validation_roc_auc_mean"),
        F.stddev_samp("validation_roc_auc").alias("validation_roc_auc_std"),
        F.avg("validation_brier_score").alias("validation_brier_score_mean"),
    )


def cross_validate(
    folded: DataFrame,
    identifier: str,
    label: str,
    folds: int,
    score_rows: Callable[[int], DataFrame],
    parallelism: int = 1,
) -> CrossValidation:
    """Score every row with every fold's model and judge each model.

    ``score_rows(fold)`` fits on all other folds and returns the whole folded
    table with a column ``p``.  Up to ``parallelism`` folds fit at a time.
    """
    if folds < 3:
        raise ValueError("folds must be at least 3")
    with ThreadPool(min(parallelism, folds)) as pool:
        fitted = pool.map(score_rows, range(1, folds + 1))
    scored = [
        df.select(
            identifier,
            label,
            F.lit(number).alias("fold"),
            F.when(F.col("fold") == number, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)).alias("part"),
            "p",
        )
        for number, df in enumerate(fitted, start=1)
    ]
    scores = materialize(reduce(DataFrame.unionByName, scored), "cv", partition_by=("part",))
    oof = scores.where(F.col("part") == VALIDATION)
    require_full_coverage(oof_coverage(folded, oof, identifier))
    per_fold = materialize(fold_metrics(scores, label), "folds")
    curve = score_curve(oof, label, "p")
    threshold = f2_threshold(curve)
    at_threshold = classification_metrics(curve.table, threshold)
    rows = folded.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))
    # Three one-row tables side by side, through one aggregate instead of a join.
    summary = (
        fold_summary(per_fold)
        .unionByName(rows, allowMissingColumns=True)
        .unionByName(
            at_threshold.select(*[F.col(name).alias(f"oof_{name}") for name in at_threshold.columns]),
            allowMissingColumns=True,
        )
    )
    summary = summary.agg(*[F.max(name).alias(name) for name in summary.columns]).withColumn(
        "oof_threshold", F.lit(threshold)
    )
    return CrossValidation(per_fold, summary, oof, threshold)


def pipeline_scorer(
    folded: DataFrame,
    counts: FitCounts,
    contract: TableContract,
    params: Mapping[str, str],
    seed: int,
) -> Callable[[int], DataFrame]:
    """Scoring function of a full pipeline: encoder and classifier per fold."""
    label = contract.label
    config = preprocessing_from_params(params)
    sizes = fold_counts(folded, label)

    def score_rows(number: int) -> DataFrame:
        others = [pair for fold, pair in sizes.items() if fold != number]
        rows, positives = sum(n for n, _ in others), sum(p for _, p in others)
        encoder = encoder_pipeline(fit_encoder(counts.without(number), contract, config), folded)
        # Encoded once per fold: an estimator reads its rows several times, and all rows are scored.
        wanted = [contract.identifier, label, "fold", "features"]
        encoded = materialize(encoder.transform(folded).select(*wanted), "encoded")
        train = encoded.where(F.col("fold") != number)
        weight = None
        if class_weight(params):
            train = train.withColumn("weight", balanced_weight(label, rows, positives))
            weight = "weight"
        estimator = build_estimator(params, rows, seed, label=label, weight=weight)
        scored = estimator.fit(spread(train, rows)).transform(encoded)
        return scored.withColumn("p", positive_probability())

    return score_rows


def cross_validate_pipeline(
    df: DataFrame,
    contract: TableContract,
    params: Mapping[str, str],
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 1,
) -> CrossValidation:
    """Fold the table, fit and judge one parameter map."""
    columns = [contract.identifier, *contract.features, contract.label]
    folded = materialize(
        stratified_folds(df.select(*columns), contract.identifier, contract.label, folds, seed),
        "folded",
        partition_by=("fold",),
    )
    counts = fit_counts(folded, contract, part="fold")
    scorer = pipeline_scorer(folded, counts, contract, params, seed)
    return cross_validate(folded, contract.identifier, contract.label, folds, scorer, parallelism)


def cross_validate_prior(
    df: DataFrame, identifier: str, label: str, folds: int = 5, seed: int = 42
) -> CrossValidation:
    """Baseline that scores every row with its fold's training prior."""
    folded = materialize(
        stratified_folds(df.select(identifier, label), identifier, label, folds, seed), "folded"
    )
    sizes = fold_counts(folded, label)

    def score_rows(number: int) -> DataFrame:
        others = [pair for fold, pair in sizes.items() if fold != number]
        prior = sum(p for _, p in others) / sum(n for n, _ in others)
        return folded.withColumn("p", F.lit(prior))

    return cross_validate(folded, identifier, label, folds, score_rows)
