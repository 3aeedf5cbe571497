"""The modeling flow: prepare, tune on development rows, finalise once."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tabloom.contracts import ContractError, TableContract
from tabloom.operators.capacity import CURVE_FRACTIONS, capacity_metrics
from tabloom.operators.crossval import (
    CrossValidation,
    balanced_weight,
    cross_validate_pipeline,
    cross_validate_prior,
)
from tabloom.operators.fairness import fairness_by_group, fairness_gaps
from tabloom.operators.features import (
    FittedEncoder,
    encoder_pipeline,
    fit_counts,
    fit_encoder,
    fit_numeric,
    preprocessing_candidates,
)
from tabloom.operators.learners import (
    DESIGN_PARAMETERS,
    build_estimator,
    class_weight,
    positive_probability,
    preprocessing_from_params,
)
from tabloom.operators.ranking import (
    classification_metrics,
    confusion_matrix,
    precision_recall_points,
    ranking_metrics,
    roc_points,
    score_curve,
)
from tabloom.operators.search import (
    COMPLETE,
    SEARCH_SPACE_VERSION,
    STUDY_PREFIX,
    completed_trials,
    initial_designs,
    parameter_map,
    require_study_contract,
    top_trials,
    trial_candidates,
)
from tabloom.operators.split import DEVELOPMENT, TEST, split_manifest, stratified_split
from tabloom.scratch import materialize, spread
from tabloom.sources.claims import Claims
from tabloom.sources.registry import ModelRegistry
from tabloom.sources.tables import read_or_empty, write_report

FRACTIONS = (0.25, 0.50, 0.75)
TEST_SIZE = 0.2
TRIAL_SCHEMA = (
    "study string, trial bigint, model_name string, strategy string, include_city boolean,"
    " params map<string,string>, metrics map<string,double>, state string, value double,"
    " source_sha256 string, cv_folds int, random_state int, search_space_version int"
)


def split_table(df: DataFrame, contract: TableContract, test_size: float = TEST_SIZE, seed: int = 42) -> DataFrame:
    """Written split of the modeling table, one folder per partition."""
    columns = [contract.identifier, *contract.features, *contract.protected, contract.label]
    split = stratified_split(df.select(*columns), contract.identifier, contract.label, test_size, seed)
    return materialize(split, "split", partition_by=("split",))


def prepare(df: DataFrame, contract: TableContract, test_size: float = TEST_SIZE, seed: int = 42) -> DataFrame:
    """Encoded width of each preprocessing candidate, fitted on development rows."""
    split = split_table(df, contract, test_size, seed)
    counts = fit_counts(split.where(F.col("split") == DEVELOPMENT), contract)
    rows, numeric = [], fit_numeric(counts, contract.numeric)
    for config in preprocessing_candidates():
        encoder = fit_encoder(counts, contract, config, numeric=numeric)
        rows.append(
            (
                config.name, config.strategy, config.include_city, config.min_category_frequency,
                encoder.width,
            )
        )
    return df.sparkSession.createDataFrame(
        rows,
        "name string, strategy string, include_city boolean, min_category_frequency int,"
        " transformed_feature_count bigint",
    )


def nested_split_manifest(
    split: DataFrame,
    contract: TableContract,
    source_sha256: str,
    test_size: float,
    seed: int,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """One row: features, exclusions with reasons, both partitions; no identifiers."""
    manifest = split_manifest(split, contract.identifier, contract.label)
    partition = F.struct("rows", "positive_rows", "positive_rate", "id_digest")
    nested = manifest.agg(
        F.max(F.when(F.col("split") == DEVELOPMENT, partition)).alias("development"),
        F.max(F.when(F.col("split") == TEST, partition)).alias("test"),
    )
    excluded = [F.lit(item) for pair in contract.excluded.items() for item in pair]
    result = nested.select(
        F.lit(1).alias("schema_version"),
        F.lit(source_sha256).alias("source_sha256"),
        F.lit(seed).alias("random_state"),
        F.lit(test_size).alias("requested_test_size"),
        F.array(*[F.lit(name) for name in contract.features]).alias("features"),
        F.create_map(*excluded).alias("excluded_from_model"),
        "development",
        "test",
    )
    if candidates is None:
        return result
    listed = candidates.orderBy("name").collect()  # four rows
    structs = [
        F.struct(*[F.lit(value).alias(name) for name, value in row.asDict().items()]) for row in listed
    ]
    return result.withColumn("preprocessing_candidates", F.array(*structs))


def trial_plan(
    spark: SparkSession, completed: DataFrame, first_trial: int, count: int, seed: int
) -> list[dict[str, str]]:
    """Parameter maps of the next trials: open initial designs first, then random draws."""
    done = {
        (row["model_name"], row["strategy"], str(row["include_city"]).lower())
        for row in completed.select("model_name", "strategy", "include_city").distinct().collect()
    }  # at most one entry per design
    designs = [
        design
        for design in initial_designs()
        if (design["model_name"], design["preprocessing_strategy"], design["include_city"]) not in done
    ][:count]
    free = spark.range(first_trial + len(designs), first_trial + count).select(F.col("id").alias("trial"))
    plan = trial_candidates(free, ["trial"], seed)
    if designs:
        rows = [
            (first_trial + number, *[design[name] for name in DESIGN_PARAMETERS])
            for number, design in enumerate(designs)
        ]
        schema = ", ".join(["trial bigint", *[f"{name} string" for name in DESIGN_PARAMETERS]])
        open_designs = trial_candidates(
            spark.createDataFrame(rows, schema), ["trial"], seed, fixed=DESIGN_PARAMETERS
        )
        plan = open_designs.unionByName(plan)
    ordered = plan.select("trial", parameter_map(plan).alias("params")).orderBy("trial")
    return [dict(row["params"]) for row in ordered.collect()]  # one row per trial to run


@dataclass(frozen=True)
class Study:
    """Trials of one data hash, fold count, seed and search-space version."""

    spark: SparkSession
    store: str
    source_sha256: str
    cv_folds: int = 5
    seed: int = 42

    @property
    def name(self) -> str:
        return f"{STUDY_PREFIX}-v{SEARCH_SPACE_VERSION}-{self.source_sha256[:12]}-cv{self.cv_folds}"

    @property
    def reports(self) -> str:
        return f"{self.store}/reports"

    @property
    def contract(self) -> dict[str, object]:
        return {
            "source_sha256": self.source_sha256,
            "cv_folds": self.cv_folds,
            "random_state": self.seed,
            "search_space_version": SEARCH_SPACE_VERSION,
        }

    def trials(self) -> DataFrame:
        stored = read_or_empty(self.spark, f"{self.store}/trials", TRIAL_SCHEMA)
        return stored.where(F.col("study") == self.name)

    def append(self, trial: int, params: Mapping[str, str], result: CrossValidation) -> float:
        metrics = {name: float(value) for name, value in result.metrics().items() if value is not None}
        value = metrics["validation_average_precision_mean"]
        row = (
            self.name, trial, params["model_name"], params["preprocessing_strategy"],
            params["include_city"] == "true", dict(params), metrics, COMPLETE, value,
            self.source_sha256, self.cv_folds, self.seed, SEARCH_SPACE_VERSION,
        )
        self.spark.createDataFrame([row], TRIAL_SCHEMA).write.mode("append").parquet(f"{self.store}/trials")
        return value


def check_tuning(target_trials: int, cv_folds: int, timeout_minutes: float) -> None:
    """Refuse a search that could not try every design or would never stop."""
    designs = len(initial_designs())
    limits = {
        f"a search tries each of the {designs} designs": target_trials >= designs,
        "a trial needs three folds or more": cv_folds >= 3,
        "a search needs some time": timeout_minutes > 0,
    }
    broken = [rule for rule, holds in limits.items() if not holds]
    if broken:
        raise ValueError("; ".join(broken))


def tune(
    df: DataFrame,
    contract: TableContract,
    study: Study,
    target_trials: int = 24,
    timeout_minutes: float = 30.0,
    parallelism: int = 1,
    evaluate: Callable[[DataFrame, Mapping[str, str]], CrossValidation] | None = None,
) -> DataFrame:
    """Resume or start a study on development rows and return its best trials."""
    check_tuning(target_trials, study.cv_folds, timeout_minutes)
    require_study_contract(study.trials(), study.contract)
    split = split_table(df, contract, seed=study.seed)
    development = split.where(F.col("split") == DEVELOPMENT)
    write_report(
        nested_split_manifest(split, contract, study.source_sha256, TEST_SIZE, study.seed),
        f"{study.reports}/split_manifest",
    )

    def default(rows: DataFrame, params: Mapping[str, str]) -> CrossValidation:
        return cross_validate_pipeline(rows, contract, params, study.cv_folds, study.seed, parallelism)

    evaluate = evaluate or default
    completed = study.trials().where(F.col("state") == COMPLETE)
    done = completed.count()
    first_trial = (study.trials().agg(F.max("trial")).first()[0] or 0) + 1
    deadline = time.monotonic() + timeout_minutes * 60
    remaining = max(0, target_trials - done)
    for number, params in enumerate(
        trial_plan(study.spark, completed, first_trial, remaining, study.seed) if remaining else []
    ):
        if time.monotonic() >= deadline:
            break
        study.append(first_trial + number, params, evaluate(development, params))
    baseline = cross_validate_prior(
        development, contract.identifier, contract.label, study.cv_folds, study.seed
    )
    summary = selection_summary(study, baseline)
    write_report(summary, f"{study.reports}/model_selection_summary")
    return summary


def selection_summary(study: Study, baseline: CrossValidation) -> DataFrame:
    """One row: completed trials, the best one, the ten best and the baseline."""
    best = top_trials(study.trials()).select("trial", "value", "params", "metrics")
    completed = completed_trials(study.trials()).count()
    if not completed:
        raise ContractError("the study has no completed trial")
    ranked = best.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("value")).alias("order"), "trial", "value",
                                    F.to_json("params").alias("params"), F.to_json("metrics").alias("metrics")))
        ).alias("top_trials")
    )  # at most ten entries
    return ranked.select(
        F.lit(1).alias("schema_version"),
        F.lit(study.name).alias("study"),
        F.lit(study.source_sha256).alias("source_sha256"),
        F.lit(False).alias("test_set_used"),
        F.lit(completed).alias("completed_trials"),
        F.element_at("top_trials", 1).alias("best_trial"),
        "top_trials",
        F.lit(json.dumps(baseline.metrics(), sort_keys=True)).alias("dummy_baseline"),
    )


def holdout_report(
    df: DataFrame,
    identifier: str,
    label: str,
    score: str,
    threshold: float,
    fractions: tuple[float, ...] = FRACTIONS,
) -> DataFrame:
    """All ranking, threshold and capacity metrics of one scored table, in long form."""
    curve = score_curve(df, label, score)
    ranking = ranking_metrics(curve)
    at_threshold = classification_metrics(curve.table, threshold)
    capacity = capacity_metrics(df, identifier, label, score, fractions, curve)

    def tall(wide: DataFrame) -> DataFrame:
        doubles = wide.select(*[F.col(name).cast("double").alias(name) for name in wide.columns])
        return doubles.unpivot([], doubles.columns, "metric", "value")

    per_capacity = capacity.select(
        F.concat(
            F.lit("capacity_"), F.round(F.col("selection_fraction") * 100).cast("int").cast("string")
        ).alias("name"),
        *[
            F.col(name).cast("double").alias(name)
            for name in (
                "selected_rows", "baseline_rate", "selected_rate", "absolute_reduction", "relative_reduction",
            )
        ],
    ).unpivot(
        "name",
        ["selected_rows", "baseline_rate", "selected_rate", "absolute_reduction", "relative_reduction"],
        "part",
        "value",
    ).select(F.concat_ws("_", "name", "part").alias("metric"), "value")
    fixed = df.sparkSession.createDataFrame([("threshold", float(threshold))], "metric string, value double")
    return tall(ranking).unionByName(tall(at_threshold)).unionByName(fixed).unionByName(per_capacity)


@dataclass(frozen=True)
class FinalModel:
    """The fitted pipeline with its hold-out and fairness reports."""

    model: PipelineModel
    encoder: FittedEncoder
    holdout: DataFrame
    fairness: DataFrame
    gaps: DataFrame
    scores: DataFrame


def fit_final(
    split: DataFrame,
    contract: TableContract,
    params: Mapping[str, str],
    threshold: float,
    seed: int = 42,
) -> FinalModel:
    """Fit on development rows, score the test rows once and judge them."""
    label = contract.label
    development = split.where(F.col("split") == DEVELOPMENT)
    test = split.where(F.col("split") == TEST)
    counts = fit_counts(development, contract)
    encoder = fit_encoder(counts, contract, preprocessing_from_params(params))
    stages = encoder_pipeline(encoder, development)
    train, weight, used = development, None, [*contract.features, label]
    rows, positives = development.agg(F.count("*"), F.sum(F.col(label).cast("bigint"))).first()
    if class_weight(params):
        train = development.withColumn("weight", balanced_weight(label, rows, positives))
        weight = "weight"
        used.append(weight)
    estimator = build_estimator(params, rows, seed, label=label, weight=weight)
    # A fit asks for its rows several times, and would deal them anew each time.  A kept table stays dealt.
    dealt = spread(train.select(*used), rows).persist(StorageLevel.DISK_ONLY)
    try:
        classifier = estimator.fit(stages.transform(dealt))
    finally:
        dealt.unpersist()
    model = PipelineModel(stages=[*stages.stages, classifier])
    scored = materialize(
        model.transform(test).select(
            contract.identifier, *contract.protected, label, positive_probability().alias("p")
        ),
        "test-scores",
    )
    fairness = fairness_by_group(scored, label, "p", contract.protected[0], threshold)
    return FinalModel(
        model,
        encoder,
        holdout_report(scored, contract.identifier, label, "p", threshold),
        fairness,
        fairness_gaps(fairness),
        scored,
    )


def reviewed_trial(study: Study) -> Row:
    """The best trial of the written selection summary, which must belong to this study.

    The summary is what a person has looked at, so it decides, not the trials
    that came after it; its trial must still be stored with the same parameters.
    """
    require_study_contract(study.trials(), study.contract)
    try:
        summary = study.spark.read.json(f"{study.reports}/model_selection_summary").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ContractError("the study has no selection summary; run the search first") from None
    wanted = {"schema_version": 1, "study": study.name, "source_sha256": study.source_sha256, "test_set_used": False}
    broken = sorted(name for name, value in wanted.items() if summary[name] != value)
    if broken:
        raise ContractError("the selection summary belongs to something else: " + ", ".join(broken))
    best = summary["best_trial"]
    trial = study.trials().where((F.col("trial") == best["trial"]) & (F.col("state") == COMPLETE)).first()
    if trial is None or dict(trial["params"]) != json.loads(best["params"]):
        raise ContractError(f"trial {best['trial']} of the selection summary is not stored as reviewed")
    return trial


def write_curves(final: FinalModel, contract: TableContract, threshold: float, folder: str) -> None:
    """The curve reports of a final model, from its written scores."""
    label = contract.label
    curve = score_curve(final.scores, label, "p")
    capacities = capacity_metrics(final.scores, contract.identifier, label, "p", CURVE_FRACTIONS, curve)
    write_report(precision_recall_points(curve), f"{folder}/precision_recall_curve")
    write_report(roc_points(curve), f"{folder}/roc_curve")
    write_report(confusion_matrix(final.scores, label, "p", threshold), f"{folder}/confusion_matrix")
    write_report(capacities, f"{folder}/capacity_curve")


def finalize(
    df: DataFrame,
    contract: TableContract,
    study: Study,
    registry: ModelRegistry,
    model_name: str,
    allow_test_reevaluation: bool = False,
) -> FinalModel:
    """Evaluate the reviewed trial on the test rows once and register it as candidate.

    The evaluation is claimed before the test rows are read: of runs at the same
    time at most one evaluates, and a crash later on does not allow a second look.
    """
    best = reviewed_trial(study)
    claims, owner = Claims(study.spark, f"{study.store}/evaluations"), f"{study.name}, trial {best['trial']}"
    if not claims.take("test rows", owner):
        if not allow_test_reevaluation:
            raise ContractError("the test rows were already evaluated; do not reuse them for selection")
        claims.repeat("test rows", owner)
    split = split_table(df, contract, seed=study.seed)
    final = fit_final(split, contract, best["params"], best["metrics"]["oof_threshold"], study.seed)
    metrics = {
        f"test_{row['metric']}": row["value"]
        for row in final.holdout.collect()  # one row per metric
        if row["value"] is not None
    }
    version = registry.register(
        model_name,
        final.model,
        split.where(F.col("split") == DEVELOPMENT).orderBy(contract.identifier).limit(5),
        features=contract.features,
        source_sha256=study.source_sha256,
        study=study.name,
        trial=best["trial"],
        preprocessing=final.encoder.config.name,
        parameters=best["params"],
        test_metrics=metrics,
    )
    registry.promote(model_name, "candidate", version, split)
    write_report(final.holdout, f"{study.reports}/final_evaluation")
    write_report(final.fairness, f"{study.reports}/fairness_by_group")
    write_report(final.gaps, f"{study.reports}/fairness_gaps")
    write_curves(final, contract, best["metrics"]["oof_threshold"], study.reports)
    return final
