"""Learners, cross-validation, the search and the final evaluation."""

import math

import pytest
from conftest import people_rows
from pyspark.sql import functions as F

from tabloom.contracts import PEOPLE, ContractError
from tabloom.operators import crossval, learners, search
from tabloom.plans import modeling
from tabloom.plans.catalogue import LOGISTIC
from tabloom.sources import manifests, tables
from tabloom.sources.registry import ModelRegistry

ROWS = 400


@pytest.fixture(scope="module")
def labelled(spark):
    """People whose label follows the development index, with some noise."""
    from conftest import PEOPLE_SCHEMA

    rows = people_rows(ROWS)
    for i, row in enumerate(rows):
        row["city_development_index"] = None if i % 37 == 0 else (i * 7919 % 1009) / 1009
        row["target"] = int((row["city_development_index"] or 0.5) + 0.3 * ((i * 31 % 11) / 11 - 0.5) > 0.6)
    return spark.createDataFrame(rows, PEOPLE_SCHEMA)


PARAMS = {
    "logistic_regression": {"logistic_c": "2.0", "logistic_l1_ratio": "1.0", "logistic_class_weight": "none"},
    "random_forest": {
        "rf_n_estimators": "5", "rf_max_depth": "4", "rf_min_samples_leaf": "2", "rf_max_features": "sqrt",
        "rf_class_weight": "balanced_subsample",
    },
    "gradient_boosting": {
        "gbt_n_estimators": "3", "gbt_learning_rate": "0.1", "gbt_max_depth": "9", "gbt_num_leaves": "6",
        "gbt_reg_alpha": "0.001", "gbt_reg_lambda": "0.1",
        "gbt_min_child_samples": "5", "gbt_subsample": "0.8", "gbt_colsample_bytree": "0.9",
        "gbt_class_weight": "none",
    },
}
DESIGN = {"preprocessing_strategy": "ordinal_aware", "include_city": "true", "min_category_frequency": "5"}


def test_estimator_parameters(spark):
    logistic = learners.build_estimator({"model_name": "logistic_regression"} | PARAMS["logistic_regression"], 100)
    assert logistic.getRegParam() == pytest.approx(1 / 200)
    assert logistic.getElasticNetParam() == 1.0 and not logistic.getStandardization()
    boosting = learners.build_estimator({"model_name": "gradient_boosting"} | PARAMS["gradient_boosting"], 100)
    assert boosting.getOrDefault("maxDepth") == 9 and boosting.getOrDefault("numLeaves") == 6
    with pytest.raises(ValueError, match="rf_max_depth"):
        learners.build_estimator({"model_name": "random_forest"} | PARAMS["random_forest"] | {"rf_max_depth": "31"}, 100)
    assert boosting.getOrDefault("featureShare") == 0.9 and boosting.getOrDefault("regLambda") == 0.1
    with pytest.raises(ValueError, match="logistic_c"):
        learners.build_estimator({"model_name": "logistic_regression"}, 100)
    with pytest.raises(ValueError, match="unsupported"):
        learners.build_estimator({"model_name": "svm"}, 100)
    with pytest.raises(ValueError, match="include_city, min_category_frequency, preprocessing_strategy"):
        learners.preprocessing_from_params({"model_name": "svm"})


@pytest.mark.parametrize("name", learners.MODEL_NAMES)
def test_every_model_beats_the_prior(labelled, name):
    params = {"model_name": name} | DESIGN | PARAMS[name]
    result = crossval.cross_validate_pipeline(labelled, PEOPLE, params, folds=3, parallelism=3)
    summary = result.metrics()
    assert summary["development_rows"] == ROWS and summary["cv_folds"] == 3
    assert summary["validation_average_precision_mean"] > summary["positive_rate"] + 0.2
    assert summary["validation_roc_auc_mean"] > 0.8
    assert 0 < summary["oof_threshold"] < 1 and summary["oof_recall"] > 0.5
    assert result.scores.count() == ROWS and result.scores.select("enrollee_id").distinct().count() == ROWS


def test_prior_baseline(labelled):
    result = crossval.cross_validate_prior(labelled, "enrollee_id", "target", folds=4)
    rate = labelled.agg(F.avg("target")).first()[0]
    for row in result.folds.collect():
        assert row["validation_roc_auc"] == 0.5
        assert row["validation_average_precision"] == pytest.approx(rate, abs=0.02)


def test_incomplete_predictions_are_refused(spark):
    development = spark.range(5).withColumnRenamed("id", "k")
    found = spark.createDataFrame([(0, 0.1), (1, 0.2), (1, 0.2), (9, 0.1), (2, None)], "k bigint, p double")
    coverage = crossval.oof_coverage(development, found, "k")
    assert tuple(coverage.first()) == (5, 2, 1, 1, 1)
    with pytest.raises(ContractError, match="unpredicted, predicted_twice, unexpected, without_score"):
        crossval.require_full_coverage(coverage)


def test_holdout_threshold_and_final_model(labelled):
    split = modeling.split_table(labelled, PEOPLE)
    final = modeling.fit_final(split, PEOPLE, LOGISTIC, 0.5)
    metrics = {r["metric"]: r["value"] for r in final.holdout.collect()}
    assert metrics["rows"] == ROWS * 0.2 and metrics["roc_auc"] > 0.8
    assert metrics["capacity_25_selected_rows"] == 20 and metrics["capacity_25_selected_rate"] < metrics["positive_rate"]
    assert {r["group"] for r in final.fairness.collect()} <= {"Male", "__MISSING__"}


def test_split_manifest_document(labelled):
    split = modeling.split_table(labelled, PEOPLE)
    candidates = modeling.prepare(labelled, PEOPLE)
    manifest = modeling.nested_split_manifest(split, PEOPLE, "a" * 64, 0.2, 42, candidates)
    row = manifest.first()
    assert row["development"]["rows"] == 320 and row["test"]["rows"] == 80
    assert row["excluded_from_model"]["training_hours"] == PEOPLE.excluded["training_hours"]
    assert [c["name"] for c in row["preprocessing_candidates"]][0] == "all_ohe_with_city"
    assert "enrollee_id" not in row["features"]


def test_designs_and_candidates(spark):
    designs = search.initial_designs()
    assert len({tuple(sorted(d.items())) for d in designs}) == 12
    trials = spark.range(300).select(F.lit("s").alias("study"), F.col("id").alias("trial"))
    drawn = search.trial_candidates(trials, ["study", "trial"]).collect()
    again = search.trial_candidates(trials.orderBy(F.rand(1)).repartition(5), ["study", "trial"]).collect()
    assert sorted(map(str, drawn)) == sorted(map(str, again))
    for parameter in search.SEARCH_SPACE:
        values = {row[parameter.name] for row in drawn} - {None}
        if parameter.choices:
            assert values == set(parameter.choices)
        else:
            assert parameter.low <= min(values) and max(values) <= parameter.high
            if parameter.whole and not parameter.log:
                assert all((v - parameter.low) % parameter.step == 0 for v in values)
        for row in drawn:
            assert (row[parameter.name] is None) == (parameter.model not in (None, row["model_name"]))
    mapped = search.trial_candidates(trials, ["study", "trial"])
    for row in mapped.select(search.parameter_map(mapped).alias("m")).limit(20).collect():
        learners.build_estimator(row["m"], 100)
        learners.preprocessing_from_params(row["m"])


def test_trial_tables(spark):
    rows = [(i, "COMPLETE" if i % 2 else "FAIL", v) for i, v in enumerate([0.1, 0.5, 0.9, 0.5, 0.2, float("nan")])]
    trials = spark.createDataFrame(rows, "trial int, state string, value double").withColumn("study", F.lit("s"))
    assert [r["trial"] for r in search.top_trials(trials).collect()] == [1, 3]
    assert tuple(search.remaining_trials(trials, 2).first()) == ("s", 3, 0)
    assert search.finite_metrics(trials).count() == 5
    assert spark.range(1).select(search.logged_parameter(F.lit(None))).first()[0] == "none"


@pytest.mark.parametrize("trials,folds,minutes", [(11, 5, 1), (12, 2, 1), (12, 5, 0)])
def test_tuning_guards(trials, folds, minutes):
    with pytest.raises(ValueError):
        modeling.check_tuning(trials, folds, minutes)


def test_tune_resumes_and_finalizes_once(spark, labelled, tmp_path):
    study = modeling.Study(spark, str(tmp_path / "study"), "a" * 64, cv_folds=3)
    cheap = crossval.cross_validate_prior(labelled, "enrollee_id", "target", folds=3)
    seen = []

    class Fake:
        def __init__(self, params):
            self.params = params

        def metrics(self):
            value = 0.9 if self.params["model_name"] == "logistic_regression" else 0.1
            value += 0.01 * (self.params["include_city"] == "false")
            return cheap.metrics() | {"validation_average_precision_mean": value, "oof_threshold": 0.5}

    def evaluate(rows, params):
        seen.append(params)
        return Fake(params)

    summary = modeling.tune(labelled, PEOPLE, study, target_trials=13, evaluate=evaluate).first()
    assert len(seen) == 13 and summary["completed_trials"] == 13
    designs = {(p["model_name"], p["preprocessing_strategy"], p["include_city"]) for p in seen[:12]}
    assert len(designs) == 12
    assert summary["best_trial"]["value"] == pytest.approx(0.91)
    modeling.tune(labelled, PEOPLE, study, target_trials=14, evaluate=evaluate)
    assert len(seen) == 14 and study.trials().select("trial").distinct().count() == 14

    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    final = modeling.finalize(labelled, PEOPLE, study, registry, "people")
    assert final.holdout.where("metric = 'roc_auc'").first()["value"] > 0.8
    row = registry.describe("people", "candidate").first()
    catalog = manifests.report_catalog(
        tables.written_reports(spark, study.reports), "run", "name", ["final_evaluation", "roc_curve", "pr_plot", "split_manifest"]
    )
    assert manifests.require_reports(catalog) == ["final_evaluation", "roc_curve", "split_manifest"]
    assert row["version"] == 1 and not math.isnan(row["test_metrics"]["test_roc_auc"])
    with pytest.raises(ContractError, match="already evaluated"):
        modeling.finalize(labelled, PEOPLE, study, registry, "people")
    other = modeling.Study(spark, study.store, "a" * 64, cv_folds=3, seed=7)
    with pytest.raises(ContractError, match="random_state"):
        modeling.tune(labelled, PEOPLE, other, target_trials=14, evaluate=evaluate)


def test_rows_of_a_final_fit_are_dealt_once(spark, people, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def noted(value):
        seen.add(1)
        return value

    spread, asked = modeling.spread, []

    def noting(rows, n):
        asked.append(n)
        name = "city_development_index"
        return spread(rows.withColumn(name, noted.asNondeterministic()(F.col(name))), n)

    monkeypatch.setattr(modeling, "spread", noting)
    modeling.fit_final(modeling.split_table(people, PEOPLE), PEOPLE, LOGISTIC, 0.5)
    assert [seen.value] == asked
