"""Seeded random search space, trial tables and study contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.contracts import ContractError
from tabloom.operators.features import STRATEGIES
from tabloom.operators.learners import MODEL_NAMES

#: 2: boosted trees with a leaf count and leaf penalties.
SEARCH_SPACE_VERSION = 2
COMPLETE = "COMPLETE"
STUDY_PREFIX = "tabular-study"


@dataclass(frozen=True)
class Parameter:
    """Range of one searched parameter, and the model it belongs to."""

    name: str
    model: str | None = None
    choices: tuple[str, ...] = ()
    low: float = 0.0
    high: float = 0.0
    step: int = 1
    whole: bool = False
    log: bool = False


# The ranges of the search space.
SEARCH_SPACE = (
    Parameter("preprocessing_strategy", choices=STRATEGIES),
    Parameter("include_city", choices=("false", "true")),
    Parameter("min_category_frequency", choices=("5", "10", "25", "50")),
    Parameter("model_name", choices=MODEL_NAMES),
    Parameter("logistic_c", "logistic_regression", low=1e-3, high=1e2, log=True),
    Parameter("logistic_l1_ratio", "logistic_regression", choices=("0.0", "1.0")),
    Parameter("logistic_class_weight", "logistic_regression", choices=("none", "balanced")),
    Parameter("rf_n_estimators", "random_forest", low=200, high=700, step=100, whole=True),
    Parameter("rf_max_depth", "random_forest", low=4, high=20, whole=True),
    Parameter("rf_min_samples_leaf", "random_forest", low=1, high=30, whole=True, log=True),
    Parameter("rf_max_features", "random_forest", choices=("sqrt", "log2", "0.5")),
    Parameter(
        "rf_class_weight", "random_forest", choices=("none", "balanced", "balanced_subsample")
    ),
    Parameter("gbt_n_estimators", "gradient_boosting", low=100, high=800, step=50, whole=True),
    Parameter("gbt_learning_rate", "gradient_boosting", low=0.01, high=0.20, log=True),
    Parameter("gbt_num_leaves", "gradient_boosting", low=15, high=127, whole=True),
    Parameter("gbt_max_depth", "gradient_boosting", low=3, high=14, whole=True),
    Parameter("gbt_min_child_samples", "gradient_boosting", low=10, high=100, whole=True),
    Parameter("gbt_subsample", "gradient_boosting", low=0.60, high=1.0),
    Parameter("gbt_colsample_bytree", "gradient_boosting", low=0.60, high=1.0),
    Parameter("gbt_reg_alpha", "gradient_boosting", low=1e-8, high=10.0, log=True),
    Parameter("gbt_reg_lambda", "gradient_boosting", low=1e-8, high=10.0, log=True),
    Parameter("gbt_class_weight", "gradient_boosting", choices=("none", "balanced")),
)


def initial_designs() -> list[dict[str, str]]:
    """The designs tried first: every model with every preprocessing candidate."""
    return [
        {
            "model_name": model,
            "preprocessing_strategy": strategy,
            "include_city": include_city,
            "min_category_frequency": "10",
        }
        for model, strategy, include_city in product(MODEL_NAMES, STRATEGIES, ("false", "true"))
    ]


def hash_uniform(seed: int, *keys: Column) -> Column:
    """Number in [0, 1) that depends on seed and keys only."""
    text = F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def _draw(parameter: Parameter, uniform: Column) -> Column:
    if parameter.choices:
        index = F.floor(uniform * len(parameter.choices)).cast("int")
        return F.element_at(F.array(*[F.lit(choice) for choice in parameter.choices]), index + 1)
    low, high = F.lit(float(parameter.low)), F.lit(float(parameter.high))
    if parameter.whole and parameter.log:
        value = F.least(F.floor(F.exp(F.ln(low) + uniform * (F.ln(high + 1) - F.ln(low)))), F.floor(high))
        return value.cast("bigint")
    if parameter.whole:
        steps = int(parameter.high - parameter.low) // parameter.step + 1
        return (F.lit(int(parameter.low)) + parameter.step * F.floor(uniform * steps)).cast("bigint")
    if parameter.log:
        return F.exp(F.ln(low) + uniform * (F.ln(high) - F.ln(low)))
    return low + uniform * (high - low)


def trial_candidates(
    trials: DataFrame, keys: Sequence[str], seed: int = 42, fixed: Sequence[str] = ()
) -> DataFrame:
    """One column per parameter for each trial key; NULL for other models' parameters.

    Every value is a hash of seed, trial and parameter, so a trial gets the
    same parameters on any cluster and in any order.  Parameters named in
    ``fixed`` are taken from ``trials`` instead.
    """
    drawn = {
        parameter.name: F.col(parameter.name)
        if parameter.name in fixed
        else _draw(parameter, hash_uniform(seed, *[F.col(key) for key in keys], F.lit(parameter.name)))
        for parameter in SEARCH_SPACE
    }
    return trials.select(
        *keys,
        *[
            (
                drawn[parameter.name]
                if parameter.model is None
                else F.when(drawn["model_name"] == parameter.model, drawn[parameter.name])
            ).alias(parameter.name)
            for parameter in SEARCH_SPACE
        ],
    )


def parameter_map(candidates: DataFrame) -> Column:
    """The set parameters of a candidate row as a text map."""
    entries = F.array(
        *[
            F.struct(F.lit(parameter.name).alias("key"), F.col(parameter.name).cast("string").alias("value"))
            for parameter in SEARCH_SPACE
            if parameter.name in candidates.columns
        ]
    )
    return F.map_from_entries(F.filter(entries, lambda entry: entry["value"].isNotNull()))


def logged_parameter(column: Column) -> Column:
    """NULL is logged as the word none."""
    return F.coalesce(column.cast("string"), F.lit("none"))


def stored_parameter(column: Column) -> Column:
    """The word none is read back as NULL."""
    return F.nullif(column, F.lit("none"))


def study_name(source_sha256: Column, cv_folds: Column) -> Column:
    """Key that separates scores of other data, folds or search spaces."""
    return F.concat_ws(
        "-",
        F.lit(f"{STUDY_PREFIX}-v{SEARCH_SPACE_VERSION}"),
        F.substring(source_sha256, 1, 12),
        F.concat(F.lit("cv"), cv_folds.cast("string")),
    )


def completed_trials(trials: DataFrame) -> DataFrame:
    """Trials that ended with a finite objective."""
    return trials.where(
        (F.col("state") == COMPLETE) & ~F.isnan("value") & (F.abs("value") < float("inf"))
    )


def remaining_trials(trials: DataFrame, target: int, study: str = "study") -> DataFrame:
    """Completed and still missing trials per study."""
    return trials.groupBy(study).agg(
        F.count_if(F.col("state") == COMPLETE).alias("completed"),
        F.greatest(F.lit(0), F.lit(target) - F.count_if(F.col("state") == COMPLETE)).alias("remaining"),
    )


def pending_designs(trials: DataFrame, study: str = "study") -> DataFrame:
    """Initial designs without a completed trial, per study."""
    designs = F.array(
        *[
            F.struct(
                F.lit(design["model_name"]).alias("model_name"),
                F.lit(design["preprocessing_strategy"]).alias("strategy"),
                F.lit(design["include_city"] == "true").alias("include_city"),
            )
            for design in initial_designs()
        ]
    )
    wanted = trials.select(study).distinct().select(study, F.inline(designs))
    done = (
        trials.where(F.col("state") == COMPLETE)
        .select(study, "model_name", "strategy", "include_city")
        .distinct()
    )
    return wanted.join(done, [study, "model_name", "strategy", "include_city"], "left_anti")


def contract_breaks(trials: DataFrame, expected: dict[str, object], study: str = "study") -> DataFrame:
    """Trials per study whose stored contract differs; a missing value is no conflict."""
    return trials.groupBy(study).agg(
        F.count("*").alias("trials"),
        *[
            F.count_if(F.col(name).isNotNull() & (F.col(name) != F.lit(value))).alias(f"other_{name}")
            for name, value in expected.items()
        ],
    )


def require_study_contract(trials: DataFrame, expected: dict[str, object]) -> None:
    """Refuse to resume a study that was started under another contract."""
    row = trials.agg(
        *[
            F.count_if(F.col(name).isNotNull() & (F.col(name) != F.lit(value))).alias(name)
            for name, value in expected.items()
        ]
    ).first()
    broken = [name for name in expected if row[name]]
    if broken:
        raise ContractError("study contract mismatch: " + ", ".join(broken))


def top_trials(trials: DataFrame, k: int = 10) -> DataFrame:
    """The k best completed trials, the earlier one on ties."""
    return completed_trials(trials).orderBy(F.desc("value"), F.asc("trial")).limit(k)


def finite_metrics(metrics: DataFrame, value: str = "value") -> DataFrame:
    """Rows with a finite number."""
    return metrics.where(
        F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) < float("inf"))
    )
