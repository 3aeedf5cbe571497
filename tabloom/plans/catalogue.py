"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.contracts import PEOPLE, ContractError
from tabloom.functions.clean import binary_label, clean_text, remap, safe_double, safe_long
from tabloom.operators import align, boosting, capacity, crossval, digest, fairness, features, learners, prefix, quality, ranking, scoring, search, split, vocabulary
from tabloom.operators.lookup import left_lookup
from tabloom.plans import modeling, views
from tabloom.scratch import materialize, scratch_path
from tabloom.sources import csv, manifests, registry, tables
from tabloom.streaming.requests import score_request_stream
from tabloom.streaming.scoring import read_batches, score_stream, stream_table

Query = Callable[[SparkSession, str], DataFrame]

ID = "enrollee_id"
THRESHOLD = 0.4
FRACTIONS = (0.25, 0.50, 0.75)
FOLDS = 5
STUDY_FOLDS = 3
MIN_FREQUENCY = 10
TARGET_TRIALS = 24
LOGISTIC = {
    "model_name": "logistic_regression",
    "preprocessing_strategy": "ordinal_aware",
    "include_city": "false",
    "min_category_frequency": "10",
    "logistic_c": "1.0",
    "logistic_l1_ratio": "0.0",
    "logistic_class_weight": "balanced",
}
FOREST = {
    **{name: LOGISTIC[name] for name in ("preprocessing_strategy", "include_city", "min_category_frequency")},
    "model_name": "random_forest",
    "rf_n_estimators": "20",
    "rf_max_depth": "6",
    "rf_min_samples_leaf": "5",
    "rf_max_features": "sqrt",
    "rf_class_weight": "balanced",
}
BOOSTING = {
    **{name: LOGISTIC[name] for name in ("preprocessing_strategy", "include_city", "min_category_frequency")},
    "model_name": "gradient_boosting",
    "gbt_n_estimators": "10",
    "gbt_learning_rate": "0.1",
    "gbt_num_leaves": "12",
    "gbt_max_depth": "4",
    "gbt_min_child_samples": "10",
    "gbt_subsample": "1.0",
    "gbt_colsample_bytree": "1.0",
    "gbt_reg_alpha": "0.001",
    "gbt_reg_lambda": "0.1",
    "gbt_class_weight": "none",
}
CONTRACT = {"source_sha256": "a", "cv_folds": 5, "random_state": 42, "search_space_version": 1}
REQUEST = scoring.request_contract(PEOPLE, {"city": (6, 20)})


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Engines add doubles in another order; compare a fixed number of digits."""
    return df.withColumns({name: F.round(F.col(name), digits) for name in columns})


def labelled_people(spark: SparkSession, folder: str) -> DataFrame:
    """The modeling table, written once as later steps scan it, without unlabelled rows.

    The label is judged on the written table: a filter before the write would be
    pushed below the deal, and the tasks of the file would make and cast the labels.
    """
    raw = views.dealt_view(spark, folder, views.RAW_PEOPLE)
    people = materialize(views.modeling_people(spark, folder, raw), "modeling")
    return people.where(F.col("target").isNotNull())


# --- ingest ----------------------------------------------------------------


def clean_strings(spark: SparkSession, folder: str) -> DataFrame:
    raw = views.raw_people(spark, folder)
    return raw.select(*[clean_text(F.col(name)).alias(name) for name in raw.columns])


def typed_cast(spark: SparkSession, folder: str) -> DataFrame:
    raw = views.raw_people(spark, folder)
    return raw.select(
        safe_long(clean_text(F.col(ID))).alias(ID),
        safe_double(clean_text(F.col("city_development_index"))).alias("city_development_index"),
        safe_long(clean_text(F.col("training_hours"))).alias("training_hours"),
        binary_label(clean_text(F.col("target"))).alias("target"),
        binary_label(clean_text(F.col("target"))).cast("tinyint").alias("label"),
    )


def value_remap(spark: SparkSession, folder: str) -> DataFrame:
    spelling = next(c.remap for c in PEOPLE.columns if c.remap)
    return views.raw_people(spark, folder).select(
        ID, remap(clean_text(F.col("relevent_experience")), spelling).alias("relevant_experience")
    )


def param_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of the modeling table are stored; the scan is pinned to one of them."""
    store = tables.VersionedTable(spark, scratch_path(spark, "versions"), "source_sha256")
    people = views.modeling_people(spark, folder)
    store.publish(people, views.SOURCE_SHA256)
    later = people.where(F.col("target").isNotNull()).withColumn("source_sha256", F.lit(views.LATER_SHA256))
    store.publish(later, views.LATER_SHA256)
    name = "tabloom_modeling_people"
    store.scan(views.SOURCE_SHA256, PEOPLE.scan_columns).createOrReplaceTempView(name)
    return tables.run_sql(
        spark,
        "SELECT * FROM IDENTIFIER(:table) WHERE source_sha256 = :sha256 AND city_development_index >= :low",
        table=name,
        sha256=views.SOURCE_SHA256,
        low=0.25,
    )


def _document_manifest(documents: DataFrame) -> DataFrame:
    entries = F.create_map(
        F.lit("sha256"), F.sha2("text", 256),
        F.lit("size_chars"), F.length("text").cast("string"),
        F.lit("lang"), F.col("lang"),
        F.lit("source"), F.col("source"),
    )
    return documents.select("doc_id", F.explode(entries).alias("key", "value"))


def manifest_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Stored manifests that differ: rewritten texts, lost source entries and added notes."""
    documents = views.table(spark, folder, "documents")
    expected = _document_manifest(documents)
    changed = documents.withColumn(
        "text", F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    )
    key = F.when(F.col("value") == "src5", F.lit("note")).otherwise(F.col("key"))
    stored = _document_manifest(changed).where(F.col("value") != "src3").withColumn("key", key)
    return manifests.manifest_diff(expected, stored, ["doc_id", "key"])


def report_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Reports written per user, one event writing one report."""
    events = views.table(spark, folder, "events")
    names = F.array(*[F.lit(name) for name in views.REPORTS])
    name = F.element_at(names, (F.col("event_id") % len(views.REPORTS) + 1).cast("int"))
    # An error writes nothing, but its user is one of the runs.
    written = events.select("user_id", F.when(F.col("event_type") != "error", name).alias("report_name"))
    return manifests.report_catalog(written, "user_id", "report_name", views.REPORTS)


def _written_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "csv")
    # Blank cells are quoted so that they read back as text, not as NULL.
    views.raw_people(spark, folder).write.option("header", True).option("emptyValue", "").csv(path)
    return path


def csv_contract(spark: SparkSession, folder: str) -> DataFrame:
    manifest = csv.verify_csv(spark, _written_csv(spark, folder), PEOPLE)
    described = manifest.table(spark)
    # Path, bytes and digest of written files are not known to SQL: their form is compared.
    form = F.when(F.col("key") == "source", F.regexp_extract("value", "tabloom-csv", 0))
    form = form.when(F.col("key") == "digest", F.length("value").cast("string"))
    form = form.when(F.col("key") == "size_bytes", (F.col("value").cast("bigint") > 0).cast("string"))
    return described.select("key", form.otherwise(F.col("value")).alias("value"))


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Files of document texts: how many bytes they hold, and the form of their digests.

    Spark decides how many files it writes, so they are summed up.
    """
    path = scratch_path(spark, "texts")
    texts = views.table(spark, folder, "documents").select(F.regexp_replace("text", "[\\r\\n]", " ").alias("value"))
    texts.write.text(path)
    files = csv.file_manifest(spark, path).where(F.col("size_bytes") > 0)
    return files.agg(
        F.sum("size_bytes").cast("bigint").alias("size_bytes"),
        F.min(F.length("sha256")).alias("digest_length"),
        (F.count_distinct("path") == F.count("*")).alias("paths_differ"),
    )


def load_raw(spark: SparkSession, folder: str) -> DataFrame:
    loaded = csv.load_raw(spark, _written_csv(spark, folder), PEOPLE, scratch_path(spark, "raw"))
    return loaded.select(*[clean_text(F.col(name)).alias(name) for name in loaded.columns])


def descriptor_parse(spark: SparkSession, folder: str) -> DataFrame:
    texts = views.view(spark, folder, views.DESCRIPTORS, "events")
    parsed = registry.parse_descriptors(texts, "body")
    return parsed.select(
        "event_id", F.coalesce("problem", F.lit("")).alias("problem"), "model_uri", "model_version", "trial",
        F.try_element_at("parameters", F.lit("c")).alias("c"),
        F.try_element_at("test_metrics", F.lit("auc")).alias("auc"),
    )


# --- quality ---------------------------------------------------------------


def dq_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of the written modeling table against the raw one."""
    return quality.quality_checks(
        materialize(views.modeling_people(spark, folder), "modeling"),
        PEOPLE,
        expected_rows=19_158,
        source_uri=views.SOURCE_URI,
        source_sha256=views.SOURCE_SHA256,
        raw=views.raw_people(spark, folder),
    )


def missingness(spark: SparkSession, folder: str) -> DataFrame:
    columns = [column.name for column in PEOPLE.columns if column.name != ID]
    return quality.missingness(views.modeling_people(spark, folder), columns)


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(views.table(spark, folder, "lineitem"), "l_orderkey")


def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_rows(views.table(spark, folder, "documents"), exclude=["doc_id"])


def frame_contract(spark: SparkSession, folder: str) -> DataFrame:
    return quality.frame_contract(
        views.modeling_people(spark, folder), PEOPLE, 19_158, views.SOURCE_SHA256
    )


def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.validation_report(dq_checks(spark, folder))
    return report.withColumn("failed_checks", F.array_join("failed_checks", ","))


# --- split -----------------------------------------------------------------


def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return split.class_counts(views.scored_people(spark, folder), "y")


def people_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_split(views.scored_people(spark, folder), ID, "y")


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return people_split(spark, folder).select(ID, "y", "split")


def document_split(spark: SparkSession, folder: str) -> DataFrame:
    labels = views.doc_labels(spark, folder)
    return split.stratified_split(labels, "doc_id", "quality", test_size=0.25, seed=7).select(
        "doc_id", "quality", "lang", "split"
    )


def people_folds(spark: SparkSession, folder: str) -> DataFrame:
    return split.stratified_folds(views.scored_people(spark, folder), ID, "y", FOLDS)


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return people_folds(spark, folder).select(ID, "y", "fold")


def split_disjoint(spark: SparkSession, folder: str) -> DataFrame:
    return split.shared_identifiers(people_split(spark, folder), ID)


def split_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(split.split_manifest(people_split(spark, folder), ID, "y"), "positive_rate")


def id_digest(spark: SparkSession, folder: str) -> DataFrame:
    orders = views.table(spark, folder, "orders")
    return digest.digests(orders, F.col("o_orderkey"), ["o_orderstatus"], output="id_digest")


def differing_leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Where two versions of the lines differ, from their leaves alone: lines of one order in 1,000 are gone."""
    lines = views.table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag")
    stored = materialize(digest.leaves(lines, F.col("l_orderkey"), ["l_returnflag"]), "leaves")
    later = lines.where("l_orderkey % 1000 <> 0")
    return digest.differing_leaves(stored, digest.leaves(later, F.col("l_orderkey"), ["l_returnflag"]), ["l_returnflag"])


def folder_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of a folder with one file per source, compared by value."""
    path = scratch_path(spark, "folder")
    per_source = views.table(spark, folder, "documents").groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("chars")
    )
    line = F.concat_ws(" ", "source", "n", "chars")
    per_source.select("source", line.alias("value")).repartition("source").write.partitionBy("source").text(path)
    files = csv.file_manifest(spark, path).where(F.col("size_bytes") > 0)
    # Spark makes up file names; a file counts by its folder here.
    named = files.withColumn("path", F.concat(F.lit(path + "/"), F.regexp_extract("path", "source=([^/]*)/", 1)))
    return csv.folder_digest(named, path)


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    weighted = split.class_weights(views.scored_people(spark, folder), "y")
    return rounded(weighted.select(ID, "y", "weight"), "weight")


# --- features --------------------------------------------------------------


def _development(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All labelled people with their split, and the development rows."""
    people = split.stratified_split(labelled_people(spark, folder), ID, "target")
    return people, people.where(F.col("split") == split.DEVELOPMENT)


def median_impute(spark: SparkSession, folder: str) -> DataFrame:
    people, development = _development(spark, folder)
    fit = features.fit_numeric(features.fit_counts(development, PEOPLE, categorical=[]), PEOPLE.numeric)
    name = PEOPLE.numeric[0]
    return rounded(
        people.select(ID, fit[name].imputed(name).alias(name), fit[name].missing(name).alias("missing")), name
    )


def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    people, development = _development(spark, folder)
    fit = features.fit_numeric(features.fit_counts(development, PEOPLE, categorical=[]), PEOPLE.numeric)
    name = PEOPLE.numeric[0]
    return rounded(people.select(ID, fit[name].scaled(name).alias(name)), name)


def document_scale(spark: SparkSession, folder: str) -> DataFrame:
    documents = views.table(spark, folder, "documents")
    counts = features.FitCounts(None, *features.numeric_counts(documents, ["n_chars"]))
    fit = features.fit_numeric(counts, ["n_chars"])["n_chars"]
    return rounded(documents.select("doc_id", fit.scaled("n_chars").alias("scaled")), "scaled").withColumn(
        "median", F.lit(fit.median)
    )


def mode_impute(spark: SparkSession, folder: str) -> DataFrame:
    people, development = _development(spark, folder)
    fits = features.fit_ordinal(
        features.fit_counts(development, PEOPLE, categorical=list(PEOPLE.ordinal), numeric=[]), PEOPLE.ordinal
    )
    return people.select(ID, *[fit.imputed(name).alias(name) for name, fit in fits.items()])


def ordinal_encode(spark: SparkSession, folder: str) -> DataFrame:
    people, development = _development(spark, folder)
    fits = features.fit_ordinal(
        features.fit_counts(development, PEOPLE, categorical=list(PEOPLE.ordinal), numeric=[]), PEOPLE.ordinal
    )
    coded = people.select(
        ID,
        *[fit.code(name).alias(name) for name, fit in fits.items()],
        *[fit.scaled(name).alias(f"{name}_scaled") for name, fit in fits.items()],
    )
    return rounded(coded, *[f"{name}_scaled" for name in fits])


def _vocabulary(spark: SparkSession, folder: str, min_frequency: int = MIN_FREQUENCY) -> tuple[DataFrame, DataFrame, list[str]]:
    people, development = _development(spark, folder)
    columns = [*PEOPLE.high_cardinality, *PEOPLE.nominal]
    counts = features.category_counts(development, columns)
    return people, features.vocabulary(counts, columns, min_frequency), columns


def one_hot_vocab(spark: SparkSession, folder: str) -> DataFrame:
    _, words, _ = _vocabulary(spark, folder, min_frequency=50)
    return words


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    people, words, columns = _vocabulary(spark, folder, min_frequency=50)
    return features.one_hot(people, ID, columns, words)


#: Nominal columns of ``table_encoder`` and the rows that make a label frequent there.
LINE_WORDS = {
    "part": "CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey AS string) END",
    "supplier": "CAST(l_suppkey AS string)",
}
LINE_MIN_FREQUENCY = 28


def table_encoder(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse vectors of all lines over parts and suppliers; the labels stay in a table."""
    lines = views.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", *[F.expr(sql).alias(name) for name, sql in LINE_WORDS.items()]
    )
    categories = lines.unpivot([], list(LINE_WORDS), "feature", "category").groupBy("feature", "category")
    counted = categories.agg(F.count("*").alias("n"))
    words = materialize(features.vocabulary(counted, list(LINE_WORDS), LINE_MIN_FREQUENCY), "vocabulary")
    rare = words.where("NOT frequent").select("feature").distinct().collect()  # one row per column
    path, stored = vocabulary.store_vocabulary(words)
    counts = {name: stored.get(name, 0) for name in LINE_WORDS}
    has_rare = frozenset(row["feature"] for row in rare)
    encoder = vocabulary.TableEncoder.of(["CAST(l_quantity AS DOUBLE)"], counts, has_rare, path, "vector")
    parts = "v struct<size:int,indices:array<int>,values:array<double>>"
    encoded = encoder.transform(lines).withColumn(
        "v", F.from_json(F.to_json(F.struct(F.col("vector").alias("v"))), parts)["v"]
    )
    return encoded.select(
        "l_orderkey", "l_linenumber", F.col("v.size").alias("size"),
        F.array_join(F.col("v.indices").cast("array<string>"), ",").alias("places"),
        F.col("v.values")[0].alias("first_value"),
    )


def feature_counts(spark: SparkSession, folder: str) -> DataFrame:
    return modeling.prepare(labelled_people(spark, folder), PEOPLE)


def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Sum of every encoded column over all rows, by position in the vector."""
    people, development = _development(spark, folder)
    counts = features.fit_counts(development, PEOPLE)
    encoder = features.fit_encoder(
        counts, PEOPLE, features.PreprocessingConfig("ordinal_aware", True, MIN_FREQUENCY)
    )
    encoded = features.encoder_pipeline(encoder, people).transform(people)
    totals = encoded.agg(vector_to_array(Summarizer.sum(F.col("features"))).alias("totals"))
    return rounded(totals.select(F.posexplode("totals").alias("position", "total")), "total", digits=4)


# --- rank and evaluation ---------------------------------------------------


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return views.scored_people(spark, folder)


def rank_all(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.rank_all(views.all_scored(spark, folder).select(ID, "p"), "p", ID).select(ID, "rank")


def line_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of every order line by price: more rows than one part of the global order takes."""
    lines = views.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col(name) for name in ("l_extendedprice", "l_orderkey", "l_linenumber")]
    return prefix.global_rank(lines, order).select("l_orderkey", "l_linenumber", "rank")


def value_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Ranking metrics of a score with about as many distinct values as rows."""
    curve = ranking.score_curve(views.view(spark, folder, views.VALUE_SCORES, "events"), "y", "p")
    return rounded(ranking.ranking_metrics(curve).select("rows", "average_precision", "roc_auc"), "average_precision", "roc_auc")


def priority_rank(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.all_scored(spark, folder).select("request_id", "input_index", "p")
    return scoring.priority_rank(rows, "request_id", "p", "input_index").select(
        "request_id", "input_index", "priority_rank"
    )


def scored_join(spark: SparkSession, folder: str) -> DataFrame:
    """Labels aligned with the documents that they judge."""
    documents = views.table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(views.table(spark, folder, "labels"), "doc_id")


def aligned_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Labels beside scores that were written without an id, in other files, by position."""
    rows = spark.sql(views.VALUE_SCORES, events=views.table(spark, folder, "events"))
    paths = []
    for name, parts, kept in (("labels", 5, ["event_id", "y"]), ("scores", 3, ["p"])):
        paths.append(scratch_path(spark, name))
        dealt = rows.repartitionByRange(parts, "event_id").sortWithinPartitions("event_id")
        dealt.select(*kept).write.parquet(paths[-1])
    return rounded(align.align(spark, *paths), "p")


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = ranking.row_metrics(scored(spark, folder), "y", "p", THRESHOLD)
    return rounded(metrics, "recall", "precision", "f1", "f2")


def brier(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.brier_score(scored(spark, folder), "y", "p"), "brier_score")


def _ranking(column: str, spark: SparkSession, folder: str) -> DataFrame:
    curve = ranking.score_curve(scored(spark, folder), "y", "p")
    return rounded(ranking.ranking_metrics(curve).select("rows", column), column)


def f2_threshold(spark: SparkSession, folder: str) -> DataFrame:
    curve = ranking.score_curve(scored(spark, folder), "y", "p")
    best = ranking.f2_threshold(curve)
    at_best = ranking.classification_metrics(curve.table, best).withColumn("threshold", F.lit(best))
    return rounded(at_best.select("threshold", "f2"), "threshold", "f2")


_CAPACITY = ("baseline_rate", "selected_rate", "absolute_reduction", "relative_reduction")


def _capacity(fractions: tuple[float, ...], spark: SparkSession, folder: str) -> DataFrame:
    report = capacity.capacity_metrics(scored(spark, folder), ID, "y", "p", fractions)
    return rounded(report, *_CAPACITY)


def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    points = ranking.precision_recall_points(ranking.score_curve(scored(spark, folder), "y", "p"))
    return rounded(points, "threshold", "precision", "recall", "baseline")


def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    points = ranking.roc_points(ranking.score_curve(scored(spark, folder), "y", "p"))
    # The origin has no finite threshold; SQL writes it as NULL.
    shown = points.withColumn("threshold", F.when(F.col("threshold") < float("inf"), F.col("threshold")))
    return rounded(shown, "threshold", "fpr", "tpr")


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.confusion_matrix(scored(spark, folder), "y", "p", THRESHOLD)


_FAIRNESS = ("positive_rate", "predicted_positive_rate", "recall", "average_precision")


def fairness_by_group(spark: SparkSession, folder: str) -> DataFrame:
    audit = fairness.fairness_by_group(scored(spark, folder), "y", "p", "gender", THRESHOLD)
    return rounded(audit, *_FAIRNESS)


def document_fairness(spark: SparkSession, folder: str) -> DataFrame:
    """Quality labels judged by document length, per language."""
    labels = views.doc_labels(spark, folder).withColumn("p", F.col("n_chars") / (F.col("n_chars") + 1000))
    return rounded(fairness.fairness_by_group(labels, "quality", "p", "lang", 0.5), *_FAIRNESS)


def fairness_gaps(spark: SparkSession, folder: str) -> DataFrame:
    audit = fairness.fairness_by_group(scored(spark, folder), "y", "p", "gender", THRESHOLD)
    return rounded(fairness.fairness_gaps(audit), "max_recall_gap", "max_predicted_positive_rate_gap")


def holdout_report(spark: SparkSession, folder: str) -> DataFrame:
    report = modeling.holdout_report(scored(spark, folder), ID, "y", "p", THRESHOLD, FRACTIONS)
    return rounded(report, "value")


# --- cross-validation ------------------------------------------------------

_FOLD_METRICS = (
    "train_average_precision", "validation_average_precision", "validation_roc_auc", "validation_brier_score",
)


def dummy_baseline(spark: SparkSession, folder: str) -> DataFrame:
    result = crossval.cross_validate_prior(scored(spark, folder), ID, "y", FOLDS)
    return rounded(result.folds, *_FOLD_METRICS)


def oof_union(spark: SparkSession, folder: str) -> DataFrame:
    folded = materialize(people_folds(spark, folder).select(ID, "y", "fold"), "folded", ("fold",))
    predicted = crossval.prior_scores(folded, "y")
    slices = [predicted.where(F.col("fold") == number) for number in range(1, FOLDS + 1)]
    return crossval.oof_coverage(folded, crossval.assemble_oof(slices), ID)


def _cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Given scores, seen once as validation and otherwise as training rows of each fold."""
    folded = people_folds(spark, folder).select(ID, "y", "p", F.col("fold").alias("own"))
    models = F.explode(F.array(*[F.lit(number) for number in range(1, FOLDS + 1)])).alias("fold")
    return folded.select(ID, "y", "p", "own", models).withColumn(
        "part",
        F.when(F.col("own") == F.col("fold"), F.lit(crossval.VALIDATION)).otherwise(F.lit(crossval.TRAIN)),
    )


def fold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(crossval.fold_metrics(_cv_scores(spark, folder), "y"), *_FOLD_METRICS)


def cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = crossval.fold_summary(crossval.fold_metrics(_cv_scores(spark, folder), "y"))
    return rounded(summary, *[name for name in summary.columns if name not in ("cv_folds", "development_rows")])


def _is_share(column: str) -> Column:
    return F.coalesce(F.col(column).between(0, 1), F.lit(False)).alias(column)


def cv_report(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a cross-validated logistic regression, and which of its metrics are shares.

    SQL cannot fit the models; tests recompute the metrics from written scores.
    """
    result = crossval.cross_validate_pipeline(
        labelled_people(spark, folder), PEOPLE, LOGISTIC, folds=FOLDS, parallelism=3
    )
    shares = ("validation_average_precision_mean", "train_average_precision_mean", "validation_roc_auc_mean", "oof_recall")
    report = result.summary.select(
        "cv_folds", "development_rows", "positive_rate", *[_is_share(name) for name in shares]
    )
    return rounded(report, "positive_rate")


def _final(spark: SparkSession, folder: str, params: dict[str, str]) -> tuple[DataFrame, modeling.FinalModel]:
    people = modeling.split_table(labelled_people(spark, folder), PEOPLE)
    return people, modeling.fit_final(people, PEOPLE, params, THRESHOLD)


def final_report(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics of a hold-out report that do not depend on the model, and which others are finite."""
    report = _final(spark, folder, LOGISTIC)[1].holdout
    fixed = F.col("metric").isin("rows", "positive_rate", "threshold") | F.col("metric").rlike("selected_rows|baseline_rate")
    return rounded(
        report.select(
            "metric", F.when(fixed, F.col("value")).alias("value"), (F.abs("value") < float("inf")).alias("finite")
        ),
        "value",
    )


def finalize_once(spark: SparkSession, folder: str) -> DataFrame:
    """A whole study: twelve trials, the summary, the claim, the registered model, and a refused second evaluation.

    One design is cross-validated and the others get the figures of the prior; the data decide which trial is best.
    """
    people = labelled_people(spark, folder)
    study = modeling.Study(spark, scratch_path(spark, "study"), views.SOURCE_SHA256, STUDY_FOLDS)
    prior = None

    def evaluate(rows: DataFrame, params: dict[str, str]) -> crossval.CrossValidation:
        nonlocal prior
        if all(params[name] == LOGISTIC[name] for name in learners.DESIGN_PARAMETERS):
            return crossval.cross_validate_pipeline(rows, PEOPLE, params, STUDY_FOLDS, study.seed)
        prior = prior or crossval.cross_validate_prior(rows, ID, PEOPLE.label, STUDY_FOLDS, study.seed)
        return prior

    modeling.tune(people, PEOPLE, study, len(search.initial_designs()), 600.0, evaluate=evaluate)
    store = registry.ModelRegistry(spark, scratch_path(spark, "registry"))
    modeling.finalize(people, PEOPLE, study, store, "people")
    try:
        modeling.finalize(people, PEOPLE, study, store, "people")
        refused = False
    except ContractError:
        refused = True
    reports = sorted(row["name"] for row in tables.written_reports(spark, study.reports).collect())  # nine names
    best = search.top_trials(study.trials()).orderBy(F.desc("value"), "trial").first()
    metric = partial(F.element_at, F.col("test_metrics"))
    return rounded(
        store.describe("people", "candidate").select(
            "name", "version", "alias", "study", "source_sha256",
            (F.col("trial") == best["trial"]).alias("best_trial"),
            (F.element_at("parameters", "preprocessing_strategy") == F.split("preprocessing", "_with")[0]).alias("own_design"),
            F.lit(",".join(reports)).alias("reports"),
            F.lit(study.trials().count()).cast("bigint").alias("trials"),
            metric(F.lit("test_rows")).alias("test_rows"),
            metric(F.lit("test_positive_rate")).alias("test_positive_rate"),
            F.lit(refused).alias("second_run_refused"),
        ),
        "test_positive_rate",
    )


#: Boosting of ``boosting_splits``, and its features in whole numbers.
LEAFWISE = {"numTrees": 2, "learningRate": 0.3, "numLeaves": 6, "maxDepth": 4, "minRowsPerLeaf": 20, "regAlpha": 0.5, "regLambda": 1.0}
LINE_FEATURES = {
    "quantity": "CAST(round(l_quantity) AS bigint)",
    "discount": "CAST(round(l_discount * 100) AS bigint)",
    "tax": "CAST(round(l_tax * 100) AS bigint)",
    "line": "CAST(l_linenumber AS bigint)",
}
LINE_LABEL = f"{LINE_FEATURES['quantity']} + 3 * {LINE_FEATURES['discount']} + CASE WHEN l_returnflag = 'R' THEN 20 ELSE 0 END > 45"


def boosting_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Every split of two leaf-wise trees over all lines, with its gain and the rows on both sides."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.array(*[F.expr(sql).cast("double") for sql in LINE_FEATURES.values()]).alias("features"),
        F.expr(LINE_LABEL).cast("double").alias("label"),
    )
    model = boosting.LeafwiseBooster(**LEAFWISE).fit(lines)
    schema = "tree int, step int, feature int, bin int, gain double, left_rows long, right_rows long"
    names = [part.split()[0] for part in schema.split(", ")]
    return rounded(spark.createDataFrame([tuple(s[n] for n in names) for s in model.splits], schema), "gain")


def _tree_report(params: dict[str, str], spark: SparkSession, folder: str) -> DataFrame:
    """Size of a fitted tree model, and how its scores of the test rows are spread."""
    final = _final(spark, folder, params)[1]
    fitted = final.model.stages[-1]
    deepest = max(tree.depth if hasattr(tree, "depth") else boosting.depth(tree) for tree in fitted.trees)
    limit = int(next(value for name, value in params.items() if name.endswith("max_depth")))
    return final.scores.agg(
        F.lit(params["model_name"]).alias("model_name"),
        F.lit(len(fitted.trees)).alias("trees"),
        F.lit(1 <= deepest <= limit).alias("within_depth"),
        F.count("*").alias("rows"),
        F.sum(F.col(PEOPLE.label).cast("bigint")).alias("positives"),
        F.count_if(~F.col("p").between(0, 1)).alias("outside"),
        (F.count_distinct("p") > 1).alias("scores_differ"),
    )


# --- search ----------------------------------------------------------------


def trial_candidates(spark: SparkSession, folder: str) -> DataFrame:
    drawn = search.trial_candidates(views.trials(spark, folder), ["study", "trial"])
    doubles = [parameter.name for parameter in search.SEARCH_SPACE if not parameter.choices and not parameter.whole]
    return rounded(drawn, *doubles)


def trial_params(spark: SparkSession, folder: str) -> DataFrame:
    logged = search.logged_parameter(F.col("class_weight"))
    return views.trials(spark, folder).select(
        "trial",
        logged.alias("logged_class_weight"),
        search.stored_parameter(logged).alias("class_weight"),
        search.study_name(F.sha2("study", 256), F.col("cv_folds")).alias("study_name"),
    )


def remaining_trials(spark: SparkSession, folder: str) -> DataFrame:
    return search.remaining_trials(views.trials(spark, folder), TARGET_TRIALS)


def initial_designs(spark: SparkSession, folder: str) -> DataFrame:
    return search.pending_designs(views.trials(spark, folder))


def study_contract(spark: SparkSession, folder: str) -> DataFrame:
    return search.contract_breaks(views.trials(spark, folder), CONTRACT)


def top_trials(spark: SparkSession, folder: str) -> DataFrame:
    best = search.top_trials(views.trials(spark, folder), 10)
    return rounded(best.select("study", "trial", "model_name", "value"), "value")


def finite_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(search.finite_metrics(views.trials(spark, folder)).select("trial", "value"), "value")


# --- scoring ---------------------------------------------------------------


def _registered_model(spark: SparkSession, folder: str) -> PipelineModel:
    """A logistic regression fitted on the people, registered and loaded by its alias."""
    people, final = _final(spark, folder, LOGISTIC)
    store = registry.ModelRegistry(spark, scratch_path(spark, "registry"))
    version = store.register("people", final.model, people, features=PEOPLE.features, source_sha256=views.SOURCE_SHA256)
    store.promote("people", "candidate", version, people)
    return store.load("people", "candidate")


def _keyed(requests: DataFrame) -> DataFrame:
    return requests.withColumn("request_id", F.expr(views.REQUEST_ID))


def _fates(scored: DataFrame, rejected: DataFrame) -> DataFrame:
    """What became of every candidate; ranks are checked against the scores that SQL cannot know."""
    request = Window.partitionBy("request_id")
    before = F.lag("p").over(request.orderBy("priority_rank"))
    judged = scored.select(
        "event_id", "request_id", F.lit("scored").alias("status"), F.lit("").alias("reasons"),
        F.col("p").between(0, 1).alias("valid"),
        (F.coalesce(before <= F.col("p"), F.lit(True)) & F.col("priority_rank").between(1, F.count("*").over(request))).alias("ranked"),
    )
    refused = rejected.select(
        "event_id", "request_id", F.lit("rejected").alias("status"), F.array_join(scoring.REASONS, ";").alias("reasons"),
        F.lit(None).cast("boolean").alias("valid"), F.lit(None).cast("boolean").alias("ranked"),
    )
    return judged.unionByName(refused)


def request_contract(spark: SparkSession, folder: str) -> DataFrame:
    checked = scoring.parse_requests(views.requests(spark, folder), "payload", REQUEST)
    return checked.select(
        "event_id", "city", "city_development_index", "last_new_job",
        F.array_join(scoring.REASONS, ";").alias("reasons"),
    )


def typed_request_contract(spark: SparkSession, folder: str) -> DataFrame:
    people = views.modeling_people(spark, folder).select(ID, *PEOPLE.features)
    checked = scoring.check_requests(people, REQUEST)
    return checked.select(ID, F.array_join(scoring.REASONS, ";").alias("reasons"))


def request_bounds(spark: SparkSession, folder: str) -> DataFrame:
    lines = views.table(spark, folder, "lineitem")
    return scoring.request_bounds(lines, "l_suppkey", maximum=590)


def score_sanity(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_sanity(views.trials(spark, folder), "value")


def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    checked = scoring.parse_requests(_keyed(views.dealt_view(spark, folder, views.REQUESTS)), "payload", REQUEST)
    model = _registered_model(spark, folder)
    return _fates(*scoring.score_batch(checked, model, "request_id", "event_id"))


def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    # A batch is dealt before requests are made of it: counting and moving its rows then needs no payloads.
    events = stream_table(spark, folder, "events").select("event_id", "user_id")

    def check(batch: DataFrame) -> DataFrame:
        return scoring.parse_requests(_keyed(batch.sparkSession.sql(views.REQUESTS, events=batch)), "payload", REQUEST)

    target, bad = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    query = score_stream(
        events,
        check,
        _registered_model(spark, folder),
        "request_id",
        "event_id",
        target,
        bad,
        scratch_path(spark, "stream"),
    )
    query.awaitTermination()
    done = read_batches(spark, target, "event_id bigint, request_id bigint, p double, priority_rank bigint")
    refused = read_batches(spark, bad, "event_id bigint, request_id bigint, reasons array<string>")
    return _fates(done, refused)


#: Request rows arrive in three files; requests ending in LATE_DIGIT announce one row too many.
REQUEST_WAIT = timedelta(hours=1)
LATE_DIGIT = 7


def split_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request rows with the file they come in, when they arrive, and how many rows their request announces."""
    keyed = _keyed(views.dealt_view(spark, folder, views.REQUESTS))
    sizes = materialize(keyed.where("request_id IS NOT NULL").groupBy("request_id").agg(F.count("*").alias("n")), "sizes")
    counted = left_lookup(keyed, sizes.withColumn("expected", F.col("n")), ["request_id"], "n")
    more = F.when(F.col("request_id") % 10 == LATE_DIGIT, 1).otherwise(0)
    # The two halves of a request come in the first two files; every fifth request comes whole, a day later.
    file = F.when(F.col("request_id") % 5 == 0, 2).otherwise((F.col("event_id") % 4 >= 2).cast("int"))
    return counted.withColumns({
        "expected": F.col("expected") + more, "file": file,
        "arrived": F.timestamp_seconds(F.when(file == 2, 86_400).otherwise(file * 60)),
    })


def stream_requests(spark: SparkSession, folder: str) -> DataFrame:
    """What became of every candidate when its request came in two micro-batches."""
    rows = materialize(split_requests(spark, folder), "split")
    source = scratch_path(spark, "files")
    target, bad = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    model, state, checkpoint = _registered_model(spark, folder), scratch_path(spark, "open"), scratch_path(spark, "stream")
    # The stream goes on where it stopped: all that arrived since, in any number of files, is one micro-batch.
    for number in range(3):
        rows.where(F.col("file") == number).drop("file").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.drop("file").schema).parquet(source)
        score_request_stream(
            stream, partial(scoring.parse_requests, payload="payload", contract=REQUEST), model, "request_id", "event_id",
            "expected", "arrived", REQUEST_WAIT, target, bad, state, checkpoint,
        ).awaitTermination()
    done = read_batches(spark, target, "event_id bigint, request_id bigint, p double, priority_rank bigint")
    refused = read_batches(spark, bad, "event_id bigint, request_id bigint, reasons array<string>")
    return _fates(done, refused)


def model_info(spark: SparkSession, folder: str) -> DataFrame:
    people, final = _final(spark, folder, LOGISTIC)
    store = registry.ModelRegistry(spark, scratch_path(spark, "registry"))
    metrics = {f"test_{row['metric']}": row["value"] for row in final.holdout.collect()}
    version = store.register(
        "people", final.model, people, features=PEOPLE.features, parameters=LOGISTIC, test_metrics=metrics,
        source_sha256=views.SOURCE_SHA256, preprocessing=final.encoder.config.name,
    )
    store.promote("people", "candidate", version, people)
    named = F.transform_values("parameters", lambda name, value: F.concat_ws("=", name, value))
    return store.describe("people", "candidate").select(
        "name", "version", "alias", "preprocessing", "source_sha256", F.array_join("features", ",").alias("features"),
        F.array_join(F.array_sort(F.map_values(named)), ",").alias("parameters"),
        F.element_at("test_metrics", "test_rows").alias("test_rows"),
    )


QUERIES: dict[str, Query] = {
    "clean_strings": clean_strings,
    "typed_cast": typed_cast,
    "value_remap": value_remap,
    "modeling_table": views.modeling_people,
    "param_scan": param_scan,
    "manifest_diff": manifest_diff,
    "report_catalog": report_catalog,
    "csv_contract": csv_contract,
    "file_manifest": file_manifest,
    "load_raw": load_raw,
    "descriptor_parse": descriptor_parse,
    "dq_checks": dq_checks,
    "missingness": missingness,
    "duplicate_keys": duplicate_keys,
    "duplicate_rows": duplicate_rows,
    "frame_contract": frame_contract,
    "validation_report": validation_report,
    "class_counts": class_counts,
    "stratified_split": stratified_split,
    "document_split": document_split,
    "stratified_folds": stratified_folds,
    "split_disjoint": split_disjoint,
    "split_manifest": split_manifest,
    "id_digest": id_digest,
    "differing_leaves": differing_leaves,
    "folder_digest": folder_digest,
    "class_weights": class_weights,
    "median_impute": median_impute,
    "standard_scale": standard_scale,
    "document_scale": document_scale,
    "mode_impute": mode_impute,
    "ordinal_encode": ordinal_encode,
    "one_hot_vocab": one_hot_vocab,
    "one_hot": one_hot,
    "table_encoder": table_encoder,
    "feature_counts": feature_counts,
    "feature_matrix": feature_matrix,
    "global_rank": rank_all,
    "line_rank": line_rank,
    "value_ranking": value_ranking,
    "priority_rank": priority_rank,
    "scored_join": scored_join,
    "aligned_scores": aligned_scores,
    "classification_metrics": classification_metrics,
    "brier": brier,
    "average_precision": partial(_ranking, "average_precision"),
    "roc_auc": partial(_ranking, "roc_auc"),
    "f2_threshold": f2_threshold,
    "capacity_metrics": partial(_capacity, FRACTIONS),
    "capacity_curve": partial(_capacity, capacity.CURVE_FRACTIONS),
    "pr_curve": pr_curve,
    "roc_curve": roc_curve,
    "confusion_matrix": confusion_matrix,
    "fairness_by_group": fairness_by_group,
    "document_fairness": document_fairness,
    "fairness_gaps": fairness_gaps,
    "holdout_report": holdout_report,
    "dummy_baseline": dummy_baseline,
    "oof_union": oof_union,
    "fold_metrics": fold_metrics,
    "cv_summary": cv_summary,
    "cv_report": cv_report,
    "final_report": final_report,
    "finalize_once": finalize_once,
    "forest_report": partial(_tree_report, FOREST),
    "boosting_splits": boosting_splits,
    "boosting_report": partial(_tree_report, BOOSTING),
    "initial_designs": initial_designs,
    "trial_candidates": trial_candidates,
    "trial_params": trial_params,
    "remaining_trials": remaining_trials,
    "study_contract": study_contract,
    "top_trials": top_trials,
    "finite_metrics": finite_metrics,
    "request_contract": request_contract,
    "typed_request_contract": typed_request_contract,
    "request_bounds": request_bounds,
    "score_sanity": score_sanity,
    "score_batch": score_batch,
    "stream_score": stream_score,
    "stream_requests": stream_requests,
    "model_info": model_info,
}
