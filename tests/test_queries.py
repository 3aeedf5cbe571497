"""Every registered query against its SQL counterpart, and the plans of large ones."""

import re

import comparing
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
#: Plans of these hold whole model fits, or Spark's own one-row tables.
FITTED = {
    "file_manifest", "folder_digest", "cv_report", "final_report", "finalize_once", "model_info", "forest_report", "boosting_report", "score_batch",
    "stream_score", "stream_requests", "boosting_splits", "csv_contract",
}
CORPUS = {name for name in entry.queries() if name == "pipeline" or name.startswith("op")}


@pytest.fixture(scope="module")
def database():
    return comparing.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql().keys() - CORPUS))
def test_query_matches_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    assert comparing.difference(df, database, entry.oracle_sql()[name]) is None


def test_every_query_is_checked():
    assert entry.queries().keys() - CORPUS == entry.oracle_sql().keys() - CORPUS


def test_entry(spark):
    assert entry.entry(spark).columns == ["check_name", "severity", "failed_rows"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "modeling_table", "stratified_split", "stratified_folds", "median_impute", "ordinal_encode",
        "class_weights", "request_contract", "trial_candidates",
    ],
)
def test_applying_a_fit_moves_no_rows(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(entry.queries().keys() - CORPUS - FITTED))
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython", text)


@pytest.mark.parametrize("name", ["dq_checks", "fairness_by_group", "classification_metrics"])
def test_no_row_is_sent_twice(spark, name):
    """No distinct counts of several columns in one aggregate, and no curve read by two joins."""
    text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search(r"Join|gid#", text)


def test_scan_reads_only_needed_columns(spark):
    text = plan(entry.queries()["duplicate_keys"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "IsNotNull(l_orderkey)" in text


@pytest.mark.parametrize(
    "name",
    [
        "global_rank", "average_precision", "f2_threshold", "capacity_curve", "document_fairness", "fold_metrics",
        "document_scale", "one_hot", "priority_rank", "roc_curve", "stratified_split", "stratified_folds",
    ],
)
def test_many_parts_and_no_broadcast_give_the_same(spark, database, monkeypatch, name):
    """The paths of large tables, forced on small ones."""
    from tabloom.operators import lookup, prefix, split

    monkeypatch.setattr(prefix, "ROWS_PER_PART", 40)
    monkeypatch.setattr(lookup.left_lookup, "__defaults__", (0, lookup.BROADCAST_BYTES))
    monkeypatch.setattr(lookup, "HOT_KEYS", 20)
    monkeypatch.setattr(split, "BUCKET_DIGITS", 1)
    df = entry.queries()[name](spark, FOLDER)
    assert comparing.difference(df, database, entry.oracle_sql()[name]) is None
