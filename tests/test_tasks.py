"""Rows dealt over tasks by their number, not by the bytes of their files."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tabloom import scratch
from tabloom.contracts import PEOPLE
from tabloom.operators import crossval, scoring
from tabloom.operators.quality import modeling_table
from tabloom.plans import catalogue, modeling
from tabloom.streaming.requests import score_request_stream
from tabloom.streaming.scoring import read_batches, score_stream
from tests.conftest import PEOPLE_SCHEMA, people_rows

CONTRACT = scoring.request_contract(PEOPLE, {"city": (6, 20)})
GOOD = {
    "city_development_index": 0.37, "city": "city_8", "relevant_experience": "No relevant experience",
    "enrolled_university": "Part time course", "education_level": "High School", "major_discipline": "Arts",
    "experience": "4", "company_size": "<10", "company_type": "NGO", "last_new_job": "3",
}


@pytest.fixture
def short_tasks(monkeypatch):
    monkeypatch.setattr(scratch, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(scratch, "LEAST_ROWS", 5)


def per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


def test_tasks_by_rows(spark, short_tasks):
    cores = spark.sparkContext.defaultParallelism
    assert [scratch.task_count(spark, n) for n in (0, 1, 6, 10_000)] == [1, 1, 2, 200]
    assert scratch.task_count(spark, 40) == min(8, cores)


def test_rows_of_one_file_are_dealt(spark, short_tasks, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    dealt = scratch.deal(one)
    sizes = per_task(dealt)
    assert len(sizes) == 20 and max(sizes) <= 60
    assert [r.id for r in dealt.orderBy("id").collect()] == list(range(1000))
    assert scratch.deal(dealt) is dealt  # even enough: nothing moves
    assert scratch.deal(one.where("id < 0")).count() == 0


def test_rows_of_a_fit_are_bounded_per_task(spark, short_tasks):
    assert max(per_task(scratch.spread(spark.range(0, 2000, 1, 8), 2000))) <= 60


def formula():
    return PipelineModel(stages=[SQLTransformer(statement="SELECT *, city_development_index AS probability FROM __THIS__")])


def test_one_file_of_a_stream_is_checked_by_many_tasks(spark, short_tasks, tmp_path):
    schema = "request_id int, input_index int, payload string, expected int, arrived timestamp"
    tasks = []

    def check(df):
        tasks.append(df.rdd.getNumPartitions())
        return scoring.parse_requests(df, "payload", CONTRACT)

    rows = [(i // 4, i % 4, json.dumps(GOOD), 4, datetime(2024, 1, 1)) for i in range(400)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.json(source)
    paths = [str(tmp_path / name) for name in ("scored", "rejected", "checkpoint")]
    stream = spark.readStream.schema(schema).json(source)
    score_stream(stream, check, formula(), "request_id", "input_index", *paths).awaitTermination()
    assert read_batches(spark, paths[0], "request_id int").count() == 400
    assert tasks == [8]

    tasks.clear()
    paths = [str(tmp_path / name) for name in ("scored2", "rejected2", "state2", "checkpoint2")]
    score_request_stream(
        stream, check, formula(), "request_id", "input_index", "expected", "arrived", timedelta(hours=1), *paths
    ).awaitTermination()
    assert read_batches(spark, paths[0], "request_id int").count() == 400
    assert tasks[0] >= 8


def test_people_are_made_by_many_tasks(spark, short_tasks, tmp_path):
    columns = "id AS event_id, id % 7 AS user_id, CASE WHEN id % 3 = 0 THEN 'purchase' ELSE 'view' END AS event_type"
    spark.range(400).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    people = catalogue.labelled_people(spark, str(tmp_path))
    assert people.count() == 400
    assert len(people.select(F.input_file_name()).distinct().collect()) == 8


def test_a_fold_is_encoded_once(spark, monkeypatch):
    names = []

    def kept(df, name, **settings):
        names.append(name)
        return scratch.materialize(df, name, **settings)

    monkeypatch.setattr(crossval, "materialize", kept)
    people = spark.createDataFrame(people_rows(60), PEOPLE_SCHEMA)
    params = catalogue.LOGISTIC | {"min_category_frequency": "2"}
    result = crossval.cross_validate_pipeline(people, PEOPLE, params, folds=3)
    assert names.count("encoded") == 3 and result.scores.count() == 60


def test_rows_of_a_final_fit_are_bounded_per_task(spark, short_tasks, monkeypatch):
    sizes = []

    def kept(df, rows):
        dealt = scratch.spread(df, rows)
        sizes.extend(per_task(dealt))
        return dealt

    monkeypatch.setattr(modeling, "spread", kept)
    split = modeling.split_table(spark.createDataFrame(people_rows(800), PEOPLE_SCHEMA), PEOPLE)
    final = modeling.fit_final(split, PEOPLE, catalogue.FOREST | {"rf_n_estimators": "2"}, 0.5)
    assert sum(sizes) == 640 and max(sizes) <= 60 and final.scores.count() == 160


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_labels_are_made_and_judged_after_the_deal(spark, short_tasks, tmp_path, monkeypatch):
    kind = "CASE WHEN id % 3 = 0 THEN 'signup' WHEN id % 2 = 0 THEN 'error' ELSE 'view' END AS event_type"
    events = spark.range(1000).selectExpr("id AS event_id", "id % 7 AS user_id", kind)
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    written = []

    def keep(df, *rest):
        written.append(df)
        return scratch.materialize(df, *rest)

    monkeypatch.setattr(catalogue, "materialize", keep)
    found = {r.enrollee_id: r.target for r in catalogue.labelled_people(spark, str(tmp_path)).collect()}
    plan = optimized(written[0])
    assert "Repartition" in plan and "Filter" not in plan.split("Repartition", 1)[1]
    unlabelled = {i for i in range(0, 1000, 101) if i % 3 and i % 2 == 0}
    assert unlabelled and found == {i: int(i % 3 == 0) for i in range(1000) if i not in unlabelled}


def test_texts_are_trimmed_once(spark, tmp_path):
    raw = spark.createDataFrame([tuple(" 1\u2003" for _ in PEOPLE.raw_columns)], PEOPLE.raw_schema)
    raw.write.parquet(str(tmp_path / "raw"))
    typed = modeling_table(spark.read.parquet(str(tmp_path / "raw")), PEOPLE, "uri", "a" * 64)
    assert optimized(typed).count("trim(") == len(PEOPLE.raw_columns)
    assert typed.select("enrollee_id", "city", "target").first() == (1, "1", 1)
