"""Request contracts, bounds, ranks, score checks and the scoring stream."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabloom.contracts import PEOPLE, ContractError
from tabloom.operators import scoring
from tabloom.operators.learners import positive_probability
from tabloom.plans import catalogue
from tabloom.scratch import deal
from tabloom.streaming.requests import open_requests, score_request_stream
from tabloom.streaming.scoring import read_batches, score_stream

CONTRACT = scoring.request_contract(PEOPLE, {"city": (6, 20)})
GOOD = {
    "city_development_index": 0.37, "city": "city_8", "relevant_experience": "No relevant experience",
    "enrolled_university": "Part time course", "education_level": "High School", "major_discipline": "Arts",
    "experience": "4", "company_size": "<10", "company_type": "NGO", "last_new_job": "3",
}


def reasons(spark, payloads):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, payload string")
    checked = scoring.parse_requests(df, "payload", CONTRACT)
    return [r["reasons"] for r in checked.orderBy("i").collect()]


def test_json_requests(spark):
    cases = [
        (GOOD, []),
        (GOOD | {"city_development_index": 1}, []),
        (GOOD | {"gender": "Male"}, ["gender:unknown"]),
        (GOOD | {"city_development_index": "0.37"}, ["city_development_index:type"]),
        (GOOD | {"city_development_index": True}, ["city_development_index:type"]),
        (GOOD | {"city_development_index": 1.01}, ["city_development_index:range"]),
        (GOOD | {"city_development_index": -0.01}, ["city_development_index:range"]),
        (GOOD | {"city_development_index": None}, ["city_development_index:required"]),
        (GOOD | {"city": None}, ["city:required"]),
        (GOOD | {"city": "  "}, ["city:required"]),
        (GOOD | {"city": " city_8 "}, []),
        (GOOD | {"city": "city_"}, ["city:domain", "city:length"]),
        (GOOD | {"city": "city_1234567890123456"}, ["city:length"]),
        (GOOD | {"city": 5}, ["city:type"]),
        (GOOD | {"relevant_experience": None}, ["relevant_experience:required"]),
        (GOOD | {"education_level": "Doctor"}, ["education_level:domain"]),
        (GOOD | {"education_level": " "}, []),
        (GOOD | {"experience": 10}, ["experience:type"]),
        (GOOD | {"last_new_job": None, "company_size": None}, []),
        ({k: v for k, v in GOOD.items() if k != "company_type"}, ["company_type:missing"]),
        ({}, sorted(f"{name}:missing" for name in GOOD)),
        ("[1, 2]", ["body:not_an_object"]),
        ("{not json", ["body:not_an_object"]),
        (json.dumps(GOOD).replace("0.37", "NaN"), ["body:not_an_object"]),
        (json.dumps(GOOD).replace("0.37", "1e400"), ["city_development_index:range"]),
    ]
    assert reasons(spark, [case for case, _ in cases]) == [want for _, want in cases]


def test_typed_requests_and_sinks(spark):
    rows = [(1, *GOOD.values()), (2, *(GOOD | {"city_development_index": float("nan"), "city": " "}).values())]
    schema = "id int, city_development_index double, " + ", ".join(f"{n} string" for n in list(GOOD)[1:])
    checked = scoring.check_requests(spark.createDataFrame(rows, schema), CONTRACT)
    good, bad = scoring.checked_requests(checked)
    assert [r["id"] for r in good.collect()] == [1]
    assert [r["reasons"] for r in bad.collect()] == [["city:required", "city_development_index:range"]]
    with pytest.raises(ContractError):
        scoring.check_requests(spark.range(1), CONTRACT)


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_requests_are_taken_or_refused_whole(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr("tabloom.operators.lookup.HOT_KEYS", 3)
    bad = ["x:type"]
    rows = [(1, i, []) for i in range(50)] + [(2, i, []) for i in range(3)] + [(3, i, bad if i else []) for i in range(4)]
    # Broken rows count: five rows and one broken are too many for a limit of five.
    rows += [(4, i, bad if i == 5 else []) for i in range(6)] + [(None, i, []) for i in range(20)]
    df = spark.createDataFrame(rows, "r int, i int, reasons array<string>").withColumn("n", F.lit("own column"))
    judged = scoring.judged_requests(df, "r", maximum=5, broadcast_rows=broadcast_rows)
    assert judged.columns == ["r", "i", "reasons", "n"] and judged.count() == len(rows)
    found = {(r.r, r.i): r.reasons for r in judged.collect()}
    assert all(found[1, i] == ["request:size"] for i in range(50))
    assert all(found[2, i] == [] for i in range(3))
    assert found[3, 0] == ["request:refused"] and found[3, 1] == bad
    assert found[4, 0] == ["request:size"] and found[4, 5] == [*bad, "request:size"]
    assert all(found[None, i] == ["request:key"] for i in range(20))


def test_no_row_of_a_batch_is_lost(spark):
    rows = [(7, i, 0.5) for i in range(1_001)] + [(8, 0, 0.9), (8, 1, 0.1), (None, 0, 0.3)]
    df = spark.createDataFrame(rows, "request_id int, input_index int, city_development_index double")
    scored, rejected = scoring.score_batch(df, formula(), "request_id", "input_index")
    assert sorted((r.request_id, r.input_index, r.priority_rank) for r in scored.collect()) == [(8, 0, 2), (8, 1, 1)]
    assert rejected.count() == 1_002 and scored.count() + rejected.count() == len(rows)


@pytest.mark.parametrize("score", [float("nan"), 7.5, None])
def test_unusable_scores_are_never_ranked(spark, score):
    df = spark.createDataFrame([(1, 0, 0.2), (1, 1, score)], "request_id int, input_index int, city_development_index double")
    with pytest.raises(ContractError, match="unusable"):
        scoring.score_batch(df, formula(), "request_id", "input_index")


def test_priority_rank_example(spark):
    df = spark.createDataFrame([(1, 0, 0.80), (1, 1, 0.10), (1, 2, 0.40), (2, 0, 0.5), (2, 1, 0.5)], "r int, i int, p double")
    ranked = scoring.priority_rank(df, "r", "p", "i").orderBy("r", "i")
    assert [r["priority_rank"] for r in ranked.collect()] == [3, 1, 2, 1, 2]


def test_score_sanity(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (float("nan"),), (float("inf"),), (None,), (-0.1,)], "p double")
    assert tuple(scoring.score_sanity(df, "p").first()) == (6, 1, 2, 2)
    with pytest.raises(ContractError, match="missing, not_finite, out_of_range"):
        scoring.require_sane_scores(df, "p", 6)
    with pytest.raises(ContractError, match="6 rows for 7"):
        scoring.require_sane_scores(df, "p", 7)
    scoring.require_sane_scores(df.where("p = 0.5"), "p", 1)


def test_positive_probability_needs_two_classes(spark):
    df = spark.createDataFrame([(Vectors.dense([0.3, 0.7]),)], ["probability"])
    assert df.select(positive_probability()).first()[0] == 0.7
    wide = spark.createDataFrame([(Vectors.dense([0.1, 0.2, 0.7]),)], ["probability"])
    with pytest.raises(Exception, match="two class probabilities"):
        wide.select(positive_probability()).collect()


def formula():
    return PipelineModel(
        stages=[SQLTransformer(statement="SELECT *, city_development_index AS probability FROM __THIS__")]
    )


def test_stream_scores_and_rejects(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(0, i, json.dumps(GOOD | {"city_development_index": v})) for i, v in enumerate([0.8, 0.1, 0.4])]
    rows += [(1, 0, json.dumps(GOOD | {"city": None}))]
    schema = "request_id int, input_index int, payload string"
    spark.createDataFrame(rows, schema).coalesce(1).write.json(source)
    stream = spark.readStream.schema(schema).json(source)
    paths = [str(tmp_path / name) for name in ("scored", "rejected", "checkpoint")]

    def run():
        score_stream(
            stream, lambda df: scoring.parse_requests(df, "payload", CONTRACT), formula(), "request_id", "input_index", *paths
        ).awaitTermination()
        return read_batches(spark, paths[0], "request_id int, input_index int, p double, complement double, priority_rank bigint")

    scored = run()
    got = [(r["input_index"], r["p"], r["complement"], r["priority_rank"]) for r in scored.orderBy("input_index").collect()]
    assert [(i, p, rank) for i, p, _, rank in got] == [(0, 0.8, 3), (1, 0.1, 1), (2, 0.4, 2)]
    assert all(c == pytest.approx(1 - p) for _, p, c, _ in got)
    assert spark.read.parquet(paths[1] + "/batch=*").first()["reasons"] == ["city:required"]
    more = [(2, 0, json.dumps(GOOD | {"city_development_index": 0.3}))]
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").json(source)
    assert run().count() == 4  # only the new file is scored


def test_requests_in_several_batches(spark, tmp_path):
    """Rows (request, index, value, expected, arrival in minutes) of one file each; the stream is started once per file."""
    files = [
        [(0, 0, 0.8, 3, 0), (1, 0, 0.5, 2, 0), (2, 0, 0.3, 1, 1), (None, 0, 0.3, 1, 1), (3, 0, 0.2, 5000, 1), (6, 0, 0.1, 2, 1)],
        [(0, 1, 0.1, 3, 5), (3, 1, 0.2, 5000, 5), (6, 1, 7.0, 2, 6)],
        [(0, 2, 0.4, 3, 30), (4, 0, 0.6, 2, 90)],
        [(1, 1, 0.4, 2, 2), (5, 0, 0.6, 1, 91), (5, 1, 0.6, 1, 91)],
        [(7, 0, 0.6, 1, 200)],
    ]
    schema = "request_id int, input_index int, payload string, expected int, arrived timestamp"
    paths = [str(tmp_path / name) for name in ("scored", "rejected", "state", "checkpoint")]
    epoch = datetime(2024, 1, 1)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        score_request_stream(
            stream, lambda df: scoring.parse_requests(df, "payload", CONTRACT), formula(), "request_id", "input_index", "expected",
            "arrived", timedelta(hours=1), *paths, maximum=100,
        ).awaitTermination()

    for file in files:
        rows = [(r, i, json.dumps(GOOD | {"city_development_index": v}), n, epoch + timedelta(minutes=at)) for r, i, v, n, at in file]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        run()
    scored = read_batches(spark, paths[0], "request_id int, input_index int, p double, priority_rank bigint")
    got = {(r.request_id, r.input_index): (r.p, r.priority_rank) for r in scored.collect()}
    assert scored.count() == len(got)
    assert got == {(0, 0): (0.8, 3), (0, 1): (0.1, 1), (0, 2): (0.4, 2), (2, 0): (0.3, 1), (7, 0): (0.6, 1)}
    refused = read_batches(spark, paths[1], "request_id int, input_index int, reasons array<string>")
    why = sorted(((r.request_id, r.input_index, ";".join(r.reasons)) for r in refused.collect()), key=str)
    assert why == sorted([
        (1, 0, "request:late"), (1, 1, "request:late"), (3, 0, "request:size"), (3, 1, "request:size"), (4, 0, "request:late"),
        (5, 0, "request:size"), (5, 1, "request:size"), (6, 0, "request:refused"), (6, 1, "city_development_index:range"),
        (None, 0, "request:key"),
    ], key=str)
    run()
    assert read_batches(spark, paths[0], "request_id int").count() == 5  # a restart without new files changes nothing
    left = open_requests(spark, paths[2], 4, schema)
    assert left.count() == 0


def test_events_are_dealt_before_requests_are_made(spark, tmp_path, monkeypatch):
    spark.range(40).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "'view' AS event_type", "repeat('x', 50) AS props"
    ).write.parquet(str(tmp_path / "events.parquet"))
    dealt = []

    def note(batch):
        dealt.append(batch.columns)
        return deal(batch)

    monkeypatch.setattr("tabloom.streaming.scoring.deal", note)
    monkeypatch.setattr(catalogue, "_registered_model", lambda *args: formula())
    fates = catalogue.stream_score(spark, str(tmp_path))
    assert sorted(row.event_id for row in fates.collect()) == list(range(40))
    assert dealt == [["event_id", "user_id"]]


def test_one_row_is_a_batch(spark):
    df = spark.createDataFrame([(0, 0, 0.25)], "request_id int, input_index int, city_development_index double")
    row = scoring.score_batch(df, formula(), "request_id", "input_index")[0].first()
    assert (row["p"], row["complement"], row["priority_rank"]) == (0.25, 0.75, 1)
    ranked = scoring.rank_all(df, "city_development_index", "input_index").first()
    assert ranked["rank"] == 1
