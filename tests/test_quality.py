"""Cleaning, typing, checks and missingness."""

import dataclasses

import pytest
from conftest import PEOPLE_SCHEMA, people_rows
from pyspark.sql import functions as F

from tabloom.contracts import PEOPLE, ContractError, require_columns
from tabloom.functions.clean import binary_label, clean_text, percent, remap, safe_double, safe_long
from tabloom.operators import quality


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_clean_text(spark):
    texts = ["  a ", "", "   ", None, " b　", "\t\nc d\r", " "]
    assert values(spark, texts, clean_text) == ["a", None, None, None, "b", "c d", None]


def test_safe_casts(spark):
    assert values(spark, ["1", "-5", "1.5", "1e3", "x", None, "99999999999999999999"], safe_long) == [
        1, -5, None, None, None, None, None,
    ]
    assert values(spark, ["1", "0.5", ".5", "5.", "1e3", "1.0d", "2f", "0x1F", "n/a", None], safe_double) == [
        1.0, 0.5, 0.5, 5.0, 1000.0, None, None, None, None, None,
    ]
    assert values(spark, ["inf", "-Infinity"], safe_double) == [float("inf"), float("-inf")]
    assert values(spark, ["1.0", "0", "1", "2.0", "0.5", "yes", None], binary_label) == [
        1, 0, 1, None, None, None, None,
    ]
    assert values(spark, ["a", "b", None], lambda c: remap(c, {"a": "A"})) == ["A", "b", None]
    assert values(spark, ["1"], lambda c: percent(F.lit(1), F.lit(0))) == [None]
    assert values(spark, ["1"], lambda c: percent(F.lit(1), F.lit(3))) == [33.33]


RAW_ROW = {
    "enrollee_id": "1", "city": " city_1 ", "city_development_index": "0.9", "gender": "Male",
    "relevent_experience": "Has relevent experience", "enrolled_university": "no_enrollment",
    "education_level": "Graduate", "major_discipline": "STEM", "experience": ">20", "company_size": "50-99",
    "company_type": "Pvt Ltd", "last_new_job": "1", "training_hours": "5", "target": "1.0",
}


def checks_of(spark, rows, **options):
    raw = spark.createDataFrame([tuple(r[c] for c in PEOPLE.raw_columns) for r in rows], PEOPLE.raw_schema)
    df = quality.modeling_table(raw, PEOPLE, "uri", "sha")
    checks = quality.quality_checks(df, PEOPLE, len(rows), "uri", "sha", raw, **options)
    return {r["check_name"]: r["failed_rows"] for r in checks.collect()}


def test_good_rows_pass(spark):
    rows = [RAW_ROW, RAW_ROW | {"enrollee_id": "2", "target": "0.0"}]
    checks = checks_of(spark, rows)
    assert len(checks) == 22 and not any(checks.values())


@pytest.mark.parametrize(
    "change,check",
    [
        ({"enrollee_id": "x"}, "enrollee_id_not_null"),
        ({"target": "2"}, "target_not_null"),
        ({"city": "city_1\nx"}, "city_domain"),
        ({"city": "city_"}, "city_domain"),
        ({"city": " "}, "city_domain"),
        ({"city_development_index": "1.01"}, "city_development_index_between_0_and_1"),
        ({"city_development_index": "nan"}, "city_development_index_between_0_and_1"),
        ({"city_development_index": ""}, "city_development_index_between_0_and_1"),
        ({"training_hours": "-1"}, "training_hours_nonnegative"),
        ({"relevent_experience": ""}, "relevant_experience_domain"),
        ({"gender": "male"}, "gender_domain"),
        ({"experience": "21"}, "experience_domain"),
        ({"company_size": "10-49"}, "company_size_domain"),
    ],
)
def test_one_breach_fails_one_check(spark, change, check):
    rows = [RAW_ROW, RAW_ROW | {"enrollee_id": "2", "target": "0.0"}, RAW_ROW | {"enrollee_id": "3"} | change]
    failing = {name for name, n in checks_of(spark, rows).items() if n}
    assert failing == {check}


def test_null_categories_pass_and_classes_are_counted(spark):
    checks = checks_of(spark, [RAW_ROW | {"gender": "", "company_size": " "}])
    assert {name for name, n in checks.items() if n} == {"both_target_classes_present"}


def test_empty_table(spark):
    checks = checks_of(spark, [])
    assert {name for name, n in checks.items() if n} == {"both_target_classes_present"}
    empty = spark.createDataFrame([], PEOPLE_SCHEMA)
    assert [tuple(r) for r in quality.missingness(empty, ["city"]).collect()] == [("city", 0, None)]


def test_unguarded_label_and_lineage(spark):
    rows = people_rows()
    rows[0] |= {"target": 7}
    df = spark.createDataFrame(rows, PEOPLE_SCHEMA).withColumn("training_hours", F.lit(1)).withColumn(
        "source_uri", F.when(F.col("enrollee_id") == 1001, F.lit("other")).when(F.col("enrollee_id") > 1002, F.lit("uri"))
    )
    checks = {
        r["check_name"]: r["failed_rows"]
        for r in quality.quality_checks(df, PEOPLE, 40, "uri", "a" * 64).collect()
    }
    assert checks["target_is_binary"] == 1
    assert checks["both_target_classes_present"] == 1  # three values are not two classes
    assert checks["source_uri_matches"] == 1  # NULL lineage passes
    assert "raw_and_modeling_row_counts_match" not in checks


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, None, "a"), (1, "a", None), (None, "b", "b"), (None, "b", "b")],
        "id int, x string, y string",
    )
    assert tuple(quality.duplicate_keys(df, "id").first()) == (3, 1, 2)
    assert tuple(quality.duplicate_rows(df).first()) == (5, 2)
    assert tuple(quality.duplicate_rows(df, exclude=["y"]).first()) == (5, 2)
    assert tuple(quality.duplicate_rows(df.limit(0)).first()) == (0, 0)


def test_validation_report_raises_with_names(spark):
    checks = spark.createDataFrame(
        [("b", "ERROR", 2), ("a", "ERROR", 1), ("w", "WARNING", 5), ("ok", "ERROR", 0)],
        "check_name string, severity string, failed_rows bigint",
    )
    row = quality.validation_report(checks).first()
    assert (row["passed"], row["failed_checks"]) == (False, ["a", "b"])
    with pytest.raises(ContractError, match="a, b"):
        quality.require_valid(checks)
    quality.require_valid(checks.where("failed_rows = 0 or severity = 'WARNING'"))


def test_frame_contract(spark, people):
    good = quality.require_frame(people, PEOPLE, 40, "a" * 64)
    assert good.columns == PEOPLE.scan_columns
    assert dict(good.dtypes)["target"] == "tinyint"
    breaches = {
        "identifier_duplicated": people.withColumn("enrollee_id", F.lit(1)),
        "identifier_missing": people.withColumn("enrollee_id", F.lit(None).cast("bigint")),
        "label_not_binary": people.withColumn("target", F.col("target") * 2),
        "city_development_index_out_of_range": people.withColumn("city_development_index", F.lit(1.5)),
        "source_hash_other": people.withColumn("source_sha256", F.lit("b")),
        "class_too_small": people.withColumn("target", F.lit(0)),
    }
    for name, df in breaches.items():
        with pytest.raises(ContractError, match=name):
            quality.require_frame(df, PEOPLE, 40, "a" * 64)
    with pytest.raises(ContractError, match="row_count"):
        quality.require_frame(people, PEOPLE, 41, "a" * 64)
    with pytest.raises(ContractError, match="city"):
        quality.require_frame(people.drop("city"), PEOPLE, 40, "a" * 64)


def test_contract_is_generic(spark):
    contract = dataclasses.replace(PEOPLE, identifier="id")
    assert contract.scan_columns[0] == "id"
    with pytest.raises(ContractError, match="b"):
        require_columns(spark.range(1), ["id", "b"])
