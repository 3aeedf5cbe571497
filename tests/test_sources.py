"""CSV contracts, manifests, tables, reports and the model registry."""

import hashlib
import json
import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tabloom.contracts import PEOPLE, ContractError
from tabloom.sources import claims, csv, manifests, registry, tables

HEADER = ",".join(PEOPLE.raw_columns)
ROW = ",".join(["value"] * len(PEOPLE.raw_columns))


def write(folder, text, name="people.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)
    return str(path)


def test_good_csv(spark, tmp_path):
    text = f"{HEADER}\n{ROW}\n{ROW}\n"
    path = write(tmp_path, text)
    files = csv.file_manifest(spark, path).first()
    assert files["sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert files["size_bytes"] == len(text.encode())
    manifest = csv.verify_csv(spark, path, PEOPLE, 2, len(text.encode()))
    assert manifest.columns == tuple(PEOPLE.raw_columns)
    assert json.loads(manifest.metadata()["columns"]) == PEOPLE.raw_columns
    loaded = csv.load_raw(spark, path, PEOPLE, str(tmp_path / "raw"), 2)
    assert loaded.count() == 2 and set(loaded.first()) == {"value"}


def test_byte_order_mark(spark, tmp_path):
    path = write(tmp_path, f"﻿{HEADER}\n{ROW}\n")
    assert csv.csv_manifest(spark, path, PEOPLE).row_count == 1


@pytest.mark.parametrize(
    "text",
    [
        f"{HEADER.replace('city,', 'town,', 1)}\n{ROW}\n",
        f"{HEADER}\n{ROW},extra\n",
        f"{HEADER}\n{ROW}\nvalue,value\n",
        HEADER + "\n" + ROW.replace("value", '"a\nb"', 1) + "\n",
    ],
    ids=["header", "long row", "short row", "quoted newline"],
)
def test_bad_csv_fails(spark, tmp_path, text):
    with pytest.raises(Exception):  # noqa: B017  the reader's own errors
        csv.csv_manifest(spark, write(tmp_path, text), PEOPLE)


@pytest.mark.parametrize("pinned", [{"expected_rows": 3}, {"expected_bytes": 1}, {"expected_digest": "x"}])
def test_pinned_numbers(spark, tmp_path, pinned):
    with pytest.raises(ContractError):
        csv.verify_csv(spark, write(tmp_path, f"{HEADER}\n{ROW}\n"), PEOPLE, **pinned)


def test_large_files_are_streamed(spark, tmp_path):
    for name in ("a.bin", "b.bin"):
        (tmp_path / name).write_bytes(name.encode() * 700_000)
    small = sorted(csv.file_manifest(spark, str(tmp_path)).collect())
    streamed = sorted(csv.file_manifest(spark, str(tmp_path), in_memory_bytes=10).collect())
    assert small == streamed and len(small) == 2


def test_folder_digest_sees_names_and_content(spark, tmp_path):
    def digest(folder):
        return csv.folder_digest(csv.file_manifest(spark, str(folder)), str(folder)).first()["digest"]

    seen = set()
    for number, (name, text) in enumerate([("a", "1"), ("a", "2"), ("b", "1")]):
        folder = tmp_path / str(number)
        folder.mkdir()
        write(folder, text, name)
        seen.add(digest(folder))
    copy = tmp_path / "copy"
    copy.mkdir()
    write(copy, "1", "a")
    assert len(seen) == 3 and digest(copy) in seen


def test_digest_and_pin_of_a_single_file(spark, tmp_path):
    text = f"{HEADER}\n{ROW}\n"
    paths = []
    for folder in ("here", "there"):
        (tmp_path / folder).mkdir()
        paths.append(write(tmp_path / folder, text))
    first, second = (csv.csv_manifest(spark, path, PEOPLE) for path in paths)
    assert first.digest == second.digest and first.sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert csv.verify_csv(spark, paths[0], PEOPLE, expected_sha256=first.sha256) == first
    with pytest.raises(ContractError, match="SHA-256"):
        csv.verify_csv(spark, paths[0], PEOPLE, expected_sha256="0" * 64)
    with pytest.raises(ContractError, match="sha256"):
        csv.acquire(spark, paths[0], PEOPLE, str(tmp_path / "store"), {"sha256": "0" * 64})


def test_a_second_copy_or_a_broken_one_is_noticed(spark, tmp_path):
    path, store = write(tmp_path, f"{HEADER}\n{ROW}\n"), str(tmp_path / "store")
    folder, _ = csv.acquire(spark, path, PEOPLE, store)
    row = spark.read.parquet(f"{store}/published").first()
    twin = spark.createDataFrame([(row["digest"], folder + "-later", 1, row["content"])], csv.PUBLISHED)
    twin.write.mode("append").parquet(f"{store}/published")
    assert csv.acquire(spark, path, PEOPLE, store) == (folder, True)
    spark.read.parquet(folder).withColumn("city", F.lit("other")).write.parquet(str(tmp_path / "changed"))
    spark.read.parquet(str(tmp_path / "changed")).write.mode("overwrite").parquet(folder)
    with pytest.raises(ContractError, match="conflicts"):
        csv.acquire(spark, path, PEOPLE, store)


def test_acquire_is_idempotent(spark, tmp_path):
    path = write(tmp_path, f"{HEADER}\n{ROW}\n")
    store = str(tmp_path / "store")
    first, reused = csv.acquire(spark, path, PEOPLE, store, {"row_count": "1"})
    again, reused_again = csv.acquire(spark, path, PEOPLE, store)
    assert (first, reused, reused_again) == (again, False, True)
    with pytest.raises(ContractError, match="row_count"):
        csv.acquire(spark, path, PEOPLE, store, {"row_count": "2"})


def test_manifest_diff(spark):
    def table(pairs):
        return spark.createDataFrame(pairs, "key string, value string")

    wanted, found = table([("a", "1"), ("b", "2"), ("c", None)]), table([("a", "1"), ("b", "3"), ("d", "4")])
    got = {r["key"]: (r["problem"], r["expected"], r["actual"]) for r in manifests.manifest_diff(wanted, found).collect()}
    assert got == {"b": ("mismatch", "2", "3"), "c": ("missing", None, None), "d": ("unexpected", None, "4")}
    with pytest.raises(ContractError, match="b .mismatch., c .missing."):
        manifests.require_same_manifest(wanted, found)
    manifests.require_same_manifest(table([("a", "1")]), found)


def test_report_catalog(spark):
    written = spark.createDataFrame([("r1", "final"), ("r1", "other"), ("r2", "other")], "run string, name string")
    catalog = manifests.report_catalog(written, "run", "name", ["final", "split"])
    assert manifests.require_reports(catalog.where("run = 'r1'")) == ["final"]
    with pytest.raises(ContractError):
        manifests.require_reports(catalog.where("run = 'r2'"))


def test_tables_and_reports(spark, tmp_path, people):
    tables.replace_table(people.limit(3), "t_people")
    assert tables.replace_table(people, "t_people").count() == 40
    found = tables.run_sql(spark, "SELECT count(*) n FROM IDENTIFIER(:t) WHERE target = :y", t="t_people", y=1)
    assert found.first()["n"] == 10
    with pytest.raises(Exception, match="UNBOUND"):
        tables.run_sql(spark, "SELECT :missing", other=1).collect()
    assert tables.pinned_scan(people, "source_sha256", "b", ["enrollee_id"]).count() == 0
    report = spark.createDataFrame([(1, None)], "b int, a string").withColumn("d", F.lit(1).cast("decimal(10,2)"))
    tables.write_report(report, str(tmp_path / "report"))
    text = spark.read.text(str(tmp_path / "report")).first()[0]
    assert text == '{"a":null,"b":1,"d":1.0}'


def test_versions_lie_side_by_side(spark, tmp_path, people):
    store = tables.VersionedTable(spark, str(tmp_path / "store"), "source_sha256")
    a, b = "a" * 64, "b" * 64
    with pytest.raises(ContractError, match="is stored"):
        store.scan(a, ["enrollee_id"])
    other = people.limit(7).withColumns({"source_sha256": F.lit(b), "extra": F.lit(1)})
    assert store.publish(people, a) == 40 and store.publish(other, b) == 7
    scan = store.scan(a, ["enrollee_id", "target", "source_sha256"])
    assert sorted(scan.collect()) == sorted(people.select(scan.columns).collect())
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*table_version#\d+ = aaaa", plan)
    assert "ReadSchema: struct<enrollee_id:bigint,target:bigint,source_sha256:string>" in plan
    assert store.scan(b, ["extra"]).count() == 7
    # A run that reads goes on with its copy while a later one replaces it.
    store.publish(people.limit(3), a)
    assert scan.count() == 40 and store.scan(a, ["enrollee_id"]).count() == 3
    # Rows of another version, or none of them: nothing becomes visible.
    with pytest.raises(ContractError, match="3 rows belong"):
        store.publish(people.limit(3), b)
    with pytest.raises(ContractError, match="missing|lack|column"):
        store.publish(people.drop("source_sha256"), b)
    with pytest.raises(ContractError, match="table_copy"):
        store.publish(people.withColumn("table_copy", F.lit(1)), a)
    assert store.publish(people.limit(0), "empty") == 0 and store.scan("empty", ["city"]).count() == 0
    assert {r["version"]: r["rows"] for r in store.versions().collect()} == {a: 3, b: 7, "empty": 0}


def test_one_of_many_runs_holds_a_claim(spark, tmp_path):
    store = claims.Claims(spark, str(tmp_path / "claims"))
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda number: store.take("work", f"run {number}"), range(4)))
    assert sum(won) == 1
    holder = store.active("work").where("holds").collect()
    assert [row["owner"] for row in holder] == [f"run {won.index(True)}"]
    assert not store.take("work", "late") and store.take("other work", "late")
    store.repeat("work", "again")
    assert store.active("work").where("holds").count() == 2


def test_a_dead_run_keeps_its_claim(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(claims, "WAIT", 0.0)
    store = claims.Claims(spark, str(tmp_path / "claims"))
    store._write("work", "dead", "1" * 32, claims.WANTED)
    assert not store.take("work", "second")
    store._write("work", "dead", "1" * 32, claims.WITHDRAWN)
    assert store.take("work", "third")


def model(number):
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {number} AS probability FROM __THIS__")])


def test_registry(spark, tmp_path, people):
    store = registry.ModelRegistry(spark, str(tmp_path / "registry"))
    assert store.versions().count() == 0
    with pytest.raises(ContractError):
        store.load("m", "candidate")
    for number in (1, 2):
        assert store.register("m", model(number), people, features=PEOPLE.features, parameters={"c": "1"},
                              test_metrics={"test_roc_auc": 0.5}, source_sha256="s", trial=7) == number
    store.promote("m", "candidate", 1, people)
    assert store.load("m", "candidate").transform(people).first()["probability"] == 1
    store.promote("m", "candidate", 2, people)
    assert store.load("m", "candidate").transform(people).first()["probability"] == 2
    bad = PipelineModel(stages=[SQLTransformer(statement="SELECT no_such_column FROM __THIS__")])
    version = store.register("m", bad, people, features=PEOPLE.features)
    with pytest.raises(Exception, match="no_such_column"):
        store.promote("m", "candidate", version, people)
    row = store.describe("m", "candidate").first()
    assert row["version"] == 2 and len(row["example"]) == 5 and row["features"] == PEOPLE.features
    text = registry.descriptor_text(row)
    parsed = registry.parse_descriptors(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert parsed["problem"] is None and parsed["trial"] == 7 and parsed["test_metrics"] == {"test_roc_auc": 0.5}
    with pytest.raises(ContractError):
        store.set_alias("m", "candidate", 9)


@pytest.mark.parametrize(
    "text,problem",
    [
        ('{"schema_version":1,"model":{"model_uri":"u"}}', None),
        ('{"schema_version":2,"model":{"model_uri":"u"}}', "schema_version"),
        ('{"schema_version":1,"model":"u"}', "model"),
        ('{"schema_version":1,"model":{}}', "model_uri"),
        ('{"schema_version":1,"model":{"model_uri":"u","parameters":[1]}}', "mapping"),
        ("not json", "schema_version"),
    ],
)
def test_descriptor_problems(spark, text, problem):
    parsed = registry.parse_descriptors(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert parsed["problem"] == problem
    if problem is None:
        assert parsed["parameters"] == {} and parsed["trial"] is None
