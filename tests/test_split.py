"""Splits, folds, digests and weights."""


import pytest
from conftest import PEOPLE_SCHEMA, people_rows
from pyspark.sql import functions as F

from tabloom.contracts import ContractError
from tabloom.operators import split


def numbered(spark, n, positives):
    return spark.range(n).select("id", (F.col("id") < positives).cast("int").alias("y"))


def test_published_sizes():
    quotas = split.development_quotas({0: 19_158 - 4_777, 1: 4_777}, 0.2)
    assert quotas == {0: 15_326 - 3_822, 1: 3_822}


def test_quotas_match_largest_remainders():
    for sizes in ({0: 7, 1: 3}, {0: 5, 1: 5}, {0: 13, 1: 4}, {0: 101, 1: 17}):
        total = sum(sizes.values())
        quotas = split.development_quotas(sizes, 0.2)
        assert sum(quotas.values()) == total - -(-total // 5)
        assert all(abs(quotas[c] - sizes[c] * sum(quotas.values()) / total) < 1 for c in sizes)


def test_forty_rows(spark):
    df = spark.createDataFrame(people_rows(), PEOPLE_SCHEMA)
    first = split.stratified_split(df, "enrollee_id", "target")
    counts = {r["split"]: (r["rows"], r["positive_rate"]) for r in split.split_manifest(first, "enrollee_id", "target").collect()}
    assert counts == {"development": (32, 0.25), "test": (8, 0.25)}
    again = split.stratified_split(df.orderBy(F.rand(3)).repartition(7), "enrollee_id", "target")
    assert sorted(first.select("enrollee_id", "split").collect()) == sorted(again.select("enrollee_id", "split").collect())
    other = split.stratified_split(df, "enrollee_id", "target", seed=43)
    assert sorted(first.select("enrollee_id", "split").collect()) != sorted(other.select("enrollee_id", "split").collect())


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_bucket_width_does_not_change_the_split(spark, monkeypatch, digits):
    df = numbered(spark, 500, 130)
    want = sorted(split.stratified_split(df, "id", "y").collect())
    monkeypatch.setattr(split, "BUCKET_DIGITS", digits)
    assert sorted(split.stratified_split(df, "id", "y").collect()) == want


def test_fold_sizes_deal_out_class_sorted_rows(spark):
    for sizes in ({0: 11, 1: 7}, {0: 10, 1: 5}, {0: 5, 1: 6}):
        dealt = [0] * sizes[0] + [1] * sizes[1]
        want = {c: [sum(1 for j, v in enumerate(dealt) if v == c and j % 5 == f) for f in range(5)] for c in sizes}
        assert split.fold_sizes(sizes, 5) == want
    df = split.stratified_folds(numbered(spark, 103, 41), "id", "y", folds=5)
    counts = {(r["fold"], r["y"]): r["count"] for r in df.groupBy("fold", "y").count().collect()}
    want = split.fold_sizes({0: 62, 1: 41}, 5)
    assert counts == {(f + 1, c): want[c][f] for c in (0, 1) for f in range(5)}


@pytest.mark.parametrize("size", [0, 0.5, 0.9, -0.1])
def test_bad_test_size(spark, size):
    with pytest.raises(ValueError):
        split.stratified_split(numbered(spark, 10, 5), "id", "y", test_size=size)


def test_refusals(spark):
    with pytest.raises(TypeError):
        split.stratified_split(numbered(spark, 10, 5), "id", "y", seed=True)
    with pytest.raises(ContractError):
        split.stratified_split(numbered(spark, 10, 0), "id", "y")
    with pytest.raises(ContractError):
        split.stratified_split(numbered(spark, 10, 1), "id", "y")
    with pytest.raises(ValueError):
        split.stratified_folds(numbered(spark, 10, 5), "id", "y", folds=2)
    with pytest.raises(ContractError):
        split.stratified_folds(numbered(spark, 10, 3), "id", "y", folds=5)


@pytest.mark.parametrize("ids", [[1] * 100, [None, *range(99)]])
def test_identifiers_that_break_quotas_are_refused(spark, ids):
    df = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "id long, y int")
    with pytest.raises(ContractError, match="must"):
        split.stratified_split(df, "id", "y")
    with pytest.raises(ContractError, match="must"):
        split.stratified_folds(df, "id", "y")


def test_weights_and_disjointness(spark):
    weighted = split.class_weights(numbered(spark, 10, 2), "y")
    assert {(r["y"], r["weight"]) for r in weighted.collect()} == {(1, 2.5), (0, 0.625)}
    both = numbered(spark, 10, 5).withColumn("split", F.lit("test")).unionByName(
        numbered(spark, 3, 1).withColumn("split", F.lit("development"))
    )
    assert split.shared_identifiers(both, "id").first()["shared_identifiers"] == 3
