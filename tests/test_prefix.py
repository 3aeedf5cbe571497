"""Running totals, ranks and lookups: physical choices never change results."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.operators.lookup import left_lookup
from tabloom.operators.prefix import global_rank, part_count, running_totals


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    # A third of the rows tie on one score and most are in one group.
    return [
        (i, "hot" if i % 3 else "cold", 0.5 if i % 3 == 0 else rng.randrange(9) / 10, rng.randrange(2))
        for i in range(200)
    ]


def expected_totals(rows):
    result = {}
    for group in ("hot", "cold"):
        total = 0
        for i, _, _, y in sorted((r for r in rows if r[1] == group), key=lambda r: (r[2], r[0])):
            total += y
            result[i] = total
    return result


@pytest.mark.parametrize("parts", [None, 1, 2, 7, 64])
def test_running_totals_match_a_loop(spark, rows, parts):
    df = spark.createDataFrame(rows, "id int, grp string, p double, y int").repartition(5)
    result = running_totals(df, [F.col("p"), F.col("id")], {"total": "y"}, ["grp"], parts)
    assert {r["id"]: r["total"] for r in result.collect()} == expected_totals(rows)


@pytest.mark.parametrize("parts", [1, 5])
def test_global_rank_descending(spark, rows, parts):
    df = spark.createDataFrame(rows, "id int, grp string, p double, y int")
    ranked = global_rank(df, [F.col("p").desc(), F.col("id")], parts=parts)
    order = [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0]))]
    assert [r["id"] for r in ranked.orderBy("rank").collect()] == order
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 201))


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, p double")
    assert global_rank(df, [F.col("p"), F.col("id")]).collect() == []
    assert global_rank(df, [F.col("p"), F.col("id")], parts=3).collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=30), st.integers(2, 9))
def test_any_rows_and_parts(spark, values, parts):
    df = spark.createDataFrame([(i, p, y) for i, (p, y) in enumerate(values)], "id int, p int, y int")
    got = running_totals(df, [F.col("p"), F.col("id")], {"total": "y"}, parts=parts)
    total, want = 0, {}
    for i, (p, y) in sorted(enumerate(values), key=lambda item: (item[1][0], item[0])):
        total += y
        want[i] = total
    assert {r["id"]: r["total"] for r in got.collect()} == want


def test_part_count_is_bounded():
    assert part_count(0) == part_count(1) == 1
    assert part_count(10**6) == 2
    assert part_count(10**13) == 20_000


@pytest.mark.parametrize("broadcast_rows", [1_000, 0])
def test_lookup_broadcast_and_hot_cold_agree(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr("tabloom.operators.lookup.HOT_KEYS", 4)
    keys = ["hot"] * 60 + [f"k{i}" for i in range(40)] + ["unknown"]
    rows = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    table = spark.createDataFrame(
        [("hot", 60, "H")] + [(f"k{i}", 1, f"v{i}") for i in range(40)], "k string, n bigint, v string"
    )
    joined = left_lookup(rows, table, ["k"], "n", broadcast_rows=broadcast_rows)
    want = {i: {"hot": "H", "unknown": None}.get(k, "v" + k[1:]) for i, k in enumerate(keys)}
    assert {r["id"]: r["v"] for r in joined.collect()} == want
    assert joined.count() == len(keys)
