"""Poisson replication against its SQL, known rates, and edge cases."""

import math
from collections import Counter

import comparing
from pyspark.sql import functions as F

from tabloom.llm import mixing, queries

FOLDER = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    df = queries.op4_poisson_mix(spark, FOLDER)
    assert comparing.difference(df, comparing.connect(FOLDER), queries.ORACLES["op4_poisson_mix"]) is None


def test_plan_is_native(spark):
    plan = queries.op4_poisson_mix(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_counts_follow_the_poisson_distribution(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    sizes = mixing.source_sizes(docs)
    rates = mixing.repetition_rates(sizes, mixing.given_weights(sizes, {"a": 1.0}), total=100_000)
    assert rates.first().rate == 2.5
    copies = Counter(r[0] for r in mixing.poisson_mix(docs, rates).select("doc_id").collect())
    counts = Counter(copies.get(i, 0) for i in range(40_000))
    for k in range(7):
        wanted = 40_000 * math.exp(-2.5) * 2.5**k / math.factorial(k)
        assert abs(counts[k] - wanted) < 6 * math.sqrt(wanted)


def test_target_weights_are_met(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("source")
    )
    sizes = mixing.source_sizes(docs)
    rates = mixing.repetition_rates(sizes, mixing.given_weights(sizes, {"big": 1, "small": 3, "absent": 5}))
    found = dict(mixing.poisson_mix(docs, rates).groupBy("source").count().collect())
    assert abs(found["small"] / sum(found.values()) - 0.75) < 0.02 and abs(sum(found.values()) - 20_000) < 900


def test_order_is_a_shuffle(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5).cast("string").alias("source"))
    sizes = mixing.source_sizes(docs)
    rates = mixing.repetition_rates(sizes, mixing.temperature_weights(sizes))
    ids = [r[0] for r in mixing.poisson_mix(docs, rates).select("doc_id").collect()]
    rising = sum(a < b for a, b in zip(ids, ids[1:])) / len(ids)
    assert 0.45 < rising < 0.55


def test_large_rates(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, source string")
    sizes = mixing.source_sizes(docs)
    rates = mixing.repetition_rates(sizes, mixing.given_weights(sizes, {"a": 1.0}), total=4000)
    counts = dict(mixing.poisson_mix(docs, rates).groupBy("doc_id").count().collect())
    assert all(1700 < n < 2300 for n in counts.values()) and len(counts) == 2


def test_edge_cases(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, "x"), (None, None, ""), (3, "", "y"), (4, "n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"n": F.lit(1), "rate": F.lit(0)})
    sizes = mixing.source_sizes(docs)
    assert sizes.count() == 4
    rates = mixing.repetition_rates(sizes, mixing.temperature_weights(sizes), total=120)
    found = mixing.poisson_mix(docs, rates)
    assert found.columns == [*docs.columns, "copy", "shuffle_key"]
    per_row = Counter(tuple(r[:3]) for r in found.collect())
    assert set(per_row) == set(rows) and per_row[rows[0]] % 2 == 0
    empty = docs.limit(0)
    none = mixing.source_sizes(empty)
    assert mixing.poisson_mix(empty, mixing.repetition_rates(none, mixing.temperature_weights(none))).collect() == []
    zero = mixing.repetition_rates(sizes, mixing.given_weights(sizes, {"a": 0.0}))
    assert mixing.poisson_mix(docs, zero).collect() == []
    assert mixing.poisson_mix(docs, mixing.repetition_rates(sizes, mixing.given_weights(sizes, {}))).collect() == []
    clash = docs.withColumns({name: F.lit(name) for name in ("copy", "Steps", "source_key", "shuffle_key")})
    renamed = mixing.poisson_mix(clash, rates)
    assert renamed.columns == [*clash.columns, "copy_", "shuffle_key_"] and renamed.count() == found.count()
    assert {r[0] for r in renamed.select("copy").collect()} == {"copy"}
