"""Skew-safe lookups: broadcast, hot and salted paths give the same rows."""

import pytest
from pyspark.sql import functions as F

from tabloom.operators import lookup


@pytest.mark.parametrize("rows,size", [(None, None), (0, lookup.BROADCAST_BYTES), (0, 0)])
def test_all_paths_agree(spark, monkeypatch, rows, size):
    monkeypatch.setattr(lookup, "HOT_KEYS", 10)
    left = [(1, i) for i in range(500)] + [(2, 0), (3, 0), (None, 7), (None, 8), (9, 1)]
    df = spark.createDataFrame(left, "k int, v int").withColumn("hot", F.lit("own"))
    table = spark.createDataFrame([(1, 500, "a"), (2, 1, "b"), (3, 1, None)], "k int, n int, name string")
    bounds = {} if rows is None else {"broadcast_rows": rows, "broadcast_bytes": size}
    found = lookup.left_lookup(df, table, ["k"], "n", **bounds)
    names = {1: "a", 2: "b"}
    assert sorted(map(str, map(tuple, found.select("k", "v", "hot", "name").collect()))) == sorted(
        str((k, v, "own", names.get(k))) for k, v in left
    )


def test_nested_values_count_by_their_length(spark):
    table = spark.range(10).selectExpr(
        "id", "array_repeat(1D, 1000) AS wide", "array_repeat('abcd', 100) AS texts", "struct(id, repeat('x', 50) AS t) AS s",
        "map('key', array(1L, 2L)) AS m", "CAST(NULL AS array<long>) AS none",
    )
    rows, size = lookup._size(table)
    assert rows == 10
    assert size == 10 * (8 + (8 + 8000) + (8 + 100 * 12) + (8 + 8 + 58) + (8 + (8 + 11) + (8 + 8 + 16)) + 8)
    keys = spark.range(40).select((F.col("id") % 10).alias("id"))
    wide = lookup.left_lookup(keys, table.withColumn("n", F.lit(4)), ["id"], "n", broadcast_bytes=10_000)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower() or "__salt" in plan
    assert wide.where("size(wide) = 1000").count() == 40
