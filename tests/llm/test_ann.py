"""Projected neighbours against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import ann, queries

FOLDER = "/root/testdata/sf0.01"


def plain(rows, asks, k):
    """id -> [(id, score)] over all other rows."""
    seen = {}
    for i, vector in rows:
        if i is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            seen[i, tuple(vector)] = np.array(vector, dtype=np.float32).astype(float)
    found = {}
    for (i, _), q in seen.items():
        if asks(i):
            scored = sorted((-float((q * x).sum()), j) for (j, _), x in seen.items() if j != i)
            found[i] = [(j, -s) for s, j in scored[:k]]
    return {i: x for i, x in found.items() if x}


def result(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(found[row.query_id])
    return found


def recall(found, wanted):
    hits = sum(len({j for j, _ in found.get(i, [])} & {j for j, _ in x}) for i, x in wanted.items())
    return hits / sum(len(x) for x in wanted.values())


def test_query_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    wanted = plain(rows, lambda i: i % 20 == 0, 20)
    found = result(queries.op1_projected_neighbours(spark, FOLDER))
    assert set(found) == set(wanted) and all(len(x) == 20 for x in found.values())
    assert recall(found, wanted) >= 0.95


def test_cells_leaves_and_lengths(spark, monkeypatch):
    """Many cells and leaves, vectors of unequal lengths, so that the inner product is not the cosine."""
    monkeypatch.setattr(ann, "CELL_ROWS", 64)
    monkeypatch.setattr(ann, "LEAF_ROWS", 16)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] * rng.uniform(0.5, 2) + 0.3 * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    wanted = plain(rows, lambda i: i % 7 == 0, 10)
    found = result(ann.nearest(df, F.col("vec_id") % 7 == 0, k=10))
    assert recall(found, wanted) >= 0.9
    exact = {i: dict(x) for i, x in wanted.items()}
    for i, x in found.items():
        assert [s for _, s in x] == sorted((s for _, s in x), reverse=True)
        assert all(abs(exact[i][j] - s) < 1e-9 for j, s in x if j in exact[i])


def test_every_width_is_searched(spark, monkeypatch):
    """Widths keep apart, the rarer ones in several cells too; copies and a lone width stay right."""
    monkeypatch.setattr(ann, "CELL_ROWS", 32)
    rng = np.random.default_rng(4)
    widths = [8] * 300 + [4] * 120 + [5] * 3 + [2]
    rows = [(i, rng.standard_normal(width).astype(np.float32).tolist()) for i, width in enumerate(widths)]
    rows += [(1000 + i, v) for i, v in rows[300:340]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5, "vec_id")
    wanted = {}
    for width in (8, 4, 5, 2):
        wanted |= plain([r for r in rows if len(r[1]) == width], lambda i: i % 3 == 0, 5)
    found = result(ann.nearest(df, F.col("vec_id") % 3 == 0, k=5))
    assert set(found) == set(wanted) and len(found[420]) == 2 and 423 not in found
    assert all(len(found[i]) == len(x) for i, x in wanted.items())
    assert recall(found, wanted) >= 0.9


def test_copies_and_ties(spark):
    hot, other = [1.0, 0.0, 2.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(i, hot) for i in range(300, 0, -1)] + [(i, other) for i in range(301, 306)] + [(400, [0.5, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = result(ann.nearest(df, F.col("vec_id").isin(1, 7, 250, 303), k=20))
    assert found == plain(rows, lambda i: i in (1, 7, 250, 303), 20)
    assert [j for j, _ in found[7]] == [*range(1, 7), *range(8, 22)]


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(0, v), (0, v), (20, None), (40, []), (60, [0.0] * 3), (80, [1.0, None, 1.0]), (100, [float("nan")] * 3), (None, v),
            (120, [float("inf"), 0.0, 0.0]), (1, v), (2, [3.0, 2.0, 1.0]), (140, [3.0, 2.0, 1.0]), (160, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"node": F.lit("clash"), "key": F.lit(1)})
    found = result(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert found == plain([r for r in rows if r[0] != 160], lambda i: i % 20 == 0, 20) and set(found) == {0, 140}
    assert ann.nearest(df.limit(0), F.lit(True)).collect() == []
    assert ann.nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []


def test_chi_square():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.50731, abs=1e-4)
    assert ann.chi_square_quantile(0.5, 2) == pytest.approx(2 * np.log(2), abs=1e-9)
    with pytest.raises(ValueError):
        ann.chi_square_quantile(0.5, 3)
