"""Spherical-cap filters against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import caps, queries

FOLDER = "/root/testdata/sf0.01"


def plain(rows, cosine=0.98):
    """id, links, component per row over all pairs of valid rows."""
    vectors = []
    for _, vector, label in rows:
        good = vector and label is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        vectors.append(np.array(vector, dtype=np.float32).astype(float) if good else None)
    links, group = [0] * len(rows), list(range(len(rows)))
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2]:
                continue
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine:
                links[i], links[j] = links[i] + 1, links[j] + 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = [r[0] for r in rows]
    first = {g: min((i for i, h in zip(ids, group) if h == g and i is not None), default=None) for g in group}
    return sorted(((i, n, first[g]) for i, n, g in zip(ids, links, group)), key=str)


def made(seed, groups, noise, size):
    rng = np.random.default_rng(seed)
    rows = []
    for g, members in enumerate(groups):
        centre = rng.standard_normal(size)
        for _ in range(members):
            v = centre + noise * rng.standard_normal(size)
            rows.append((v / np.linalg.norm(v)).astype(np.float32).tolist())
    order = rng.permutation(len(rows))
    return [(int(i), rows[k], g % 3) for g, (i, k) in enumerate(zip(range(len(rows)), order))]


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({"node": F.lit("clash"), "n": F.lit(0), "filters": F.lit(1)})
    found = caps.near_duplicate_vectors(df, **options).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str)


def test_documented_vectors(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    found = queries.op9_spherical_caps(spark, FOLDER).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain(rows)


@pytest.mark.parametrize("block_rows", [1024, 20])
def test_groups_of_near_copies(spark, block_rows):
    rows = made(3, [90, 70, 5, 2] + [1] * 60, 0.09, 64)
    wanted = plain(rows)
    assert sum(n for _, n, _ in wanted) > 1000
    found = result(spark, rows, block_rows=block_rows)
    missed = sum(n for _, n, _ in wanted) - sum(n for _, n, _ in found)
    assert 0 <= missed <= 0.002 * sum(n for _, n, _ in wanted)
    assert all(a <= b for (_, a, _), (_, b, _) in zip(found, wanted))


def test_recall_at_the_threshold(spark):
    """Pairs of cosine just above the threshold are the hardest ones to find."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(400):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (0.9805 * a + np.sqrt(1 - 0.9805**2) * b).tolist(), 0)]
    found = result(spark, rows)
    assert sum(n for _, n, _ in found) >= 2 * 0.98 * 400


def test_edge_cases(spark):
    v, w = [1.0, 2.0, 3.0, 4.0, 5.0], [5.0, -1.0, 0.5, 0.0, 1.0]
    rows = [(9, v, 1), (3, v, 1), (3, v, 1), (4, [2 * x for x in v], 1), (5, v, 2), (6, v, None), (7, None, 1), (8, [], 1),
            (10, [0.0] * 5, 1), (11, [1.0, None, 3.0, 4.0, 5.0], 1), (12, [float("nan")] * 5, 1), (13, [float("inf"), 1.0, 1.0, 1.0, 1.0], 1),
            (None, w, 1), (14, w, 1), (None, [7.0, 1.0], 1), (15, [1.0, 2.0], 1), (16, [1.0], 1), (17, [2.0], 1), (18, [-1.0], 1)]
    assert result(spark, rows) == plain(rows)
    assert result(spark, rows[:0]) == []
    assert result(spark, [(1, None, None)]) == [(1, 0, 1)]


@pytest.mark.parametrize("kind", ["one-hot", "three coordinates", "padded", "dense"])
def test_vectors_with_weight_in_few_coordinates(spark, kind):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(150):
        v = rng.standard_normal(64)
        if kind == "one-hot":
            v = np.eye(64)[k % 64] * rng.choice([-1, 1])
        elif kind == "three coordinates":
            v[rng.permutation(64)[3:]] = 0
        elif kind == "padded":
            v[16:] = 0
        v /= np.linalg.norm(v)
        noise = rng.standard_normal(64)
        near = v + 0.045 * noise / np.linalg.norm(noise)
        rows += [(2 * k, v.tolist(), k), (2 * k + 1, near.tolist(), k)]
    assert sum(n for _, n, _ in plain(rows)) == 300
    assert result(spark, rows) == plain(rows)
