"""Leaf-wise trees against a plain version that splits one leaf at a time."""

import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import boosting
from tabloom.operators.boosting import LeafwiseBooster

S = boosting.SCALE


def rows_of(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [float(rng.randrange(30)), float(rng.randrange(8)), float(rng.random() < 0.1), 5.0]
        y = float(x[0] + 3 * x[1] + 8 * x[2] + rng.random() * 6 > 30)
        rows.append((i, x, y, 1.0 + (i % 3 == 0)))
    return rows


def plain_fit(rows, trees, rate, leaves, depth, least, alpha, lam, weighted=False):
    """Splits (tree, step, feature, value bin, gain, rows left, rows right) and final scores."""
    def weight(row):
        return row[3] if weighted else 1.0

    def value(g, h):
        return -math.copysign(max(abs(g) - alpha, 0.0), g) / (h + lam)

    def part(g, h):
        return max(abs(g) - alpha, 0.0) ** 2 / (h + lam)

    levels = [sorted({row[1][k] for row in rows}) for k in range(4)]
    total = sum(map(weight, rows))
    prior = sum(weight(row) * row[2] for row in rows) / total
    scores, splits = [math.log(prior / (1 - prior))] * len(rows), []
    for tree in range(trees):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        g = [math.floor(weight(r) * (q - r[2]) * S + 0.5) / S for q, r in zip(p, rows)]
        h = [math.floor(weight(r) * q * (1 - q) * S + 0.5) / S for q, r in zip(p, rows)]
        groups = [(0, list(range(len(rows))))]
        for step in range(1, leaves):
            best = None
            for at, (deep, members) in enumerate(groups):
                if deep >= depth:
                    continue
                whole = part(sum(g[i] for i in members), sum(h[i] for i in members))
                for k in range(4):
                    for b, border in enumerate(levels[k]):
                        sides = [[i for i in members if (rows[i][1][k] > border) == side] for side in (False, True)]
                        if min(map(len, sides)) < least:
                            continue
                        gain = sum(part(sum(g[i] for i in side), sum(h[i] for i in side)) for side in sides) - whole
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, at, k, b, sides)
            if best is None:
                break
            gain, at, k, b, sides = best
            deep = groups[at][0] + 1
            groups[at : at + 1] = [(deep, sides[0]), (deep, sides[1])]
            splits.append((tree + 1, step, k, b, round(gain, 6), len(sides[0]), len(sides[1])))
        for _, members in groups if len(groups) > 1 else []:
            add = value(sum(g[i] for i in members), sum(h[i] for i in members))
            for i in members:
                scores[i] += rate * add
    return splits, [1 / (1 + math.exp(-s)) for s in scores]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>, label double, weight double")


def found_splits(model):
    names = ("tree", "step", "feature", "bin", "gain", "left_rows", "right_rows")
    return [tuple(round(s[n], 6) if n == "gain" else s[n] for n in names) for s in model.splits]


@pytest.mark.parametrize(("leaves", "depth", "weighted"), [(6, 10, False), (9, 3, True), (2, 1, False)])
def test_trees_against_a_plain_version(spark, leaves, depth, weighted):
    rows = rows_of(300)
    wanted, scores = plain_fit(rows, 3, 0.3, leaves, depth, 8, 0.5, 1.0, weighted)
    booster = LeafwiseBooster(
        numTrees=3, learningRate=0.3, numLeaves=leaves, maxDepth=depth, minRowsPerLeaf=8, regAlpha=0.5, regLambda=1.0,
        weightCol="weight" if weighted else None,
    )
    model = booster.fit(frame(spark, rows).repartition(5))
    assert found_splits(model) == wanted
    assert all(boosting.depth(tree) <= depth for tree in model.trees)
    found = model.transform(frame(spark, rows)).select("id", "probability")
    assert [round(r.probability[1], 9) for r in found.orderBy("id").collect()] == [round(p, 9) for p in scores]


def test_scores_written_again_and_small_groups_of_nodes_change_nothing(spark, monkeypatch):
    rows = rows_of(200, 4)
    booster = LeafwiseBooster(numTrees=4, learningRate=0.2, numLeaves=5, minRowsPerLeaf=5, subsample=0.8, featureShare=0.7)
    plain = booster.fit(frame(spark, rows).coalesce(1))
    assert len({s["feature"] for s in plain.splits}) > 1
    monkeypatch.setattr(boosting, "REWRITE", 1)
    monkeypatch.setattr(boosting, "CELLS", 300)
    assert booster.fit(frame(spark, rows).coalesce(1)).splits == plain.splits


def test_penalties_and_bounds(spark):
    rows = frame(spark, rows_of(200, 2)).persist()
    assert LeafwiseBooster(numTrees=2, regAlpha=1e6).fit(rows).splits == []
    free, tied = (LeafwiseBooster(numTrees=1, numLeaves=4, regLambda=lam).fit(rows) for lam in (0.0, 100.0))
    assert max(map(abs, tied.trees[0]["value"])) < max(map(abs, free.trees[0]["value"])) / 2
    sides = [s[side] for s in LeafwiseBooster(numTrees=1, minRowsPerLeaf=60).fit(rows).splits for side in ("left_rows", "right_rows")]
    assert sides and min(sides) >= 60


def test_pipeline_is_saved_and_loaded(spark, tmp_path):
    rows = frame(spark, rows_of(150, 3)).select("id", "label", *[F.col("features")[i].alias(f"x{i}") for i in range(4)])
    rows = rows.withColumn("x0", F.when(F.col("id") % 11 != 0, F.col("x0")).otherwise(float("nan")))
    stages = [VectorAssembler(inputCols=[f"x{i}" for i in range(4)], outputCol="features", handleInvalid="keep")]
    model = Pipeline(stages=[*stages, LeafwiseBooster(numTrees=2, numLeaves=4, minRowsPerLeaf=5)]).fit(rows)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    before, after = (m.transform(rows).orderBy("id").select("probability").collect() for m in (model, again))
    assert before == after and len({r[0][1] for r in before}) > 2
    assert model.transform(rows.limit(0)).collect() == []


def test_one_class_gives_the_prior(spark):
    rows = frame(spark, [(i, [1.0, 2.0, float(i), 0.0], 0.0, 1.0) for i in range(20)])
    model = LeafwiseBooster(numTrees=3).fit(rows)
    assert model.trees == [] and model.transform(rows).first().probability[1] < 1e-9


def test_passes_over_the_rows_read_blocks_not_rows(spark, monkeypatch):
    written = {}

    def kept(df, name):
        written.setdefault(name, []).append(boosting_write(df, name))
        return written[name][-1]

    boosting_write = boosting.materialize
    monkeypatch.setattr(boosting, "materialize", kept)
    monkeypatch.setattr(boosting, "REWRITE", 1)
    LeafwiseBooster(numTrees=2, numLeaves=3, subsample=0.9).fit(frame(spark, rows_of(1000)).coalesce(2))
    # The rows once, and again with the first tree in their score; the last tree needs no third copy.
    first, again = written["boosting-bins"]
    assert first.count() <= 1000 / boosting.BLOCK + 2 and again.count() <= 1000 / boosting.BLOCK + 2
    for name, size in (("bins", 4), ("label", 8), ("key", 8), ("score", 8)):
        assert {t.agg(F.sum(F.octet_length(name))).first()[0] for t in (first, again)} == {1000 * size}


def test_leaves_of_rows_in_an_uneven_tree():
    import numpy as np

    tree = boosting.Tree()
    _, right = tree.split(0, 1, 3)
    left, _ = tree.split(right, 0, 2)
    tree.split(left, 1, 5)
    bins = np.array([[0, 3], [9, 4], [2, 5], [2, 6]], dtype=np.uint8)
    assert boosting.nodes_of(tree.plain(), bins).tolist() == [1, 4, 5, 6]
    assert boosting.nodes_of(boosting.Tree().plain(), bins).tolist() == [0] * 4
    assert boosting.nodes_of(tree.plain(), bins[:0]).tolist() == []
