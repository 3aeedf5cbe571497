"""Boosted trees for two classes, grown leaf by leaf from histograms.

Rows are binned once, by borders of a bounded sample, and written with their
score, BLOCK rows as one record: a pass over all rows moves a few long byte
strings, not rows.  A tree grows from gradient histograms: every task sums the gradients of
its rows per (node, feature, bin), one aggregate joins the sums of all tasks, and
a window over the bins of a feature finds the best cut of each node; one row per
node reaches the driver.

The leaf with the largest gain is split next, until the tree has ``numLeaves``
leaves.  Which leaf that is depends on the gains alone, so the order is replayed
on what is known, and all nodes whose histograms the replay lacks are judged by
one job: a tree costs about as many jobs as it has levels, not leaves, and is
the tree that splits one leaf at a time.

Gradients are whole multiples of 1/SCALE.  Sums are exact, so trees depend on
neither partitions nor lost executors.

Edge cases: a label of one class gives no trees and the prior as score; a missing
value sorts after all numbers; rows with weight 0 count as rows only; a feature
of one value is never split; an empty table is refused.
"""

from __future__ import annotations

import heapq
import json
import math
import sys

import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.contracts import ContractError
from tabloom.scratch import materialize

# Functions that run in Python workers travel by value; executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that the borders of bins are fitted on (chosen by a hash); all rows take part in the trees.
BORDER_ROWS = 200_000
#: Bins of a feature at most; a bin is one byte.
MAX_BINS = 64
#: Wider vectors are refused: a node's histogram has MAX_BINS cells per place.
MAX_WIDTH = 20_000
#: Cells of histograms, and places of rows, that a task holds at once.
CELLS = 1 << 22
SCALE = 1 << 24
MIN_HESSIAN = 1e-3
#: Scores are written again after so many trees; until then tasks add the newer trees themselves.
REWRITE = 5
#: Rows of a record at most, bytes of its bins if they are more than one row, and rows that numpy takes at a time.
BLOCK = 64
BLOCK_BYTES = 1 << 14
PIECE = 1 << 14


def leaf_weight(gradient: float, alpha: float) -> float:
    """The gradient sum without the part that the L1 penalty takes."""
    return math.copysign(max(abs(gradient) - alpha, 0.0), gradient)


def leaf_value(gradient: float, hessian: float, alpha: float, lam: float) -> float:
    """The score that a leaf adds, before the learning rate."""
    return -leaf_weight(gradient, alpha) / (hessian + lam)


class Tree:
    """Nodes in arrays: the feature and bin of a split and the two nodes below; -1 marks a leaf."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value = [-1], [0], [0], [0], [0.0]

    def split(self, node: int, feature: int, at: int) -> tuple[int, int]:
        left = len(self.feature)
        for column, empty in zip((self.feature, self.bin, self.left, self.right, self.value), (-1, 0, 0, 0, 0.0)):
            column += [empty, empty]
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, at, left, left + 1
        return left, left + 1

    def plain(self) -> dict:
        return dict(vars(self))


def depth(tree: dict) -> int:
    """Levels of a grown tree."""
    deep = [0] * len(tree["feature"])
    for node, feature in enumerate(tree["feature"]):
        if feature >= 0:
            deep[tree["left"][node]] = deep[tree["right"][node]] = deep[node] + 1
    return max(deep)


def nodes_of(tree: dict, bins):
    """The leaf of every row; ``bins`` is a matrix of rows and features."""
    import numpy as np

    count = len(tree["feature"])
    feature, leaf = np.array(tree["feature"]), np.array(tree["feature"]) < 0
    # A leaf leads to itself, so all rows take the same number of steps.
    below = np.stack([np.where(leaf, np.arange(count), tree[side]) for side in ("left", "right")], axis=1).ravel()
    cut, feature = np.array(tree["bin"]), np.where(leaf, 0, feature)
    node, cells = np.zeros(len(bins), dtype=np.int64), np.ascontiguousarray(bins).ravel()
    first = np.arange(len(bins)) * bins.shape[1]
    for _ in range(depth(tree)):
        node = below.take(2 * node + (cells.take(first + feature.take(node)) > cut.take(node)))
    return node


def _packed(values, rows: int):
    """A binary column of ``rows`` rows of an array per record."""
    import numpy as np
    import pyarrow as pa

    values = np.ascontiguousarray(values)
    starts = np.append(np.arange(0, len(values), rows), len(values)) * (values.nbytes // max(1, len(values)))
    buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers)


def _unpacked(column, kind: str):
    """All values of a packed column."""
    import numpy as np
    import pyarrow as pa

    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, dtype=kind)
    starts = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset :][: len(column) + 1]
    count = int(starts[-1] - starts[0]) // np.dtype(kind).itemsize
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=kind, count=count, offset=int(starts[0])) if count else np.zeros(0, dtype=kind)


#: Written rows: all columns are packed; ``key`` is empty where no tree draws rows.
PACKED = {"bins": "u1", "label": "f8", "weight": "f8", "key": "i8", "score": "f8"}
PACKED_SCHEMA = ", ".join(f"{name} binary" for name in PACKED)


def _block(width: int) -> int:
    """Rows of a record."""
    return max(1, min(BLOCK, BLOCK_BYTES // max(1, width)))


def _pieces(batch, width: int):
    """The rows of a batch of records as arrays, a bounded number of rows at a time."""
    columns = {name: _unpacked(batch.column(name), kind) for name, kind in PACKED.items()}
    columns["bins"] = columns["bins"].reshape(-1, width)
    some = max(1, min(PIECE, CELLS // max(1, width)))
    for at in range(0, len(columns["label"]), some):
        yield {name: values[at : at + some] for name, values in columns.items()}


def _values(column, width: int):
    """A column of number lists as a matrix."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def binned(values, borders: list[list[float]]):
    """The number of borders below each value, as bytes."""
    import numpy as np

    found = np.empty(values.shape, dtype=np.uint8)
    for place, limits in enumerate(borders):
        found[:, place] = np.searchsorted(np.array(limits), values[:, place], side="left")
    return found


def _uniform(keys, *salts: int):
    """Numbers in [0, 1) that depend on keys and salts only."""
    import numpy as np

    mixed = keys.astype(np.uint64)
    for salt in (*salts, 0):
        mixed = (mixed ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def fit_borders(rows: DataFrame, features: str, width: int, rows_wanted: int = BORDER_ROWS) -> list[list[float]]:
    """Borders of every place of a number list, from a bounded sample of rows."""
    total = rows.count()
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows if total <= rows_wanted else rows.where(draw < rows_wanted / total)
    placed = sample.select(F.posexplode(features).alias("place", "value")).where(~F.isnan("value"))
    shares = F.array(*[F.lit(i / MAX_BINS) for i in range(1, MAX_BINS)])
    cuts = F.percentile_approx("value", shares, F.lit(10_000))
    found = placed.groupBy("place").agg(
        F.array_sort(
            F.filter(F.array_distinct(F.array_append(cuts, F.min("value"))), lambda cut: cut < F.lit(math.inf))
        ).alias("cuts"),
        F.max("value").alias("most"),
    )
    # At most MAX_BINS numbers for each of MAX_WIDTH places.
    borders: list[list[float]] = [[] for _ in range(width)]
    for place, limits, most in found.collect():
        borders[place] = [float(cut) for cut in limits if cut < most][: MAX_BINS]
    return borders


class _Booster:
    """One fit: the written rows, and the trees so far."""

    def __init__(self, rows: DataFrame, width: int, init: float, settings: dict):
        self.rows, self.width, self.init, self.settings = rows, width, init, settings
        self.recent: list[dict] = []

    def _gradients(self, tree: int):
        """A function from some rows to bins, whole gradients and hessians, and whether the row is drawn for this tree."""
        recent, width, rate = self.recent, self.width, self.settings["rate"]
        seed, subsample = self.settings["seed"], self.settings["subsample"]

        def make(rows):
            import numpy as np

            bins, score = rows["bins"], rows["score"].copy()
            for grown in recent:
                score += rate * np.array(grown["value"])[nodes_of(grown, bins)]
            label, weight = rows["label"], rows["weight"]
            if np.isnan(label).any() or np.isnan(weight).any():
                raise ValueError("boosting needs a label and a weight in every row")
            p = 1.0 / (1.0 + np.exp(-score))
            g = np.floor(weight * (p - label) * SCALE + 0.5).astype(np.int64)
            h = np.floor(weight * p * (1.0 - p) * SCALE + 0.5).astype(np.int64)
            drawn = np.ones(len(bins), dtype=bool)
            if subsample < 1.0:
                drawn = _uniform(rows["key"], seed, tree) < subsample
            return bins, g, h, drawn

        return make

    def judge(self, number: int, tree: Tree, nodes: list[int], features: list[int]) -> dict[int, dict]:
        """Sums and the best split of nodes that are leaves of the tree."""
        gradients, grown, width, bins_ = self._gradients(number), tree.plain(), self.width, MAX_BINS + 1

        def sums(batches):
            import numpy as np
            import pyarrow as pa

            place = np.full(len(grown["feature"]), -1)
            place[nodes] = np.arange(len(nodes))
            size = len(nodes) * len(features) * bins_
            total = [np.zeros(size, dtype=np.int64) for _ in range(3)]
            for rows in (piece for batch in batches for piece in _pieces(batch, width)):
                bins, g, h, drawn = gradients(rows)
                at = place[nodes_of(grown, bins)]
                found = np.flatnonzero((at >= 0) & drawn)
                some = max(1, CELLS // len(features))
                for used in (found[i : i + some] for i in range(0, len(found), some)):
                    chosen = bins[used][:, features].astype(np.int64)
                    cells = ((at[used, None] * len(features) + np.arange(len(features))) * bins_ + chosen).ravel()
                    for held, values in zip(total, (g[used], h[used], np.ones(len(used), dtype=np.int64))):
                        np.add.at(held, cells, np.repeat(values, len(features)))
            filled = np.flatnonzero(total[2])
            node, rest = np.divmod(filled, len(features) * bins_)
            feature, bin_ = np.divmod(rest, bins_)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(nodes, dtype=np.int64)[node]), pa.array(np.array(features, dtype=np.int64)[feature]),
                    pa.array(bin_.astype(np.int64)), *[pa.array(held[filled]) for held in total],
                ],
                ["node", "feature", "bin", "g", "h", "n"],
            )

        parts = self.rows.mapInArrow(sums, "node long, feature long, bin long, g long, h long, n long")
        # Tasks have summed their rows already, so one exchange serves the sums and the windows over bins.
        dealt = parts.repartition("node", "feature")
        cells = dealt.groupBy("node", "feature", "bin").agg(*[F.sum(name).alias(name) for name in "ghn"])
        found = best_splits(cells, self.settings)
        # One row per node, of which a tree has fewer than 2 * numLeaves.
        return {node: {"gain": None} for node in nodes} | {row["node"]: row.asDict() for row in found.collect()}

    def grow(self, number: int, features: list[int]) -> tuple[Tree, list[dict]]:
        """One tree, and its splits in order."""
        known: dict[int, dict] = {}
        whole, wanted = Tree(), [0]
        depth = {0: 0}
        while wanted:
            most = max(1, CELLS // (len(features) * (MAX_BINS + 1)))
            for at in range(0, len(wanted), most):
                known |= self.judge(number, whole, wanted[at : at + most], features)
            wanted = []
            queue = [(-known[0]["gain"], 0)] if known[0]["gain"] else []
            leaves, splits = 1, []
            while queue and leaves < self.settings["leaves"]:
                _, node = heapq.heappop(queue)
                best = known[node]
                if whole.feature[node] < 0:
                    below = whole.split(node, best["feature"], best["bin"])
                    depth |= dict.fromkeys(below, depth[node] + 1)
                leaves += 1
                splits.append(best)
                for child in (whole.left[node], whole.right[node]):
                    if depth[child] >= self.settings["depth"]:
                        continue
                    if child not in known:
                        wanted.append(child)
                    elif known[child]["gain"]:
                        heapq.heappush(queue, (-known[child]["gain"], child))
        return self._finished(splits, whole)

    def _finished(self, splits: list[dict], whole: Tree) -> tuple[Tree, list[dict]]:
        """The tree of the splits alone, with the values of its leaves, and what is reported of them."""
        alpha, lam = self.settings["alpha"], self.settings["lambda"]
        tree, places, report = Tree(), {0: 0}, []
        for step, best in enumerate(splits, 1):
            node = best["node"]
            below = tree.split(places[node], best["feature"], best["bin"])
            places[whole.left[node]], places[whole.right[node]] = below
            for child, side in zip(below, ("left", "right")):
                tree.value[child] = leaf_value(best[f"{side}_g"] / SCALE, best[f"{side}_h"] / SCALE, alpha, lam)
            kept = {name: best[name] for name in ("feature", "bin", "gain")}
            report.append({"step": step, **kept, "left_rows": best["left_n"], "right_rows": best["right_n"]})
        return tree, report


def best_splits(cells: DataFrame, settings: dict) -> DataFrame:
    """One row per node with its best split; ``gain`` is NULL where no split helps."""
    alpha, lam = F.lit(settings["alpha"]), F.lit(settings["lambda"])

    def part(g: Column, h: Column) -> Column:
        """What a leaf with these sums takes off the loss, twice."""
        weight = F.greatest(F.abs(g / float(SCALE)) - alpha, F.lit(0.0))
        return weight * weight / (h / float(SCALE) + lam)

    order = Window.partitionBy("node", "feature").orderBy("bin")
    every = Window.partitionBy("node", "feature")
    summed = cells.select(
        "node", "feature", "bin",
        *[F.sum(x).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(f"left_{x}") for x in "ghn"],
        *[F.sum(x).over(every).alias(f"all_{x}") for x in "ghn"],
    ).withColumns({f"right_{x}": F.col(f"all_{x}") - F.col(f"left_{x}") for x in "ghn"})
    able = F.lit(True)
    for side in ("left", "right"):
        able &= (F.col(f"{side}_n") >= settings["least_rows"]) & (F.col(f"{side}_h") / float(SCALE) >= MIN_HESSIAN)
    gain = part(F.col("left_g"), F.col("left_h")) + part(F.col("right_g"), F.col("right_h")) - part(F.col("all_g"), F.col("all_h"))
    rated = summed.withColumn("gain", F.when(able & (gain > 0), gain))
    kept = F.struct(
        *["feature", "bin", "gain"], *[f"{side}_{x}" for side in ("left", "right") for x in "ghn"]
    )
    # The largest gain; ties go to the first feature, then the first bin.
    first = F.struct(F.coalesce("gain", F.lit(-1.0)), -F.col("feature"), -F.col("bin"))
    return rated.groupBy("node").agg(F.max_by(kept, first).alias("best")).select("node", "best.*")


class _Settings(HasFeaturesCol, HasLabelCol, HasWeightCol, HasProbabilityCol, HasSeed):
    """What an estimator and its model share."""


class LeafwiseBooster(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting of leaf-wise trees on a logistic loss."""

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "share of a leaf's value that counts", TypeConverters.toFloat)
    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree at most", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree at most", TypeConverters.toInt)
    minRowsPerLeaf = Param(Params._dummy(), "minRowsPerLeaf", "rows of a leaf at least", TypeConverters.toInt)
    subsample = Param(Params._dummy(), "subsample", "share of rows drawn for each tree", TypeConverters.toFloat)
    featureShare = Param(Params._dummy(), "featureShare", "share of features drawn for each tree", TypeConverters.toFloat)
    regAlpha = Param(Params._dummy(), "regAlpha", "L1 penalty of leaf values", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf values", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", weightCol=None, probabilityCol="probability", seed=42, numTrees=100,
        learningRate=0.1, numLeaves=31, maxDepth=14, minRowsPerLeaf=20, subsample=1.0, featureShare=1.0, regAlpha=0.0,
        regLambda=0.0,
    ):
        super().__init__()
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})
        self._setDefault(
            featuresCol="features", labelCol="label", probabilityCol="probability", seed=42, numTrees=100, learningRate=0.1,
            numLeaves=31, maxDepth=14, minRowsPerLeaf=20, subsample=1.0, featureShare=1.0, regAlpha=0.0, regLambda=0.0,
        )

    def _features_drawn(self, width: int, tree: int) -> list[int]:
        import numpy as np

        share = self.getOrDefault("featureShare")
        if share >= 1.0:
            return list(range(width))
        order = np.argsort(_uniform(np.arange(width), self.getSeed(), tree, 1), kind="stable")
        return sorted(order[: max(1, round(width * share))].tolist())

    def _fit(self, df: DataFrame) -> LeafwiseModel:
        get = self.getOrDefault
        weight = F.col(get("weightCol")).cast("double") if self.isDefined("weightCol") else F.lit(1.0)
        kind = df.schema[self.getFeaturesCol()].dataType.typeName()
        values = F.col(self.getFeaturesCol()) if kind == "array" else vector_to_array(F.col(self.getFeaturesCol()))
        rows = materialize(
            df.select(
                values.cast("array<double>").alias("values"), F.col(self.getLabelCol()).cast("double").alias("label"),
                weight.alias("weight"), F.monotonically_increasing_id().alias("key"),
            ),
            "boosting-rows",
        )
        width, count, total, positive = rows.agg(
            F.max(F.size("values")), F.count("*"), F.sum("weight"), F.sum(F.col("weight") * F.col("label"))
        ).first()
        if not count:
            raise ContractError("boosting needs at least one row")
        if width > MAX_WIDTH:
            raise ContractError(f"boosting takes at most {MAX_WIDTH} features, not {width}")
        prior = min(max(positive / total, 1e-15), 1 - 1e-15)
        init = math.log(prior / (1 - prior))
        borders = fit_borders(rows, "values", width)

        block, keyed = _block(width), get("subsample") < 1.0

        def code(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                bins = binned(_values(batch.column("values"), width), borders)
                columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("label", "weight", "key")]
                if not keyed:
                    columns[2] = np.zeros((len(bins), 0), dtype=np.int64)
                packed = [_packed(values, block) for values in (bins, *columns, np.full(len(bins), init))]
                yield pa.RecordBatch.from_arrays(packed, list(PACKED))

        settings = {
            "rate": get("learningRate"), "leaves": get("numLeaves"), "depth": get("maxDepth"), "seed": self.getSeed(),
            "least_rows": get("minRowsPerLeaf"), "subsample": get("subsample"), "alpha": get("regAlpha"), "lambda": get("regLambda"),
        }
        booster = _Booster(materialize(rows.mapInArrow(code, PACKED_SCHEMA), "boosting-bins"), width, init, settings)
        trees, report = [], []
        for number in range(get("numTrees") if 0 < positive < total else 0):
            tree, splits = booster.grow(number, self._features_drawn(width, number))
            if not splits:
                break
            trees.append(tree.plain())
            report += [{"tree": number + 1, **split} for split in splits]
            booster.recent.append(tree.plain())
            if len(booster.recent) == REWRITE and number + 1 < get("numTrees"):
                booster.rows = _rescored(booster)
                booster.recent = []
        stored = {"init": init, "rate": get("learningRate"), "borders": borders, "trees": trees, "splits": report}
        model = LeafwiseModel(
            stored=json.dumps(stored), featuresCol=self.getFeaturesCol(), probabilityCol=self.getProbabilityCol()
        )
        return model


def _rescored(booster: _Booster) -> DataFrame:
    """The rows with the recent trees in their score, written again."""
    recent, width, rate = booster.recent, booster.width, booster.settings["rate"]
    block = _block(width)

    def add(batches):
        import numpy as np
        import pyarrow as pa

        for rows in (piece for batch in batches for piece in _pieces(batch, width)):
            score = rows["score"].copy()
            for grown in recent:
                score += rate * np.array(grown["value"])[nodes_of(grown, rows["bins"])]
            keys = rows["key"] if len(rows["key"]) else np.zeros((len(score), 0), dtype=np.int64)
            columns = rows | {"key": keys, "score": score}
            yield pa.RecordBatch.from_arrays([_packed(columns[name], block) for name in PACKED], list(PACKED))

    return materialize(booster.rows.mapInArrow(add, PACKED_SCHEMA), "boosting-bins")


class LeafwiseModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Trees, borders and the prior; adds the probabilities of both classes."""

    stored = Param(Params._dummy(), "stored", "the model as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, stored=None, featuresCol="features", probabilityCol="probability"):
        super().__init__()
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    @property
    def _parts(self) -> dict:
        return json.loads(self.getOrDefault("stored"))

    @property
    def trees(self) -> list[dict]:
        return self._parts["trees"]

    @property
    def splits(self) -> list[dict]:
        """Every split in order: tree, step, feature, bin, gain and the rows on both sides."""
        return self._parts["splits"]

    @property
    def borders(self) -> list[list[float]]:
        return self._parts["borders"]

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = self._parts

        @F.pandas_udf("double")
        def positive(values: pd.Series) -> pd.Series:
            import numpy as np

            bins = binned(np.stack(values.to_list()), parts["borders"]) if len(values) else np.zeros((0, 1), np.uint8)
            score = np.full(len(bins), parts["init"])
            for grown in parts["trees"]:
                score += parts["rate"] * np.array(grown["value"])[nodes_of(grown, bins)]
            return pd.Series(1.0 / (1.0 + np.exp(-score)))

        kind = df.schema[self.getFeaturesCol()].dataType.typeName()
        column = F.col(self.getFeaturesCol())
        p = positive((column if kind == "array" else vector_to_array(column)).cast("array<double>"))
        return df.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1.0 - p, p)))
