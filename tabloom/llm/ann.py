"""Nearest vectors by inner product, from stable projections in a kd-tree.

Vectors are first made longer by one coordinate, sqrt(M^2 - |x|^2) with M the
largest norm, so that a larger inner product is a smaller distance.  Vectors of
each width (number of components) have cells of their own, so one search serves
all widths; inner products exist within a width only.  A random
Gaussian projection to ``PROJECTED`` dimensions is 2-stable: the squared
projected distance of a pair is its squared distance times a chi-square variable
with that many degrees of freedom.  A query verifies projected neighbours
nearest first, a leaf of a kd-tree at a time, and stops when the next projected
distance is so large that a vector nearer than the k-th found so far would lie
there with a probability below 1 - ``CONFIDENCE`` (the chi-square test).

The upper levels of the tree are cells that Spark deals out.  A query searches
the cell around its own projection first; the k-th distance found there bounds
the search, and only cells whose box passes the same test are visited.  Points of
a cell are bounded in number; queries stream past them.

Equal vectors are one point with the smallest ids of its rows, of which no
answer can need more than k + 1, so copies cost nothing.  Every vector is
indexed; only the borders of the cells are fitted on a sample, of
``SAMPLE_PER_CELL`` points per cell and never fewer than ``SAMPLE``.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do null ids; a query finds vectors of its own width,
so the only vector of a width gives no rows; repeated rows count once; a candidate with the query's id is not
returned; ties go to the smaller id; fewer candidates give fewer rows; an empty
table gives none.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import finite_vector, float_matrix, vector_key
from tabloom.operators.lookup import left_lookup
from tabloom.scratch import materialize

NEIGHBOURS = 20
PROJECTED = 8
CONFIDENCE = 0.95
SEED = 5
#: Points that the cells' borders are fitted on, about: at least so many, and so many for each cell.
SAMPLE, SAMPLE_PER_CELL = 20_000, 16
CELL_ROWS, MAX_CELLS = 4096, 1 << 16
LEAF_ROWS = 128
#: Queries that are searched together.
BATCH = 256
#: Share of M^2 within which distances count as equal, for lengths rounded to floats.
SLACK = 1e-6


def chi_square_quantile(probability: float, freedom: int = PROJECTED) -> float:
    """Quantile of the chi-square distribution for an even number of degrees of freedom."""
    from math import exp

    if freedom % 2:
        raise ValueError("an even number of degrees of freedom is needed")

    def below(x: float) -> float:
        term = total = exp(-x / 2)
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    low, high = 0.0, 1.0
    while below(high) < probability:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < probability else (low, middle)
    return high


def _projection(size: int):
    """The Gaussian projection of the lengthened vectors."""
    import numpy as np

    return np.random.default_rng([SEED, size]).standard_normal((size + 1, PROJECTED))


def _splits(points, cells: int) -> list:
    """Borders of a kd-tree with ``cells`` leaves (a power of two), level by level: (axis, value)."""
    import numpy as np

    levels, groups = [], [points]
    while len(groups) < cells:
        level, below = [], []
        for group in groups:
            axis = int(np.argmax(np.ptp(group, axis=0))) if len(group) else 0
            value = float(np.median(group[:, axis])) if len(group) else 0.0
            left = group[:, axis] <= value if len(group) else np.zeros(0, dtype=bool)
            level.append((axis, value))
            below += [group[left], group[~left]]
        levels.append(level)
        groups = below
    return levels


def _cell_of(points, levels):
    import numpy as np

    cell = np.zeros(len(points), dtype=np.int64)
    for level in levels:
        axis, value = np.array([x[0] for x in level]), np.array([x[1] for x in level])
        cell = 2 * cell + (points[np.arange(len(points)), axis[cell]] > value[cell])
    return cell


def _by_width(batch, column: int):
    """(width, rows) for each width of vectors in a batch."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    widths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        yield int(width), batch.take(pa.array(np.flatnonzero(widths == width)))


def _box_distances(queries, low, high):
    """Squared distance of each query to each box."""
    import numpy as np

    total = np.zeros((len(queries), len(low)))
    for axis in range(queries.shape[1]):
        at = queries[:, axis, None]
        gap = np.maximum(np.maximum(low[None, :, axis] - at, at - high[None, :, axis]), 0.0)
        total += gap * gap
    return total


class _Leaves:
    """A kd-tree over the points of one cell: its leaves with their boxes."""

    def __init__(self, matrix, projected, ids):
        import numpy as np

        parts, todo = [], [np.arange(len(matrix))]
        while todo:
            part = todo.pop()
            if len(part) <= LEAF_ROWS:
                parts.append(part)
                continue
            axis = int(np.argmax(np.ptp(projected[part], axis=0)))
            half = len(part) // 2
            order = np.argpartition(projected[part, axis], half)
            todo += [part[order[:half]], part[order[half:]]]
        self.parts = parts
        self.matrix, self.ids = matrix, ids
        self.low = np.array([projected[p].min(axis=0) for p in parts])
        self.high = np.array([projected[p].max(axis=0) for p in parts])

    def search(self, queries, projected, bound, base, limit, k: int):
        """The k best points of each query as (scores, places); ``bound`` holds k-th scores known before.

        ``base`` is |q|^2 + M^2, so a score s stands for the squared distance base - 2 s.
        """
        import numpy as np

        count = len(queries)
        scores, places = np.full((count, k), -np.inf), np.full((count, k), -1, dtype=np.int64)
        key = np.full((count, k), np.iinfo(np.int64).max)
        gaps = _box_distances(projected, self.low, self.high)
        order = np.argsort(gaps, axis=1, kind="stable")
        for step in range(len(self.parts)):
            leaf = order[:, step]
            worst = np.maximum(scores[:, -1], bound)
            # The test: beyond this radius a better vector is too unlikely.
            open_ = gaps[np.arange(count), leaf] <= limit(base - 2 * worst)
            if not open_.any():
                break
            for number in np.unique(leaf[open_]):
                asked = np.flatnonzero(open_ & (leaf == number))
                part = self.parts[number]
                fresh = queries[asked] @ self.matrix[part].T
                all_scores = np.concatenate([scores[asked], fresh], axis=1)
                all_keys = np.concatenate([key[asked], np.broadcast_to(self.ids[part], fresh.shape)], axis=1)
                all_places = np.concatenate([places[asked], np.broadcast_to(part, fresh.shape)], axis=1)
                best = np.lexsort((all_keys, -all_scores), axis=1)[:, :k]
                scores[asked] = np.take_along_axis(all_scores, best, axis=1)
                key[asked] = np.take_along_axis(all_keys, best, axis=1)
                places[asked] = np.take_along_axis(all_places, best, axis=1)
        return scores, places


def _searcher(norms: dict, k: int):
    """From sorted rows of a cell (points before queries) to the k best points per query.

    ``norms`` holds the largest squared norm of each width; a cell has one width.
    """
    quantile = chi_square_quantile(CONFIDENCE)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tree, tree_cell, point_node = None, None, None
        gathered: list = []

        def answers(table):
            queries = float_matrix(table["vector"])
            projected = float_matrix(table["projected"])
            bound = table["bound"].to_numpy()
            longest = norms[queries.shape[1]]
            base = (queries * queries).sum(axis=1) + longest

            def limit(squared):
                return quantile * (squared + SLACK * longest)

            scores, places = tree.search(queries, projected, bound, base, limit, k)
            asked, rank = np.nonzero((places >= 0) & (scores >= bound[:, None] - SLACK * longest))
            found = places[asked, rank]
            # Products of equal vectors are added up in one order, so ties are ties.
            exact = (queries[asked] * tree.matrix[found]).sum(axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array(table["node"].to_numpy()[asked]), pa.array(point_node[found]), pa.array(exact)],
                ["query", "node", "score"],
            )

        for batch in batches:
            # A batch may hold several cells; each part has one cell and one kind.
            table = pa.Table.from_batches([batch])
            cells, kind = table["cell"].to_numpy(), table["kind"].to_numpy()
            borders = np.flatnonzero((cells[1:] != cells[:-1]) | (kind[1:] != kind[:-1])) + 1
            for start, end in zip([0, *borders], [*borders, table.num_rows]):
                part = table.slice(start, end - start)
                cell = int(cells[start])
                if kind[start] == 0:
                    if tree_cell != cell:
                        gathered, tree_cell = [], cell
                    gathered.append(part)
                    tree = None
                    continue
                if tree_cell != cell:
                    continue
                if tree is None:
                    points = pa.concat_tables(gathered)
                    matrix = float_matrix(points["vector"])
                    point_node = points["node"].to_numpy()
                    tree = _Leaves(matrix, float_matrix(points["projected"]), points["first"].to_numpy())
                for at in range(0, part.num_rows, BATCH):
                    yield answers(part.slice(at, BATCH))

    return run


def _prepared(spark, classes: DataFrame, norms: dict, cells: dict, first_cell: dict, totals: dict) -> DataFrame:
    """Projections of points and of queries, and the cell of each point."""
    import numpy as np

    def project(levels):
        def run(batches):
            import pyarrow as pa

            for whole in batches:
                for width, batch in _by_width(whole, 1):
                    matrix = _projection(width)
                    vectors = float_matrix(batch.column(1))
                    rest = np.sqrt(np.maximum(norms[width] - (vectors * vectors).sum(axis=1), 0.0))
                    query = vectors @ matrix[:-1]
                    point = query + rest[:, None] * matrix[-1]
                    cell = first_cell[width] + _cell_of(point, levels.get(width, []))

                    def lists(values):
                        offsets = pa.array(np.arange(0, values.size + 1, PROJECTED), pa.int32())
                        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))

                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(cell), lists(point), lists(query)], ["node", "cell", "point", "query"]
                    )

        return run

    schema = "node long, cell long, point array<double>, query array<double>"
    levels: dict = {}
    for width, count in cells.items():
        if count > 1:
            # A bounded sample, drawn by hash, fits the borders only.
            share = min(1.0, max(SAMPLE, SAMPLE_PER_CELL * count) / totals[width])
            drawn = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30))
            sample = classes.where((F.size("vector") == width) & drawn).select("node", "vector")
            rows = sample.mapInArrow(project({}), schema).select("point").toArrow()
            levels[width] = _splits(float_matrix(rows["point"]), count)
    return classes.select("node", "vector").mapInArrow(project(levels), schema)


def nearest(
    df: DataFrame,
    is_query: Column,
    identifier: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` holds, its k nearest other rows."""
    import numpy as np

    spark = df.sparkSession
    value = F.col(vector)
    valid = materialize(
        df.where(finite_vector(value) & F.col(identifier).isNotNull()).select(
            F.col(identifier).cast("long").alias("id"), value.alias("vector"), vector_key(value).alias("key"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )
    result = "query_id long, rank int, vec_id long, score double"
    # The k + 1 smallest ids of equal vectors: Spark keeps that many per task before it shuffles.
    smallest = valid.withColumn("place", F.dense_rank().over(Window.partitionBy("key").orderBy("id"))).where(
        F.col("place") <= k + 1
    )
    members = smallest.groupBy("key").agg(
        F.array_sort(F.collect_set("id")).alias("ids"), F.first("vector").alias("vector")
    )
    asking = valid.where("asks").groupBy("key").agg(F.count("*").alias("n"))
    classes = materialize(
        members.join(asking, "key", "left").withColumn("node", F.monotonically_increasing_id()), "points"
    )
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    # One row per width.
    widths = classes.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"), F.max(squared).alias("norm"))
    norms, totals, cells, first_cell, next_cell = {}, {}, {}, {}, 0
    for row in widths.orderBy("width").collect():
        norms[row["width"]], totals[row["width"]] = row["norm"], row["n"]
        count = 1
        while count < MAX_CELLS and count * CELL_ROWS < row["n"]:
            count *= 2
        cells[row["width"]], first_cell[row["width"]] = count, next_cell
        next_cell += count
    if not norms:
        return spark.createDataFrame([], result)

    placed = materialize(_prepared(spark, classes, norms, cells, first_cell, totals), "projections")
    points = materialize(
        classes.join(placed, "node").select(
            "cell", F.lit(0).alias("kind"), "node", F.col("ids")[0].alias("first"), "vector",
            F.col("point").alias("projected"), F.lit(float("-inf")).alias("bound"), F.col("query"), F.col("n"),
        ),
        "cells",
    )
    corners = [f(F.col("projected")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(PROJECTED)]
    # One row per cell, at most MAX_CELLS of each width.
    boxes = points.groupBy("cell").agg(*corners).orderBy("cell").toPandas()
    cell_ids = boxes["cell"].to_numpy(dtype=np.int64)
    low = boxes[[f"low{i}" for i in range(PROJECTED)]].to_numpy(dtype=float)
    high = boxes[[f"high{i}" for i in range(PROJECTED)]].to_numpy(dtype=float)
    # Cells of one width are neighbours in that order.
    cell_range = {
        width: slice(*np.searchsorted(cell_ids, [first, first + cells[width]])) for width, first in first_cell.items()
    }
    quantile = chi_square_quantile(CONFIDENCE)
    columns = ["cell", "kind", "node", "first", "vector", "projected", "bound"]
    kept = valid.schema["vector"].dataType.simpleString()
    schema = f"cell long, kind int, node long, first long, vector {kept}, projected array<double>, bound double"

    def route(home: bool):
        """Rows of queries for their home cell, or for all other cells that pass the test."""

        def run(batches):
            import pyarrow as pa

            for whole in batches:
                for width, batch in _by_width(whole, 1):
                    own = cell_range[width]
                    for at in range(0, batch.num_rows, BATCH):
                        part = batch.slice(at, BATCH)
                        gaps = _box_distances(float_matrix(part.column(2)), low[own], high[own])
                        nearest_cell = gaps.argmin(axis=1)
                        if home:
                            row, cell = np.arange(part.num_rows), nearest_cell
                        else:
                            vectors = float_matrix(part.column(1))
                            bound = part.column(3).to_numpy(zero_copy_only=False)
                            squares = (vectors * vectors).sum(axis=1)
                            radius = quantile * (squares + (1 + SLACK) * norms[width] - 2 * bound)
                            passes = gaps <= radius[:, None]
                            passes[np.arange(part.num_rows), nearest_cell] = False
                            row, cell = np.nonzero(passes)
                        rows = pa.Table.from_batches([part]).take(pa.array(row)).combine_chunks()
                        size_ = len(row)
                        arrays = [
                            pa.array(cell_ids[own][cell]), pa.array(np.ones(size_, dtype=np.int32)), rows["node"],
                            pa.array(np.zeros(size_, dtype=np.int64)), rows["vector"], rows["query"], rows["bound"],
                        ]
                        yield from pa.table(arrays, names=columns).to_batches()

        return run

    def search(routed: DataFrame, name: str) -> DataFrame:
        rows = points.select(*columns).unionByName(routed)
        ordered = rows.repartition("cell").sortWithinPartitions("cell", "kind", "node")
        found = ordered.mapInArrow(_searcher(norms, k + 1), "query long, node long, score double")
        return materialize(found, name)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    firsts = classes.select("node", F.col("ids")[0].alias("first"))
    queries = points.where("n IS NOT NULL").select("node", "vector", "query", "bound")
    home = search(queries.mapInArrow(route(True), schema), "home-cells")
    kth = home.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(
        F.col("place") == k + 1
    )
    bounded = queries.drop("bound").join(
        kth.select(F.col("query").alias("node"), F.col("score").alias("bound")), "node", "left"
    ).withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    away = search(bounded.select("node", "vector", "query", "bound").mapInArrow(route(False), schema), "other-cells")

    chosen = (
        home.unionByName(away).join(firsts, "node")
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    )
    ranked = chosen.join(classes.select("node", "ids"), "node").groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "ids"))).alias("found")
    )
    pairs = F.flatten(
        F.transform("found", lambda x: F.transform(x["ids"], lambda i: F.struct(x["minus"].alias("minus"), i.alias("id"))))
    )
    # Of each class of equal queries: one more row than asked for, as one may be the query itself.
    lists = ranked.select(F.col("query").alias("node"), F.slice(F.array_sort(pairs), 1, k + 1).alias("found"))
    answered = materialize(
        lists.join(classes.where("n IS NOT NULL").select("node", "key", "n"), "node").select("key", "n", "found"), "answers"
    )
    asked = valid.where("asks").select("id", "key").distinct()
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k)
    return (
        left_lookup(asked, answered, ["key"], "n")
        .select("id", F.posexplode(others).alias("at", "x"))
        .select(
            F.col("id").alias("query_id"), (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"),
            (-F.col("x.minus")).alias("score"),
        )
    )
