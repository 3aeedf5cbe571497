"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter is a direction made of one code word per block of coordinates, so a few
code words per block make many filters.  A vector passes every filter whose cap
it lies in (inner product at or above a threshold); a vector with fewer than
``LEAST`` lowers its threshold step by step and passes all filters above it.  All
of them are listed by meeting in the middle of the blocks, without a look at most
filters.  Vectors are rotated by one random rotation per length first, so weight
in few coordinates is spread over all blocks.  Vectors that share a filter, a label and a
length meet, and their cosine is computed in double precision.

Equal vectors of a label are one class before any join.  A class is sent once
per filter; a filter that more than ``BLOCK_ROWS`` classes pass is cut into
blocks, and each pair of blocks is one group, so no task holds an unbounded
group.  Pairs are counted where they first share a filter and are not emitted:
a group gives per class the weight of its links, and a star for components.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label, link with nothing; repeated rows are
members of one class and link with each other; a null id counts as a member but
names no component; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf, finite_vector, float_matrix, vector_key, whole_runs
from tabloom.llm.components import connected_components
from tabloom.operators.lookup import left_lookup
from tabloom.scratch import materialize

COSINE = 0.98
BLOCKS = 4
#: Filters that a vector passes on average, and at least.
MEAN, LEAST = 16, 12
#: A threshold is lowered by this part of the deviation of inner products.
STEP = 0.2
SEED = 7
#: Classes of one filter that meet in one group.
BLOCK_ROWS = 1024
#: Groups up to this size are compared together.
SMALL = 48
CHUNK_ROWS = 16_384
PAIRS = 1 << 15
#: Comparisons of filter numbers, and columns of filters, that are held at once.
COMPARED, COLUMNS = 1 << 22, 1024


def code_size(rows: int) -> int:
    """Code words per block: about one filter per vector."""
    return max(8, min(64, round(max(rows, 1) ** (1 / BLOCKS) + 0.5)))


def _decoder(words: int):
    """A function from one vector to the numbers of the filters that it passes."""
    from statistics import NormalDist

    import numpy as np

    codes: dict[int, tuple] = {}
    quantile = NormalDist().inv_cdf(1 - min(0.5, MEAN / words**BLOCKS))

    def code(size: int):
        if size not in codes:
            rng = np.random.default_rng([SEED, size])
            parts = np.array_split(np.arange(size), BLOCKS)
            book = [rng.standard_normal((words, len(part))) for part in parts]
            book = [b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12) for b in book]
            # A block of one coordinate has two directions and an empty one has one: no filter comes twice.
            book = [b if b.shape[1] > 1 else np.array([[1.0], [-1.0]]) if b.shape[1] else b[:1] for b in book]
            rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
            codes[size] = rotation, parts, book, np.sqrt(BLOCKS / size)
        return codes[size]

    def sums(tables):
        total = tables[0]
        for other in tables[1:]:
            total = (total[:, None] + other[None, :]).ravel()
        return total

    def passed(vector):
        vector = np.asarray(vector, dtype=np.float64)
        vector = vector / np.abs(vector).max()
        vector = vector / np.linalg.norm(vector)
        rotation, parts, book, deviation = code(len(vector))
        vector, threshold = rotation @ vector, quantile * deviation
        inner = [b @ vector[part] for part, b in zip(parts, book)]
        first, second = sums(inner[: BLOCKS // 2]), sums(inner[BLOCKS // 2 :])
        order = np.argsort(-second, kind="stable")
        falling = -second[order]
        while True:
            counts = np.searchsorted(falling, first - threshold, side="right")
            total = int(counts.sum())
            if total >= min(LEAST, len(first) * len(second)):
                break
            threshold -= STEP * deviation
        rows = np.repeat(np.arange(len(first)), counts)
        places = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.sort(rows * len(second) + order[places])

    return passed


def filters(vector, words: int):
    """The filters that a vector passes, ascending."""

    def make():
        import pandas as pd

        passed = _decoder(words)
        return lambda vectors: pd.Series([passed(v) for v in vectors], dtype=object)

    return column_udf(make, "array<long>")(vector)


def _verifier(cosine: float):
    """From sorted rows of groups to ``node, links, other``: weights of links, and edges."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def first_shared(lists, i, j, numbers):
            """Whether the group's filter is the smallest one of each pair."""
            answer, step = np.empty(len(i), dtype=bool), max(1, COMPARED // lists.shape[1] ** 2)
            for at in range(0, len(i), step):
                a, b = lists[i[at : at + step]], lists[j[at : at + step]]
                shared = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a >= 0)
                answer[at : at + step] = np.where(shared, a, np.iinfo(np.int64).max).min(axis=1) == numbers[i[at : at + step]]
            return answer

        def met_before(lists, number):
            """Pairs of rows of one group that share a smaller filter."""
            rows, places = np.nonzero((lists >= 0) & (lists < number))
            _, column, times = np.unique(lists[rows, places], return_inverse=True, return_counts=True)
            shared = times[column] > 1
            rows, column = rows[shared], column[shared]
            _, column = np.unique(column, return_inverse=True)
            met = np.zeros((len(lists), len(lists)), dtype=bool)
            for at in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
                part = (column >= at) & (column < at + COLUMNS)
                passes = np.zeros((len(lists), COLUMNS), dtype=np.float32)
                passes[rows[part], column[part] - at] = 1
                met |= (passes @ passes.T) > 0
            return met

        def stars(hit):
            """The smallest row that each row of a group reaches."""
            label = np.arange(len(hit))
            while True:
                lower = np.where(hit, label[None, :], len(hit)).min(axis=1)
                new = np.minimum(label, lower)
                new = np.minimum(new, new[new])
                if (new == label).all():
                    return label
                label = new

        for table in whole_runs(batches, ["label", "dim", "filter", "left", "right"], CHUNK_ROWS):
            n = table.num_rows
            matrix = float_matrix(table["vector"])
            lengths = np.sqrt((matrix * matrix).sum(axis=1))
            node, weight = table["node"].to_numpy(), table["n"].to_numpy()
            numbers, side = table["filter"].to_numpy(), table["side"].to_numpy()
            column = table["filters"].combine_chunks()
            sizes = np.diff(column.offsets.to_numpy())
            lists = np.full((n, int(sizes.max(initial=1))), -1, dtype=np.int64)
            lists[np.arange(lists.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
            new = np.zeros(n, dtype=bool)
            new[0] = True
            for key in ("label", "dim", "filter", "left", "right"):
                values = table[key].to_numpy()
                new[1:] |= values[1:] != values[:-1]
            run = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], n)
            across = table["left"].to_numpy() != table["right"].to_numpy()
            links, edges = np.zeros(n, dtype=np.int64), []

            def count(i, j):
                once = first_shared(lists, i, j, numbers)
                i, j = i[once], j[once]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                return i, j

            small = (ends - starts)[run] <= SMALL
            for offset in range(1, SMALL):
                left = np.flatnonzero(small[: n - offset] & (run[: n - offset] == run[offset:]))
                if not len(left):
                    break
                for at in range(0, len(left), PAIRS):
                    i = left[at : at + PAIRS]
                    j = i + offset
                    keep = ~across[i] | (side[i] != side[j])
                    i, j = i[keep], j[keep]
                    found = (matrix[i] * matrix[j]).sum(axis=1) / (lengths[i] * lengths[j]) >= cosine
                    edges.append(count(i[found], j[found]))
            for start, end in zip(starts, ends):
                if end - start <= SMALL:
                    continue
                part, size = matrix[start:end], lengths[start:end]
                hit = (part @ part.T) / (size[:, None] * size[None, :]) >= cosine
                np.fill_diagonal(hit, False)
                if across[start]:
                    hit &= side[start:end, None] != side[None, start:end]
                new_hit = hit & ~met_before(lists[start:end], numbers[start])
                links[start:end] += new_hit @ weight[start:end]
                linked = np.flatnonzero(hit.any(axis=1))
                edges.append((linked + start, stars(hit)[linked] + start))
            used = np.flatnonzero(links)
            i, j = (np.concatenate(x) for x in zip(*edges)) if edges else (used[:0], used[:0])
            apart = node[i] != node[j]
            i, j = i[apart], j[apart]
            nothing = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(node[used]), pa.array(node[i])]),
                    pa.concat_arrays([pa.array(links[used]), pa.array(np.zeros(len(i), dtype=np.int64))]),
                    pa.concat_arrays([nothing, pa.array(node[j])]),
                ],
                ["node", "links", "other"],
            )

    return run


def near_duplicate_vectors(
    df: DataFrame,
    identifier: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per input row: the id, ``n_links``, ``component_id`` and ``kept``."""
    valid = finite_vector(F.col(vector)) & F.col(label).isNotNull()
    rows = materialize(
        df.select(
            F.col(identifier).alias("id"),
            F.when(valid, F.struct(F.col(label).cast("string").alias("label"), vector_key(F.col(vector)).alias("key"))).alias("class"),
            F.when(valid, F.col(vector)).alias("vector"),
        ),
        "vectors",
    )
    grouped = rows.where("class IS NOT NULL").groupBy("class").agg(
        F.min("id").alias("first"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    counted = materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    words = code_size(counted.count())
    listed = materialize(
        counted.select(
            "node", "n", "vector", F.col("class.label").alias("label"),
            filters(F.col("vector"), words).alias("filters"),
        ),
        "filters",
    )
    passed = listed.select(
        "label", F.size("vector").alias("dim"), F.explode("filters").alias("filter"), "node", "n", "vector", "filters"
    )
    crowded = materialize(
        passed.groupBy("label", "dim", "filter").agg(F.count("*").alias("size")).where(F.col("size") > block_rows), "crowded"
    )
    spread = passed.join(crowded, ["label", "dim", "filter"], "left").withColumn(
        "parts", F.coalesce(F.ceil(F.col("size") / block_rows), F.lit(1)).cast("int")
    )
    sided = spread.withColumn("side", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    meeting = sided.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "label", "dim", "filter",
        F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"),
        "side", "node", "n", "vector", "filters",
    )
    keys = ["label", "dim", "filter", "left", "right"]
    sorted_rows = meeting.repartition(*keys).sortWithinPartitions(*keys)
    found = materialize(
        sorted_rows.mapInArrow(_verifier(cosine), "node long, links long, other long"), "links"
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = connected_components(found.where("other IS NOT NULL"), "node", "other")
    classes = (
        counted.select("class", "node", "n", "first")
        .join(links, "node", "left")
        .join(linked, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    named = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    table = materialize(
        classes.join(named, "component").select(
            F.col("class").alias("class"), "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
        ),
        "vector-classes",
    )
    keyed = rows.select("id", F.col("class.label").alias("label"), F.col("class.key").alias("key"))
    flat = table.select("class.label", "class.key", "n", "n_links", "component_id")
    alone = keyed.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    joined = left_lookup(keyed.where("key IS NOT NULL"), flat, ["label", "key"], "n").select("id", "n_links", "component_id")
    return joined.unionByName(alone).select(
        F.col("id").alias(identifier), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
