"""Pieces that several operators share."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = re.compile(rb"[\x20\x09-\x0d]")
#: Words are taken from a long text in runs of about this many bytes.
RUN_BYTES = 1 << 20
#: Rows whose results a Python worker holds at once.
BATCH_ROWS = 512
#: Items of an array that ``running`` handles at once.
RUNNING_BLOCK = 128


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores after it while the other columns have it (case does not count)."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def fold_of(identifier: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    column = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds


def word_runs(text: str | None) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, run by run."""
    data = (text or "").encode().lower()
    start = 0
    while len(data) - start > RUN_BYTES:
        found = SPACE.search(data, start + RUN_BYTES)
        if found is None:
            break
        yield data[start : found.start()].split()
        start = found.end()
    yield data[start:].split()


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and in whatever lambda the body reads it."""
    return F.transform(F.array(value), body)[0]


def running(items: Column, zero: Column, step: Callable[[Column, Column], Column], result: str) -> Column:
    """One value per item of an array, from left to right, as an array of type ``result``.

    ``step(state, item)`` gives a struct of the next ``state`` and of ``value``,
    the item's result.  Items are taken in blocks, because appending to an array
    copies it: n items cost n * RUNNING_BLOCK steps, not n^2.
    """
    none = F.from_json(F.lit("[]"), f"array<{result}>")

    def one(seen: Column, item: Column) -> Column:
        return bound(
            step(seen["state"], item),
            lambda made: F.struct(made["state"].alias("state"), F.array_append(seen["found"], made["value"]).alias("found")),
        )

    def over(all_items: Column) -> Column:
        def block(seen: Column, number: Column) -> Column:
            part = F.slice(all_items, number * RUNNING_BLOCK + 1, F.lit(RUNNING_BLOCK))
            start = F.struct(seen["state"].alias("state"), none.alias("found"))
            return bound(
                F.aggregate(part, start, one),
                lambda done: F.struct(done["state"].alias("state"), F.array_append(seen["found"], done["found"]).alias("found")),
            )

        blocks = F.sequence(F.lit(0), F.floor(F.size(all_items) / RUNNING_BLOCK).cast("int"))
        outer = F.struct(zero.alias("state"), F.from_json(F.lit("[]"), f"array<array<{result}>>").alias("found"))
        return F.flatten(F.aggregate(blocks, outer, block, lambda seen: seen["found"]))

    return bound(items, over)


def column_udf(make: Callable[[], Callable[[Iterable], "object"]], schema: str):
    """A Column function over Arrow batches.

    ``make()`` runs once per task and returns a function from the values of one
    batch to a pandas Series or DataFrame.  The function is marked as not
    deterministic only to keep the optimizer from evaluating it twice.
    """
    import pandas as pd  # noqa: F401  (names in the signature below)

    def run(batches):
        work = make()
        for batch in batches:
            # Spark may hand over thousands of long texts at once; results leave in smaller pieces.
            for at in range(0, len(batch), BATCH_ROWS):
                yield work(batch.iloc[at : at + BATCH_ROWS])

    struct = " " in schema.split("<")[0].strip()
    result = "pd.DataFrame" if struct else "pd.Series"
    run.__annotations__ = {
        "batches": Iterator[pd.Series],
        "return": Iterator[pd.DataFrame] if result == "pd.DataFrame" else Iterator[pd.Series],
    }
    return F.pandas_udf(run, schema).asNondeterministic()


def worker_cache(name: str, make: Callable[[], object]):
    """State that a reused Python worker keeps from task to task."""
    holder = sys.modules.setdefault("_tabloom_worker_cache", types.ModuleType("_tabloom_worker_cache"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def finite_vector(vector: Column) -> Column:
    """Not null, not empty, only finite components, and not the zero vector."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_key(vector: Column) -> Column:
    """A digest by which equal vectors meet."""
    return F.sha2(F.array_join(vector.cast("array<string>"), ","), 256)


def float_matrix(column):
    """A list column of an Arrow batch or table as a matrix; shorter rows end in zeros."""
    import numpy as np
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(lengths.max(initial=0))
    if len(lengths) and lengths.min() == width:
        return values.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width))
    matrix[np.arange(width) < lengths[:, None]] = values
    return matrix


def whole_runs(batches, keys: list[str], rows: int):
    """Tables of at least ``rows`` rows (but the last) from sorted batches, cut only where a key changes."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held, size = [], 0

    def changes(table):
        new = np.zeros(table.num_rows, dtype=bool)
        for key in keys:
            column = table[key].combine_chunks()
            differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
            new[1:] |= differs.to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        borders = changes(table)
        if len(borders):
            yield table.slice(0, int(borders[-1]))
            table = table.slice(int(borders[-1]))
        held, size = table.to_batches(), table.num_rows
        # A run longer than ``rows`` is looked at again only when it has doubled.
        rows = max(rows, 2 * size) if not len(borders) else rows
    if size:
        yield pa.Table.from_batches(held)
