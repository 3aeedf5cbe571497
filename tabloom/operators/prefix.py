"""Running totals and ranks in one global order, without a one-task sort.

The rows are range-partitioned on the full order (group, key, tie-breaker), so
a hot group or a hot key is cut between tasks wherever it falls.  Each part is
summed by its own window; the totals of earlier parts are added from a table
with at most one row per part and group boundary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.scratch import materialize

ROWS_PER_PART = 500_000
MAX_PARTS = 20_000

_PART = "__part"


def part_count(rows: int) -> int:
    """Number of range parts: a physical choice that never changes results."""
    return max(1, min(MAX_PARTS, -(-rows // ROWS_PER_PART)))


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, str],
    groups: Sequence[str] = (),
    parts: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add inclusive running totals of columns, per group in the given order.

    ``totals`` maps the new column to the summed one.  ``order`` must be a total
    order inside a group; group columns must not be NULL.  ``rows`` is the row
    count when known; otherwise it is counted.
    """
    groups = list(groups)
    if parts is None:
        parts = part_count(df.count() if rows is None else rows)
    if parts == 1:
        # Proven small: at most ROWS_PER_PART rows in total.
        window = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(value).over(window).alias(name) for name, value in totals.items()])

    spread = df.repartitionByRange(parts, *[F.col(name) for name in groups], *order)
    ranged = materialize(spread.withColumn(_PART, F.spark_partition_id()), "ranged")

    earlier = (
        Window.partitionBy(*groups).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranged.groupBy(_PART, *groups)
        .agg(*[F.sum(value).alias(f"__sum_{name}") for name, value in totals.items()])
        .select(
            _PART,
            *groups,
            *[F.sum(f"__sum_{name}").over(earlier).alias(f"__offset_{name}") for name in totals],
        )
    )
    inside = (
        Window.partitionBy(_PART, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = ranged.select(
        "*", *[F.sum(value).over(inside).alias(f"__local_{name}") for name, value in totals.items()]
    )
    return local.join(offsets, [_PART, *groups]).select(
        *df.columns,
        *[
            (F.col(f"__local_{name}") + F.coalesce(F.col(f"__offset_{name}"), F.lit(0))).alias(name)
            for name in totals
        ],
    )


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    rank: str = "rank",
    parts: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in a total order, per group."""
    ones = df.withColumn("__one", F.lit(1).cast("bigint"))
    return running_totals(ones, order, {rank: "__one"}, groups, parts, rows).drop("__one")


def with_next(
    df: DataFrame, order: Sequence[Column], values: dict[str, str], parts: int | None = None, rows: int | None = None
) -> DataFrame:
    """Add columns of the next row in a total order over all rows; NULL for the last row.

    ``values`` maps the new column to the one that is read.  Rows are range
    partitioned; a part's last row takes the first row of the next part, from a
    table of one row per part.
    """
    if parts is None:
        parts = part_count(df.count() if rows is None else rows)
    if parts == 1:
        # Proven small: at most ROWS_PER_PART rows in total.
        window = Window.orderBy(*order)
        return df.select("*", *[F.lead(value).over(window).alias(name) for name, value in values.items()])
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn(_PART, F.spark_partition_id()), "ranged")
    inside = Window.partitionBy(_PART).orderBy(*order)
    read = {name: F.struct(value) for name, value in values.items()}
    local = ranged.select("*", *[F.lead(value).over(inside).alias(f"__{name}") for name, value in read.items()])
    first = F.row_number().over(inside) == 1
    heads = ranged.withColumn("__first", first).where("__first").select(
        _PART, *[value.alias(f"__head_{name}") for name, value in read.items()]
    )
    # One row per part, at most MAX_PARTS.
    every = Window.orderBy(_PART)
    following = heads.select(_PART, *[F.lead(f"__head_{name}").over(every).alias(f"__head_{name}") for name in read])
    joined = local.join(F.broadcast(following), _PART, "left")
    return joined.select(
        *df.columns, *[F.coalesce(f"__{name}", f"__head_{name}")[value].alias(name) for name, value in values.items()]
    )
