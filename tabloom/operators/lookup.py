"""Joins of rows with a table that holds one row per key and its weight."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 128 * 1024 * 1024
HOT_KEYS = 10_000
SALTS = 64


def _bytes(value: Column, kind: DataType) -> Column:
    """Bytes of a value: text and binary as they are, lists by their items, 8 for any other value."""
    fixed = F.lit(8)
    if isinstance(kind, (StringType, BinaryType)):
        return fixed + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, StructType):
        return sum((_bytes(value[field.name], field.dataType) for field in kind), fixed)
    if isinstance(kind, MapType):
        parts = ((F.map_keys(value), kind.keyType), (F.map_values(value), kind.valueType))
        return sum((_bytes(part, ArrayType(inner)) for part, inner in parts), fixed)
    if isinstance(kind, ArrayType):
        inner = kind.elementType
        if isinstance(inner, (StringType, BinaryType, StructType, MapType, ArrayType)):
            items = F.aggregate(value, F.lit(0).cast("long"), lambda total, x: total + _bytes(x, inner).cast("long"))
        else:
            items = 8 * F.size(value).cast("long")
        return fixed + F.coalesce(F.when(value.isNotNull(), items), F.lit(0))
    return fixed


def _size(table: DataFrame) -> tuple[int, int]:
    """Rows and a byte count."""
    row = sum((_bytes(F.col(f"`{field.name}`"), field.dataType) for field in table.schema), F.lit(0))
    counted = table.agg(F.count("*"), F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()
    return counted[0], counted[1]


def left_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    weight: str,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join ``rows`` with ``table`` on ``keys``; exact for any key skew.

    ``weight`` is the number of rows of each key.  A table measured below both
    bounds is broadcast.  A larger one is cut in two: keys that hold more than
    1/HOT_KEYS of all weight, of which there are fewer than HOT_KEYS, are
    broadcast, or dealt over SALTS places when they are too wide; the other keys
    are small enough for a shuffle join.  Rows with a NULL key match nothing.
    """
    keys = list(keys)
    values = [name for name in table.columns if name not in (*keys, weight)]
    count, size = _size(table)
    if count <= broadcast_rows and size <= broadcast_bytes:
        return rows.join(F.broadcast(table.drop(weight)), keys, "left")

    total = table.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT_KEYS > F.lit(total)
    hot = table.where(is_hot).drop(weight).withColumn("__hot", F.lit(True))
    cold = table.where(~is_hot).drop(weight)
    has_key = reduce(and_, [F.col(key).isNotNull() for key in keys])
    # Rows without a key match nothing; in a shuffle join they would all go to one task.
    keyed, unkeyed = rows.where(has_key), rows.where(~has_key)
    if _size(hot)[1] <= broadcast_bytes:
        tagged = keyed.join(F.broadcast(hot), keys, "left")
    else:
        # Too wide to broadcast: every hot entry goes to SALTS places, and its rows are dealt among them.
        copies = hot.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = keyed.withColumn("__salt", F.pmod(F.xxhash64(*keyed.columns), F.lit(SALTS)).cast("int"))
        tagged = dealt.join(copies, [*keys, "__salt"], "left").drop("__salt")
    matched = tagged.where(F.col("__hot")).drop("__hot")
    unmatched = tagged.where(F.col("__hot").isNull()).drop("__hot", *values)
    found = matched.unionByName(unmatched.join(cold, keys, "left"))
    return found.unionByName(unkeyed, allowMissingColumns=True)
