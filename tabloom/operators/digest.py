"""Digest of a set of keys: a hash tree over ordered keys with fixed borders.

Keys are ordered by their SHA-256, whose first ``LEAF`` digits name a leaf and
first ``INNER`` digits a node above, so borders do not depend on the data and
leaves hold equally many keys.  A key counts once with the number of its rows,
so a hot key is one entry.  No task holds more than one leaf, or the at most
16^(LEAF - INNER) or 16^INNER nodes below a node.  A changed key changes one leaf; two tables
are compared by their leaves, without their keys.

Edge cases: a null key counts as a key of its own; the order of rows plays no
part; without groups an empty table has the digest of an empty text, and none
with groups; groups may be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF, INNER = 6, 3


def key_hash(key: Column) -> Column:
    """SHA-256 of a key's text; null differs from every text."""
    return F.sha2(F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("-")), 256)


def _level(df: DataFrame, keys: Sequence[str | Column], entry: Column, sums: Sequence[str]) -> DataFrame:
    """One row per node: the sums below it, and the hash of its ordered entries."""
    digest = F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), ","), 256)
    return df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums], digest.alias("__digest"))


def leaves(
    df: DataFrame, key: Column, groups: Sequence[str] = (), sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """``groups, __leaf, __rows, sums, __digest``: one row per leaf of each group's tree."""
    sums = dict(sums or {})
    hashed = df.select(*groups, key_hash(key).alias("__key"), *[value.alias(name) for name, value in sums.items()])
    keys = hashed.groupBy(*groups, "__key").agg(
        F.count("*").alias("__rows"), *[F.sum(name).alias(name) for name in sums]
    )
    named = keys.withColumn("__leaf", F.substring("__key", 1, LEAF))
    entry = F.concat_ws(":", "__key", F.col("__rows").cast("string"))
    return _level(named, [*groups, "__leaf"], entry, ["__rows", *sums])


def roots(tree: DataFrame, groups: Sequence[str] = (), sums: Sequence[str] = (), output: str = "digest") -> DataFrame:
    """``groups, rows, sums`` and the digest of each group, from its leaves."""
    below = ["__rows", *sums]
    named = tree.withColumn("__node", F.substring("__leaf", 1, INNER))
    inner = _level(named, [*groups, "__node"], F.concat_ws(":", "__leaf", "__digest"), below)
    top = _level(inner, list(groups), F.concat_ws(":", "__node", "__digest"), below)
    return top.select(
        *groups, F.coalesce("__rows", F.lit(0)).alias("rows"), *sums, F.col("__digest").alias(output)
    )


def digests(
    df: DataFrame,
    key: Column,
    groups: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    output: str = "digest",
) -> DataFrame:
    """Rows, sums and key digest of each group."""
    return roots(leaves(df, key, groups, sums), groups, list(sums or {}), output)


def differing_leaves(left: DataFrame, right: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Leaves whose keys differ, with the rows on both sides (0 where a side has none)."""
    names = [*groups, "__leaf"]
    sides = left.select(*names, F.lit(0).alias("__side"), "__rows", "__digest").unionByName(
        right.select(*names, F.lit(1).alias("__side"), "__rows", "__digest")
    )

    def side(number: int, name: str) -> Column:
        return F.max(F.when(F.col("__side") == number, F.col(name)))

    both = sides.groupBy(*names).agg(
        F.coalesce(side(0, "__rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(side(1, "__rows"), F.lit(0)).alias("right_rows"),
        side(0, "__digest").eqNullSafe(side(1, "__digest")).alias("__same"),
    )
    return both.where("NOT __same").select(*groups, F.col("__leaf").alias("leaf"), "left_rows", "right_rows")
