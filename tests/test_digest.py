"""The hash tree over keys against a plain one."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabloom.operators import digest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(keys):
    """Root over sorted key hashes with their counts, level by level."""
    nodes = Counter(sha("-" if key is None else f"={key}") for key in keys)
    level = [(h, f"{h}:{n}") for h, n in sorted(nodes.items())]
    for digits in (digest.LEAF, digest.INNER, 0):
        below = {}
        for name, entry in level:
            below.setdefault(name[:digits], []).append(entry)
        level = [(name, f"{name}:{sha(','.join(entries))}") for name, entries in sorted(below.items())]
    return level[0][1][1:] if level else sha("")


@pytest.mark.parametrize(
    "keys", [[], [None], ["-"], [""], list("abc"), ["x"] * 500 + [None, None, "y", "="], [f"k{i}" for i in range(3000)]]
)
def test_against_a_plain_tree(spark, keys):
    df = spark.createDataFrame([(key,) for key in keys], "key string")
    row = digest.digests(df.repartition(5), F.col("key")).first()
    assert tuple(row) == (len(keys), plain(keys))


def test_groups_and_sums(spark):
    rows = [(i % 3 if i % 4 else None, i, i * 2) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, k bigint, v bigint")
    found = {r["g"]: r for r in digest.digests(df, F.col("k"), ["g"], {"total": F.col("v")}, "d").collect()}
    for group in (None, 0, 1, 2):
        mine = [r for r in rows if r[0] == group]
        assert tuple(found[group]) == (group, len(mine), sum(r[2] for r in mine), plain([r[1] for r in mine]))
    assert digest.digests(df.limit(0), F.col("k"), ["g"]).collect() == []


def test_order_and_parts_do_not_matter(spark):
    ids = spark.range(100)
    value = digest.digests(ids, F.col("id")).first()["digest"]
    assert digest.digests(ids.orderBy(F.rand(1)).repartition(9), F.col("id")).first()["digest"] == value
    assert digest.digests(spark.range(101), F.col("id")).first()["digest"] != value


def test_a_changed_key_changes_one_leaf(spark):
    left = digest.leaves(spark.range(2000), F.col("id"))
    gone = digest.leaves(spark.range(2000).where("id <> 77"), F.col("id"))
    twice = digest.leaves(spark.range(2000).unionByName(spark.range(5, 6)), F.col("id"))
    assert digest.differing_leaves(left, left).collect() == []
    assert [tuple(r) for r in digest.differing_leaves(left, gone).collect()] == [(sha("=77")[:6], 1, 0)]
    assert [tuple(r) for r in digest.differing_leaves(left, twice).collect()] == [(sha("=5")[:6], 1, 2)]
