"""SimHash groups against a plain version over all pairs."""

import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tabloom.llm import simhash
from tabloom.llm.components import connected_components

FOLDER = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [(i, plain_fingerprint(text)) for i, text in rows]
    label = {fp: fp for _, fp in prints}
    todo = list(label)
    changed = True
    while changed:
        changed = False
        for a in todo:
            for b in todo:
                if (a ^ b).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    first = {}
    for i, fp in prints:
        if i is not None:
            first[label[fp]] = min(i, first.get(label[fp], i))
    return sorted((i, f"{fp:016x}", first.get(label[fp])) for i, fp in prints if i is not None)


def groups(df):
    return sorted(tuple(row) for row in df.collect() if row[0] is not None)


def test_documents_against_all_pairs(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(row) for row in documents.select("doc_id", "text").collect()]
    found = groups(simhash.near_duplicate_groups(documents))
    assert found == plain_groups(rows)
    assert sum(1 for i, _, component in found if i != component) > 10


def test_fingerprints_one_and_two_bits_apart_are_found(spark):
    base = [0, 1, 3, 7, -1, -2, (1 << 62) + 5, 1 << 40, (1 << 40) + (1 << 21) + (1 << 22), -(1 << 63)]
    prints = base + [p ^ (1 << i) ^ (1 << j) for p in base[6:8] for i in (0, 20, 21, 42, 62) for j in (1, 22, 43, 61)]
    prints = sorted({p if p < 1 << 63 else p - (1 << 64) for p in prints})
    classes = spark.createDataFrame([(p,) for p in prints], "fp long")
    wanted = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert {tuple(r) for r in simhash.near_fingerprints(classes, "fp").collect()} == wanted
    for segments in (3, 4, 5, 10):
        assert {tuple(r) for r in simhash.near_fingerprints(classes, "fp", 2, segments).collect()} == wanted
    assert simhash.near_fingerprints(classes, "fp", 0, 4).collect() == []
    wide = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert {tuple(r) for r in simhash.near_fingerprints(classes, "fp", 4, 6).collect()} == wide
    with pytest.raises(ValueError):
        simhash.near_fingerprints(classes, "fp", 3, 3)


def test_few_random_fingerprints_meet(spark):
    """Rows of the join before its condition, for 200,000 random fingerprints."""
    classes = spark.range(200_000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.near_fingerprints(classes, "fp").select("left", "right")
    assert plan.count() == 0
    key = (1 << 27) - 1
    met = classes.groupBy(F.col("fp").bitwiseAND(key)).count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert 7 * met < 5_000


def test_edge_cases(spark):
    long_text = "lorem IPSUM dolor " * 200_000
    rows = [(5, None), (3, ""), (9, " \t\n"), (1, "One two"), (2, "one  TWO"), (4, "a"), (4, "a"), (8, long_text),
            (7, long_text), (None, "x y z"), (10, "É è ç à"), (11, "é è ç à")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit("clash"), "component": F.lit(1), "id": F.lit(0), "n": F.lit(2)}
    )
    assert groups(simhash.near_duplicate_groups(df)) == plain_groups(rows)
    assert simhash.near_duplicate_groups(df).count() == len(rows)
    assert simhash.near_duplicate_groups(df.limit(0)).collect() == []


def test_components(spark):
    path = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1200)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (1000, 1001), (None, 3)], "l long, r long")
    found = {tuple(r) for r in connected_components(edges, "l", "r").collect()}
    assert found == {(i, 1) for i in range(1, 61)} | {(i, 1000) for i in range(1000, 1200)}
    assert connected_components(edges.where("l > r"), "l", "r").collect() == []
