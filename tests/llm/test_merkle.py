"""Trees, proofs and tampering against a plain version."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tabloom.llm import merkle, queries
from tabloom.llm.merkle import MerkleManifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 16])) for i in range(0, len(low), 16)])
    return levels


def plain_way(levels, pos):
    way = []
    for level in levels[:-1]:
        first = pos // 16 * 16
        run = level[first : first + 16]
        way.append((pos - first, run[: pos - first] + run[pos - first + 1 :]))
        pos //= 16
    return way


def plain_rows(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the columns of the query."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append(plain_tree([plain_leaf(r) for r in groups[source]]))
    top = plain_tree([tree[-1][0] for tree in trees]) if trees else []
    found = []
    for at, source in enumerate(order):
        for pos, row in enumerate(groups[source]):
            way = plain_way(trees[at], pos) + plain_way(top, at)
            tampered = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                tampered = (*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4]))
            digest = plain_leaf(tampered)
            for place, others in way:
                digest = sha("".join([*others[:place], digest, *others[place:]]))
            root = top[-1][0]
            proof = sha("".join("".join(others) for _, others in way))
            found.append((row[0], plain_leaf(row), trees[at][-1][0], root, proof, digest, digest == root))
    return sorted(found, key=str)


def proved(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_documents_against_plain_version(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in documents.select(*COLUMNS).collect()]
    wanted = plain_rows(rows)
    assert proved(queries.op11_octopus_manifest(spark, "/root/testdata/sf0.01")) == wanted
    assert {r[-1] for r in wanted} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [4097, 3], [256, 4096, 1, 5] + [1] * 30])
def test_tree_shapes(spark, sizes):
    rows = [(i * 1000 + k, f"s{i:03}", None, k, f"Text {k}") for i, n in enumerate(sizes) for k in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert proved(queries.manifest_rows(df)) == plain_rows(rows)


def test_small_blocks_take_many_steps(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(k, "hot" if k % 3 else f"s{k % 50}", "en", k, "A" * (k % 7)) for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert proved(queries.manifest_rows(df)) == plain_rows(rows)


def test_a_few_leaves_fetch_the_least_union_and_prove_alone(spark):
    rows = [(k, "a" if k < 900 else "b", "en", k, f"text {k}") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    manifest = MerkleManifest.build(df, merkle.row_digest(*map(F.col, COLUMNS)), "source", "doc_id")
    some = manifest.leaves.where("doc_id IN (0, 1, 17, 450, 999)")
    fetched = [tuple(r) for r in manifest.missing(some).select("node_tree", "level", "pos").collect()]
    # Tree a, 900 leaves: runs of 0-15 (14 missing), 16-31 (15), 448-463 (15); level 1: of 0-15 without 0 and 1, of 16-31 without 28;
    # level 2: of 4 without 0 and 1.  Tree b, 100 leaves: 99 in 96-99 (3), 6 of 0-6.  Above: the other subroot, for either block.
    inside = [(level, sum(t == 0 and at == level for t, at, _ in fetched)) for level in range(3)]
    assert inside == [(0, 44), (1, 29), (2, 2)] and len(fetched) == 75 + 9 + 2
    assert len(set(fetched)) == len(fetched)
    found = manifest.proofs(some).select("doc_id", (merkle.fold(F.col("digest"), F.col("proof")) == F.col("root")).alias("ok"))
    assert sorted(tuple(r) for r in found.collect()) == [(k, True) for k in (0, 1, 17, 450, 999)]


def test_missing_coordinates():
    assert merkle.missing_coordinates([0], 1) == []
    assert merkle.missing_coordinates([0], 2) == [(0, 1)]
    assert merkle.missing_coordinates(list(range(17)), 17) == []
    assert merkle.missing_coordinates([16], 17) == [(1, 0)]


def test_edge_cases(spark):
    long_text = "Lorem Ipsum " * 200_000
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "b", "en", 3, "Abc"), (None, "b", "en", 3, "abd"),
            (2, "", "en", 0, ""), (3, "é", "en", -5, "É A"), (4, "z", None, 1, long_text), (5, "z", "en", 1, "-"), (5, "z", "EN", 1, "x")]
    rows += [(10 + k, "n", "x", k, "Cc") for k in range(20)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    df = spark.createDataFrame(rows, schema).withColumns(
        {name: F.lit("clash") for name in ("tree", "pos", "digest", "n", "leaf", "root", "key", "rank", "kept_0", "proof", "at")}
    )
    assert proved(queries.manifest_rows(df)) == plain_rows(rows)
    assert queries.manifest_rows(df.limit(0)).collect() == []
