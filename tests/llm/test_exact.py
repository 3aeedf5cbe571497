"""Exact groups against a plain version, and the trie itself."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tabloom.llm import exact

FOLDER = "/root/testdata/sf0.01"


def plain_owners(rows):
    """(id, text) rows; sorted (id, keep_id, size, kept, digest)."""
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i))
    found = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] if m[2] is not None else 0))
        digest = hashlib.sha256(body.encode()).hexdigest()
        left = 1
        for member in members:
            kept = member == best and left > 0
            left -= kept
            found.append((member[2], best[2], len(members), kept, digest))
    return sorted(found, key=str)


def owners(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trie_holds_every_string_once():
    rng = random.Random(5)
    words = [bytes(rng.choices(b"ab", k=rng.randrange(12))) for _ in range(3000)] + [b"a" * 5000, b"a" * 4999 + b"b"]
    trie, counted = exact.RadixTrie(), {}
    for word in words:
        node = trie.terminal(word)
        node.owner = (node.owner or 0) + 1
        counted[word] = counted.get(word, 0) + 1
    assert trie.size > 0
    first = trie.heaviest()
    part = dict(trie.take(first))
    assert part and all(word[0] == first for word in part)
    rest = dict(trie.take())
    assert not part.keys() & rest.keys() and part | rest == counted
    assert list(trie.take()) == [] and trie.size == 0


def test_split_of_long_labels():
    trie = exact.RadixTrie()
    base = b"x" * 1_000_000
    for tail in (b"", b"1", b"2", b"12"):
        trie.terminal(base + tail).owner = tail
    trie.terminal(base[:500_000]).owner = b"half"
    assert dict(trie.take()) == {base + t: t for t in (b"", b"1", b"2", b"12")} | {base[:500_000]: b"half"}


def test_documents_against_plain_version(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    wanted = plain_owners(rows)
    assert owners(exact.duplicate_owners(documents)) == wanted
    assert sum(not r[3] for r in wanted) > 10


@pytest.mark.parametrize("held", [0, 2000])
def test_spilled_subtrees_and_many_tasks_give_the_same(spark, held):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices(["a", "ab", "b", "ba"], k=rng.randrange(6)))) for i in range(800)]
    rows += [(2000 + i, "one  hot text" if i % 2 else "onehot\ttext") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert owners(exact.duplicate_owners(df, held_bytes=held)) == plain_owners(rows)


def test_equal_length_and_hash_do_not_make_texts_equal(spark):
    schema = "terminal long, length long, hash long, body binary, n long, weight long, best_id long, place long"
    rows = [(1, 2, 9, b"ab", 1, 2, 30, 0), (2, 2, 9, b"cd", 2, 2, 10, 1), (3, 2, 9, b"ab", 1, 3, 40, 5), (4, 3, 9, b"abc", 1, 3, 5, 6)]
    arrow = spark.createDataFrame(rows, schema).toArrow()
    kinds = [(name, LongType()) for name in ("terminal", "owner", "owner_place", "keep_id", "group_size")]
    out = exact._owners(exact._schema(LongType(), [*kinds, ("text_sha256", StringType())]))(arrow.to_batches())
    found = sorted(tuple(r.values())[:5] for batch in out for r in batch.to_pylist())
    assert found == [(1, 3, 5, 40, 2), (2, 2, 1, 10, 2), (3, 3, 5, 40, 2), (4, 4, 6, 5, 1)]


def test_edge_cases(spark):
    long_text = "lorem ipsum " * 300_000
    rows = [(1, None), (2, ""), (3, " \n"), (3, " \n"), (None, "\t\r\x0b\x0c"), (4, "É a"), (5, "Éa"), (6, "éa"), (7, "a b"),
            (8, "ab"), (9, long_text), (10, long_text + "x"), (11, long_text.replace(" ", "")), (None, "alone"), (12, "AB")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit("clash") for name in ("id", "terminal", "n", "kept", "keep_id", "body", "weight", "place")}
    )
    assert owners(exact.duplicate_owners(df)) == plain_owners(rows)
    assert exact.duplicate_owners(df.limit(0)).collect() == []
    named = spark.createDataFrame([("b", "x"), ("a", " x"), ("c", "x ")], "key string, body string")
    assert owners(exact.duplicate_owners(named, "key", "body"))[0][1:4] == ("a", 3, True)
