"""Lattice probabilities against all segmentations, and the query against a plain version."""

import math
import zlib
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tabloom.llm import lattice, queries
from tabloom.llm.lattice import Lattice, SubwordLattice

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pieces():
    with open(queries.RANKS, "rb") as file:
        return Lattice(file.read())


def by_segmentations(pieces, word):
    """Sum over all ways to cut the word, each the product of its pieces."""
    text = b" " + word

    @lru_cache(maxsize=None)
    def ways(start):
        if start == len(text):
            return math.exp(pieces.stop)
        return sum(
            math.exp(pieces.log[text[start:end]]) * ways(end)
            for end in range(start + 1, len(text) + 1)
            if text[start:end] in pieces.log
        )

    return math.log10(ways(0))


WORDS = [w.encode() for w in ("a", "the", "thionation", "éauxment", "x" * 20, "漢字", "!?", "12345", "über", "queletre")]


def test_words_against_all_segmentations(pieces):
    words = [*WORDS, b"y" * 64, b"z" * 65, b"\xff\x00"]
    for word, found in zip(words, pieces.log10(words)):
        assert found == pytest.approx(by_segmentations(pieces, word), rel=1e-9)


def test_pieces_are_distributions(pieces):
    first = sum(math.exp(v) for p, v in pieces.log.items() if p[:1] == b" ")
    later = sum(math.exp(v) for p, v in pieces.log.items() if p[:1] != b" ")
    assert first == pytest.approx(1) and later + lattice.STOP == pytest.approx(1)
    assert {bytes([b]) for b in range(256)} - {bytes([b]) for b in b"\t\n\x0b\x0c\r"} - set(pieces.log) <= {
        bytes([b]) for b in range(65, 91)
    }


def test_long_words_do_not_underflow(pieces):
    assert -1e7 < pieces.log10([b"qz" * 50_000])[0] < -1000


def plain(pieces, rows):
    texts = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1, (t or "").encode().lower().split()) for i, t in rows]
    counts, ends = Counter(), 0
    for _, held_out, words in texts:
        if not held_out:
            counts.update(words)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    every = sorted({w for _, _, words in texts for w in words})
    g = dict(zip(every, pieces.log10(every))) if every else {}
    out = []
    for i, held_out, words in texts:
        base = score = 0.0
        for c, spread in [*((counts[w], 10 ** g[w] * (1 - lattice.END)) for w in words), (ends, lattice.END)]:
            base += math.log10((c + 0.5) / max(n + 0.5 * (v + 1), 1))
            score += math.log10((c + max(v, 1) * spread) / (n + max(v, 1)))
        known = sum(counts[w] > 0 for w in words) + (ends > 0)
        out.append((i, held_out, len(words) + 1, known, n, base, score))
    return sorted(out, key=str)


def same(found, wanted):
    found = sorted((tuple(r) for r in found), key=str)
    assert len(found) == len(wanted)
    for a, b in zip(sorted(found, key=lambda r: str(r[:5])), sorted(wanted, key=lambda r: str(r[:5]))):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


@pytest.mark.parametrize("frequent", [lattice.FREQUENT, 50])
def test_query_against_plain_version(spark, pieces, monkeypatch, frequent):
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    monkeypatch.setattr(lattice, "HELD_WORDS", 3_000)
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op2_subword_lattice(spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(found.collect(), plain(pieces, rows))


def test_edge_cases(spark, pieces, monkeypatch):
    monkeypatch.setattr(lattice, "FREQUENT", 2)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b  a"), (4, "A b  a"), (None, "new"), (7, "long " * 250_000), (8, "É é"), (9, "q" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "c": F.lit(1), "base": F.lit(0)})

    def run(df):
        held_out = queries.fold_of("doc_id", 5) == 1
        model = SubwordLattice.fit(df, queries.RANKS, ~held_out)
        return model.apply(df, {"doc_id": F.col("doc_id"), "held_out": held_out}).collect()

    same(run(df), plain(pieces, rows))
    assert run(df.limit(0)) == []
    held = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1]
    if held:
        same(run(spark.createDataFrame(held, "doc_id long, text string")), plain(pieces, held))
