"""Held-out accuracy, mixtures of known shares, and edge cases of the language model."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tabloom.llm import langid, queries

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op3_language_mixture(spark, FOLDER).collect()
    assert len(found) == len(labels)
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0.0 <= row.score <= 1.0 and row.lang_pred in set(labels.values())
    judged = [row.lang_pred == labels[row.doc_id] for row in found if row.held_out and labels[row.doc_id]]
    assert len(judged) > 150 and np.mean(judged) > 0.97


def test_shares_of_two_languages_are_found(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.fit(documents)
    texts = {lang: " ".join(r[0] for r in documents.where(F.col("lang") == lang).select("text").head(60)) for lang in ("en", "fr")}
    mixed = texts["en"][:30_000] + " " + texts["fr"][:10_000]
    row = spark.createDataFrame([(mixed,)], "text string").select(langid.detect(spark, model, F.col("text")).alias("x")).first().x
    assert row.langs == ["en", "fr"] and row.lang_pred == "en"
    assert abs(row.score - 0.75) < 0.05 and abs(sum(row.shares) - 1) < 0.05


def test_expectation_maximisation_against_a_plain_version():
    rng = np.random.default_rng(5)
    probabilities = rng.dirichlet(np.ones(40), size=3).T
    counts = rng.integers(1, 9, size=40).astype(float)
    share = [1 / 3] * 3
    for _ in range(langid.ROUNDS):
        new = [0.0] * 3
        for row, n in zip(probabilities, counts):
            whole = sum(s * p for s, p in zip(share, row))
            for k in range(3):
                new[k] += n * share[k] * row[k] / whole
        share = [x / counts.sum() for x in new]
    found, likelihood = langid.shares(probabilities, counts, langid.ROUNDS)
    assert np.allclose(found, share)
    assert np.isclose(likelihood, sum(n * np.log(probabilities[i] @ np.array(share)) for i, n in enumerate(counts)))


def test_trigrams_against_a_plain_version(monkeypatch):
    def plain(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        shown = " " + " ".join(letters.split()) + " "
        return (len(shown) - 2, sum(c.isalpha() for c in text.lower())) if shown.strip() else (0, 0)

    texts = ["", "a", ".a", "ab", "a b", " a, b!", "👍", "x👍y", "éÀ\U00020000", "one two  three" * 50, "." * 40, "a" * 16 + "." * 16]
    for block in (1 << 20, 4):
        monkeypatch.setattr(langid, "BLOCK", block)
        count = langid._bucket_counter()
        for text in texts:
            counts, letters = count(text)
            assert (int(counts.sum()), letters) == plain(text), (text, block)


def test_edge_cases(spark):
    rows = [(1, None, "aa"), (2, "", "aa"), (3, "123 !!\n", "bb"), (4, "lala lala", "aa"), (5, "zuzu zozu", "bb"),
            (5, "zuzu zozu", "bb"), (None, "lala", None), (7, "lala " * 600_000, "aa"), (8, "漢字👍", None), (9, "x", None),
            (10, "👍👍👍", None), (11, ".a", None), (12, "\U00020000", None), (13, "Z", None), (14, "\U0001d7d8 4", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    model = langid.fit(df)
    found = df.select("doc_id", langid.detect(spark, model, F.col("text")).alias("x")).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row.x for row in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[4].lang_pred == "aa" and by_id[5].lang_pred == "bb" and by_id[7].lang_pred == "aa"
    assert by_id[None].lang_pred == "aa" and by_id[8].lang_pred in ("aa", "bb")
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (10, 14))
    assert all(by_id[i].lang_pred in ("aa", "bb") for i in (9, 11, 12, 13))
    nothing = langid.fit(df.where("false"))
    assert {r.x.lang_pred for r in df.select(langid.detect(spark, nothing, F.col("text")).alias("x")).collect()} == {"und"}
    assert df.limit(0).select(langid.detect(spark, model, F.col("text"))).collect() == []
