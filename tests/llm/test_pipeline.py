"""The stages against plain versions, on their own inputs."""

import hashlib
import struct

import corpus_pipeline
import public_tokenizers
import pytest
from llm.test_simhash import plain_groups
from pyspark.sql import functions as F

from tabloom.llm import langid, mixing
from tabloom.llm.bpe import Tokenizer

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], FOLDER).persist())
    return tables


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixing", "tokens"]


def test_language_keeps_clean_documents(spark, stages):
    before, after = set(rows(stages[0])), set(rows(stages[1]))
    assert after <= before and len(after) >= 0.98 * len(before)
    model = langid.fit(stages[0])
    found = stages[0].select("doc_id", langid.detect(spark, model, F.col("text")).alias("x")).collect()
    kept = {r.doc_id for r in found if r.x.lang_pred != "und" and r.x.score >= corpus_pipeline.MIN_SHARE}
    assert {r[0] for r in after} == kept


def test_one_document_of_each_group_stays(stages):
    before = rows(stages[1])
    groups = plain_groups([r[:2] for r in before])
    first = {i: component for i, _, component in groups}
    assert sorted(rows(stages[2])) == sorted(r for r in before if first[r[0]] == r[0])
    texts = [r[1] for r in rows(stages[2])]
    assert len(set(texts)) == len(texts) < len(before)


def test_rows_that_share_an_id_or_have_none_are_rows_of_their_own(spark):
    words = [f"w{i}" for i in range(400)]
    text = [" ".join(words[i * 40 : i * 40 + 40]) for i in range(10)]
    data = [(1, text[0], "a"), (1, text[1], "a"), (1, text[0], "b"), (None, text[2], "a"), (None, text[2], "a"), (None, text[3], "a"),
            (7, text[3], "a"), (8, text[4], "a"), (8, text[4], "a"), (9, text[4].upper(), "a")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3)
    found = [tuple(r) for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()]
    assert len(found) == 5
    assert sorted((r[0], r[1]) for r in found if r[0]) == sorted([(1, text[0]), (1, text[1]), (7, text[3]), (8, text[4])])
    assert [r for r in found if r[0] is None] == [(None, text[2], "a")]


def test_personal_data_is_replaced_and_other_texts_stay(stages):
    before, after = {r[0]: r for r in rows(stages[2])}, {r[0]: r for r in rows(stages[3])}
    assert set(before) == set(after)
    changed = 0
    for i, row in after.items():
        assert row[2:4] == before[i][2:4] and row[4] == len(row[1])
        if row[1] != before[i][1]:
            changed += 1
            assert "[" in row[1]
        assert "@mail" not in row[1]
    assert 0 < changed < len(after) / 4


def test_mixing_repeats_by_the_poisson_draw(stages):
    before, after = {r[0]: r for r in rows(stages[3])}, rows(stages[4])
    assert set(after) <= set(before.values())
    sizes = mixing.source_sizes(stages[3])
    steps = {r.source_key: r.steps for r in mixing.repetition_rates(sizes, mixing.temperature_weights(sizes)).collect()}
    for i, row in before.items():
        u = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[: mixing.UNIFORM_DIGITS], 16) / 16.0**mixing.UNIFORM_DIGITS
        assert after.count(row) == sum(s <= u for s in steps["s" + row[3]])


def test_tokens(stages):
    with open(corpus_pipeline.RANKS, "rb") as file:
        tokenizer = Tokenizer(file.read(), public_tokenizers.PATTERN)
    texts = {r[0]: r[1] for r in rows(stages[4])}
    found = stages[5].collect()
    assert len(found) == stages[4].count()
    for row in found:
        packed = struct.pack(f"<{len(row.ids)}i", *row.ids)
        assert packed == tokenizer.encode(texts[row.doc_id]) and row.n_tokens == len(row.ids) and row.decodes
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()


def test_run_applies_all_stages(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER).drop("ids")
    assert sorted(rows(found)) == sorted(rows(stages[5].drop("ids")))


def test_edge_cases(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    backwards = " ".join(reversed(words.split())) + " "
    data = [(1, words, "aa", "s", 3), (1, words, "aa", "s", 3), (2, words, "aa", None, 3), (3, None, "aa", "s", None), (4, "", None, "s", 0),
            (None, words + " mu", "aa", "s", 1), (5, backwards * 20_000, "aa", "t", 1), (6, "1 2 3", None, None, 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {name: F.lit("clash") for name in ("fp", "component", "found", "Base", "spans", "copy", "steps", "n", "row")}
    )
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, "")
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [1, 5, None]
    for _, stage in corpus_pipeline.STAGES[2:]:
        docs = stage(spark, docs, "")
    assert all(r.decodes for r in docs.collect())
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, "")
    assert nothing.collect() == []


def test_texts_of_several_languages_stay(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {lang: [r[0] for r in docs.where(F.col("lang") == lang).select("text").head(20)] for lang in ("en", "fr", "de")}
    mixed = [(20_000 + k, " ".join(t[:600] for t in parts), None, "s", 1) for k, parts in enumerate(zip(*texts.values()))]
    short = [(30_000, "All rights reserved. This text may be copied.", None, "s", 1), (30_001, "123 456", None, "s", 1)]
    more = docs.select(*COLUMNS).unionByName(spark.createDataFrame(mixed + short, docs.select(*COLUMNS).schema))
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, more, FOLDER).where("doc_id >= 20000").collect()}
    assert len(mixed) == 20 and kept == {r[0] for r in mixed} | {30_000}
