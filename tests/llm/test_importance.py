"""Buckets, gains, weights and draws against a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import importance, queries

FOLDER = "/root/testdata/sf0.01"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_features(text):
    words = plain_words(text)
    return [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def plain_rows(rows, target, share=5, least=20):
    s, t = [0] * 10000, [0] * 10000
    for texts, counts in (([x for _, x in rows], s), (target, t)):
        for text in texts:
            for feature in plain_features(text):
                counts[plain_bucket(feature)] += 1
    gains = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t)]
    found = []
    for i, text in rows:
        features = plain_features(text)
        weight = sum(gains[plain_bucket(f)] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((i, len(features), weight, score, len(plain_words(text)) >= least))
    able = sorted((f for f in found if f[4]), key=lambda f: (-f[3], f[0] is None, f[0] or 0))
    drawn = able[: share * len(able) // 100]
    ranks = {id(f): rank for rank, f in enumerate(drawn, 1)}
    return sorted(((*f[:4], ranks.get(id(f))) for f in found), key=str)


def resampled(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def test_joined_crc():
    rng = random.Random(3)
    pairs = [(rng.randbytes(rng.randrange(9)), rng.randbytes(k)) for k in [*range(40), 1000, 70_000]]
    first = np.array([zlib.crc32(a) for a, _ in pairs], dtype=np.uint32)
    second = np.array([zlib.crc32(b) for _, b in pairs], dtype=np.uint32)
    joined = importance.joined_crc(first, second, np.array([len(b) for _, b in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@pytest.mark.parametrize("size", [1, 30, 1 << 21])
def test_blocks_of_any_size_give_the_same_features(size):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["one", "TWO,", "é3", "---", "x" * 300, ""], k=rng.randrange(60))).lower() for _ in range(40)]
    texts += ["", "...", "alone", ("w" * 500 + " ") * 5]
    separators, found = re.compile(importance.SEPARATORS), [[] for _ in texts]
    words = [0] * len(texts)
    for block in importance._blocks(texts, separators, size):
        rows, buckets, new = importance._features(block)
        for row, bucket in zip(rows.tolist(), buckets.tolist()):
            found[row].append(bucket)
        for row in new.tolist():
            words[row] += 1
    for text, buckets, n in zip(texts, found, words):
        assert sorted(buckets) == sorted(plain_bucket(f) for f in plain_features(text)) and n == len(plain_words(text))


def test_documents_against_plain_version(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("text").collect()]
    wanted = plain_rows(documents, target)
    assert resampled(queries.op12_importance_resampling(spark, FOLDER)) == wanted
    assert sum(r[4] is not None for r in wanted) > 20


def test_edge_cases(spark):
    rng = random.Random(9)
    vocabulary = ["alpha", "Beta", "gamma!", "É", "7", "日本", "z"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=25))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "!!! ..."), (103, "one"), (None, "alpha beta " * 30), (5, "z " * 40), (5, "z " * 40),
             (200, "Long words " * 150_000), (201, "x" * 300_000 + " y\x00z " + "\t".join("abc" * 9))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit("clash") for name in ("id", "found", "weight", "score", "rank", "n_words", "bucket", "n")}
    )
    target = spark.createDataFrame([("alpha beta",), (None,), ("Z z z",)], "text string").withColumn("n", F.lit(1))
    wanted = plain_rows(rows, ["alpha beta", None, "Z z z"], share=20)
    assert resampled(importance.resample(df, target, share=20)) == wanted
    nothing = importance.resample(df, target.limit(0), share=20)
    assert resampled(nothing) == plain_rows(rows, [], share=20)
    assert importance.resample(df.limit(0), target).collect() == []
