"""Personal data against a plain version with Python's regular expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tabloom.llm import pii, queries

FOLDER = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for place, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def passes(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 14 <= len(number) <= 19 and luhn(number)
    return kind != "phone" or 10 <= len(number) <= 15


def plain(text):
    found = [
        (m.start(), place, m.end(), kind)
        for place, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group(0))
    ]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def spans_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    df = df.withColumns({"base": pii.base_spans(F.col("text")), "kind": F.lit("clash"), "score": F.lit(0)})
    rows = df.select("doc_id", "base", pii.all_spans(F.col("text"), F.col("base")).alias("spans")).orderBy("doc_id").collect()
    return [([(s.kind, s.start, s.end) for s in r.base], [(s.kind, s.start, s.end) for s in r.spans]) for r in rows]


def test_documents_against_plain_version(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op8_personal_data(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    total = 0
    for row in rows:
        wanted = plain(texts[row.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(row.spans.split(","))
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in wanted)
        total += len(wanted)
    assert total > 20


def test_random_texts_against_plain_version(spark):
    random_ = random.Random(11)
    parts = ["a@b.co", "x.y_z@q-r.s.t", "@", ".", "1", "255", "256.1.1.1", "10.0.0.001", "4111 1111 1111 1111", "-", " ",
             "+", "+1 (988) 555-2485", "é", "👍", "_", "%", "49", "00", "\n", "b.c@d", "3.4.5", "5555555555554444", "(", ")"]
    texts = ["".join(random_.choices(parts, k=random_.randint(1, 14))) for _ in range(1500)]
    for text, (base, _) in zip(texts, spans_of(spark, texts)):
        assert base == plain(text), text


def test_added_kinds_need_a_checksum_or_context(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 please", "IBAN GB83 WEST 1234 5698 7654 32 please", "ssn: 123-45-6789", "part 123-45-6789",
        "phone 555-867-5309", "code 555-867-5309", "+1 (988) 555-2485 phone", "ssn 000-12-3456",
    ]
    added = [[s for s in all_ if s not in base] for base, all_ in spans_of(spark, texts)]
    assert added == [[("iban", 5, 32)], [], [("ssn", 5, 16)], [], [("local_phone", 6, 18)], [], [], []]


def test_redaction(spark):
    texts = ["mail a@b.co now", "+4111 1111 1111 1111 x", None, "", "é👍 10.0.0.1, a@b.co"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    spans = df.withColumn("base", pii.base_spans(F.col("text")))
    out = [r[0] for r in spans.orderBy("i").select(pii.redact(F.col("text"), F.col("base"))).collect()]
    assert out == ["mail [EMAIL] now", "+[CARD] x", None, "", "é👍 [IP], [EMAIL]"]


@pytest.mark.parametrize("long", ["1 " * 60_000, "a" * 120_000 + "@", "1" * 12_000, "+1" + " " * 100_000, "1." * 6_000, "A1" * 6_000])
def test_long_texts(spark, long):
    text = long + " me@example.org " + long
    base, _ = spans_of(spark, [text])[0]
    assert ("email", len(long) + 1, len(long) + 15) in base
    if not long.startswith("a"):
        assert base == plain(text)


def test_many_spans_in_one_text(spark):
    import time

    pieces = [f"10.0.{i % 256}.{i // 256 % 256}" + (" call " if i % 3 else ", ") for i in range(100_000)]
    text = "".join(pieces)
    df = spark.createDataFrame([(text,)], "text string").withColumn("base", pii.base_spans(F.col("text")))
    df = df.withColumn("spans", pii.all_spans(F.col("text"), F.col("base")))
    start = time.perf_counter()
    row = df.select("base", F.size("spans").alias("n"), pii.redact(F.col("text"), F.col("spans")).alias("clean")).first()
    assert time.perf_counter() - start < 90
    assert row.n == 100_000 and [(s.kind, s.start, s.end) for s in row.base] == plain(text)
    assert row.clean == re.sub("[0-9.]{7,}", "[IP]", text)


def test_added_spans_beside_many_base_spans(spark):
    random_ = random.Random(2)
    parts = ["10.0.0.1 ", "ssn 123-45-6789 ", "+1 555-867-5309 ", "phone 555-867-5309 ", "x", "@", "a@b.co ", "call 1.555-867-5309"]
    texts = ["".join(random_.choices(parts, k=400)) for _ in range(20)]
    for base, found in spans_of(spark, texts):
        added = [s for s in found if s not in base]
        assert added and all(not (b < y and x < e) for _, x, y in added for _, b, e in base)
        assert found == sorted(found, key=lambda s: s[1])


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string")
    assert df.select(pii.base_spans(F.col("text"))).collect() == []
