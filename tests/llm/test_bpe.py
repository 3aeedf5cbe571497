"""BPE against the tiktoken library, exact round trips, appends and edits."""

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.llm import queries
from tabloom.llm.bpe import ByteBpe, PrefixTable, Tokenizer

FOLDER = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    with open(PATH, "rb") as file:
        return Tokenizer(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


PARTS = ["a", "b", "aa", " ", "  ", "\n", "\t", "é", "ß", "'s", "'ll", "1", "23", ".", "\x1c", "\x85", "漢", "👍",
         "\xa0", "the", "ing", " x", "　", "​"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=20).map("".join))
def test_same_ids_as_the_library(tokenizer, library, text):
    assert tokenizer.encode(text) == packed(library.encode_ordinary(text))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_round_trip(tokenizer, text):
    assert tokenizer.decode(tokenizer.encode(text)) == text.encode()


def test_long_pieces(tokenizer, library):
    for text in ("ab" * 3000, "thing" * 500, " " * 900, "é" * 700, "1" * 1000):
        assert tokenizer.encode(text) == packed(library.encode_ordinary(text))
    assert tokenizer.decode(tokenizer.encode("na" * 200_000)) == b"na" * 200_000


def test_full_memories_change_nothing(library, monkeypatch):
    monkeypatch.setattr("tabloom.llm.bpe.MEMORY_ENTRIES", 40)
    with open(PATH, "rb") as file:
        small = Tokenizer(file.read(), public_tokenizers.PATTERN)
    text = "Oumentoioi the erlichkeiten and thionation, eauxment queletre."
    assert small.encode(text) == packed(library.encode_ordinary(text))


def test_table_after_appends_and_edits(tokenizer):
    random_ = random.Random(3)
    letters = "".join(random_.choices(["the", "ing", "tion", "e", "a", "x"], k=300)).encode()
    table = PrefixTable(tokenizer.merges)
    for at in range(0, len(letters), 7):
        table.append(letters[at : at + 7])
    assert table.last == PrefixTable(tokenizer.merges, letters).last
    for _ in range(60):
        start = random_.randrange(len(table.data))
        end = min(len(table.data), start + random_.randrange(5))
        new = random_.choice([b"", b"q", b"ation", b"zz"])
        before = table.data
        touched = table.replace(start, end, new)
        assert table.data == before[:start] + new + before[end:]
        assert table.last == PrefixTable(tokenizer.merges, table.data).last
        assert start < 200 or touched <= len(new) + len(before) - end
    assert table.replace(10, 11, b"t") < 200 < len(table.data)
    assert table.tokens() == PrefixTable(tokenizer.merges, table.data).tokens()


def test_query_against_the_library(spark, library):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted(
        (i, len(ids := library.encode_ordinary(t or "")), hashlib.sha256(packed(ids)).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in texts
    )
    assert sorted(tuple(r) for r in queries.op6_byte_bpe(spark, FOLDER).collect()) == wanted


def test_columns_and_edge_cases(spark, library):
    rows = [(1, None), (2, ""), (3, "one  two\n"), (3, "one  two\n"), (None, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    bpe = ByteBpe(spark, PATH, public_tokenizers.PATTERN)
    coded = df.select("doc_id", "text", bpe.encode(F.col("text")).alias("coded"))
    back = coded.select("text", "coded", bpe.decode(F.col("coded")).alias("back")).collect()
    assert len(back) == len(rows)
    for text, ids, decoded in back:
        assert bytes(decoded) == (text or "").encode()
        assert len(text or "") > 1000 or ids == library.encode_ordinary(text or "")
    assert df.limit(0).select(bpe.encode(F.col("text"))).collect() == []
    for wrong in ([50256], [-1], [1, None]):
        with pytest.raises(Exception, match="no token has the id|an id is null"):
            spark.createDataFrame([(wrong,)], "ids array<int>").select(bpe.decode(F.col("ids"))).collect()
