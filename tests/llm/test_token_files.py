"""Separator scan of flat files against a plain split of the whole stream."""

import comparing
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import queries, token_files

FOLDER = "/root/testdata/sf0.01"


def plain(ids, end):
    found, start = [], 0
    for at, value in enumerate(ids):
        if value == end:
            found.append((len(found), start, at - start, True))
            start = at + 1
    if start < len(ids):
        found.append((len(found), start, len(ids) - start, False))
    return found


def rows(df):
    return sorted(tuple(r) for r in df.select("ordinal", "start", "n_tokens", "complete").collect())


def test_query_matches_sql(spark):
    df = queries.op5_separator_scan(spark, FOLDER)
    assert comparing.difference(df, comparing.connect(FOLDER), queries.ORACLES["op5_separator_scan"]) is None


@pytest.mark.parametrize("width,end", [(1, 7), (2, 0), (2, 50256), (4, 100_257)])
def test_documents_across_blocks(spark, tmp_path, width, end):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 200, size=5_000)
    ids[ids == end] += 1
    ids[rng.choice(5_000, 90, replace=False)] = end
    ids[[0, 63, 64, 65, 128, 4_999]] = end
    ids[1_000:2_000] = 5 if end != 5 else 6
    (tmp_path / "a.bin").write_bytes(ids.astype(token_files.FORMATS[width]).tobytes())
    for block in (1, 64, 10_000):
        found = rows(token_files.token_counts(spark, str(tmp_path), width, end, block_tokens=block)) if block > 1 else None
        assert found is None or found == plain(ids, end)


def test_a_stream_of_several_files(spark, tmp_path):
    ids = np.array([3, 3, 0, 4, 5, 6, 7, 8, 0, 0, 9, 9], dtype="<u2")
    for number, (a, b) in enumerate([(0, 1), (1, 4), (4, 4), (4, 8), (8, 12)]):
        (tmp_path / f"part-{number:03}.bin").write_bytes(ids[a:b].tobytes())
    files = spark.read.format("binaryFile").load(str(tmp_path))
    blocks = token_files.scan_blocks(files, F.lit("all"), 2, 0, block_tokens=2)
    assert rows(token_files.stitch(blocks)) == plain(ids, 0)
    by_file = token_files.token_counts(spark, str(tmp_path))
    assert by_file.select("stream").distinct().count() == 4


def test_edge_cases(spark, tmp_path):
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "odd.bin").write_bytes(b"\x01\x00\x00\x00\x05")
    assert rows(token_files.token_counts(spark, str(tmp_path))) == [(0, 0, 1, True)]
    with pytest.raises(ValueError):
        token_files.token_counts(spark, str(tmp_path), width=3)
    texts = [(1, None), (2, ""), (3, "a b\tc"), (3, "a b\tc"), (3, "x"), (None, "y z"), (5, "w " * 300_000), (6, " \n ")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "hash": F.lit(1)})
    found = sorted(((r.doc_id, r.n_tokens) for r in token_files.documents_token_counts(df).collect()), key=str)
    assert found == sorted(((i, len((t or "").split())) for i, t in texts), key=str)
    assert token_files.documents_token_counts(df.limit(0)).collect() == []
