"""Resampling rows towards a target distribution, by importance weights.

Texts become bags of hashed n-grams of one to three words.  The importance of a
bucket is the logarithm of its share among the target's n-grams over its share
among the source's; a row's weight sums the importance of its n-grams, and rows
are drawn by the largest weight plus Gumbel noise, seeded by their identifier.

The kernels work on blocks of text in Arrow.  ``ascii_lower`` and
``split_pattern_regex`` cut words, ``list_flatten`` and ``dictionary_encode``
number them.  The numbers, shifted by one and two places, name pairs and
triples; each distinct one gets its CRC-32 once, joined from the CRC of what it
extends and the CRC of its last word, without building its text.  Gains are
taken by bucket and summed per row.

A long text is cut between words into blocks of about ``BLOCK_BYTES``; a block
repeats the last two words of the one before, and an n-gram counts where its
last word is new.  So memory is bounded by a block and the longest word.

The only numbers that reach the driver are the two tables of ``BUCKETS`` counts.

Edge cases: a null or wordless text has no n-grams and weight 0; a null
identifier is drawn as empty text, after other identifiers of the same score; a
repeated row is drawn on its own; with an empty target, or none of its words, all
is defined by the added ones; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf, free_name
from tabloom.operators.prefix import global_rank, part_count
from tabloom.scratch import materialize

BUCKETS = 10_000
WORDS = 3
#: What stands between words, in lower-cased text.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = 42
SCALE = 1000
SHARE = 5
LEAST_WORDS = 20
#: Text that the kernels handle at once.
BLOCK_BYTES = 1 << 21
POLYNOMIAL = 0xEDB88320


@cache
def _zeros(power: int):
    """Tables (4 of 256) that carry a CRC over 2**power zero bytes, one for each of its bytes."""
    import numpy as np

    if power:
        half = _zeros(power - 1)
        return _over(half, half)
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(POLYNOMIAL), steps >> 1)
    values = np.arange(256, dtype=np.uint32)
    # One zero byte: the low byte passes through the step table, the others move down.
    return np.stack([steps, values, values << np.uint32(8), values << np.uint32(16)])


def _over(values, tables):
    """CRCs carried over the zero bytes of the tables."""
    import numpy as np

    low = np.uint32(255)
    return (
        tables[0][values & low]
        ^ tables[1][(values >> np.uint32(8)) & low]
        ^ tables[2][(values >> np.uint32(16)) & low]
        ^ tables[3][values >> np.uint32(24)]
    )


def joined_crc(first, second, lengths):
    """CRC-32 of joined byte strings from their CRCs and the lengths of the second ones."""
    values, power = first.copy(), 0
    while (lengths >> power).any():
        carried = ((lengths >> power) & 1).astype(bool)
        values[carried] = _over(values[carried], _zeros(power))
        power += 1
    return values ^ second


def _blocks(texts, separators, block_bytes: int):
    """Lists of (row, text, repeated words) of about ``block_bytes``; long texts are cut between words."""
    held, size = [], 0
    for row, text in enumerate(texts):
        before, repeated = "", 0
        while True:
            # Every piece has something new beside the repeated words.
            room = len(before) + max(block_bytes - size, block_bytes // 2, 1)
            found = separators.search(text, room) if len(text) > room else None
            piece = text[: found.start()] if found else text
            held.append((row, piece, repeated))
            size += len(piece)
            if size >= block_bytes:
                yield held
                held, size = [], 0
            if not found:
                break
            # The next piece begins with the last words of this one.
            words = [w for w in separators.split(piece[-_tail(piece, separators) :]) if w][-(WORDS - 1) :]
            before = " ".join(words)
            text, repeated = before + text[found.start() :], len(words)
    if held:
        yield held


def _tail(piece: str, separators) -> int:
    """Length of an end of the text that holds its last words whole."""
    length = 256
    while length < len(piece):
        if len([w for w in separators.split(piece[-length:]) if w]) > WORDS - 1:
            return length
        length *= 2
    return len(piece)


def _features(block: list[tuple[int, str, int]]):
    """Arrays for all n-grams of a block: their rows and buckets; and the row of every new word."""
    import zlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pa.array([text for _, text, _ in block], pa.string())
    lists = pc.split_pattern_regex(texts, pattern=SEPARATORS)
    words, parts = pc.list_flatten(lists), pc.list_parent_indices(lists)
    filled = pc.greater(pc.binary_length(words), 0)
    words, part = words.filter(filled), parts.filter(filled).to_numpy().astype(np.int64)
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = [w.encode() for w in coded.dictionary.to_pylist()]
    alone = np.array([zlib.crc32(w) for w in distinct], dtype=np.uint32)
    spaced = np.array([zlib.crc32(b" " + w) for w in distinct], dtype=np.uint32)
    lengths = np.array([len(w) + 1 for w in distinct], dtype=np.int64)

    # A word is new unless it stands among the first, repeated ones of its part.
    starts = np.searchsorted(part, np.arange(len(block)))
    place = np.arange(len(part)) - starts[part]
    new = place >= np.array([repeated for _, _, repeated in block], dtype=np.int64)[part]
    rows = np.array([row for row, _, _ in block], dtype=np.int64)[part]

    found_rows, found = [rows[new]], [(alone % BUCKETS)[index[new]]]
    crc, names = alone, index
    for width in range(2, WORDS + 1):
        # names[p] numbers the n-gram of width-1 words that ends at word p; where there is none it is not read.
        ends = np.flatnonzero(place >= width - 1)
        keys = names[ends - 1] * len(distinct) + index[ends]
        unique, inverse = np.unique(keys, return_inverse=True)
        crc = joined_crc(crc[unique // max(len(distinct), 1)], *(v[unique % max(len(distinct), 1)] for v in (spaced, lengths)))
        names = np.zeros(len(index), dtype=np.int64)
        names[ends] = inverse
        counted = new[ends]
        found_rows.append(rows[ends[counted]])
        found.append((crc % BUCKETS)[inverse[counted]])
    return np.concatenate(found_rows), np.concatenate(found).astype(np.int64), rows[new]


def _lowered(column) -> list[str]:
    import pyarrow.compute as pc

    return pc.ascii_lower(pc.fill_null(column, "")).to_pylist()


def bucket_counts(df: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``bucket, n``: n-grams of all rows; buckets without any are left out."""

    def count(batches):
        import re

        import numpy as np
        import pyarrow as pa

        separators, counts = re.compile(SEPARATORS), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for block in _blocks(_lowered(batch.column(0)), separators, block_bytes):
                counts += np.bincount(_features(block)[1], minlength=BUCKETS)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(counts[filled])], ["bucket", "n"])

    partial = df.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def _held(counts: DataFrame) -> list[int]:
    """At most BUCKETS numbers."""
    held = [0] * BUCKETS
    for bucket, n in counts.collect():
        held[bucket] = n
    return held


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln(target share / source share)) of every bucket, with one added to each count."""
    s_all, t_all = float(sum(source) + BUCKETS), float(sum(target) + BUCKETS)
    return [math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def weighed(df: DataFrame, gains: list[int], text: str = "text", block_bytes: int = BLOCK_BYTES) -> Column:
    """Struct of n_words, n_features and weight for a text column."""
    shared = df.sparkSession.sparkContext.broadcast(gains)

    def make():
        import re

        import numpy as np
        import pandas as pd
        import pyarrow as pa

        separators, gain = re.compile(SEPARATORS), np.array(shared.value, dtype=np.int64)

        def work(texts):
            sums = {name: np.zeros(len(texts), dtype=np.int64) for name in ("n_words", "n_features", "weight")}
            for block in _blocks(_lowered(pa.array(texts, pa.string())), separators, block_bytes):
                rows, buckets, words = _features(block)
                sums["n_words"] += np.bincount(words, minlength=len(texts))
                sums["n_features"] += np.bincount(rows, minlength=len(texts))
                order = np.argsort(rows, kind="stable")
                rows, taken = rows[order], gain.take(buckets[order])
                if len(rows):
                    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    sums["weight"][rows[first]] += np.add.reduceat(taken, first)
            return pd.DataFrame(sums)

        return work

    return column_udf(make, "n_words long, n_features long, weight long")(F.col(text).cast("string"))


def gumbel(identifier: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) for a u in (0, 1) that the seed and the identifier decide."""
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    df: DataFrame, target: DataFrame, identifier: str = "doc_id", text: str = "text", share: int = SHARE,
    least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per input row: the identifier, n_words, n_features, weight, score and rank.

    ``share`` per cent of the rows with at least ``least_words`` words are drawn:
    rank 1, 2, ... for these by falling score, then identifier; null for the rest.
    """
    gains = bucket_gains(_held(bucket_counts(df, text)), _held(bucket_counts(target, text)))
    found = free_name("found", [identifier])
    rows = df.select(F.col(identifier).alias("id"), weighed(df, gains, text).alias(found))
    scored = materialize(
        rows.select("id", f"{found}.*").withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "weights"
    )
    enough = F.col("n_words") >= least_words
    count = scored.where(enough).count()
    drawn = share * count // 100
    parts = max(part_count(count), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    ranked = global_rank(scored.where(enough), order, rank="rank", parts=parts)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    others = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select(
        F.col("id").alias(identifier), "n_words", "n_features", "weight", "score", "rank"
    )
