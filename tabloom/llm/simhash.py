"""SimHash near-duplicates, found by pigeonring filtering.

Fingerprints are 64 bits.  The bits are cut into ``segments`` parts that stand
on a ring.  If two fingerprints differ in at most d bits, some segment starts a
chain whose first k segments differ in at most floor(k*d/segments) bits, for
every k (the pigeonring principle).  As long as that is 0 the chain is equal, so
its first ceil(segments/d) - 1 segments are the join key: three of seven, 27
bits, for two differing bits.  Of n distinct random fingerprints about 4e-8 n^2
pairs meet there.  The longer chains are tested as the join's condition,
cheapest first, before the full distance.

Equal fingerprints are one class before any join, so copies form no pairs.

Edge cases: a null or empty text has no words and fingerprint zero, which links
like any other; a repeated row is one more member of its class; a null id keeps
its row and takes part as a member, but names no group (a group of null ids only
has a null component); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf, word_runs
from tabloom.llm.components import connected_components
from tabloom.operators.lookup import left_lookup
from tabloom.scratch import materialize

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2
SEGMENTS = 7
#: Shingles whose bits are summed at once.
BLOCK = 1 << 15


def _fingerprinter(width: int, seed: int):
    import numpy as np
    import pandas as pd
    from xxhash import xxh64_intdigest

    def bits_set(hashes: list[int]):
        packed = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        return np.unpackbits(packed, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)

    def fingerprint(text: str | None) -> int:
        counts, total, carried = np.zeros(BITS, dtype=np.int64), 0, []
        for words in word_runs(text):
            words = carried + words
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
            carried = words[len(words) - width + 1 :] if len(words) >= width else words
            total += len(last)
            for at in range(0, len(last), BLOCK):
                spans = zip(first[at : at + BLOCK], last[at : at + BLOCK])
                counts += bits_set([xxh64_intdigest(joined[i:j], seed) for i, j in spans])
        if not total and carried:
            counts, total = bits_set([xxh64_intdigest(b" ".join(carried), seed)]), 1
        packed = np.packbits(2 * counts > total, bitorder="little") if total else np.zeros(8, np.uint8)
        return int(packed.view("<i8")[0])

    return lambda texts: pd.Series([fingerprint(text) for text in texts], dtype="int64")


def simhash(text: Column, width: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprint as a signed long: a bit is set if more than half of the shingle hashes have it."""
    return column_udf(lambda: _fingerprinter(width, seed), "long")(F.coalesce(text, F.lit("")))


def _segment_bits(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    edges = [i * BITS // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_fingerprints(classes: DataFrame, column: str, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``left < right`` of distinct fingerprints within the distance; a pair may come more than once."""
    if segments <= distance:
        raise ValueError("pigeonring keys need more segments than differing bits")
    masks = [((1 << width) - 1) << first for first, width in _segment_bits(segments)]

    def chained(length: int) -> list[int]:
        return [sum(masks[(i + k) % segments] for k in range(length)) for i in range(segments)]

    equal = -(-segments // distance) - 1 if distance else segments
    value = F.col(column)
    keyed = classes.select(
        value.alias("fp"),
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("at"), value.bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(chained(equal))])
        ).alias("segment"),
    ).select("fp", F.col("segment.at").alias("at"), F.col("segment.bits").alias("bits"))
    left, right = keyed.alias("l"), keyed.alias("r")
    differing = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    condition = (F.col("l.at") == F.col("r.at")) & (F.col("l.bits") == F.col("r.bits")) & (F.col("l.fp") < F.col("r.fp"))
    for length in range(equal + 1, segments):
        chain = F.element_at(F.array(*[F.lit(_signed(m)) for m in chained(length)]), F.col("l.at") + 1)
        condition &= F.bit_count(differing.bitwiseAND(chain)) <= length * distance // segments
    condition &= F.bit_count(differing) <= distance
    return left.join(right, condition).select(F.col("l.fp").alias("left"), F.col("r.fp").alias("right"))


def near_duplicate_groups(
    df: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (hex) and ``component_id``, the smallest id reachable."""
    prints = materialize(
        df.select(F.col(identifier).alias("id"), simhash(F.col(text), width).alias("fp")), "simhash"
    )
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")), "classes")
    linked = connected_components(near_fingerprints(classes, "fp", distance, segments), "left", "right")
    grouped = classes.join(linked, classes.fp == linked.node, "left").select(
        "fp", "first", "n", F.coalesce("component", "fp").alias("component")
    )
    named = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    members = materialize(grouped.join(named, "component").select("fp", "n", "component_id"), "members")
    return left_lookup(prints, members, ["fp"], "n").select(
        F.col("id").alias(identifier),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
