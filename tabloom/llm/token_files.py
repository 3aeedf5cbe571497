"""Token counts of the documents in flat token files that have no index.

A flat file is a run of fixed-width token ids in which an end-of-document id
follows each document.  Each file is searched block by block with vector
comparisons; a block gives its number of tokens and the places of its
separators.  A prefix scan over the blocks of a stream then turns places into
positions of the stream, and hands the last separator of earlier blocks to the
first document of each block, so documents may cross any number of blocks, and
of files if a stream has several.

Files come through Spark's binary source, one row per file, so a file may have
up to 2 GB and should have at most a few hundred MB.  The scan sees one row per
block, never tokens.

``write_token_files`` writes such files with Spark's text sink, whose row
separator is the end-of-document id.

Edge cases: an empty file or folder of them has no documents; two separators in
a row enclose an empty document; tokens after the last separator are an
unfinished document (``complete`` is false); bytes after the last whole token
are no token.  For the writer a null or empty text is an empty document, and a
null id, ties and repeated rows are documents like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf, word_runs
from tabloom.scratch import materialize, scratch_path

#: Tokens that are compared at once.
BLOCK_TOKENS = 1 << 20
WIDTH, END_OF_DOCUMENT = 2, 0
#: Documents that share a file, on average.
FILE_DOCUMENTS = 4096
FORMATS = {1: "u1", 2: "<u2", 4: "<u4", 8: "<u8"}


def word_tokens(text: Column) -> Column:
    """Little-endian 16-bit ids of the words of a text; the ids are hashes, and 0 is none of them."""

    def make():
        from zlib import crc32

        import numpy as np
        import pandas as pd

        def ids(value):
            found = [np.fromiter(map(crc32, words), np.uint32, len(words)) for words in word_runs(value)]
            return (np.concatenate(found) % 0xFFFF + 1).astype(FORMATS[WIDTH]).tobytes()

        return lambda texts: pd.Series([ids(value) for value in texts], dtype=object)

    return column_udf(make, "binary")(F.coalesce(text, F.lit("")))


def write_token_files(tokens: DataFrame, path: str, shard: str, order: list[str], data: str, width: int, end: int) -> None:
    """One flat file per shard, documents in the given order, each followed by the end id."""
    separator = end.to_bytes(width, "little").decode("latin-1")
    rows = tokens.repartition(shard).sortWithinPartitions(shard, *order)
    rows.select(shard, F.col(data).cast("string").alias("value")).write.partitionBy(shard).options(
        lineSep=separator, encoding="ISO-8859-1"
    ).text(path)


def scan_blocks(files: DataFrame, stream: Column, width: int, end: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block: its tokens, and the places of separators counted from the block's start."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for name, path, content in zip(*[batch.column(i) for i in range(3)]):
                data = np.frombuffer(content.as_buffer(), dtype=np.uint8)
                ids = data[: len(data) // width * width].view(FORMATS[width])
                rows = []
                for number, at in enumerate(range(0, len(ids), block_tokens)):
                    block = ids[at : at + block_tokens]
                    rows.append((name.as_py(), path.as_py(), number, len(block), np.flatnonzero(block == end)))
                if rows:
                    names, paths, numbers, sizes, ends = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, pa.string()), pa.array(paths, pa.string()), pa.array(numbers, pa.int32()),
                            pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64())),
                        ],
                        ["stream", "path", "block", "n_tokens", "ends"],
                    )

    if width not in FORMATS:
        raise ValueError(f"tokens of {width} bytes")
    schema = "stream string, path string, block int, n_tokens long, ends array<long>"
    return files.select(stream.cast("string").alias("stream"), "path", "content").mapInArrow(run, schema)


def stitch(blocks: DataFrame) -> DataFrame:
    """``stream, ordinal, start, n_tokens, complete`` of every document, from the blocks of each stream."""
    key = ["stream", "path", "block"]
    whole = Window.partitionBy("stream").orderBy("path", "block")
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    counted = blocks.select(
        *key, "n_tokens", F.size("ends").cast("long").alias("n_ends"), F.get("ends", F.size("ends") - 1).alias("last")
    )
    placed = counted.select(
        *key, "n_tokens",
        F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("offset"),
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("before"),
        "n_ends", "last",
    ).withColumn("last", F.col("offset") + F.col("last"))
    scanned = placed.withColumn("previous", F.coalesce(F.max("last").over(earlier), F.lit(-1)))
    documents = (
        blocks.where(F.size("ends") > 0)
        .join(scanned.select(*key, "offset", "before", "previous"), key)
        .select("stream", "offset", "before", "previous", "ends", F.posexplode("ends").alias("at", "end"))
    )
    start = F.when(F.col("at") == 0, F.col("previous") + 1).otherwise(
        F.col("offset") + F.get("ends", F.greatest(F.col("at") - 1, F.lit(0))) + 1
    )
    finished = documents.select(
        "stream", (F.col("before") + F.col("at")).alias("ordinal"), start.alias("start"),
        (F.col("offset") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("complete"),
    )
    rest = scanned.groupBy("stream").agg(
        F.sum("n_ends").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"),
        F.max(F.col("offset") + F.col("n_tokens")).alias("total"),
    )
    unfinished = rest.where("total > start").select(
        "stream", "ordinal", "start", (F.col("total") - F.col("start")).alias("n_tokens"), F.lit(False).alias("complete")
    )
    return finished.unionByName(unfinished)


def token_counts(
    spark: SparkSession,
    path: str,
    width: int = WIDTH,
    end: int = END_OF_DOCUMENT,
    stream: Column | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Documents of all files below ``path``; each file is a stream unless ``stream`` makes another key of ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    blocks = scan_blocks(files, F.col("path") if stream is None else stream, width, end, block_tokens)
    return stitch(materialize(blocks, "blocks"))


def documents_token_counts(documents: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """``identifier, n_tokens``: write the documents' words as flat files, then count from the files alone.

    The files have no ids.  A document's file and place follow from its id and a
    hash of its text, by which ids are joined to the counts found.
    """
    spark = documents.sparkSession
    shards = max(1, -(-documents.count() // FILE_DOCUMENTS))
    known = F.coalesce(F.col(text), F.lit(""))
    keyed = documents.select(F.col(identifier).alias("id"), F.xxhash64(known).alias("hash"), known.alias("text")).withColumn(
        "shard", F.pmod(F.xxhash64("id", "hash"), F.lit(shards)).cast("int")
    )
    path = scratch_path(spark, "tokens")
    tokens = keyed.select("shard", "id", "hash", word_tokens(F.col("text")).alias("data"))
    write_token_files(tokens, path, "shard", ["id", "hash"], "data", WIDTH, END_OF_DOCUMENT)
    counts = token_counts(spark, path, stream=F.regexp_extract("path", "/shard=([0-9]+)/", 1))
    order = Window.partitionBy("shard").orderBy("id", "hash")
    places = keyed.select("id", "shard", (F.row_number().over(order) - 1).cast("long").alias("ordinal"))
    joined = places.join(
        counts.select(F.col("stream").cast("int").alias("shard"), "ordinal", "start", "n_tokens"), ["shard", "ordinal"], "left"
    )
    return joined.select(F.col("id").alias(identifier), "n_tokens", "shard", "ordinal", "start")
