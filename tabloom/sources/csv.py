"""Strict CSV input and file manifests."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tabloom.contracts import ContractError, TableContract
from tabloom.operators.digest import digests

IN_MEMORY_BYTES = 256 * 1024 * 1024
CHUNK_BYTES = 1024 * 1024


def read_raw(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """All-text table; a wrong header, a jagged row or a quoted newline fails.

    Column pruning stays off: a pruned scan does not see jagged rows.
    """
    return (
        spark.read.schema(contract.raw_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", False)
        .option("columnPruning", False)
        .csv(path)
    )


def file_manifest(spark: SparkSession, path: str, in_memory_bytes: int = IN_MEMORY_BYTES) -> DataFrame:
    """Path, size and SHA-256 of each file below ``path``.

    Small files are hashed from their content column.  Larger ones are streamed
    in chunks by the task that owns them, so no file has to fit in memory.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    small = files.where(F.col("length") <= in_memory_bytes).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )
    is_large = F.col("length") > in_memory_bytes
    # Lengths come from the listing; Python workers start for large files only.
    if files.select("length").where(is_large).isEmpty():
        return small
    large = (
        files.where(is_large)
        .select("path", F.col("length").alias("size_bytes"))
        .mapInPandas(_stream_digests, "path string, size_bytes bigint, sha256 string")
    )
    return small.unionByName(large)


def _stream_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch["path"]:
            system, name = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
            digest = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def folder_digest(files: DataFrame, root: str) -> DataFrame:
    """One digest of a folder: relative paths and content, in any order.

    Each file is a key of a hash tree, so any number of files merges without a
    sorted list in one task.  A root that is a file counts by its name, so where
    it lies does not matter.
    """
    below = F.regexp_replace("path", "^.*" + _quote(root.rstrip("/")) + "(/|$)", "")
    relative = F.when(below == "", F.substring_index("path", "/", -1)).otherwise(below)
    entry = F.concat_ws("\u0000", relative, F.col("sha256"))
    found = digests(files, entry, sums={"size_bytes": F.col("size_bytes")})
    return found.select(F.col("rows").alias("files"), "size_bytes", "digest")


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"


@dataclass(frozen=True)
class CsvManifest:
    """What a verified CSV source looks like."""

    source: str
    digest: str
    size_bytes: int
    row_count: int
    columns: tuple[str, ...]
    #: SHA-256 of the source if it is one file.
    sha256: str | None = None

    def metadata(self) -> dict[str, str]:
        """The manifest as flat text, columns as a JSON list."""
        plain = asdict(self)
        del plain["sha256"]
        plain["columns"] = json.dumps(list(self.columns), separators=(",", ":"))
        return {key: str(value) for key, value in plain.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """The flat metadata as (key, value) rows."""
        return spark.createDataFrame(sorted(self.metadata().items()), "key string, value string")


def csv_manifest(spark: SparkSession, path: str, contract: TableContract) -> CsvManifest:
    """Read the whole source strictly and describe it."""
    raw = read_raw(spark, path, contract)
    rows = raw.count()
    hashed = file_manifest(spark, path)
    files = folder_digest(hashed, path).first()
    if not files["files"]:
        raise ContractError(f"{path} is empty")
    sha256 = hashed.first()["sha256"] if files["files"] == 1 else None
    return CsvManifest(path, files["digest"], files["size_bytes"], rows, tuple(raw.columns), sha256)


def verify_csv(
    spark: SparkSession,
    path: str,
    contract: TableContract,
    expected_rows: int | None = None,
    expected_bytes: int | None = None,
    expected_digest: str | None = None,
    expected_sha256: str | None = None,
) -> CsvManifest:
    """Manifest of a CSV source that must match the pinned numbers."""
    manifest = csv_manifest(spark, path, contract)
    for name, expected, actual in (
        ("rows", expected_rows, manifest.row_count),
        ("bytes", expected_bytes, manifest.size_bytes),
        ("digest", expected_digest, manifest.digest),
        ("file SHA-256", expected_sha256, manifest.sha256),
    ):
        if expected is not None and expected != actual:
            raise ContractError(f"expected {expected} {name}, found {actual}")
    return manifest


def load_raw(
    spark: SparkSession, path: str, contract: TableContract, target: str, expected_rows: int | None = None
) -> DataFrame:
    """Replace the raw table at ``target`` with the strictly read source."""
    read_raw(spark, path, contract).write.mode("overwrite").parquet(target)
    table = spark.read.schema(contract.raw_schema).parquet(target)
    if expected_rows is not None and table.count() != expected_rows:
        raise ContractError(f"expected {expected_rows} raw rows, loaded {table.count()}")
    return table


PUBLISHED = "digest string, folder string, row_count bigint, content string"


def _content(df: DataFrame) -> tuple[int, str]:
    """Rows, and a fingerprint of the rows in any order."""
    row = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string")).first()
    return row[0], row[1] or "0"


def _published(spark: SparkSession, store: str, digest: str) -> Row | None:
    """The copy of a content that everybody uses: of several, the first by name."""
    try:
        copies = spark.read.schema(PUBLISHED).parquet(f"{store}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return copies.where(F.col("digest") == digest).orderBy("folder").first()


def acquire(
    spark: SparkSession, path: str, contract: TableContract, store: str, expected: dict[str, str] | None = None
) -> tuple[str, bool]:
    """Keep one immutable, verified raw copy per content; returns (folder, reused).

    A copy is written to a folder of its own, compared with its source row for
    row by a fingerprint, and only then published in an append-only list.  A run
    that dies before publishes nothing; two runs at once publish two equal
    copies, and all runs from then on use the same one.
    """
    store = store.rstrip("/")
    manifest = csv_manifest(spark, path, contract)
    if expected is not None:
        found = manifest.metadata() | {"sha256": manifest.sha256}
        broken = sorted(key for key, value in expected.items() if found.get(key) != value)
        if broken:
            raise ContractError("source conflicts with its pinned contract: " + ", ".join(broken))
    known = _published(spark, store, manifest.digest)
    reused = known is not None
    if not reused:
        folder = f"{store}/{manifest.digest}/copy-{uuid.uuid4().hex}"
        raw = read_raw(spark, path, contract)
        raw.write.mode("errorifexists").parquet(folder)
        content = _content(raw)
        row = (manifest.digest, folder, *content)
        if _content(spark.read.schema(contract.raw_schema).parquet(folder)) != content:
            raise ContractError(f"the copy {folder} differs from its source")
        spark.createDataFrame([row], PUBLISHED).write.mode("append").parquet(f"{store}/published")
        known = _published(spark, store, manifest.digest)
    stored = spark.read.parquet(known["folder"])
    if stored.columns != contract.raw_columns or _content(stored) != (known["row_count"], known["content"]):
        raise ContractError(f"stored raw copy {known['folder']} conflicts with its manifest")
    return known["folder"], reused
