"""From raw documents to token ids, in five stages over all documents.

1. Language: documents whose language cannot be told are dropped (no letters,
   or the known languages together hold less than ``MIN_SHARE`` of the trigrams).
2. Near-duplicates: documents whose SimHash fingerprints over three words differ
   in at most two bits are linked; of each linked group the one with the smallest
   id stays.
3. Personal data: spans are replaced by their kind in brackets.
4. Mixing: documents are repeated or left out so that sources reach their target
   weights, and shuffled.
5. Tokens: every copy is encoded; its ids, and a check that they decode to the
   text, are the result.

Every stage but the last returns the columns of the documents.  A stage is
written as Parquet in the shared folder before the next one reads it, so a lost
executor never costs more than one stage's tasks.

Edge cases: rows that share an id, or have none, are rows of their own for stage
2 (a missing id comes last, and equal ids are ordered by a digest of the row), and
of rows that agree in all columns one stays; null texts are dropped by stage 1;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import langid, mixing, pii, simhash
from tabloom.llm.bpe import ByteBpe
from tabloom.llm.common import free_name
from tabloom.operators.lookup import left_lookup
from tabloom.scratch import materialize

#: Smallest share of all known languages together for a document to stay.
MIN_SHARE = 0.5
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language."""
    model = langid.fit(docs)
    name = free_name("found", docs.columns)
    found = docs.withColumn(name, langid.detect(spark, model, F.col("text")))
    together = F.aggregate(F.col(name)["shares"], F.lit(0.0), lambda total, share: total + share)
    known = (F.col(name)["lang_pred"] != langid.UNKNOWN) & (together >= MIN_SHARE)
    return found.where(known).select(*docs.columns)


def _identity(docs: DataFrame, taken: list[str]) -> list[Column]:
    """Whether the id is missing, the id, and two digests of all columns: equal for repeated rows only."""
    every = [F.col(name) for name in taken]
    return [F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.xxhash64(*every), F.xxhash64(F.lit(1), *every)]


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    key, n, stays = (free_name(name, docs.columns) for name in ("identity", "n", "stays"))
    keyed = docs.withColumn(key, F.struct(*_identity(docs, docs.columns)))
    # A group is named by its smallest identity, so its first id stays; rows may share an id, or have none.
    groups = simhash.near_duplicate_groups(keyed, key)
    rows = groups.groupBy(key).agg(F.count("*").alias(n), F.min("component_id").alias("component_id"))
    special = materialize(
        rows.select(key, n, (F.col(key) == F.col("component_id")).alias(stays)).where(~F.col(stays) | (F.col(n) > 1)), "leaving"
    )
    marked = left_lookup(keyed, special.select(key, stays, n), [key], n)
    kept = marked.where(F.col(stays).isNull()).select(*docs.columns)
    if special.where(stays).isEmpty():
        return kept
    # Repeated rows of which one stays: only these are sent by their identity.
    repeated = marked.where(F.col(stays)).dropDuplicates([key]).select(*docs.columns)
    return kept.unionByName(repeated)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    base, spans = free_name("base", docs.columns), free_name("spans", docs.columns)
    found = docs.withColumn(base, pii.base_spans(F.col("text")))
    found = found.withColumn(spans, pii.all_spans(F.col("text"), F.col(base)))
    clean = found.withColumn("text", pii.redact(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents in random order, sources at their target weights."""
    sizes = mixing.source_sizes(docs)
    rates = mixing.repetition_rates(sizes, mixing.temperature_weights(sizes))
    return mixing.poisson_mix(docs, rates).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    bpe = ByteBpe(spark, RANKS, public_tokenizers.PATTERN)
    whole = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    coded = docs.select("doc_id", "lang", "source", whole.alias("whole"), bpe.encoded(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id", "lang", "source", "coded.n_tokens", "coded.ids", "coded.ids_sha256",
        (F.col("coded.decoded_sha256") == F.col("whole")).alias("decodes"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", without_near_copies),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("tokens", token_ids),
]

#: Language mixtures, fingerprints and merges cannot be written in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
