"""Registered queries of the operators, over whole tables, and their SQL counterparts."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import ann, caps, chat, exact, importance, langid, merkle, mixing, pii, simhash, token_files
from tabloom.llm.bpe import ByteBpe
from tabloom.llm.common import fold_of, table
from tabloom.llm.lattice import SubwordLattice
from tabloom.scratch import materialize

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary file of the byte-level operators.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_projected_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = fold_of("doc_id", 5) == 1
    model = SubwordLattice.fit(documents, RANKS, ~held_out)
    return model.apply(documents, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op3_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    fold = fold_of("doc_id", 4)
    model = langid.fit(documents.where(fold != 2))
    found = documents.select(
        "doc_id", (fold == 2).alias("held_out"), langid.detect(spark, model, F.col("text")).alias("found")
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.langs", "found.shares")


def op4_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    sizes = mixing.source_sizes(documents)
    rates = mixing.repetition_rates(sizes, mixing.temperature_weights(sizes))
    return mixing.poisson_mix(documents, rates)


def op5_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.documents_token_counts(table(spark, folder, "documents")).select("doc_id", "n_tokens")


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    bpe = ByteBpe(spark, RANKS, public_tokenizers.PATTERN)
    coded = table(spark, folder, "documents").select("doc_id", bpe.digests(F.col("text")).alias("coded"))
    return coded.select("doc_id", "coded.n_tokens", "coded.ids_sha256", "coded.decoded_sha256")


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    words = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(words).alias("text"),
    )
    records = chat.canonical(chat.records_of_rows(given.unionByName(probe)), "record")
    output = materialize(chat.format_turns(records).select("conv_id", "layout", "formatted", "loss"), "formatted")
    back = output.select(
        "conv_id", "layout", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("taught"),
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(chat.turns_text(F.col("turns")), 256).alias("turns_sha256"),
        F.length("taught").cast("long").alias("loss_chars"),
        F.sha2("taught", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", "text", pii.base_spans(F.col("text")).alias("base"))
    spans = found.select("doc_id", "base", pii.all_spans(F.col("text"), F.col("base")).alias("spans"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id",
        *[count(kind.name) for kind in pii.BASE],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op9_spherical_caps(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_duplicate_vectors(table(spark, folder, "embeddings"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, folder, "documents"))


def manifest_rows(documents: DataFrame) -> DataFrame:
    """Every document's leaf, roots and proof, and the root that a tampered leaf leads to."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    others = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", 5) == 0),
        merkle.row_digest(*others, lowered),
    )
    leaf = merkle.row_digest(*others, F.col("text"))
    manifest = merkle.MerkleManifest.build(documents, leaf, "source", "doc_id", {"tampered": tampered})
    folded = manifest.proofs().withColumn("folded_root", merkle.fold(F.coalesce("tampered", "digest"), F.col("proof")))
    return folded.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(merkle.joined_proof(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op11_octopus_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_rows(table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_patricia_owners(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicate_owners(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_projected_neighbours": op1_projected_neighbours,
    "op2_subword_lattice": op2_subword_lattice,
    "op3_language_mixture": op3_language_mixture,
    "op4_poisson_mix": op4_poisson_mix,
    "op5_separator_scan": op5_separator_scan,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_chat_format": op7_chat_format,
    "op8_personal_data": op8_personal_data,
    "op9_spherical_caps": op9_spherical_caps,
    "op10_simhash": op10_simhash,
    "op11_octopus_manifest": op11_octopus_manifest,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_patricia_owners": op13_patricia_owners,
}

_MIX = f"""
WITH sizes AS (
  SELECT coalesce('s' || source, 'n') AS source_key, count(*)::DOUBLE AS n FROM documents GROUP BY 1
), rates AS (
  SELECT source_key, pow(n, {mixing.TEMPERATURE}) / sum(pow(n, {mixing.TEMPERATURE})) OVER () * sum(n) OVER () / n AS rate
  FROM sizes
), steps AS (
  SELECT source_key, sum(exp(-rate + k * ln(rate) - lgamma(k + 1.0))) OVER (PARTITION BY source_key ORDER BY k) AS below
  FROM (SELECT source_key, rate, unnest(range(ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates)
), drawn AS (
  SELECT d.doc_id, count(s.below) AS n
  FROM documents d LEFT JOIN steps s
    ON s.source_key = coalesce('s' || d.source, 'n')
    AND s.below <= ('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, {mixing.UNIFORM_DIGITS}))::BIGINT
      / {float(16**mixing.UNIFORM_DIGITS)}
  GROUP BY d.doc_id
), copies AS (
  SELECT doc_id, unnest(range(1, n + 1))::INTEGER AS copy FROM drawn
)
SELECT d.*, c.copy,
  ('0x' || substr(md5('{mixing.SEED}:' || c.doc_id::VARCHAR || ':' || c.copy::VARCHAR), 1, {mixing.ORDER_DIGITS}))::BIGINT
    AS shuffle_key
FROM copies c JOIN documents d ON d.doc_id = c.doc_id
"""

_WORDS = r"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents
"""

_CONTROL = r"[<\[]\\*(\||/?s>|/?INST\])"
_CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), grouped AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS taught,
    list(role ORDER BY turn, role, text) AS roles,
    sum({len(chat.TURN)} + length(role) + 1 + length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + {len(chat.END)})
      ::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(taught)::BIGINT AS loss_chars, sha256(taught) AS loss_sha256, formatted_chars,
  CASE WHEN roles IN (['user', 'assistant'], ['system', 'user', 'assistant']) THEN 'prompt_response' ELSE 'messages' END
    AS layout
FROM grouped
"""

# crc32 bit by bit, over the decimal digits of an id.
_CRC = """
xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(
    list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  )
), 4294967295)
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


_FIELDS = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
_LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
# Levels by recursion; leaves of the upper tree are the roots below.
_TREE = """
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, source, {fields} AS part, sha256({fields} || {text}) AS leaf,
    CASE WHEN {crc} % 5 = 0 AND text IS NOT NULL THEN sha256({fields} || {lowered}) END AS tampered
  FROM documents
), placed AS MATERIALIZED (
  SELECT doc_id, leaf, coalesce(tampered, leaf) AS start, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16
), kept AS MATERIALIZED (SELECT * FROM nodes
), subroots AS MATERIALIZED (SELECT tree, level, digest FROM kept WHERE n = 1
), upper AS (
  SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY level, pos // 16
), above AS MATERIALIZED (SELECT * FROM upper
), root AS (SELECT digest AS root FROM above WHERE n = 1
), steps AS MATERIALIZED (
  SELECT tree, level, pos, digest,
    coalesce(string_agg(digest, '') OVER (
      PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
    coalesce(string_agg(digest, '') OVER (
      PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
  FROM (
    SELECT tree, level, pos, digest FROM kept WHERE n > 1
    UNION ALL SELECT -1, level, pos, digest FROM above WHERE n > 1
  )
), ways AS (
  SELECT p.tree AS leaf_tree, p.pos AS leaf_pos, 0 AS hops, p.tree, 0 AS level, p.pos, p.start AS digest, '' AS proof FROM placed p
  UNION ALL
  SELECT w.leaf_tree, w.leaf_pos, w.hops + 1, coalesce(s.tree, -1), CASE WHEN s.tree IS NULL THEN 0 ELSE w.level + 1 END,
    CASE WHEN s.tree IS NULL THEN w.leaf_tree ELSE w.pos // 16 END,
    CASE WHEN s.tree IS NULL THEN w.digest ELSE sha256(s.lefts || w.digest || s.rights) END,
    w.proof || coalesce(s.lefts || s.rights, '')
  FROM ways w LEFT JOIN steps s ON s.tree = w.tree AND s.level = w.level AND s.pos = w.pos
  WHERE s.tree IS NOT NULL OR w.tree >= 0
), ends AS (
  SELECT leaf_tree, leaf_pos, arg_max(digest, hops) AS folded_root, arg_max(proof, hops) AS proof FROM ways GROUP BY ALL
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded_root,
  e.folded_root = r.root AS verified
FROM placed p JOIN ends e ON e.leaf_tree = p.tree AND e.leaf_pos = p.pos JOIN subroots s ON s.tree = p.tree CROSS JOIN root r
"""
_MANIFEST = _TREE.format(
    fields=_FIELDS, text=_field("text"), lowered=_field(_LOWERED), crc=_CRC.format(text="doc_id::VARCHAR")
)

_EXACT = r"""
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM given WINDOW best AS (PARTITION BY body ORDER BY length(text) DESC, doc_id)
"""

# crc32 byte by byte, for the distinct n-grams.
_GAINS = rf"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
    ORDER BY b) AS step
  FROM (SELECT unnest(range(256)) AS b)
), texts AS (
  SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), worded AS MATERIALIZED (
  SELECT side, row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
), features AS MATERIALIZED (
  SELECT side, row, unnest(list_concat(words,
    list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]),
    list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) AS feature
  FROM worded
), hashed AS MATERIALIZED (
  SELECT feature, xor(list_reduce(
    list_prepend(4294967295::BIGINT,
      list_transform(range(1, strlen(feature) + 1), lambda i: ('0x' || substr(hex(feature), 2 * i - 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) % {importance.BUCKETS} AS bucket
  FROM (SELECT DISTINCT feature FROM features) CROSS JOIN steps
), counted AS MATERIALIZED (
  SELECT bucket, count_if(side = 0)::DOUBLE AS s, count_if(side = 1)::DOUBLE AS t FROM features JOIN hashed USING (feature) GROUP BY 1
), gains AS (
  SELECT bucket, floor({importance.SCALE} * ln((t + 1) * (sum(s) OVER () + {importance.BUCKETS})
    / ((s + 1) * (sum(t) OVER () + {importance.BUCKETS}))))::BIGINT AS gain
  FROM counted
), weights AS (
  SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row
), scored AS (
  SELECT doc_id, len(words) >= {importance.LEAST_WORDS} AS enough, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-{importance.SCALE} * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded LEFT JOIN weights USING (row) WHERE side = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY enough) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= {importance.SHARE} * n // 100 THEN place END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op12_importance_resampling": _GAINS,
    "op11_octopus_manifest": _MANIFEST,
    "op13_patricia_owners": _EXACT,
    "op4_poisson_mix": _MIX,
    "op5_separator_scan": _WORDS,
    "op7_chat_format": _CHAT,
}
