"""Languages of a text as a mixture, estimated by expectation-maximisation.

Each language is a distribution over hashed trigrams of lower-cased letters.  A
text is a draw from a mixture of languages, plus a flat background that takes
what no language explains.  Expectation-maximisation estimates the shares of
all languages; languages then leave the set, smallest share first, as long as
the penalised likelihood rises (each language costs half the log of the number
of trigrams, as in the Bayesian information criterion).  The predicted language
has the largest share and its share is the score.

The model is learned from a bounded sample of labelled rows: ``SAMPLE`` rows of
each language are expected, chosen by a hash of the id; a language with fewer
rows gives all of them.  Every text is predicted from its whole text.

Edge cases: a null text, or one without letters, is ``und`` with score 0, and any
other text gets a learned language (letters are those of Unicode, in all
planes); very long texts are counted in blocks; rows with a null label teach nothing; without
any labelled row every text is ``und``; repeated rows are predicted alike; ties
go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf

#: Expected rows of each language that the model is learned from.
SAMPLE = 4_000
#: Hashed trigrams that are told apart.
BUCKETS = 1 << 15
#: Languages beyond this number (fewest rows first) are refused, which bounds the model's size.
MAX_LANGUAGES = 256
SMOOTHING = 0.5
ROUNDS = 8
#: Smallest share that a language needs after the first rounds to stay a candidate.
SMALL_SHARE = 0.01
UNKNOWN = "und"
#: Characters that are counted at once.
BLOCK = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    """Probabilities of trigram buckets: one row per language, then the background."""

    languages: tuple[str, ...]
    probabilities: object


def _bucket_counter():
    """A function from a text to its trigram counts per bucket, and the number of letters."""
    import sys

    import numpy as np

    letters = np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)
    native = "utf-32-le" if sys.byteorder == "little" else "utf-32-be"

    def count(text: str | None):
        counts, seen, carried = np.zeros(BUCKETS, dtype=np.int64), 0, np.zeros(1, dtype=np.uint64)
        text = text or ""
        for at in range(0, len(text), BLOCK):
            codes = np.frombuffer(text[at : at + BLOCK].lower().encode(native, "replace"), dtype=np.uint32)
            is_letter = letters[np.minimum(codes, 0xFFFF)]
            high = codes > 0xFFFF
            if high.any():
                which, place = np.unique(codes[high], return_inverse=True)
                is_letter[high] = np.array([chr(c).isalpha() for c in which.tolist()])[place]
            seen += int(is_letter.sum())
            codes = np.where(is_letter, codes, 0).astype(np.uint64)
            # A blank follows the last letter, so one letter is a trigram.
            last = [0] if at + BLOCK >= len(text) else []
            codes = np.concatenate([carried, codes, np.array(last, dtype=np.uint64)])
            # Runs of other characters are one blank.
            codes = codes[np.concatenate([[True], (codes[1:] | codes[:-1]) != 0])]
            if len(codes) > 2:
                mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
                mixed += codes[2:] * np.uint64(0x165667B19E3779F9)
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                counts += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
            carried = codes[-2:]
        return counts, seen

    return count


def _sampled(labelled: DataFrame, identifier: str, language: str) -> tuple[DataFrame, list[str]]:
    """About SAMPLE rows of each language, by a hash of the id; the languages learned."""
    sizes = labelled.where(F.col(language).isNotNull()).groupBy(language).agg(F.count("*").alias("n"))
    rows = sizes.orderBy(F.desc("n"), language).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not rows:
        return labelled.limit(0), []
    rates = F.create_map(*[x for row in rows for x in (F.lit(row[0]), F.lit(SAMPLE / row["n"]))])
    draw = F.pmod(F.xxhash64(F.col(identifier).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(draw < F.element_at(rates, F.col(language))), sorted(row[0] for row in rows)


def fit(labelled: DataFrame, identifier: str = "doc_id", text: str = "text", language: str = "lang") -> LanguageModel:
    """Learn from the labelled rows given (leave held-out rows out before)."""
    import numpy as np

    sample, languages = _sampled(labelled, identifier, language)

    def counts(batches):
        import pyarrow as pa

        count, totals = _bucket_counter(), {}
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = count(value)[0]
                totals[lang] = totals[lang] + found if lang in totals else found
        for lang, found in totals.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(found[used], pa.int64())],
                ["lang", "bucket", "n"],
            )

    table = np.full((len(languages) + 1, BUCKETS), SMOOTHING)
    if languages:
        counted = sample.select(F.col(language).alias("lang"), F.col(text).alias("text")).mapInArrow(
            counts, "lang string, bucket int, n long"
        )
        # At most one row per language and bucket, both bounded.
        summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        rows = summed["lang"].map({name: i for i, name in enumerate(languages)})
        table[rows.to_numpy(dtype=int), summed["bucket"].to_numpy(dtype=int)] += summed["n"].to_numpy(dtype=float)
    # The background knows no trigram better than another.
    return LanguageModel(tuple(languages), table / table.sum(axis=1, keepdims=True))


def shares(probabilities, counts, rounds: int):
    """Shares of the given rows (languages) by expectation-maximisation, and the log likelihood.

    ``probabilities`` has one row per trigram bucket that occurs, one column per
    language; ``counts`` how often the bucket occurs.
    """
    import numpy as np

    total = counts.sum()
    share = np.full(probabilities.shape[1], 1.0 / probabilities.shape[1])
    for _ in range(rounds):
        share = share * (probabilities.T @ (counts / (probabilities @ share))) / total
    return share, float(counts @ np.log(probabilities @ share))


def mixture(probabilities, counts):
    """The chosen columns and their shares: columns leave while the penalised likelihood rises."""
    import numpy as np

    penalty = 0.5 * np.log(counts.sum())
    share, _ = shares(probabilities, counts, ROUNDS)
    chosen = np.flatnonzero(share >= min(SMALL_SHARE, share.max()))
    share, likelihood = shares(probabilities[:, chosen], counts, ROUNDS)
    while len(chosen) > 1:
        fewer = np.delete(chosen, int(np.argmin(share)))
        share_fewer, likelihood_fewer = shares(probabilities[:, fewer], counts, ROUNDS if len(fewer) > 1 else 0)
        if likelihood_fewer + penalty < likelihood:
            break
        chosen, share, likelihood = fewer, share_fewer, likelihood_fewer
    return chosen, share


def detect(spark, model: LanguageModel, text: Column) -> Column:
    """``lang_pred`` and ``score``, with all languages found, largest share first, in ``langs`` and ``shares``."""
    # The model's size is bounded by MAX_LANGUAGES * BUCKETS.
    shared = spark.sparkContext.broadcast((model.languages, model.probabilities))
    def make():
        import numpy as np
        import pandas as pd

        (languages, probabilities), count = shared.value, _bucket_counter()
        by_bucket = np.ascontiguousarray(probabilities.T)

        def one(value):
            counts, letters = count(value)
            used = np.flatnonzero(counts)
            if not languages or not letters or not len(used):
                return UNKNOWN, 0.0, [], []
            chosen, share = mixture(by_bucket[used], counts[used].astype(float))
            known = [(s, languages[c]) for c, s in zip(chosen, share) if c < len(languages)]
            if not known:
                # Only the background is left: name the likeliest language, with no share of its own.
                likely = counts[used] @ np.log(by_bucket[used][:, : len(languages)])
                return languages[int(np.argmax(likely))], 0.0, [], []
            known.sort(key=lambda x: (-x[0], x[1]))
            best = min(1.0, max(0.0, float(known[0][0])))
            return known[0][1], best, [x[1] for x in known], [float(x[0]) for x in known]

        names = ["lang_pred", "score", "langs", "shares"]
        return lambda texts: pd.DataFrame([one(value) for value in texts], columns=names)

    schema = "lang_pred string, score double, langs array<string>, shares array<double>"
    return column_udf(make, schema)(F.coalesce(text, F.lit("")))
