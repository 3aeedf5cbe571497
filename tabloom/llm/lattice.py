"""Probability of a text under a unigram model over subwords and learned words.

Subwords come from an existing vocabulary; their scores follow the vocabulary's
order (a piece of rank r weighs 1/(r + RANK_OFFSET)), with pieces that open a
word and pieces that go on normalised apart.  A word is one opening piece, any
number of further pieces, and a stop; its subword probability G sums over all
segmentations, by a forward recursion in log space over the word's lattice.
No piece crosses a border between words, so the lattice of a text falls apart
into the lattices of its words.

Corpus counts add one edge per learned word.  With c the count of a token, N
all training tokens and V the distinct ones, a token has the probability
(c + V G) / (N + V): the learned edge with weight N / (N + V) plus all subword
paths with weight V / (N + V).  Each text ends with an end token, whose G is
END; G of a word is scaled by 1 - END.

Counts of all words are aggregated in Spark.  The most frequent words, a fixed
number, go to every worker; the other words of each text are joined with the
table of counts by shuffle.  Rare words cannot be skewed: each has fewer
occurrences than any of the frequent ones.

Edge cases: a null or empty text is its end token alone; a text is scored as a
whole, however long; repeated rows each teach and are each scored; a null id
keeps its row; without training rows N and V are 0 and only subwords count.
"""

from __future__ import annotations

import base64
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf, word_runs, worker_cache
from tabloom.scratch import materialize

RANK_OFFSET = 256
#: Probability that a word stops after a piece.
STOP = 0.25
#: Subword probability of the end token.
END = 1e-3
#: Words that every worker keeps; about 10 MB.
FREQUENT = 1 << 17
#: Distinct words that a counting task keeps before it hands them on.
HELD_WORDS = 1 << 17
#: Longer words are scored one by one.
LONG_WORD = 64
BLANK = b" "


class Lattice:
    """Log probabilities of words over all segmentations into pieces of a rank file."""

    def __init__(self, rank_file: bytes):
        import numpy as np

        opening, going = {}, {}
        for line in rank_file.splitlines():
            if not line:
                continue
            token, rank = line.split()
            piece = base64.b64decode(token)
            body = piece[1:] if piece[:1] == BLANK else piece
            # Words are lower-cased and hold no white space.
            if body != body.lower() or body.split() != ([body] if body else []):
                continue
            (opening if piece[:1] == BLANK else going)[piece] = 1.0 / (int(rank) + RANK_OFFSET)
        if BLANK not in opening:
            raise ValueError("the vocabulary lacks the blank")
        first, later = sum(opening.values()), sum(going.values())
        self.log = {p: math.log(w / first) for p, w in opening.items()}
        self.log.update({p: math.log((1 - STOP) * w / later) for p, w in going.items()})
        self.stop = math.log(STOP)
        self.longest = max(map(len, self.log))
        self._hash_table(np)

    def _hash_table(self, np) -> None:
        """Pieces in an open table over their polynomial hashes."""
        self.factor = np.uint64(0x9E3779B97F4A7C15)
        whole = [pow(int(self.factor), i, 1 << 64) for i in range(self.longest + 1)]
        self.powers = np.array(whole, dtype=np.uint64)
        self.bits = 20
        size = 1 << self.bits
        self.keys, self.values = np.zeros(size, dtype=np.uint64), np.full(size, -np.inf)
        self.probes = 1
        mask = (1 << 64) - 1
        for piece, value in self.log.items():
            key = 0
            for byte in piece:
                key = (key * int(self.factor) + byte + 1) & mask
            slot, probes = self._slot(key), 1
            while self.keys[slot]:
                slot, probes = (slot + 1) % size, probes + 1
            self.keys[slot], self.values[slot] = key, value
            self.probes = max(self.probes, probes)

    def _slot(self, key: int) -> int:
        return ((key * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1)) >> (64 - self.bits)

    def _look_up(self, np, keys):
        """Log probabilities of hashed pieces, minus infinity for no piece."""
        slots = ((keys * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.where(self.keys[slots] == keys, self.values[slots], -np.inf)
        for step in range(1, self.probes):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            found = np.where(self.keys[slots] == keys, self.values[slots], found)
        return found

    def _equal_length(self, np, words: list[bytes], length: int):
        """Log probabilities of words of one length, column by column of their lattices."""
        letters = np.frombuffer(b"".join(BLANK + w for w in words), dtype=np.uint8).reshape(len(words), length + 1)
        width = length + 1
        prefix = np.zeros((width + 1, len(words)), dtype=np.uint64)
        for j in range(width):
            prefix[j + 1] = prefix[j] * self.factor + letters[:, j].astype(np.uint64) + np.uint64(1)
        forward = np.full((width + 1, len(words)), -np.inf)
        forward[0] = 0.0
        scores = {
            size: self._look_up(np, prefix[size:] - prefix[: width + 1 - size] * self.powers[size])
            for size in range(1, min(width, self.longest) + 1)
        }
        for j in range(1, width + 1):
            for size in range(1, min(j, self.longest) + 1):
                np.logaddexp(forward[j], forward[j - size] + scores[size][j - size], out=forward[j])
        return forward[width] + self.stop

    def long_word(self, word: bytes) -> float:
        """The same recursion for one word of any length."""
        text = BLANK + word
        forward = [0.0] + [-math.inf] * len(text)
        for j in range(1, len(text) + 1):
            terms = [
                forward[i] + score
                for i in range(max(0, j - self.longest), j)
                if (score := self.log.get(text[i:j])) is not None and forward[i] > -math.inf
            ]
            if terms:
                most = max(terms)
                forward[j] = most + math.log(sum(math.exp(t - most) for t in terms))
        return forward[-1] + self.stop

    def log10(self, words: list[bytes]):
        """log10 of the subword probability of each word."""
        import numpy as np

        result = np.empty(len(words))
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            if length > LONG_WORD:
                result[places] = [self.long_word(words[i]) for i in places]
            else:
                result[places] = self._equal_length(np, [words[i] for i in places], length)
        return result / math.log(10.0)


def worker_lattice(rank_file) -> Lattice:
    import hashlib

    key = hashlib.sha256(rank_file.value).hexdigest()
    return worker_cache(f"lattice_{key}", lambda: Lattice(rank_file.value))


def subword_log10(spark: SparkSession, rank_path: str, word: Column) -> Column:
    """log10 probability of a binary word over all its segmentations."""
    with open(rank_path, "rb") as file:
        # A vocabulary file has a fixed size, here below a megabyte.
        rank_file = spark.sparkContext.broadcast(file.read())

    def make():
        import pandas as pd

        lattice = worker_lattice(rank_file)
        return lambda words: pd.Series(lattice.log10([bytes(w) for w in words]))

    return column_udf(make, "double")(word)


def word_counts(df: DataFrame, text: str, taught: Column) -> DataFrame:
    """``word, c`` for all words of all texts; c counts the rows where ``taught`` holds, and may be 0."""

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        def rows(held):
            words = list(held)
            for at in range(0, len(words), 1 << 16):
                part = words[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], ["word", "c"]
                )

        held: Counter = Counter()
        for batch in batches:
            for value, taught_row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for words in word_runs(value):
                    if taught_row:
                        held.update(words)
                    else:
                        for word in words:
                            if word not in held:
                                held[word] = 0
                if len(held) > HELD_WORDS:
                    yield from rows(held)
                    held = Counter()
        yield from rows(held)

    partial = df.select(F.col(text).alias("text"), taught.alias("taught")).mapInArrow(count, "word binary, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


class SubwordLattice:
    """The fitted model: a table of words with counts and subword scores, and the totals."""

    def __init__(self, spark: SparkSession, words: DataFrame, train_rows: int):
        self.spark, self.words = spark, words
        total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
        self.train_rows = train_rows
        self.tokens = total + train_rows
        self.distinct = distinct + (1 if train_rows else 0)

    @classmethod
    def fit(cls, df: DataFrame, rank_path: str, taught: Column, text: str = "text") -> SubwordLattice:
        """Count the words of the rows where ``taught`` holds; score all words of all rows."""
        spark = df.sparkSession
        scored = word_counts(df, text, taught).withColumn("g", subword_log10(spark, rank_path, F.col("word")))
        train_rows = df.where(taught).count()
        return cls(spark, materialize(scored, "words"), train_rows)

    def base(self, c: Column) -> Column:
        """log10 of the add-half estimate of a token."""
        return F.log10((c + 0.5) / F.lit(max(self.tokens + 0.5 * (self.distinct + 1), 1.0)))

    def score(self, c: Column, g: Column) -> Column:
        """log10((c + V G) / (N + V)), without underflow for long words."""
        distinct = max(self.distinct, 1)
        spread = g + math.log10(1 - END) + math.log10(distinct)
        known = F.log10(c) + F.log10(1 + F.pow(F.lit(10.0), spread - F.log10(c)))
        return F.when(c > 0, known).otherwise(spread) - math.log10(self.tokens + distinct)

    def _end(self) -> tuple[float, float]:
        distinct = max(self.distinct, 1)
        base = math.log10((self.train_rows + 0.5) / max(self.tokens + 0.5 * (self.distinct + 1), 1.0))
        return base, math.log10((self.train_rows + distinct * END) / (self.tokens + distinct))

    def apply(self, df: DataFrame, keep: dict[str, Column], text: str = "text") -> DataFrame:
        """``keep`` plus n_tokens, n_known, train_tokens, base_score and score for every row."""
        valued = self.words.withColumns(
            {"base": self.base(F.col("c")), "score": self.score(F.col("c"), F.col("g"))}
        ).select("word", "base", "score", (F.col("c") > 0).alias("known"))
        frequent = (
            self.words.where("c > 0").orderBy(F.desc("c"), "word").limit(FREQUENT)
            .select("word", self.base(F.col("c")).alias("base"), self.score(F.col("c"), F.col("g")).alias("score"))
        )
        # A fixed number of rows; words above LONG_WORD bytes stay in the table.
        table = frequent.where(F.octet_length("word") <= LONG_WORD).toArrow()
        shared = self.spark.sparkContext.broadcast(
            (table["word"].to_pylist(), table["base"].to_numpy(), table["score"].to_numpy())
        )
        end_base, end_score = self._end()

        def make():
            from collections import Counter
            from itertools import repeat

            import numpy as np
            import pandas as pd

            words, bases, scores = shared.value
            place = {word: i for i, word in enumerate(words)}.get

            def one(value):
                n, known, base, score, others = 1, int(self_train_rows > 0), end_base, end_score, Counter()
                for found in word_runs(value):
                    at = np.fromiter(map(place, found, repeat(-1)), dtype=np.int64, count=len(found))
                    hit = at[at >= 0]
                    n, known = n + len(found), known + len(hit)
                    base, score = base + float(bases[hit].sum()), score + float(scores[hit].sum())
                    if len(hit) < len(found):
                        others.update([found[i] for i in np.flatnonzero(at < 0)])
                return n, known, base, score, list(others), list(others.values())

            names = ["n_tokens", "n_known", "base", "score", "words", "counts"]
            return lambda texts: pd.DataFrame([one(value) for value in texts], columns=names)

        self_train_rows = self.train_rows
        schema = "n_tokens long, n_known long, base double, score double, words array<binary>, counts array<long>"
        part = column_udf(make, schema)(F.coalesce(F.col(text), F.lit("")))
        parts = materialize(
            df.select(*[c.alias(name) for name, c in keep.items()], part.alias("__part")).withColumn(
                "__row", F.monotonically_increasing_id()
            ),
            "partial-scores",
        )
        rare = parts.select(
            "__row", F.explode(F.arrays_zip("__part.words", "__part.counts")).alias("x")
        ).select("__row", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
        sums = rare.join(valued, "word").groupBy("__row").agg(
            F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("__known"),
            F.sum(F.col("n") * F.col("base")).alias("__base"),
            F.sum(F.col("n") * F.col("score")).alias("__score"),
        )

        def plus(mine: str, other: str, zero) -> Column:
            return F.col(f"__part.{mine}") + F.coalesce(F.col(other), F.lit(zero))

        slim = parts.withColumn("__part", F.col("__part").dropFields("words", "counts"))
        return slim.join(sums, "__row", "left").select(
            *keep,
            F.col("__part.n_tokens").alias("n_tokens"),
            plus("n_known", "__known", 0).alias("n_known"),
            F.lit(self.tokens).cast("long").alias("train_tokens"),
            plus("base", "__base", 0.0).alias("base_score"),
            plus("score", "__score", 0.0).alias("score"),
        )
