"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text there is exactly one token that can end the
BPE encoding of that prefix.  ``PrefixTable`` stores it for each prefix, so the
encoding is read by walking back from the end, an append only adds entries, and
an edit recomputes entries from the edit until the table repeats its old course.
Short pieces share one table over prefixes of all pieces, filled where needed.

A token may follow another one if BPE, given both texts in a row, never merges
across the seam; that test is local, so it is remembered per pair of tokens.

Texts are first split by the pattern of the vocabulary; each match is encoded
separately.  A match that is a token as a whole is that token.

Edge cases: a null text is an empty one; an empty text has no ids; ids that the
vocabulary lacks, and null ids, raise ``ValueError`` when decoded.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import cached_property

import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import column_udf, worker_cache

#: Entries of each memory of a Python worker (words, prefixes, seams); a full memory starts anew.
MEMORY_ENTRIES = 1 << 18
#: Words and pieces of more bytes are not remembered.
REMEMBERED_LENGTH = 64
#: Stands for the start of a piece where a token is expected.
START = 0xFFFFFFFF
_LOOSE_SPACE = re.compile(r"\s ")


class Merges:
    """A rank file and what follows from it: token bytes, a byte trie, and the seams."""

    def __init__(self, rank_file: bytes):
        lines = (line.split() for line in rank_file.splitlines() if line)
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.text = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.fits = _Seams(self)
        self.last_of = _Prefixes(self)

    @cached_property
    def root(self) -> dict:
        """The byte trie: byte -> [next bytes, token or -1]; only tables of single texts need it."""
        root: dict = {}
        for token, rank in self.rank.items():
            node = root
            for byte in token[:-1]:
                node = node.setdefault(byte, [{}, -1])[0]
            node.setdefault(token[-1], [{}, -1])[1] = rank
        return root

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge into ``token`` joins; None for a byte.

        Raises ``KeyError`` for a token that merging never produces.
        """
        if token not in self._halves:
            parts = [bytes([byte]) for byte in self.text[token]]
            while len(parts) > 2:
                ranks = [self.rank.get(a + b) for a, b in zip(parts, parts[1:])]
                best = min((r for r in ranks if r is not None), default=None)
                if best is None:
                    break
                at = ranks.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (
                None if len(parts) == 1 else (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else (-1, -1)
            )
        found = self._halves[token]
        if found == (-1, -1):
            raise KeyError(token)
        return found

    def growth(self, token: int, side: int) -> list[tuple[int, float]]:
        """How the outermost part on one side grows, from a byte to the token: (part, rank at which it is absorbed)."""
        steps, until = [(token, float("inf"))], token
        while (pair := self.halves(until)) is not None:
            steps.append((pair[side], until))
            until = pair[side]
        return steps[::-1]

    def seam_holds(self, left: int, right: int) -> bool:
        """Whether BPE leaves the border between the two tokens alone."""
        try:
            if left == START:
                self.halves(right)
                return True
            before, after = self.growth(left, 1), self.growth(right, 0)
        except KeyError:
            return False
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = before[i], after[j]
            crossing = self.rank.get(self.text[a] + self.text[b], float("inf"))
            # Of equal ranks the leftmost merge comes first.
            if crossing < a_ends and crossing <= b_ends:
                return False
            if a_ends == b_ends == float("inf"):
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1


class _Seams(dict):
    """left << 32 | right -> whether the pair may stand side by side."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, pair: int) -> bool:
        if len(self) >= MEMORY_ENTRIES:
            self.clear()
        answer = self[pair] = self.merges.seam_holds(pair >> 32, pair & 0xFFFFFFFF)
        return answer


class _Prefixes(dict):
    """Prefix -> its last token, over the prefixes of all short pieces."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, prefix: bytes) -> int:
        rank, fits = self.merges.rank, self.merges.fits
        for i in range(max(0, len(prefix) - self.merges.longest), len(prefix)):
            token = rank.get(prefix[i:])
            # The first fitting token is the longest one, and no other fits.
            if token is not None and fits[(self[prefix[:i]] if i else START) << 32 | token]:
                if len(self) >= MEMORY_ENTRIES:
                    self.clear()
                self[prefix] = token
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def tokens(self, piece: bytes) -> list[int]:
        """The encoding, by walking back over last tokens."""
        text, found = self.merges.text, []
        while piece:
            token = self[piece]
            found.append(token)
            piece = piece[: -len(text[token])]
        return found[::-1]


class PrefixTable:
    """The last token of every prefix of ``data``; ``last[n]`` belongs to the first n bytes."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.merges, self.data, self.last = merges, b"", [START]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Extend the text; entries of old prefixes stay as they are."""
        start = len(self.data)
        self.data += data
        self.last += [-1] * len(data)
        self._fill(max(0, start + 1 - self.merges.longest), start)

    def _fill(self, begin: int, known: int) -> None:
        """Set the entries after ``known`` from the tokens that start at ``begin`` or later."""
        data, last, root, fits, size = self.data, self.last, self.merges.root, self.merges.fits, len(self.data)
        for i in range(begin, size):
            node, before = root, last[i] << 32
            for j in range(i, size):
                hit = node.get(data[j])
                if hit is None:
                    break
                node, token = hit
                # The first fitting token is the longest one, and no other fits.
                if token >= 0 and last[j + 1] < 0 and j >= known and fits[before | token]:
                    last[j + 1] = token

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of the bytes from start to end; the number of entries computed anew."""
        old_last, shift, reach = self.last, len(data) - (end - start), self.merges.longest
        tail = self.data[end:]
        self.data, self.last = self.data[:start], old_last[: start + 1]
        self.append(data)
        done, same = 0, 0
        while done < len(tail):
            # Once as many entries as the longest token has bytes agree, all later ones do.
            if same >= reach:
                self.data += tail[done:]
                self.last += old_last[end + done + 1 :]
                break
            self.append(tail[done : done + 1])
            done += 1
            same = same + 1 if self.last[-1] == old_last[end + done] else 0
        return len(data) + done

    def tokens(self) -> list[int]:
        """The encoding, by walking back over last tokens."""
        found, at = [], len(self.data)
        while at:
            token = self.last[at]
            found.append(token)
            at -= len(self.merges.text[token])
        return found[::-1]


class Tokenizer:
    """Encodes texts to little-endian unsigned 32-bit ids and back."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.merges = Merges(rank_file)
        self.pattern = regex.compile(pattern)
        self.words = _Words(self)

    def piece_ids(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.merges.rank.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= REMEMBERED_LENGTH:
            return self.merges.last_of.tokens(piece)
        return PrefixTable(self.merges, piece).tokens()

    def split_encode(self, text: str) -> bytes:
        ids = [i for match in self.pattern.findall(text) for i in self.piece_ids(match.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as packed bytes.

        No match crosses a border between other characters and a single blank
        that follows them, so a text where each blank follows such a character
        is encoded blank by blank.
        """
        if not text:
            return b""
        if text[0].isspace() or _LOOSE_SPACE.search(text):
            return self.split_encode(text)
        first, *others = text.split(" ")
        return self.split_encode(first) + b"".join(map(self.words.__getitem__, others))

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids."""
        if len(packed) % 4:
            raise ValueError("ids are 4 bytes each")
        try:
            return b"".join(map(self.merges.text.__getitem__, memoryview(packed).cast("I")))
        except KeyError as unknown:
            raise ValueError(f"no token has the id {unknown}") from None


class _Words(dict):
    """Ids of a word with a blank before it."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        found = self.tokenizer.split_encode(" " + word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= MEMORY_ENTRIES:
                self.clear()
            self[word] = found
        return found


def worker_tokenizer(rank_file, pattern: str) -> Tokenizer:
    """The tokenizer of this Python worker for a broadcast rank file."""
    import hashlib

    key = hashlib.sha256(rank_file.value + pattern.encode()).hexdigest()
    return worker_cache(f"bpe_{key}", lambda: Tokenizer(rank_file.value, pattern))


class ByteBpe:
    """Columns of ids and texts for one vocabulary, whose rank file is read once on the driver."""

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        with open(rank_path, "rb") as file:
            # A vocabulary file has a fixed size, here below a megabyte.
            self.rank_file = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """The ids of each text as ``array<int>``."""
        rank_file, pattern = self.rank_file, self.pattern

        def make():
            import numpy as np
            import pandas as pd

            tokenizer = worker_tokenizer(rank_file, pattern)
            return lambda texts: pd.Series([np.frombuffer(tokenizer.encode(t), "<i4") for t in texts], dtype=object)

        return column_udf(make, "array<int>")(F.coalesce(text, F.lit("")))

    def decode(self, ids: Column) -> Column:
        """The bytes of each array of ids; invalid ids raise."""
        rank_file, pattern = self.rank_file, self.pattern

        def make():
            import numpy as np
            import pandas as pd

            tokenizer = worker_tokenizer(rank_file, pattern)

            def one(values):
                if values is None:
                    return b""
                numbers = np.asarray(values)
                if numbers.dtype == object or (numbers.dtype.kind == "f" and np.isnan(numbers).any()):
                    raise ValueError("an id is null")
                return tokenizer.decode(numbers.astype("<i4").tobytes())

            return lambda arrays: pd.Series([one(values) for values in arrays], dtype=object)

        return column_udf(make, "binary")(ids)

    def _described(self, text: Column, with_ids: bool) -> Column:
        rank_file, pattern = self.rank_file, self.pattern

        def make():
            import hashlib

            import numpy as np
            import pandas as pd

            tokenizer = worker_tokenizer(rank_file, pattern)

            def rows(texts) -> Iterator[tuple]:
                for value in texts:
                    packed = tokenizer.encode(value)
                    decoded = tokenizer.decode(packed)
                    digests = hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()
                    ids = (np.frombuffer(packed, "<i4"),) if with_ids else ()
                    yield len(packed) // 4, *digests, *ids

            names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
            return lambda texts: pd.DataFrame(list(rows(texts)), columns=names)

        schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
        return column_udf(make, schema)(F.coalesce(text, F.lit("")))

    def digests(self, text: Column) -> Column:
        """Per text the number of ids, the digest of the ids, and that of the text decoded from them."""
        return self._described(text, with_ids=False)

    def encoded(self, text: Column) -> Column:
        """``digests`` and the ids themselves."""
        return self._described(text, with_ids=True)
