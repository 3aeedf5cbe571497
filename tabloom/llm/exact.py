"""Exact duplicates, owned by the terminals of Patricia tries.

Texts are compared as whole byte strings, never by digest alone.

1. Every map task inserts its texts into one radix trie, whose edges hold runs
   of bytes.  A terminal stores how many rows ended there and the best of them;
   each row leaves with the number of its terminal.  If the trie grows beyond
   ``HELD_BYTES``, its heaviest subtrees are handed on and forgotten.  So a text
   leaves a task once per hand-over, however many rows of the task repeat it.
2. Terminals are dealt by length and content hash, and sorted.  The strings of one
   length and hash meet in a small trie of their own, which is handed on when
   the next length or hash begins; what is held is one such trie.
3. Rows find the owner of their group by their terminal's number.  A terminal
   belongs to one map task, so a hot text is many small keys there.

The row that stays has the largest ``weight``, then the smallest identifier
(a null one comes last), then the first place in the input.

Edge cases: a null text counts as empty, and empty texts are equal; a null
identifier takes part; of rows that agree in everything exactly one is kept;
texts of any length are whole; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructType

from tabloom.scratch import materialize

SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of edges and nodes that a map task's trie may hold before it hands subtrees on.
HELD_BYTES = 48 * 1024 * 1024
#: A node's share of that, besides its label.
NODE_BYTES = 400
#: Terminals handed on at once hold about this many bytes of text.
PIECE_BYTES = 8 * 1024 * 1024


class Node:
    """An edge with its label, and what follows it; ``owner`` is set on terminals."""

    __slots__ = ("label", "next", "owner")

    def __init__(self, label: bytes):
        self.label, self.next, self.owner = label, {}, None


def _shared(label: bytes, data: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``data[at:]``, by halving."""
    low, high = 0, min(len(label), len(data) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == data[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Byte strings in a compressed trie."""

    def __init__(self):
        self.root, self.held = Node(b""), {}

    @property
    def size(self) -> int:
        return sum(self.held.values())

    def terminal(self, data: bytes) -> Node:
        """The node at which ``data`` ends, made if need be."""
        node, at = self.root, 0
        while at < len(data):
            child = node.next.get(data[at])
            if child is None:
                child = node.next[data[at]] = Node(data[at:])
                self._grow(data, len(child.label) + NODE_BYTES)
                return child
            if data.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = _shared(child.label, data, at)
            upper = Node(child.label[:shared])
            child.label = child.label[shared:]
            upper.next[child.label[0]] = child
            node.next[data[at]] = upper
            self._grow(data, NODE_BYTES)
            node, at = upper, at + shared
        return node

    def _grow(self, data: bytes, size: int) -> None:
        first = data[0]
        self.held[first] = self.held.get(first, 0) + size

    def heaviest(self) -> int:
        return max(self.held, key=self.held.__getitem__)

    def take(self, first: int | None = None):
        """Remove a subtree (all without ``first``); its strings with their owners, one by one."""
        if first is None:
            nodes, self.held = [self.root], {}
            self.root = Node(b"")
        else:
            nodes = [self.root.next.pop(first)]
            del self.held[first]
        todo = [(b"", node) for node in nodes]
        while todo:
            before, node = todo.pop()
            data = before + node.label
            if node.owner is not None:
                yield data, node.owner
            todo.extend((data, child) for child in node.next.values())


def _better(one: tuple, other: tuple) -> bool:
    """Whether the first of two (weight, identifier, terminal, place) stays rather than the second."""
    if one[0] != other[0]:
        return one[0] > other[0]
    if (one[1] is None) != (other[1] is None):
        return other[1] is None
    if one[1] != other[1]:
        return one[1] < other[1]
    return one[2:] < other[2:]


def _schema(identifier, fields: list[tuple]) -> StructType:
    made = StructType()
    for name, kind in fields:
        made.add(name, identifier if kind is None else kind)
    return made


def _task_tries(schema: StructType, held_bytes: int):
    """Rows ``id, weight, body`` to rows with the number of their terminal, and the terminals."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        from xxhash import xxh64_intdigest

        arrow = to_arrow_schema(schema)
        # 2^23 tasks of 2^40 terminals each; a task that runs again numbers its terminals alike.
        number, place = TaskContext.get().partitionId() << 40, 0
        trie = RadixTrie()

        def table(**columns):
            rows = len(next(iter(columns.values())))
            arrays = [
                pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in arrow
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        def handed_on(first=None):
            held, size = [], 0
            for body, (terminal, n, best) in trie.take(first):
                held.append((terminal, len(body), xxh64_intdigest(body) - (1 << 63), body, n, *best[:2], best[3]))
                size += len(body) + NODE_BYTES
                if size > PIECE_BYTES:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

        def packed(held):
            names = ("terminal", "length", "hash", "body", "n", "weight", "best_id", "place")
            return table(**dict(zip(names, map(list, zip(*held)))))

        for batch in batches:
            bodies = batch.column(2).cast(pa.binary())
            ids, weights = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            terminals = []
            for i in range(batch.num_rows):
                node = trie.terminal((bodies[i].as_py() or b"").translate(None, SPACES))
                if node.owner is None:
                    number += 1
                    node.owner = [number, 1, (weights[i], ids[i], number, place + i)]
                else:
                    terminal, _, best = node.owner
                    mine = (weights[i], ids[i], terminal, place + i)
                    node.owner[1] += 1
                    if _better(mine, best):
                        node.owner[2] = mine
                terminals.append(node.owner[0])
                while trie.size > held_bytes:
                    yield from handed_on(trie.heaviest())
            yield table(id=batch.column(0), terminal=terminals, place=list(range(place, place + batch.num_rows)))
            place += batch.num_rows
        yield from handed_on()

    return run


def _owners(schema: StructType):
    """Terminals sorted by length and hash to terminals with the owner of their group."""

    def run(batches):
        import hashlib

        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        trie, current = RadixTrie(), None

        def handed_on():
            rows = []
            for body, (terminals, n, (_, best_id, owner, place)) in trie.take():
                digest = hashlib.sha256(body).hexdigest()
                rows.extend((t, owner, place, best_id, n, digest) for t in terminals)
            columns = map(list, zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        waiting, size = [], 0
        for batch in batches:
            bodies = batch.column(3)
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            stats = list(zip(*(batch.column(i).to_pylist() for i in range(4, 8))))
            for i, ((terminal, length, content), (n, weight, best_id, place)) in enumerate(zip(keys, stats)):
                if (length, content) != current:
                    if current is not None:
                        waiting.append(handed_on())
                        size += waiting[-1].num_rows
                        if size >= 4096:
                            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                            waiting, size = [], 0
                    current = (length, content)
                node = trie.terminal(bodies[i].as_py())
                best = (weight, best_id, terminal, place)
                if node.owner is None:
                    node.owner = [[terminal], n, best]
                else:
                    node.owner[0].append(terminal)
                    node.owner[1] += n
                    if _better(best, node.owner[2]):
                        node.owner[2] = best
        if current is not None:
            waiting.append(handed_on())
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return run


def duplicate_owners(
    df: DataFrame, identifier: str = "doc_id", text: str = "text", weight: Column | None = None,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """One row per input row: the identifier, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical without white space; ``weight`` (the
    number of code points by default) decides which row of a group stays.
    """
    kind = df.schema[identifier].dataType
    long = LongType()
    weight = F.coalesce(F.length(text), F.lit(0)) if weight is None else weight
    given = df.select(F.col(identifier).alias("id"), weight.cast("long").alias("weight"), F.col(text).alias("body"))
    first = _schema(kind, [
        ("id", None), ("terminal", long), ("place", long), ("length", long), ("hash", long), ("body", BinaryType()),
        ("n", long), ("weight", long), ("best_id", None),
    ])
    found = materialize(given.mapInArrow(_task_tries(first, held_bytes), first), "terminals")

    second = _schema(kind, [
        ("terminal", long), ("owner", long), ("owner_place", long), ("keep_id", None), ("group_size", long),
        ("text_sha256", StringType()),
    ])
    dealt = (
        found.where("n IS NOT NULL")
        .select("terminal", "length", "hash", "body", "n", "weight", "best_id", "place")
        .repartition("length", "hash")
        .sortWithinPartitions("length", "hash")
    )
    owners = dealt.mapInArrow(_owners(second), second)
    kept = (F.col("terminal") == F.col("owner")) & (F.col("place") == F.col("owner_place"))
    return found.where("n IS NULL").select("id", "terminal", "place").join(owners, "terminal").select(
        F.col("id").alias(identifier), "keep_id", "group_size", kept.cast(BooleanType()).alias("kept"), "text_sha256"
    )
