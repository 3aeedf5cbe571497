"""A Merkle manifest of a table, and octopus multiproofs of its rows.

Rows are leaves of one tree per group (a source, say); the roots of these trees
are the leaves of one more tree, whose root stands for the whole table.  A node
is the SHA-256 of its ``FAN`` children, digests in hex, joined; the last run of
a level may be shorter, even a single node.

Building.  Leaves are numbered inside their group by range parts.  A block of
``FAN**3`` leaves is one small subtree, whose interiors one group function
derives; their roots are the leaves of the next block, so a table of 6e10 rows
takes three such steps.  No step holds more than a block.

Proving.  Requested leaves are dealt by block.  A block lists the coordinates
that its requests miss, each once: those members of the runs on its way to the
root that are neither requested nor derived from what is.  All blocks fetch
theirs with one join, derive the interiors that their requests share, and
expand a proof for every request.  The nodes near the root, which all blocks
miss, are the hot keys of that join and are looked up skew-safe.

Edge cases: rows with equal order values are ordered by leaf digest, so equal
rows are neighbours and their leaves alike; a null order value comes first; a
null group is a group of its own and comes first; a group of one leaf has that
leaf as its root, and so has a table of one group; an empty table has no nodes
and gives no proofs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tabloom.llm.common import free_name
from tabloom.operators.lookup import left_lookup
from tabloom.operators.prefix import global_rank, part_count
from tabloom.scratch import materialize

FAN = 16
#: Levels of a block: a group function handles FAN**DEPTH leaves at most.
DEPTH = 3
BLOCK = FAN**DEPTH
#: Tree number of the tree over the groups.
TOP = -1
DIGEST = 64

NODES = "tree long, level int, pos long, digest string"
PROOF = ArrayType(StructType([StructField("place", IntegerType()), StructField("siblings", StringType())]))


def row_digest(*columns: Column) -> Column:
    """SHA-256 of values, each ``-`` if null, else its UTF-8 byte count, a colon and the value."""

    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(digest: Column, step: Column) -> Column:
        cut = DIGEST * step["place"]
        siblings = step["siblings"]
        whole = F.concat(F.substr(siblings, F.lit(1), cut), digest, F.substr(siblings, cut + 1))
        return F.sha2(whole, 256)

    return F.aggregate(proof, leaf, up)


def joined_proof(proof: Column) -> Column:
    """All siblings of a proof as one text, from leaf to root, left to right."""
    return F.array_join(F.transform(proof, lambda step: step["siblings"]), "")


def _block_nodes(base: int):
    return lambda table: _interiors(table, base)


def _interiors(table, base: int):
    """Interior nodes of one block; columns tree, pos, digest, n (nodes of the tree on this level)."""
    from hashlib import sha256

    import pyarrow as pa

    tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
    known = sorted(zip(table["pos"].to_pylist(), table["digest"].to_pylist()))
    first, digests = known[0][0], [digest for _, digest in known]
    rows = []
    for level in range(base + 1, base + DEPTH + 1):
        if n == 1:
            break
        first, n = first // FAN, -(-n // FAN)
        digests = [sha256("".join(digests[i : i + FAN]).encode()).hexdigest() for i in range(0, len(digests), FAN)]
        rows.extend((tree, level, first + i, digest) for i, digest in enumerate(digests))
    return _arrow(rows, [pa.int64(), pa.int32(), pa.int64(), pa.string()], ["tree", "level", "pos", "digest"])


def _arrow(rows: list[tuple], kinds: list, names: list[str]):
    import pyarrow as pa

    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _forest(leaves: DataFrame, most: int) -> DataFrame:
    """All interior nodes over ``tree, pos, digest, n``; no tree has more than ``most`` leaves."""
    found, base, current = None, 0, leaves.select("tree", "pos", "digest", "n")
    while most > 1:
        block = current.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block"))
        nodes = materialize(block.applyInArrow(_block_nodes(base), NODES), "nodes")
        found = nodes if found is None else found.unionByName(nodes)
        base, most = base + DEPTH, -(-most // BLOCK)
        sizes = leaves.groupBy("tree").agg(F.max("n").alias("n"))
        # Every tree with more than one node left takes part in the next step.
        left = sizes.select("tree", F.ceil(F.col("n") / FAN**base).cast("long").alias("n")).where("n > 1")
        if most > 1:
            top = nodes.where(F.col("level") == base).select("tree", "pos", "digest")
            current = left_lookup(top, left.withColumn("w", F.col("n")), ["tree"], "w").where("n IS NOT NULL")
    return found if found is not None else leaves.sparkSession.createDataFrame([], NODES)


def heights(leaves: Column) -> Column:
    """Levels above the leaves of a tree."""
    bounds = [FAN**k for k in range(16)]
    return F.aggregate(F.array(*[F.lit(b) for b in bounds]), F.lit(0), lambda h, b: h + (leaves > b).cast("int"))


class MerkleManifest:
    """Leaves, nodes and groups of a table, written to the shared folder.

    ``leaves``: tree, pos, digest and the kept columns; ``groups``: one row per
    tree with the group's value (as text), n (leaves), subroot and root; ``nodes``: all
    nodes, leaves included, as tree, level, pos, digest.
    """

    def __init__(self, leaves: DataFrame, groups: DataFrame, nodes: DataFrame):
        self.leaves, self.groups, self.nodes = leaves, groups, nodes

    @classmethod
    def build(cls, df: DataFrame, leaf: Column, group: str, order: str, keep: dict[str, Column] | None = None) -> MerkleManifest:
        """One leaf per row, with digest ``leaf``; leaves of a group ascend by ``order``."""
        spark = df.sparkSession
        kept = {order: F.col(order)} | (keep or {})
        key = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n"))
        names = {name: free_name(f"kept_{i}", kept) for i, name in enumerate(kept)}
        hashed = materialize(
            df.select(
                key.alias("key"), F.col(order).alias("at"), leaf.alias("digest"),
                *[column.alias(names[name]) for name, column in kept.items()],
            ),
            "leaves",
        )
        rows = hashed.count()
        parts = max(part_count(rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
        order_by = [F.col("at").asc_nulls_first(), F.col("digest")]
        ranked = global_rank(hashed, order_by, ["key"], "rank", parts)
        sizes = materialize(ranked.groupBy("key").agg(F.max("rank").alias("n")), "sizes")
        count = sizes.count()
        trees = global_rank(sizes, [F.col("key")], rank="tree", parts=part_count(count), rows=count)
        trees = materialize(trees.withColumn("tree", F.col("tree") - 1).withColumn("weight", F.col("n")), "trees")
        numbered = left_lookup(ranked, trees, ["key"], "weight")
        leaves = materialize(
            numbered.select("tree", (F.col("rank") - 1).alias("pos"), "digest", "n", *names.values()), "numbered"
        )
        most = trees.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        inner = _forest(leaves, most)
        roots = leaves.where("n = 1").select("tree", "digest").unionByName(
            inner.where("pos = 0").join(trees.select("tree", "n"), "tree").where(F.col("level") == heights(F.col("n")))
            .select("tree", "digest")
        )
        subroots = materialize(roots.withColumnRenamed("digest", "subroot"), "subroots")
        over = subroots.select(
            F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("digest"),
            F.lit(count).cast("long").alias("n"),
        )
        upper = _forest(over, count)
        # A table of one group has that group's root.
        root = over.select(F.lit(0).alias("level"), "digest").unionByName(upper.select("level", "digest")).orderBy(F.desc("level")).first()
        nodes = (
            leaves.select("tree", F.lit(0).alias("level"), "pos", "digest")
            .unionByName(inner)
            .unionByName(over.select("tree", F.lit(0).alias("level"), "pos", "digest"))
            .unionByName(upper)
        )
        named = F.when(F.col("key") != "n", F.substr("key", F.lit(2)))
        groups = trees.join(subroots, "tree").select(
            "tree", named.alias("value"), "n", "weight", "subroot", F.lit(root.digest if root else None).alias("root"),
            F.lit(count).cast("long").alias("groups"),
        )
        back = [F.col(made).alias(name) for name, made in names.items()]
        return cls(leaves.select("tree", "pos", "digest", "n", *back), groups, nodes)

    def missing(self, requests: DataFrame) -> DataFrame:
        """``tree, block, node_tree, level, pos``: the least coordinates that each block of requests must fetch."""
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        touched = requests.groupBy("tree", block).agg(
            F.sort_array(F.collect_set("pos")).alias("known"), F.count("*").alias("weight")
        )
        info = self.groups.select("tree", "n", "groups", F.col("weight").alias("rows"))
        touched = left_lookup(touched, info, ["tree"], "rows")

        def coordinates(batches):
            import pyarrow as pa

            for batch in batches:
                rows = []
                for tree, block, known, _, n, groups in zip(*[c.to_pylist() for c in batch.columns]):
                    rows.extend((tree, block, tree, *c) for c in missing_coordinates(known, n))
                    rows.extend((tree, block, TOP, *c) for c in missing_coordinates([tree], groups))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = ["tree", "block", "node_tree", "level", "pos"]
                yield from _arrow(rows, kinds, names).to_batches(max_chunksize=1 << 16)

        listed = touched.select("tree", "block", "known", "weight", "n", "groups")
        return listed.mapInArrow(coordinates, "tree long, block long, node_tree long, level int, pos long")

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """Requested leaves (rows of ``leaves``; all, if None) with ``proof``, ``subroot`` and ``root``.

        A proof lists, from the leaf to the root, the place of the proved node in
        its run and the digests of the run's other nodes, joined.
        """
        requests = self.leaves if requests is None else requests
        keys = ["node_tree", "level", "pos"]
        missing = materialize(self.missing(requests), "missing")
        wanted = missing.groupBy(*keys).agg(F.count("*").alias("weight"))
        stored = self.nodes.withColumnRenamed("tree", "node_tree")
        fetched = left_lookup(missing, materialize(wanted.join(stored, keys), "fetched"), keys, "weight")
        block = F.floor(F.col("pos") / BLOCK)
        info = self.groups.select("tree", "subroot", "root", "groups", F.col("weight").alias("rows"))
        asked = left_lookup(requests, info, ["tree"], "rows").withColumn("block", block)
        names = [name for name in asked.columns if name != "block"]
        schema = asked.select(*names).schema.add("proof", PROOF)

        def expand(own, other):
            return _expanded(own, other, names)

        return (
            asked.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(expand, schema)
        )


def missing_coordinates(known: list[int], n: int) -> list[tuple[int, int]]:
    """(level, pos) of the nodes beside the ways from known leaves to the root that cannot be derived."""
    found, level, known = [], 0, sorted(set(known))
    while n > 1:
        runs, have = sorted({pos // FAN for pos in known}), set(known)
        for run in runs:
            members = range(run * FAN, min(n, run * FAN + FAN))
            found.extend((level, pos) for pos in members if pos not in have)
        known, n, level = runs, -(-n // FAN), level + 1
    return found


def _runs(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """Per level, the runs on the ways to the root: run number to its digests, joined.  Interiors are derived once."""
    from hashlib import sha256

    levels, level, known = [], 0, leaves
    while n > 1:
        runs = {}
        for run in {pos // FAN for pos in known}:
            members = range(run * FAN, min(n, run * FAN + FAN))
            runs[run] = "".join([known.get(pos) or fetched[level, pos] for pos in members])
        levels.append(runs)
        known = {run: sha256(whole.encode()).hexdigest() for run, whole in runs.items()}
        n, level = -(-n // FAN), level + 1
    return levels


def _way(pos: int, levels: list[dict[int, str]]) -> list[dict]:
    """Steps of one leaf's proof."""
    steps = []
    for runs in levels:
        run, place = divmod(pos, FAN)
        whole = runs[run]
        steps.append({"place": place, "siblings": whole[: DIGEST * place] + whole[DIGEST * (place + 1) :]})
        pos = run
    return steps


def _expanded(own, other, names: list[str]):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))
    if not own.num_rows:
        return own.select(names).append_column("proof", pa.array([], kind))
    tree, n, groups, subroot = (own[name][0].as_py() for name in ("tree", "n", "groups", "subroot"))
    inside, above = {}, {}
    for at, level, pos, digest in zip(*[other[name].to_pylist() for name in ("node_tree", "level", "pos", "digest")]):
        (above if at == TOP else inside)[level, pos] = digest
    places = own["pos"].to_pylist()
    levels = _runs(dict(zip(places, own["digest"].to_pylist())), inside, n)
    upper = _way(tree, _runs({tree: subroot}, above, groups))
    proofs = pa.array([_way(pos, levels) + upper for pos in places], kind)
    return own.select(names).append_column("proof", proofs)
