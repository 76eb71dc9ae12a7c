"""A manifest of a dataset as a Merkle tree: parents keep copies of their hash state before every child."""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelflume.llm.common import saved, sealed
from panelflume.llm.ordering import numbered

FANOUT = 16
CHUNK = FANOUT ** 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Run:
    """A parent: the digests of its children, joined, and the hash state before each child."""

    WIDTH = 64

    def __init__(self, children: list[str]):
        self.joined = "".join(children).encode()
        self.before = []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def left(self, i: int) -> bytes:
        return self.joined[:i * self.WIDTH]

    def right(self, i: int) -> bytes:
        return self.joined[(i + 1) * self.WIDTH:]

    def fold(self, i: int, digest: str) -> str:
        """The digest with child i replaced: the state kept before it goes on with the replacement and what stands to its right."""
        return resume(self.before[i], digest, self.right(i))


def resume(before, digest: str, right: bytes) -> str:
    state = before.copy()
    state.update(digest.encode())
    state.update(right)
    return state.hexdigest()


def runs_above(digests: list[str], total: int) -> list[list[Run]]:
    """The levels of runs above a chunk's nodes: two, or fewer where the whole tree has at most FANOUT (or one) nodes."""
    levels = []
    while total > 1 and len(levels) < 2:
        levels.append([Run(digests[i:i + FANOUT]) for i in range(0, len(digests), FANOUT)])
        digests = [r.digest for r in levels[-1]]
        total = -(-total // FANOUT)
    return levels


class Tree(NamedTuple):
    """nodes[0] are the leaves, nodes[k] the tops of the chunks of nodes[k - 1], nodes[-1] one node per tree; tree, place_, digest.
    heads[k]: tree, place_ (number of the chunk), total (nodes of the tree in nodes[k])."""
    nodes: list[DataFrame]
    heads: list[DataFrame]


def _dealt(heads: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes by chunk in order, the chunk's head before them."""
    heads = heads.withColumnsRenamed({"place_": "chunk"}).withColumn("place_", F.lit(-1).cast("long"))
    nodes = nodes.withColumn("chunk", F.floor(F.col("place_") / CHUNK))
    return heads.unionByName(nodes, allowMissingColumns=True).repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "place_")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Head and nodes of each chunk; at most CHUNK nodes are held."""
    head, nodes = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["place_"] < 0:
                if head:
                    yield head, nodes
                head, nodes = row, []
            else:
                nodes.append(row)
    if head:
        yield head, nodes


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def grow(leaves: DataFrame, totals: DataFrame) -> Tree:
    """The trees over leaves (tree, place_, digest), a written table; totals: tree, total. A chunk of 256 nodes is hashed in one
    task, two levels at once, and its top goes on to the next table, which has a 256th of the rows."""
    schema = pa.schema([("tree", pa.string()), ("place_", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops():
            for head, nodes in _chunks(batches):
                digests = [n["digest"] for n in nodes]
                levels = runs_above(digests, head["total"])
                yield head["tree"], head["chunk"], levels[-1][0].digest if levels else digests[0]
        yield from _batches(tops(), schema)

    nodes, heads = [leaves.select("tree", "place_", "digest")], []
    most = totals.agg(F.max("total")).first()[0] or 1
    while most > 1:
        chunks = F.ceil(F.col("total") / CHUNK)
        heads.append(totals.select("tree", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("place_"), "total"))
        nodes.append(saved(_dealt(heads[-1], nodes[-1]).select("tree", "chunk", "place_", "total", "digest")
                           .mapInArrow(run, "tree string, place_ long, digest string")))
        totals = totals.select("tree", chunks.alias("total"))
        most = -(-most // CHUNK)
    return Tree(nodes, heads)


def paths(tree: Tree, tops: DataFrame, down_to: int = 0) -> DataFrame:
    """(tree, place_, path, subroot) of the nodes of tree.nodes[down_to]. A path has, level by level upward, what stands left and what
    stands right of the node in its run. tops: tree, path, subroot of each tree's last node."""
    schema = pa.schema([("tree", pa.string()), ("place_", pa.int64()), ("path", pa.list_(pa.string())), ("subroot", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def down():
            for head, nodes in _chunks(batches):
                levels = runs_above([n["digest"] for n in nodes], head["total"])
                for n in nodes:
                    own, at = [], n["place_"] % CHUNK
                    for runs in levels:
                        at, i = divmod(at, FANOUT)
                        own += [runs[at].left(i).decode(), runs[at].right(i).decode()]
                    yield head["tree"], n["place_"], own + head["path"], head["subroot"]
        yield from _batches(down(), schema, 256)

    found = tops.select("tree", F.lit(0).cast("long").alias("place_"), "path", "subroot")
    for k in range(len(tree.heads) - 1, down_to - 1, -1):
        heads = tree.heads[k].join(found, ["tree", "place_"])
        found = saved(_dealt(heads, tree.nodes[k]).select("tree", "chunk", "place_", "total", "path", "subroot", "digest").mapInArrow(
            run, "tree string, place_ long, path array<string>, subroot string"))
    return found


def prove(leaves: DataFrame, tree: Tree, tops: DataFrame, root: str | None) -> DataFrame:
    """Per leaf (tree, place_, doc_id, digest, replacement): its proof's digest, and the root folded from its replacement, or from the
    leaf itself where that is null."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs():
            for head, nodes in _chunks(batches):
                levels = runs_above([n["digest"] for n in nodes], head["total"])
                sides = [s.encode() for s in head["path"]]
                above = [(hashlib.sha256(left), right) for left, right in zip(sides[::2], sides[1::2])]
                rest = b"".join(sides)
                for n in nodes:
                    at, value, proof = n["place_"] % CHUNK, n["replacement"] or n["digest"], hashlib.sha256()
                    for runs in levels:
                        at, i = divmod(at, FANOUT)
                        proof.update(runs[at].left(i))
                        proof.update(runs[at].right(i))
                        value = runs[at].fold(i, value)
                    proof.update(rest)
                    for before, right in above:
                        value = resume(before, value, right)
                    yield n["doc_id"], n["digest"], head["subroot"], proof.hexdigest(), value
        yield from _batches(proofs(), schema)

    if tree.heads:
        found = paths(tree, tops, 1)
        heads = tree.heads[0].join(found, ["tree", "place_"])
    else:
        heads = tops.select("tree", F.lit(0).cast("long").alias("place_"), F.lit(1).cast("long").alias("total"), "path", "subroot")
    rows = _dealt(heads, leaves).select("tree", "chunk", "place_", "total", "path", "subroot", "doc_id", "digest", "replacement")
    out = rows.mapInArrow(run, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return out.withColumn("root", F.lit(root)).withColumn("verified", F.col("folded_root") == F.col("root"))


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(columns[c]) for c in FIELDS]).cast("binary"), 256)


class Manifest(NamedTuple):
    """leaves: doc_id, tree (the source), digest, replacement, place_. by_source: a tree per source. over: one tree of their roots."""
    leaves: DataFrame
    by_source: Tree
    over: Tree
    root: str | None


def manifest(docs: DataFrame, tampered: Callable[[Column], Column] | None = None) -> Manifest:
    """The trees of docs (doc_id, source, lang, n_chars, text), all written tables.

    tampered: a condition made from the doc_id column; where it holds, `replacement` is the leaf of the row with A-Z lower-cased, if that differs.
    Leaves ascend by doc_id within a source (null ids first, equal ids by digest); sources ascend bytewise, null first. A source may
    hold any share of the rows: its leaves are numbered by range and hashed in chunks of 256. An empty table has no root.
    """
    docs, names = sealed(docs.select(*FIELDS))
    cols = {c: F.col(names[c]) for c in FIELDS}
    lower = F.translate(cols["text"], UPPER, LOWER)
    other = F.lit(None).cast("string")
    if tampered is not None:
        hit = F.coalesce(tampered(cols["doc_id"]), F.lit(False)) & (lower != cols["text"])
        other = F.when(hit, leaf_digest({**cols, "text": lower}))
    tree = F.coalesce(F.concat(F.lit("="), cols["source"].cast("string")), F.lit(""))
    rows = docs.withColumn("doc_id", cols["doc_id"].cast("long")).select(
        "doc_id", tree.alias("tree"), leaf_digest(cols).alias("digest"), other.alias("replacement"))
    leaves = saved(numbered(saved(rows), "tree", ["doc_id", "digest"]))
    totals = saved(leaves.groupBy("tree").agg(F.count("*").alias("total")))
    by_source = grow(leaves, totals)
    subroots = by_source.nodes[-1].select("tree", F.lit("").alias("all"), "digest")
    ranked = saved(numbered(subroots, "all", ["tree"]))
    over = grow(ranked.select(F.col("all").alias("tree"), "place_", "digest"),
                ranked.groupBy(F.col("all").alias("tree")).agg(F.count("*").alias("total")))
    top = over.nodes[-1].first()
    return Manifest(leaves, by_source, over._replace(nodes=[ranked, *over.nodes[1:]]), top["digest"] if top else None)


def verify(made: Manifest) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The siblings above a chunk come down to it once, on its head; its parents' states are built once per chunk and copied for each
    leaf. Nulls in any column, empty and very long texts are leaves like others; repeated rows are leaves of their own, with equal
    digests. A null id is never tampered with. A source of one row is its own subroot, a single source its own root.
    """
    ranked = made.over.nodes[0]
    over = made.over._replace(nodes=[ranked.select(F.col("all").alias("tree"), "place_", "digest"), *made.over.nodes[1:]])
    end = F.array().cast("array<string>")
    above = paths(over, over.nodes[-1].select("tree", end.alias("path"), F.lit("").alias("subroot")))
    tops = ranked.join(above.select("place_", "path"), "place_").select("tree", "path", F.col("digest").alias("subroot"))
    return prove(made.leaves, made.by_source, saved(tops), made.root).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
