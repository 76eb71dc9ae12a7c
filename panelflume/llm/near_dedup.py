"""Near-duplicate documents: trees of nodes chosen by minwise shingles, small nodes compared whole, links confirmed on full sets."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelflume.llm.common import bloom, bloom_hit, discard, opened, saved, sealed
from panelflume.llm.components import stars

SHINGLE = 5
PERCENT = 75
TREES = 10
DEPTH = 9
BRANCHES = (2, 2, 1)
SKETCH = 128
SKETCH_CUT = 0.58
SMALL_NODE = 1024
BLOCK_SHINGLES = 1 << 22
FILTER_SLOTS = 1 << 24
CHUNK_BYTES = 1 << 18
SLICE_ROWS = 256
SEED = 20240229
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Word and shingle hashes of many texts at once. Powers of an odd base make any word's hash a difference of prefix sums."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        rng = np.random.default_rng(SEED)
        self.places = rng.integers(0, 2 ** 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.xors = rng.integers(0, 2 ** 32, TREES + SKETCH, dtype=np.uint32)
        self.muls = rng.integers(0, 2 ** 31, TREES + SKETCH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.branch_xors = rng.integers(0, 2 ** 32, TREES * DEPTH * max(BRANCHES), dtype=np.uint32)
        self.branch_muls = rng.integers(0, 2 ** 31, TREES * DEPTH * max(BRANCHES), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << n.bit_length()
            self.powers = np.full(size, self.BASE, dtype=np.uint64)
            self.inverse = np.full(size, pow(self.BASE, -1, 2 ** 64), dtype=np.uint64)
            self.powers[0] = self.inverse[0] = 1
            np.multiply.accumulate(self.powers, out=self.powers)
            np.multiply.accumulate(self.inverse, out=self.inverse)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text. Fewer than SHINGLE words make one shingle, none make an empty set."""
        buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        self._grow(len(buf))
        gap = SPACES[buf]
        starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
        ends = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((self.lower[buf].astype(np.uint64) + np.uint64(1)) * self.powers[:len(buf)], dtype=np.uint64)))
        words = _mix((sums[ends] - sums[starts]) * self.inverse[starts])
        bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        n = len(words) - SHINGLE + 1
        shingles = np.zeros(max(n, 0), dtype=np.uint64)
        for k in range(SHINGLE):
            if n > 0:
                shingles += words[k:k + n] * self.places[k]
        shingles = _mix(shingles)
        out, a = [], 0
        for b in bounds:
            if b - a >= SHINGLE:
                out.append(np.unique(shingles[a:b - SHINGLE + 1]))
            elif b > a:
                few = (words[a:b] * self.places[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(_mix(np.array([few])))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            a = b
        return out

    def minwise(self, sets: list[np.ndarray], branches: bool = False) -> np.ndarray:
        """Minwise values of each non-empty set: TREES + SKETCH of them, or those of all branches of all trees."""
        xors, muls = (self.branch_xors, self.branch_muls) if branches else (self.xors, self.muls)
        flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        offsets = np.cumsum([0, *[len(s) for s in sets[:-1]]])
        out = np.empty((len(sets), len(xors)), dtype=np.uint32)
        for i, (x, m) in enumerate(zip(xors, muls)):
            out[:, i] = np.minimum.reduceat((flat ^ x) * m, offsets)
        return out


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Parts of a text column of about CHUNK_BYTES, with the place of their first row; nulls are empty."""
    for first in range(0, len(column), SLICE_ROWS):
        part, size, at = [], 0, first
        for i, t in enumerate(column.slice(first, SLICE_ROWS).cast(pa.binary()).to_pylist(), first):
            part.append(t or b"")
            size += len(part[-1])
            if size >= CHUNK_BYTES:
                yield at, part
                part, size, at = [], 0, i + 1
        if part:
            yield at, part
    pa.default_memory_pool().release_unused()


def count_words(column: pa.Array) -> pa.Array:
    """The number of words of each text of a column; nulls have none."""
    table, out = SPACES.tobytes(), []
    for _, texts in _chunks(column):
        gap = np.frombuffer((b" " + b" ".join(texts)).translate(table), dtype=bool)
        starts, at = gap[:-1] > gap[1:], 0
        for t in texts:
            out.append(np.count_nonzero(starts[at:at + len(t)]))
            at += len(t) + 1
    return pa.array(out, pa.int64())


def signatures(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> id, n (set size), f1, f2 (fingerprint of the set), path and sketch (minwise values; null if empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at, texts in _chunks(batch.column(1)):
                sets = hasher.sets(texts)
                full = [i for i, s in enumerate(sets) if len(s)]
                low = dict(zip(full, hasher.minwise([sets[i] for i in full]))) if full else {}
                scrambled = [_mix(s ^ np.uint64(SEED)) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([s.sum(dtype=np.uint64) for s in scrambled], dtype=np.uint64).view(np.int64)),
                    pa.array(np.array([np.bitwise_xor.reduce(s, initial=0) for s in scrambled], dtype=np.uint64).view(np.int64)),
                    pa.array([low[i][:TREES].view(np.int32) if i in low else None for i in range(len(sets))], pa.list_(pa.int32())),
                    pa.array([low[i][TREES:].astype(np.uint8).tobytes() if i in low else None for i in range(len(sets))], pa.binary())],
                    names=["id", "n", "f1", "f2", "path", "sketch"])

    return docs.mapInArrow(run, "id long, n long, f1 long, f2 long, path array<int>, sketch binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> id, set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at, texts in _chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)),
                    pa.array([s.view(np.int64) for s in hasher.sets(texts)], pa.list_(pa.int64()))], names=["id", "set"])

    return docs.mapInArrow(run, "id long, set array<long>")


def branch_tokens(docs: DataFrame) -> DataFrame:
    """docs (id, text; no empty sets) -> id, tokens: the minwise values that choose branches, fresh ones for every tree and depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at, texts in _chunks(batch.column(1)):
                low = hasher.minwise(hasher.sets(texts), True).view(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(list(low), pa.list_(pa.int32()))], names=["id", "tokens"])

    return docs.mapInArrow(run, "id long, tokens array<int>")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches: their share of equal bytes, less chance hits."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def sketch_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches don't rule out a link."""
    sketches = reps.select("rep", "sketch")
    both = pairs.join(sketches.toDF("b", "sb"), "b").join(sketches.toDF("a", "sa"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, SKETCH) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(_alike(a, b) >= SKETCH_CUT))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _arrays(rows: list[dict], *columns: str) -> list[np.ndarray]:
    return [np.array([r[c] for r in rows], dtype=np.int64) for c in columns]


def by_rep(members: DataFrame, values: DataFrame) -> DataFrame:
    """members joined with values by rep, however many nodes or groups a rep is in: all its rows are one row of the join."""
    names = [c for c in members.columns if c != "rep"]
    places = members.groupBy("rep").agg(F.collect_list(F.struct(*names)).alias("places"))
    met = places.join(values, "rep").withColumn("place", F.explode("places"))
    return met.select("rep", "place.*", *[c for c in values.columns if c != "rep"])


def alike_members(members: DataFrame, small: int) -> DataFrame:
    """group_, rep, component, probe: members of nodes with a sketch near that of a member of another component.

    members: node, rep, component, sketch, n, and per node weight, main (its largest component) and main_weight. Members
    outside `main` are probes: each is compared with all members, in blocks of about `small` members (fewer if their sets are large),
    every block of members meeting every block of probes, so that no task holds a whole node. What comes out are members, at
    most each block's own, never pairs.
    """
    def parts(weight):
        return F.greatest(F.ceil(weight / small), F.lit(1)).cast("int")

    def own(blocks):
        return F.pmod(F.xxhash64("rep"), blocks).cast("int")

    def each(blocks, place):
        return F.transform(F.sequence(F.lit(0), blocks - 1), place)

    def place(block, probes_of, probe):
        return F.struct(block.alias("block"), probes_of.alias("probes_of"), F.lit(probe).alias("probe"))

    blocks, probe_blocks = parts(F.col("weight")), parts(F.col("weight") - F.col("main_weight"))
    base = each(probe_blocks, lambda k: place(own(blocks), k, False))
    probes = each(F.when(F.col("component") != F.col("main"), blocks), lambda k: place(k, own(probe_blocks), True))
    dealt = members.select("node", F.struct("rep", "component", "sketch").alias("row"), F.explode(F.concat(base, F.coalesce(probes, F.array()))).alias("at"))
    groups = dealt.select("node", "at.*", "row").groupBy("node", "block", "probes_of").agg(
        F.collect_list(F.when(F.col("probe"), F.col("row"))).alias("probes"), F.collect_list(F.when(~F.col("probe"), F.col("row"))).alias("rows"))
    groups = groups.select(F.xxhash64("node", "block", "probes_of").alias("group_"), "probes", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                group, some, all_ = (batch.column(k)[i].as_py() for k in range(3))
                if not some or not all_:
                    continue
                sketches = [np.frombuffer(b"".join(r["sketch"] for r in rows), dtype=np.uint8).reshape(-1, SKETCH) for rows in (some, all_)]
                (rep, comp), (rep_, comp_) = _arrays(some, "rep", "component"), _arrays(all_, "rep", "component")
                near, met = np.zeros(len(some), dtype=bool), np.zeros(len(all_), dtype=bool)
                for k, (c, s) in enumerate(zip(comp, sketches[0])):
                    hit = (comp_ != c) & (_alike(sketches[1], s) >= SKETCH_CUT)
                    near[k] = hit.any()
                    met |= hit
                out = [np.concatenate((rep[near], rep_[met])), np.concatenate((comp[near], comp_[met]))]
                probe = np.arange(len(out[0])) < near.sum()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(probe), group)), pa.array(out[0]), pa.array(out[1]), pa.array(probe)],
                                                 names=["group_", "rep", "component", "probe"])

    return groups.mapInArrow(run, "group_ long, rep long, component long, probe boolean")


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """docs (id, text) of ids, which may repeat, one row each. docs is read again; a Bloom filter of fixed size keeps other texts out of the shuffle.
    Copies of one id meet in salted groups first."""
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_SLOTS))
    near = bloom_hit(docs, slot, bloom(ids.select(slot.alias("slot_")), "slot_"), "hit_").where("hit_").select(
        "id", "text", (F.monotonically_increasing_id() % 64).alias("salt_"))
    return near.dropDuplicates(["id", "salt_"]).select("id", "text").join(ids.distinct(), "id").dropDuplicates(["id"])


def sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The full sets (id, set), written, of ids, which may repeat."""
    return saved(full_sets(texts_of(ids, docs)))


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a written table) that link, by their full sets, as a table of stars."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs)
    met = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"),
                                                      F.size(F.array_intersect("sa", "sb")).alias("shared"))
    out = stars(met.where((F.col("shared") * 100).cast("long") >= (F.col("na") + F.col("nb") - F.col("shared")).cast("long") * percent).select("a", "b"))
    discard(sets)
    return out


def linked_forest(probes: list[tuple], rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Of all links between probes and rows (rep, component, sorted set) of different components, as many as join the components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    sizes = np.array([len(s) for _, _, s in rows])
    tokens, owners = np.concatenate([s for _, _, s in rows]), np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    out = []
    for rep, comp, own in probes:
        first, last = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        times = last - first
        at = np.arange(int(times.sum())) + np.repeat(first - (np.cumsum(times) - times), times)
        shared = np.bincount(owners[at], minlength=len(rows))
        for k in np.flatnonzero(100 * shared >= percent * (sizes + len(own) - shared)):
            a, b = find(comp), find(rows[k][1])
            if a != b:
                root[a] = b
                out.append((rep, rows[k][0]))
    return out


def compared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the probes and the other members of each group, by full sets: a forest of each group's components.
    A rep that is both in its group comes with its set once."""
    once = members.repartition("rep").groupBy("rep", "group_", "component").agg(F.bool_or("probe").alias("probe"), F.bool_or(~F.col("probe")).alias("base"))
    met = by_rep(once, sets.withColumnRenamed("id", "rep"))
    groups = met.groupBy("group_").agg(F.collect_list(F.struct("rep", "component", "probe", "base", "set")).alias("rows")).select("rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(0)[i].values
                reps, comps, probe, base = (rows.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                sets, offsets = rows.field(4).values.to_numpy(), rows.field(4).offsets.to_numpy()
                all_ = [(int(r), int(c), sets[a:b]) for r, c, a, b in zip(reps, comps, offsets[:-1], offsets[1:])]
                links = linked_forest([x for x, p in zip(all_, probe) if p], [x for x, p in zip(all_, base) if p], percent) if base.any() else []
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], names=["a", "b"])

    return groups.mapInArrow(run, "a long, b long")


def _nodes(members: DataFrame) -> DataFrame:
    """members (tree, node, rep, n) of nodes with two or more, with low, the node's smallest rep.

    Both sides of the join are written tables, so adaptive execution can split a node that holds many members.
    """
    members = saved(members)
    stats = saved(members.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("low")).where("size > 1").drop("size"))
    out = saved(members.join(stats, "node"))
    discard(members, stats)
    return out


def mixed_members(known: DataFrame) -> DataFrame:
    """known (tree, node, rep, component, n) of nodes whose members are of two components or more, with the node's weight, main
    component and its weight, and the number outside it."""
    weight = 1 + F.col("n") / (BLOCK_SHINGLES / SMALL_NODE)
    shares = known.groupBy("node", "component").agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
    largest = F.max_by(F.struct("component", "w", "n"), F.struct("n", "component")).alias("top")
    stats = shares.groupBy("node").agg(F.sum("n").alias("size"), F.sum("w").alias("weight"), largest).where("size > top.n")
    stats = saved(stats.select("node", "weight", F.col("top.component").alias("main"), F.col("top.w").alias("main_weight"), (F.col("size") - F.col("top.n")).alias("others")))
    out = saved(known.join(stats, "node"))
    discard(stats)
    return out


def children(members: DataFrame, tokens: DataFrame, depth: int) -> DataFrame:
    """The members in the nodes below theirs: one, or two, chosen by minwise tokens of this tree and depth."""
    most = max(BRANCHES)
    met = by_rep(members.select("tree", "node", "rep", "component", "n"), tokens.withColumnRenamed("id", "rep"))

    def below(branch):
        return F.xxhash64("node", branch, F.col("tokens")[(F.col("tree") * DEPTH + depth) * most + branch])

    nodes = F.array(*[below(F.lit(k)) for k in range(BRANCHES[depth % len(BRANCHES)])])
    return met.select("tree", F.explode(nodes).alias("node"), "rep", "component", "n")


def deeper_links(nodes: DataFrame, found: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, small: int) -> DataFrame:
    """Links found in the trees below nodes (tree, node, rep, n), given stars (a, b) of the components found so far.

    A node whose members are all in one component ends. One with at most `small` members outside its largest component is compared whole.
    Others branch; what is still larger at DEPTH is compared whole too, in blocks.
    """
    known = saved(nodes.join(found.toDF("rep", "root"), "rep", "left").select("tree", "node", "rep", F.coalesce("root", "rep").alias("component"), "n"))
    ends, tokens, levels = None, None, []
    for depth in range(DEPTH + 1):
        still = mixed_members(known)
        discard(known)
        levels.append(still)
        large = F.col("others") > small if depth < DEPTH else F.lit(False)
        small_ones = still.where(~large).drop("tree", "others")
        ends = small_ones if ends is None else ends.unionByName(small_ones)
        many = still.where(large)
        if many.isEmpty():
            break
        if tokens is None:
            tokens = saved(branch_tokens(texts_of(many.select(F.col("rep").alias("id")), docs)))
        known = saved(children(many, tokens, depth))
    near = saved(alike_members(by_rep(ends, reps.select("rep", "sketch")), small))
    discard(*levels)
    sets = sets_of(near.select(F.col("rep").alias("id")), docs)
    links = saved(compared(near, sets, percent))
    discard(near, sets)
    return links


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trees: int = TREES, small: int = SMALL_NODE,
                   percent: int = PERCENT) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Documents with equal shingle sets are one class. In each of `trees` (at most TREES) independent trees a class goes to the
    node of its minwise shingle. Every node first compares its members with its smallest one; links are confirmed on full sets and
    joined to components. A node whose members are all in one component is done: it can add nothing. In others, members of
    different components are compared with each other, if at most `small` are outside the node's largest component: by sketches, then
    by full sets, within tasks that hand on a forest of links, never pairs. Nodes with more branch: each member goes on to one or two nodes
    chosen by fresh minwise shingles of this tree and depth (BRANCHES, 1.59 a level on average, above 1 / 0.75, so that the number of nodes in
    which a pair at the threshold meets grows with depth, while it shrinks for pairs less than 0.63 alike). What has not become small
    after DEPTH levels is compared whole as well, block by block. All copies of one text cost one member, and a large group of near copies
    costs comparisons in proportion to its size.

    A pair exactly at the threshold meets in a node with probability 0.75, so ten trees miss one in a million where nodes are small. Below
    six levels of branching it meets in a tree with probability 0.59, and ten trees miss one in 8,000; below nine, 0.56 and one in 3,000. Of
    128 sketch bytes, which spare most comparisons, a cut of 0.58 misses one in 100,000 such pairs, and components mostly have
    other links for these.

    Null and empty texts have no shingles and link with nothing; fewer than five words are one shingle. Rows with a null id
    link with nothing. Repeated rows are copies. An empty table gives an empty result. Other columns do not matter. If an id repeats with
    different texts, the id's links are those of all.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sig = saved(signatures(rows))
    print_ = ["f1", "f2", "n"]
    classes = saved(sig.where("n > 0 and id is not null").groupBy(*print_).agg(
        F.min("id").alias("rep"), F.first("path").alias("path"), F.first("sketch").alias("sketch")))
    reps = classes.select("rep", "n", "path", "sketch")
    starts = reps.select("rep", "n", F.posexplode(F.slice("path", 1, trees)).alias("tree", "token"))
    nodes = _nodes(starts.select("tree", F.xxhash64("tree", "token").alias("node"), "rep", "n"))
    hubs = nodes.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct()
    pairs = saved(sketch_pairs(hubs, reps))
    found = confirmed(pairs, rows, percent)
    links = deeper_links(nodes, found, reps, rows, percent, small)
    discard(nodes, pairs)
    if not links.isEmpty():
        found = stars(found.unionByName(links))

    whole = saved(classes.select(*print_, "rep").join(found.toDF("rep", "root"), "rep", "left").select(*print_, F.coalesce("root", "rep").alias("component")))
    some = sig.where("n > 0 and id is not null").select("id", *print_).join(whole, print_).select("id", "n", "component")
    discard(classes)
    none = sig.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return some.unionByName(none).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                                         F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with the columns of docs: the one with the smallest id (one row, if that repeats).

    Rows with a null id stay. A Bloom filter of the ids that go or repeat lets all other rows through without a shuffle.
    """
    out = saved(link_documents(docs, doc_id, text, **options).select("doc_id", "kept"))
    ids = out.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and("kept").alias("kept"))
    doubt = saved(ids.where("n > 1 or not kept").select(F.col("doc_id").alias("doubt_"), "kept"))
    rows, names = sealed(docs)
    key = F.col(names[doc_id])
    slot = F.pmod(F.xxhash64(key.cast("long")), F.lit(FILTER_SLOTS))
    slots = doubt.select(F.pmod(F.xxhash64("doubt_"), F.lit(FILTER_SLOTS)).alias("slot_"))
    tested = bloom_hit(rows, slot, saved(bloom(slots, "slot_")), "hit_")
    clear = tested.where(~F.col("hit_") | key.isNull())
    checked = tested.where(F.col("hit_") & key.isNotNull()).join(doubt, key.cast("long") == F.col("doubt_"), "left")
    stays = checked.where("coalesce(kept, true)").dropDuplicates([names[doc_id]])
    return opened(clear.select(*names.values()).unionByName(stays.select(*names.values())), names)
