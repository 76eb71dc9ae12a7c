"""Token ids in files of Re-Pair grammars, with random access to any range of any document."""
from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflume.llm.common import saved, scratch
from panelflume.llm.ordering import offsets, range_sorted

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 0
SHARD_IDS = 1 << 20
MIN_COUNT = 6
ROUND_RULES = 8192
ROUND_SHARE = 1024
TABLE_BITS = 18
TABLE_FACTOR = 0x9E3779B97F4A7C15
CACHE_WORDS = 1 << 19
ROW_PIECES = 64
SLICE_BYTES = 1 << 22

COLUMNS = ("part_ int, shard long, start long, n_ids long, doc_id array<long>, number array<long>, piece array<int>, more array<boolean>, "
           "payload binary")
MAGIC = b"RePair1\n"
HEADER = "<8sIIII"

WHITE = r"[\s\pZ\x0b\x1c-\x1f\x85]"
SPACES = f" {WHITE}|{WHITE} "
CUT = re.compile(r"(?<=\S) (?=\S)")


class WordEncoder:
    """Ids of whole texts, by encoding each distinct piece once.

    The vocabulary's pattern never joins characters across a single space between two non-spaces: the space always begins
    the next token. So a text's ids are those of its pieces, cut there. Ids of at most CACHE_WORDS pieces are kept.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.size = self.tokenizer.get_vocab_size()
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(self.size)])
        self._clear()

    def _clear(self) -> None:
        self.heads: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)
        self.met = np.zeros(0, dtype=np.int32)

    def _learn(self, known: dict[str, int], new: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.starts) - 1
        known.update(zip(new, range(first, first + len(new))))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(lengths))
        self.flat = np.append(self.flat, flat)
        self.met = np.append(self.met, np.zeros(len(new), dtype=np.int32))

    def _learn_heads(self, pieces: set[str]) -> None:
        """Pieces that begin a text, each encoded by itself."""
        new = list(pieces.difference(self.heads))
        if new:
            coded = [c.ids for c in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            self._learn(self.heads, new, np.array([i for c in coded for i in c], dtype=np.uint32), [len(c) for c in coded])

    def _learn_tails(self, new: list[str]) -> None:
        """New pieces that follow a space, each once. Those without another space are encoded in rows: a token that begins with a space begins a
        piece, and no other does."""
        odd = [p for p in new if not p or " " in p]
        if odd:
            coded = [c.ids for c in self.tokenizer.encode_batch_fast([" " + p for p in odd], add_special_tokens=False)]
            self._learn(self.tails, odd, np.array([i for c in coded for i in c], dtype=np.uint32), [len(c) for c in coded])
            new = [p for p in new if p and " " not in p]
        if new:
            rows = [" " + " ".join(new[k:k + ROW_PIECES]) for k in range(0, len(new), ROW_PIECES)]
            flat = np.fromiter(chain.from_iterable(c.ids for c in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)), dtype=np.uint32)
            begins = np.flatnonzero(self.spaced[flat])
            self._learn(self.tails, new, flat, np.diff(np.append(begins, len(flat))))

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, with END after them. Texts where a space meets other white space are cut one by one."""
        if len(self.starts) > CACHE_WORDS:
            self._forget()
        spaced = pc.match_substring_regex(texts, SPACES).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for rows, cut in ((np.flatnonzero(~spaced), lambda some: pc.split_pattern(some, " ")),
                          (np.flatnonzero(spaced), lambda some: pa.array([CUT.split(t) for t in some.to_pylist()], pa.list_(pa.string())))):
            if len(rows):
                for row, ids in zip(rows, self._of_pieces(cut(texts.take(pa.array(rows))))):
                    out[row] = ids
        return out

    def _forget(self) -> None:
        """Drops the pieces met in one slice only, or all if too few are dropped."""
        again = self.met > 1
        if again.sum() > CACHE_WORDS // 2:
            again[:] = False
        kept = [p for p, i in self.tails.items() if again[i]] if again.any() else []
        index = np.fromiter(map(self.tails.__getitem__, kept), dtype=np.int64, count=len(kept))
        flat, starts = self.flat, self.starts
        self._clear()
        lengths = np.diff(starts)[index]
        ends = np.cumsum(lengths)
        at = np.arange(int(lengths.sum())) + np.repeat(starts[index] - (ends - lengths), lengths)
        self._learn(self.tails, kept, flat[at], lengths)

    def _of_pieces(self, pieces: pa.ListArray) -> list[np.ndarray]:
        words, firsts = pieces.flatten(), pieces.offsets.to_numpy()[:-1] - pieces.offsets[0].as_py()
        counts = np.diff(pieces.offsets.to_numpy())
        is_tail = np.ones(len(words), dtype=bool)
        is_tail[firsts] = False
        heads = words.take(pa.array(firsts)).to_pylist()
        tails = words.filter(pa.array(is_tail)).dictionary_encode()
        kinds = strings(tails.dictionary)
        self._learn_heads({*heads, ""})
        known = np.fromiter(map(self.tails.get, kinds, repeat(-1)), dtype=np.int64, count=len(kinds))
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            new = [kinds[i] for i in unknown.tolist()]
            self._learn_tails(new)
            known[unknown] = np.fromiter(map(self.tails.__getitem__, new), dtype=np.int64, count=len(new))
        # each text: its pieces, and an empty one in whose place END goes
        at = np.cumsum(counts + 1) - (counts + 1)
        which = np.full(len(words) + len(heads), self.heads[""], dtype=np.int64)
        which[at] = [self.heads[h] for h in heads]
        inner = np.ones(len(which), dtype=bool)
        inner[at] = inner[at + counts] = False
        self.met[known] += 1
        which[inner] = known[tails.indices.to_numpy()]
        lengths = np.diff(self.starts)[which]
        lengths[at + counts] = 1
        ends = np.cumsum(lengths)
        source = np.arange(int(ends[-1])) + np.repeat(self.starts[which] - (ends - lengths), lengths)
        last = ends[at + counts] - 1
        source[last] = 0
        out = self.flat[source] if len(self.flat) else np.zeros(len(source), dtype=np.uint32)
        out[last] = END
        return np.split(out, last[:-1] + 1)


def strings(column: pa.Array) -> list[str]:
    """column.to_pylist(), by one join and one split where no string holds a space."""
    if len(column) == 0 or pc.any(pc.match_substring(column, " ")).as_py():
        return column.to_pylist()
    whole = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


def kept_encoder(vocabulary) -> WordEncoder:
    """The encoder of this Python worker: workers serve one task after another, so a vocabulary is loaded and common pieces are
    encoded once per worker. Modules shipped by value don't outlive a task, hence the named one."""
    import sys
    import types
    kept = sys.modules.setdefault("panelflume_kept", types.ModuleType("panelflume_kept"))
    if getattr(kept, "vocabulary", None) != vocabulary.value:
        kept.vocabulary, kept.encoder = vocabulary.value, WordEncoder(vocabulary.value)
    return kept.encoder


def _chosen(codes: np.ndarray, counts: np.ndarray, wide: int, room: int) -> list[tuple[int, int]]:
    """Frequent pairs, most frequent first, such that no symbol is the left of one and the right of another: their occurrences never
    overlap, but in runs of one symbol."""
    floor = max(MIN_COUNT, int(counts.max(initial=0)) // ROUND_SHARE)
    keep = np.flatnonzero(counts >= floor)
    keep = keep[np.lexsort((codes[keep], -counts[keep]))][:2 * ROUND_RULES]
    lefts: set[int] = set()
    rights: set[int] = set()
    twins: set[int] = set()
    out = []
    for code in codes[keep].tolist():
        a, b = divmod(code, wide)
        if a == b:
            fits = a not in lefts and a not in rights
            twins.update([a] * fits)
        else:
            fits = a not in rights and b not in lefts and a not in twins and b not in twins
            if fits:
                lefts.add(a)
                rights.add(b)
        if fits:
            out.append((a, b))
            if len(out) == min(room, ROUND_RULES):
                break
    return out


def _matches(codes: np.ndarray, inside: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where codes inside documents are wanted ones, in order, and which: a hashed table finds them, and the few that lost their slot to
    another are searched for among what the table leaves over."""
    bits, kind = 8 * codes.itemsize, codes.dtype.type
    factor, shift = kind(TABLE_FACTOR >> (64 - bits) | 1), kind(bits - TABLE_BITS)

    def slots(c):
        return (c * factor) >> shift

    table = np.zeros(1 << TABLE_BITS, dtype=np.uint16)
    own = slots(wanted)
    table[own[::-1]] = np.arange(len(wanted), 0, -1)
    at = np.flatnonzero((rank := table[slots(codes)]).astype(bool) & inside)
    rank = rank[at].astype(np.int64) - 1
    hit = wanted[rank] == codes[at]
    lost = np.flatnonzero(table[own] != np.arange(1, len(wanted) + 1))
    if len(lost):
        lost = lost[np.argsort(wanted[lost])]
        left = np.flatnonzero(~hit)
        found = lost[np.minimum(np.searchsorted(wanted[lost], codes[at[left]]), len(lost) - 1)]
        rank[left] = found
        hit[left] = wanted[found] == codes[at[left]]
    return at[hit], rank[hit]


def compress(ids: np.ndarray, sizes: np.ndarray, base: int) -> bytes:
    """A shard: documents of `sizes` ids, all below base, as a grammar of pairs.

    In each round the most frequent pairs that don't get in each other's way become nonterminals (base and up), until no pair is
    frequent enough to pay for its rule. Pairs never reach across documents. After the header: the rules' left and right symbols,
    their expansion lengths, each document's number of ids and of symbols, the symbols.
    """
    wide = 1 << 16
    kind, code_kind = (np.uint16, np.uint32)
    if base + ROUND_RULES > wide:
        wide, kind, code_kind = 1 << 32, np.uint32, np.uint64
    symbols = ids.astype(kind)
    ends = np.zeros(len(ids), dtype=bool)
    ends[np.cumsum(sizes) - 1] = True
    left, right, expanded = [], [], []
    while base + len(left) < wide:
        inside = ~ends[:-1]
        codes = (symbols[:-1].astype(code_kind) * code_kind(wide) + symbols[1:])
        seen = np.sort(codes[inside])
        edges = np.flatnonzero(np.concatenate(([True], seen[1:] != seen[:-1]))) if len(seen) else np.zeros(0, dtype=np.int64)
        pairs = _chosen(seen[edges], np.diff(np.append(edges, len(seen))), wide, wide - base - len(left))
        if not pairs:
            break
        wanted = np.array([a * wide + b for a, b in pairs], dtype=code_kind)
        at, rank = _matches(codes, inside, wanted)
        run = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))  # overlaps: every second of a run
        keep = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0
        at, rank = at[keep], rank[keep]
        lengths = np.array(expanded, dtype=np.int64)
        for a, b in pairs:
            expanded.append((1 if a < base else int(lengths[a - base])) + (1 if b < base else int(lengths[b - base])))
        symbols[at] = (base + len(left) + rank).astype(kind)
        left += [a for a, _ in pairs]
        right += [b for _, b in pairs]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        ends[at] |= ends[at + 1]
        symbols, ends = symbols[stay], ends[stay]
    per_doc = np.diff(np.concatenate(([0], np.flatnonzero(ends) + 1)))
    rules = np.array([left, right], dtype=kind)
    return b"".join([struct.pack(HEADER, MAGIC, base, len(left), len(sizes), len(symbols)), rules.tobytes(), np.array(expanded, dtype=np.uint32).tobytes(),
                     sizes.astype(np.uint32).tobytes(), per_doc.astype(np.uint32).tobytes(), symbols.tobytes()])


class Shard:
    """A compressed shard, opened without expanding it."""

    def __init__(self, payload: bytes):
        magic, self.base, rules, docs, symbols = struct.unpack_from(HEADER, payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        kind = np.dtype(np.uint16 if self.base + ROUND_RULES <= 1 << 16 else np.uint32)
        parts, at = [], struct.calcsize(HEADER)
        for dtype, n in ((kind, rules), (kind, rules), (np.uint32, rules), (np.uint32, docs), (np.uint32, docs), (kind, symbols)):
            parts.append(np.frombuffer(payload, dtype, n, at))
            at += parts[-1].nbytes
        self.left, self.right, self.expanded, self.sizes, per_doc, self.symbols = parts
        self.first = np.concatenate(([0], np.cumsum(per_doc, dtype=np.int64)))
        self._rules = None

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self.base
        out[rule] = self.expanded[symbols[rule] - self.base]
        return out

    def rules(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rules, one after the other, and where each begins: made on first use, by replacing nonterminals until none
        is left."""
        if self._rules is None:
            out = np.arange(len(self.left), dtype=np.uint32) + self.base
            while True:
                rule = out >= self.base
                if not rule.any():
                    break
                width = rule.astype(np.int64) + 1
                at = np.cumsum(width) - width
                wider = np.empty(int(width.sum()), dtype=np.uint32)
                number = out[rule] - self.base
                wider[at[~rule]] = out[~rule]
                wider[at[rule]] = self.left[number]
                wider[at[rule] + 1] = self.right[number]
                out = wider
            ends = np.cumsum(self.expanded, dtype=np.int64)
            self._rules = out, ends - self.expanded
        return self._rules

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of symbols."""
        flat, begins = self.rules()
        lengths = self.lengths(symbols)
        ends = np.cumsum(lengths)
        out = np.repeat(symbols.astype(np.uint32), lengths)
        rule = out >= self.base
        source = np.arange(len(out)) + np.repeat(np.where(symbols < self.base, 0, begins[np.maximum(symbols, self.base) - self.base] if len(begins) else 0) - (ends - lengths), lengths)
        out[rule] = flat[source[rule]]
        return out

    def read(self, doc: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids begin to end of a document: expansion lengths say which symbols cover them; no other is expanded."""
        symbols = self.symbols[self.first[doc]:self.first[doc + 1]]
        end = int(self.sizes[doc]) if end is None else min(end, int(self.sizes[doc]))
        if begin >= end:
            return np.zeros(0, dtype=np.uint32)
        ends = np.cumsum(self.lengths(symbols))
        a, b = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, end, "left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[begin - skipped:end - skipped]


def write(docs: DataFrame, folder: str | None = None, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """Encodes docs (doc_id, text) into shards under `folder` (a fresh one of the shared scratch folder by default), and returns the
    table of shards read back: part_, shard, start (ids before it in the part), n_ids, doc_id, number (documents before it in the part),
    piece, more, payload.

    Ids stand in ascending order of doc_id (null first), then text; a part is a range of that order, a shard about SHARD_IDS ids of it.
    A document of more ids has pieces in several shards. Every document ends with END; null and empty texts are END alone.
    Repeated rows are documents of their own. An empty table makes no shard; other columns do not matter. The files are written by
    Spark's own committer, so lost tasks leave nothing behind, into any store that Spark can write. A task holds one shard.
    The vocabulary file is read by the driver and broadcast (its size is that of one vocabulary).
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = range_sorted(rows.withColumn("order", F.xxhash64("text")), ["doc_id", "order"]).select("part_", "doc_id", "text")
    schema = pa.schema([("part_", pa.int32()), ("shard", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                        ("number", pa.list_(pa.int64())), ("piece", pa.list_(pa.int32())), ("more", pa.list_(pa.bool_())), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, number, shard, start = None, 0, 0, 0, 0
        held: list[tuple] = []
        size = 0

        def closed():
            ids, about = [h[0] for h in held], [h[1:] for h in held]
            columns = [list(c) for c in zip(*about)]
            payload = compress(np.concatenate(ids), np.array([len(i) for i in ids]), encoder.size)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([part, shard, start, size, *columns, payload], schema)], schema=schema)

        for batch in batches:
            for at, texts in slices(batch.column(2)):
                encoder = encoder or kept_encoder(vocabulary)
                part = batch.column(0)[at].as_py()
                for doc_id, ids in zip(batch.column(1).slice(at, len(texts)).to_pylist(), encoder.ids(texts)):
                    piece = 0
                    while True:
                        take = SHARD_IDS - size
                        held.append((ids[:take], doc_id, number, piece, len(ids) > take))
                        size += len(held[-1][0])
                        ids = ids[take:]
                        if size == SHARD_IDS:
                            yield closed()
                            shard, start, held, size = shard + 1, start + size, [], 0
                        if not len(ids):
                            break
                        piece += 1
                    number += 1
        if held:
            yield closed()

    folder = folder or scratch(spark)
    dealt.mapInArrow(run, COLUMNS).write.parquet(folder)
    return read(spark, folder)


def slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a text column of about SLICE_BYTES, with the place of their first row."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield at, column.slice(at, to - at)
        at = to


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(folder)


def crc_shift(crc: int, n: int) -> int:
    """The crc32 state after n zero bytes, without the usual inversions, by squaring the matrix of one zero bit."""
    matrix = [0xEDB88320] + [1 << k for k in range(31)]

    def times(rows: list[int], v: int) -> int:
        out, k = 0, 0
        while v:
            if v & 1:
                out ^= rows[k]
            v >>= 1
            k += 1
        return out

    n *= 8
    while n:
        if n & 1:
            crc = times(matrix, crc)
        matrix = [times(matrix, r) for r in matrix]
        n >>= 1
    return crc


def crc_joined(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two strings in a row, from those of each."""
    return crc_shift(first, second_bytes) ^ second


def read_back(shards: DataFrame) -> DataFrame:
    """shards -> per document doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files alone.

    Parts are summed up first, then numbered through (a row per part). Documents in several shards join their pieces' counts
    and checksums; no task holds more than a shard.
    """
    schema = pa.schema([("part_", pa.int32()), ("number", pa.int64()), ("piece", pa.int32()), ("more", pa.bool_()), ("doc_id", pa.int64()),
                        ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, start, doc_id, number, piece, more, payload = (c[row].as_py() for c in batch.columns)
                shard = Shard(payload)
                sizes = shard.sizes.astype(np.int64)
                whole, ends = memoryview(shard.expand(shard.symbols).astype("<u4").tobytes()), (4 * np.cumsum(sizes)).tolist()
                crcs = [zlib.crc32(whole[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(sizes), pa.int32()), pa.array(number, pa.int64()), pa.array(piece, pa.int32()), pa.array(more, pa.bool_()),
                    pa.array(doc_id, pa.int64()), pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(crcs, pa.int64())], schema=schema)

    pieces = saved(shards.select("part_", "start", "doc_id", "number", "piece", "more", "payload").mapInArrow(
        run, "part_ int, number long, piece int, more boolean, doc_id long, at long, n long, crc long"))

    @F.udf("long")
    def joined(parts):
        total = 0
        for p in parts:
            total = crc_joined(total, p["crc"], 4 * p["n"])
        return total

    whole = pieces.where("piece = 0 and not more").select("part_", "doc_id", "at", "n", "crc")
    split = pieces.where("piece > 0 or more").groupBy("part_", "number").agg(
        F.min("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("parts"))
    rows = whole.unionByName(split.select("part_", "doc_id", "at", "n", joined("parts").alias("crc")))
    before = offsets(shards.groupBy("part_").agg(F.sum("n_ids").alias("n")), None)
    start = F.col("at") + F.coalesce("before_", F.lit(0))
    return rows.join(F.broadcast(before), "part_", "left").select(
        "doc_id", start.alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
