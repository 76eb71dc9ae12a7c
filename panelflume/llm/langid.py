"""Language identification by cross-parsing: how few phrases of a language's sample text spell out a document."""
from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelflume.llm.common import discard, saved, sealed

SAMPLE_LETTERS = 49_152
SLICE_CHARS = 768
BLOCK = 8192
LANES = 2048
PIECE = 1 << 20
GROUP_LETTERS = 1 << 24
TRIES = 32
CODE_POINTS = 0x110000
SPACE, NEW_LETTER = 0, 1
UNKNOWN = "und"


def letter(ch: str) -> str:
    """A letter or combining mark in lower case, any other character as a space: one for one, whatever stands beside it."""
    if ch.isalpha():
        return ch.lower()[0]
    return ch if ch > "\x7f" and unicodedata.category(ch)[0] == "M" else " "


def normalise(text: str) -> str:
    """Lower case; every run of other characters than letters and their marks is one space."""
    return " ".join("".join(map(letter, text)).split())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads every substring of codes; state 0 is the start."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return nexts


class Slots:
    """Transitions of many states in one row of slots: state s goes by code c through slot base[s] + c, if that slot is its own.

    Only transitions that exist take room, so an alphabet may be as large as its scripts are. States with several
    transitions are placed first (after TRIES crowded places the search moves on), those with one fill the gaps.
    """

    def __init__(self, width: int):
        self.width, self.taken = width, bytearray(width)
        self.open, self.gap = 0, 0
        self.at: list[int] = []
        self.entry: list[int] = []

    def place(self, rows: list[dict[int, int]], first: int) -> np.ndarray:
        """rows: transitions of the states first, first + 1, ... among them; the start state, rows[0], is left out. Their bases."""
        base = np.zeros(len(rows), dtype=np.int64)
        several = sorted((s for s in range(1, len(rows)) if len(rows[s]) > 1), key=lambda s: -len(rows[s]))
        for s in several:
            base[s] = self._fit(sorted(rows[s]))
        single = [s for s in range(1, len(rows)) if len(rows[s]) == 1]
        for s in single:
            c = next(iter(rows[s]))
            slot = self._free(max(self.gap, c))
            self.taken[slot] = 1
            base[s] = slot - c
            if c <= self.gap:
                self.gap = slot + 1
        for s in several + single:
            for c, q in rows[s].items():
                self.at.append(int(base[s]) + c)
                self.entry.append((first + s) << 32 | (first + q))
        return base

    def _free(self, at: int) -> int:
        """The first free slot from `at` on, with room for a whole row behind it."""
        slot = self.taken.find(0, at)
        slot = max(len(self.taken), at) if slot < 0 else slot
        if slot + self.width > len(self.taken):
            self.taken.extend(bytes(max(slot + self.width - len(self.taken), len(self.taken))))
        return slot

    def _fit(self, codes: list[int]) -> int:
        low, slot, tries = codes[0], self.open, 0
        while True:
            slot = self._free(max(slot, low))
            if not any(self.taken[slot - low + c] for c in codes):
                for c in codes:
                    self.taken[slot - low + c] = 1
                return slot - low
            slot, tries = slot + 1, tries + 1
            if tries == TRIES:
                self.open, tries = slot, 0

    def table(self) -> np.ndarray:
        """By slot: state << 32 | next state, or -1 where free; free slots for a whole row follow the last one."""
        out = np.full(max(self.at, default=0) + self.width + 1, -1, dtype=np.int64)
        out[self.at] = self.entry
        return out


class Model(NamedTuple):
    """langs in order; alphabet: code of every letter in any sample; start state of each language; bases of all states and
    their slots; entered: where each language's start goes by each code (itself, if no phrase begins so); bits a phrase costs."""
    langs: list[str]
    alphabet: dict[str, int]
    starts: np.ndarray
    base: np.ndarray
    slots: np.ndarray
    entered: np.ndarray
    bits: np.ndarray


def letter_code(ch: str, alphabet: dict[str, int]) -> int:
    return SPACE if ch == " " else alphabet.get(ch, NEW_LETTER)


def train(samples: dict[str, str]) -> Model:
    """samples: language -> normalised text. Letters that no sample has share one code, which no phrase contains.

    Naming a phrase takes a place in the sample and, where it is a single letter, the letter, so it is charged
    log2(sample length + 1) + log2(alphabet) bits. Samples of one length are thus ranked by phrases alone, and a language
    with little text is neither held back by its size nor favoured.
    """
    langs = sorted(samples)
    seen = sorted({c for lang in langs for c in samples[lang]} - {" "})
    alphabet = {c: NEW_LETTER + 1 + i for i, c in enumerate(seen)}
    width = NEW_LETTER + 1 + len(alphabet)
    slots, bases, starts = Slots(width), [], []
    entered = np.empty((len(langs), width), dtype=np.int64)
    states = 0
    for i, lang in enumerate(langs):
        rows = suffix_automaton([letter_code(c, alphabet) for c in samples[lang]])
        entered[i] = states
        for c, q in rows[0].items():
            entered[i, c] = states + q
        bases.append(slots.place(rows, states))
        starts.append(states)
        states += len(rows)
    bits = np.log2([len(samples[lang]) + 1 for lang in langs]) + np.log2(width)
    return Model(langs, alphabet, np.array(starts, dtype=np.int64), np.concatenate(bases) if bases else np.zeros(0, dtype=np.int64),
                 slots.table(), entered, bits)


def code_table(model: Model) -> np.ndarray:
    """Code of every code point."""
    table = np.zeros(CODE_POINTS, dtype=np.uint16 if len(model.alphabet) < 65_000 else np.uint32)
    for cp in range(CODE_POINTS):
        table[cp] = letter_code(letter(chr(cp)), model.alphabet)
    return table


def encode(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of the normalised text, made a piece of the text at a time."""
    parts, after_space = [], True
    for at in range(0, len(text), PIECE):
        codes = table[np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        keep = codes != SPACE
        ends_in_space = not keep[-1]
        keep[1:] |= keep[:-1].copy()
        keep[0] |= not after_space
        after_space = ends_in_space
        parts.append(codes[keep])
    codes = np.concatenate(parts) if parts else np.zeros(0, dtype=table.dtype)
    return codes[:-1] if len(codes) and codes[-1] == SPACE else codes


def walk(blocks: list[np.ndarray], begin: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that begin in each block and the state after it, per language (rows) and block (columns), from the states in
    begin. LANES blocks of like length step through their letters together in all languages. Where a state has no
    transition its phrase is over, and the next begins with that letter."""
    counts, ends = np.zeros(begin.shape, dtype=np.int64), begin.copy()
    by_size = np.argsort([-len(b) for b in blocks], kind="stable")
    for lane in range(0, len(blocks), LANES):
        order = by_size[lane:lane + LANES]
        sizes = np.array([len(blocks[i]) for i in order])
        grid = np.zeros((sizes[0], len(order)), dtype=blocks[order[0]].dtype)
        for col, i in enumerate(order):
            grid[:sizes[col], col] = blocks[i]
        live = np.searchsorted(-sizes, -np.arange(1, len(grid) + 1), side="right")
        state, begun = begin[:, order], np.zeros((len(begin), len(order)), dtype=np.int64)
        for t, k in enumerate(live):
            codes, now = grid[t, :k].astype(np.int64), state[:, :k]
            entry = model.slots.take(model.base.take(now) + codes)
            over = (entry >> 32) != now
            begun[:, :k] += over
            state[:, :k] = np.where(over, model.entered.take(codes, axis=1), entry & 0xFFFFFFFF)
        counts[:, order], ends[:, order] = begun, state
    return counts, ends


def phrase_counts(docs: list[np.ndarray], model: Model) -> np.ndarray:
    """Phrases of each document (rows) in each language, of whole texts: the state is carried from block to block.

    All blocks are walked side by side as if a phrase began with each, then those after a document's first again from the
    states their predecessors came to. Parses soon fall into step, so that is seldom another state than the final one; a
    last sweep in order walks a block once more where it is.
    """
    blocks, owner, nth = [], [], []
    for i, codes in enumerate(docs):
        for at in range(0, len(codes), BLOCK):
            blocks.append(codes[at:at + BLOCK])
            owner.append(i)
            nth.append(at // BLOCK)
    out = np.zeros((len(docs), len(model.langs)), dtype=np.int64)
    if not blocks:
        return out
    place = np.array(nth)
    begin = np.repeat(model.starts[:, None], len(blocks), axis=1)
    counts, ends = walk(blocks, begin, model)

    def settle(some: np.ndarray) -> None:
        some = some[(begin[:, some] != ends[:, some - 1]).any(axis=0)]
        if len(some):
            begin[:, some] = ends[:, some - 1]
            counts[:, some], ends[:, some] = walk([blocks[i] for i in some], begin[:, some], model)

    settle(np.flatnonzero(place > 0))
    for n in range(2, place.max() + 1):
        settle(np.flatnonzero(place == n))
    np.add.at(out, np.array(owner), counts.T)
    return out


def identify(texts: list[str | None], model: Model, table: np.ndarray) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    langs: list[str] = [UNKNOWN] * len(texts)
    scores = [0.0] * len(texts)
    group: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        for (i, codes), phrases in zip(group, phrase_counts([codes for _, codes in group], model)):
            costs = phrases * model.bits
            best = int(np.argmin(costs))  # the first of equals
            rest = np.delete(costs, best)
            langs[i] = model.langs[best]
            scores[i] = float(1 - costs[best] / rest.min()) if len(rest) else 1.0
        group.clear()

    held = 0
    for i, text in enumerate(texts):
        if model.langs and text and any(map(str.isalpha, text)):
            group.append((i, encode(text, table)))
            held += len(group[-1][1])
            if held >= GROUP_LETTERS:
                flush()
                held = 0
    flush()
    return langs, scores


def sample_texts(docs: DataFrame, letters: int = SAMPLE_LETTERS, slice_chars: int = SLICE_CHARS) -> dict[str, str]:
    """A bounded sample per language: `letters` letters, or nearly all there are where a language has fewer.

    docs: text, lang. Each different text, however often it is repeated, counts once as consecutive slices of slice_chars.
    Slices follow in the order of a hash of the text and their number until the language is full, so all languages are
    filled to the same length, from many texts or from one. Only slices with small hashes (about four times the
    sample) are cut out and ordered.
    """
    rows = docs.toDF("text", "lang").where("lang is not null and length(text) > 0").select(
        "lang", "text", F.xxhash64("text").alias("hash_"), F.length("text").alias("chars_"))
    each = rows.groupBy("lang", "hash_").agg(F.max("chars_").alias("chars_"))
    totals = saved(each.groupBy("lang").agg(F.sum("chars_").alias("total_")))

    def place(n):
        return F.shiftrightunsigned(F.xxhash64("hash_", n), 1)

    last = F.floor((F.col("chars_") - 1) / F.lit(slice_chars)).cast("int")
    near = F.filter(F.sequence(F.lit(0), last), lambda n: place(n).cast("double") * F.col("total_") < 4.0 * letters * 2.0 ** 63)
    chosen = rows.join(totals, "lang").select("lang", "text", "hash_", F.explode(near).alias("n_"))
    cut = F.substring("text", F.col("n_") * slice_chars + 1, F.lit(slice_chars))
    slices = chosen.select("lang", place(F.col("n_")).alias("at_"), F.regexp_replace(cut, r"[^\p{L}\p{M}]+", " ").alias("slice_"))
    few = slices.groupBy("lang", "at_").agg(F.min("slice_").alias("slice_"))
    before = Window.partitionBy("lang").orderBy("at_").rowsBetween(Window.unboundedPreceding, -1)
    got = few.withColumn("before_", F.coalesce(F.sum(F.length("slice_")).over(before), F.lit(0))).where(F.col("before_") < letters).collect()
    discard(totals)
    out: dict[str, list[str]] = {}
    for r in sorted(got, key=lambda r: (r["lang"], r["before_"], r["at_"])):
        out.setdefault(r["lang"], []).append(normalise(r["slice_"]))
    return {lang: " ".join(p for p in parts if p)[:letters] for lang, parts in out.items() if any(parts)}


def predict_language(docs: DataFrame, samples: dict[str, str], text: str = "text") -> DataFrame:
    """docs with lang_pred and score.

    For every language the whole text is cut greedily into the longest phrases that occur in the language's sample; the one
    whose phrases cost the fewest bits wins (see train; the first by name of equals). Score: the share of the cost saved
    against the runner-up, 0 to 1, and 1 if only one language was learned. Null texts, texts without a letter and a model
    without languages give `und` and 0. An empty table gives an empty one; repeated rows are predicted alike, and a sample
    counts a repeated text once. Columns of docs named like a result column are replaced by it. Long texts are coded a
    piece at a time into two bytes a letter. The automata depend on the bounded samples only and go to the executors as
    one broadcast.
    """
    docs = docs.drop("lang_pred", "score")
    model = train(samples)
    shared = docs.sparkSession.sparkContext.broadcast((model, code_table(model)))
    rows, names = sealed(docs)
    at = rows.columns.index(names[text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, table = shared.value
        for batch in batches:
            langs, scores = identify(batch.column(at).to_pylist(), m, table)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", lang_pred string, score double"
    return rows.mapInArrow(run, schema).toDF(*docs.columns, "lang_pred", "score")
