"""Repair of conversation structure at least cost, by tables of whole blocks of turns (Four Russians)."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelflume.llm.common import saved
from panelflume.llm.ordering import numbered

FAR = 1 << 20
BLOCK = 4
SEGMENT = 4096
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

# States of a repaired conversation: 0 nothing yet, 1 after the system turn, 2 after a user's, 3 after an assistant's.
TURN = (2, 2, 3, 2)
ACCEPTS = (True, False, False, True)
# A symbol is a role (0 system, 1 user, 2 assistant, 3 other) plus 4 where the text is cut off; 8 is a turn that must go.
SYMBOLS = 9
ROLE_NAMES = {2: "user", 3: "assistant"}
ONLY = [np.where(np.arange(4) == q, 0, FAR) for q in range(4)]


def kept_to(state: int, role: int) -> int | None:
    """State after a turn that keeps its role, if it may stand here."""
    if role == 0:
        return 1 if state == 0 else None
    return TURN[state] if role + 1 == TURN[state] else None


def inserted(cost: np.ndarray) -> np.ndarray:
    """Costs to go with turns inserted first, as many as pay."""
    cost = cost.copy()
    for _ in range(3):
        cost = np.minimum(cost, cost[list(TURN)] + INSERT)
    return np.minimum(cost, FAR)


def stepped(after: np.ndarray, symbol: int) -> np.ndarray:
    """Costs to go before a turn, from those after it."""
    before = after + DELETE
    if symbol < 8:
        cut = CUT * (symbol >> 2)
        for state in range(4):
            to = kept_to(state, symbol & 3)
            if to is not None:
                before[state] = min(before[state], after[to] + cut)
            before[state] = min(before[state], after[TURN[state]] + REROLE + cut)
    return inserted(np.minimum(before, FAR))


def end_costs() -> np.ndarray:
    return inserted(np.where(ACCEPTS, 0, FAR))


class BlockTables:
    """Transitions of normalised cost vectors for every block of BLOCK symbols.

    Costs to go differ by little from state to state, so less their least only a few vectors occur. All that can be reached
    from the end of a conversation, or from a single state (for segments whose end is not known yet), are numbered;
    `jump[vector, block]` is the vector before the block and `added` what the least cost grows by.
    """

    def __init__(self):
        self.vectors: list[np.ndarray] = []
        self.number: dict[tuple, int] = {}
        for v in [end_costs(), *ONLY]:
            self._place(v)
        step, grew = [], []
        while len(step) < len(self.vectors):
            found = [self._place(stepped(self.vectors[len(step)], s)) for s in range(SYMBOLS)]
            step.append([n for n, _ in found])
            grew.append([low for _, low in found])
        self.step, self.grew = np.array(step), np.array(grew)
        self.jump, self.added = self.step, self.grew
        for _ in range(BLOCK - 1):  # a symbol in front of all shorter blocks
            self.added = (self.added[:, None, :] + self.grew[self.jump].transpose(0, 2, 1)).reshape(len(step), -1)
            self.jump = self.step[self.jump].transpose(0, 2, 1).reshape(len(step), -1)

    def _place(self, vector: np.ndarray) -> tuple[int, int]:
        """The number of a vector less its least cost, and that cost."""
        low = int(vector.min())
        key = tuple(int(v) - low if v < FAR else FAR for v in vector)
        if key not in self.number:
            self.number[key] = len(self.vectors)
            self.vectors.append(np.array(key))
        return self.number[key], low

    def find(self, vector: np.ndarray) -> int:
        return self.number[tuple(int(v) for v in vector)]

    def passed(self, symbols: np.ndarray, vector: int) -> tuple[np.ndarray, int, int]:
        """(vector after each block, vector before all symbols, cost added). Blocks are looked up from the last to the first; symbols
        beyond the last whole block come singly."""
        whole = len(symbols) // BLOCK
        total = 0
        for s in symbols[whole * BLOCK:][::-1]:
            total += int(self.grew[vector, s])
            vector = int(self.step[vector, s])
        codes = symbols[:whole * BLOCK].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
        after = np.empty(whole, dtype=np.int64)
        for k in range(whole - 1, -1, -1):
            after[k] = vector
            total += int(self.added[vector, codes[k]])
            vector = int(self.jump[vector, codes[k]])
        return after, vector, total

    def between(self, symbols: np.ndarray, after: int) -> list[int]:
        """A block expanded backward: the vector after each of its symbols."""
        out = [after]
        for s in symbols[:0:-1]:
            out.append(int(self.step[out[-1], s]))
        return out[::-1]

    def trace(self, symbols: np.ndarray, vector: int, state: int, last: bool) -> tuple[list[str], str, int]:
        """Of the cheapest edits from a state the ASCII-least: per turn the state before it and its edits, the same for what
        follows the last turn of a conversation, and the state at the end. vector: the costs to go after the last symbol."""
        whole = len(symbols) // BLOCK * BLOCK
        rest = self.between(symbols[whole:], vector) if whole < len(symbols) else []
        after, _, _ = self.passed(symbols[:whole], int(self.step[rest[0], symbols[whole]]) if rest else vector)
        edits = []
        for k in range(0, len(symbols), BLOCK):
            part = symbols[k:k + BLOCK]
            for s, v in zip(part, self.between(part, int(after[k // BLOCK])) if k < whole else rest):
                text, to = choose(self.vectors[v], int(s), state)
                edits.append(f"{state}{text}")
                state = to
        tail = str(state)
        while last and not ACCEPTS[state]:
            tail, state = tail + "I", TURN[state]
        return edits, tail, state


def choose(after: np.ndarray, symbol: int, state: int) -> tuple[str, int]:
    """The edits at one turn: of the cheapest, the least letter each time (D, I, K, R)."""
    text = ""
    before = stepped(after, symbol)
    while True:
        best = before[state]
        cut = CUT * (symbol >> 2)
        if after[state] + DELETE == best:
            return text + "D", state
        if before[TURN[state]] + INSERT == best:
            text, state = text + "I", TURN[state]
            continue
        to = kept_to(state, symbol & 3) if symbol < 8 else None
        if to is not None and after[to] + cut == best:
            return text + "K", to
        return text + "R", TURN[state]


def fields(turns: DataFrame) -> DataFrame:
    """turns as key (the conversation as text), turn, role, text, with one space for null roles and texts."""
    space = F.lit(" ")
    return turns.select(F.coalesce(F.col("conv_id").cast("string"), space).alias("key"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Faults planted by crc32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats the
    row, 4 makes it the user's."""
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat("key", F.lit(":"), turn).cast("binary")) % 20
    out = rows.withColumn("kind", kind).where("kind <> 0")
    out = out.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    out = out.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return out.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def diagnosed(rows: DataFrame) -> DataFrame:
    """rows (key, turn, role, text) in order, written: place_ in the conversation and the row's first fault.

    A conversation of any length spreads over ranges of turns. Whether role and text were seen earlier is told by the least place of
    each (conversation, role, digest), which is summed up before it is shuffled.
    """
    digest = F.sha2(F.concat_ws("\n", F.hex("role"), "text").cast("binary"), 256)
    placed = saved(numbered(saved(rows.withColumn("digest", digest)), "key", ["turn", "role", "text"]))
    firsts = placed.groupBy("key", "digest").agg(F.min("place_").alias("first_"), F.count("*").alias("n_")).where("n_ > 1").drop("n_")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, BLANK).when(F.col("place_") > F.col("first_"), DUPLICATE).when(cut, TRUNCATED).otherwise(0)
    return saved(placed.join(firsts, ["key", "digest"], "left").withColumn("fault", fault).drop("first_", "digest"))


def symbol() -> Column:
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.when(F.col("fault").isin(BLANK, DUPLICATE), 8).otherwise(role + F.when(F.col("fault") == TRUNCATED, 4).otherwise(0))


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def summaries(segments: DataFrame) -> DataFrame:
    """What a segment costs from each state to each state: 16 numbers in place of up to SEGMENT turns."""
    schema = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("costs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = BlockTables()
        for batch in batches:
            out = []
            for key, segment, symbols in zip(*(batch.column(i).to_pylist() for i in range(3))):
                columns = []
                for q in range(4):
                    _, v, added = tables.passed(np.array(symbols), tables.find(ONLY[q]))
                    columns.append(np.minimum(tables.vectors[v] + added, FAR))
                out.append((key, segment, np.stack(columns, 1).ravel().tolist()))
            yield _arrow(out, schema)

    return segments.select("key", "segment", "symbols").mapInArrow(run, "key string, segment long, costs array<long>")


def _scan(rows: DataFrame, descending: bool, step, out: str, schema: pa.Schema) -> DataFrame:
    """Segments of each conversation one after the other; a task holds one segment and a carry."""
    order = F.col("segment").desc() if descending else F.col("segment").asc()
    dealt = rows.repartition("key").sortWithinPartitions("key", order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["key"] != key:
                    key, carry = row["key"], None
                item, carry = step(row, carry)
                found.append((key, row["segment"], item))
            yield _arrow(found, schema)

    return dealt.mapInArrow(run, out)


def traced(segments: DataFrame) -> DataFrame:
    """segments (key, segment, last, symbols), a written table -> key, segment, edits (state and edits per turn), tail.

    The costs after a segment come from the summaries of those behind it, its first state from the ends of those before it; both are
    carried along a conversation's summaries, a few numbers per SEGMENT turns. Conversations of one segment skip this.
    """
    long = saved(segments.where("segment > 0").select("key").distinct())
    vectors = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("after", pa.list_(pa.int64()))])
    states = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("start", pa.int64())])

    def behind(row, carry):
        after = end_costs() if carry is None else carry
        before = inserted((np.array(row["costs"]).reshape(4, 4) + after).min(1))
        return after.tolist(), before - before.min()

    def before(row, carry):
        state = 0 if carry is None else carry
        return state, row["ends"][state]

    costs = summaries(segments.join(long, "key", "left_semi"))
    after = saved(_scan(costs, True, behind, "key string, segment long, after array<long>", vectors))
    rows = segments.join(after, ["key", "segment"], "left")
    schema = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("ends", pa.list_(pa.int64())),
                        ("edits", pa.list_(pa.list_(pa.string()))), ("tails", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = BlockTables()
        end = tables.find(end_costs())
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(at, 64).to_pylist():
                    one = row["after"] is None
                    vector = end if one else tables.find(np.array(row["after"]))
                    ways = [tables.trace(np.array(row["symbols"]), vector, q, row["last"]) for q in range(1 if one else 4)]
                    out.append((row["key"], row["segment"], [w[2] for w in ways], [w[0] for w in ways], [w[1] for w in ways]))
                yield _arrow(out, schema)

    ways = saved(rows.select("key", "segment", "last", "symbols", "after").mapInArrow(
        run, "key string, segment long, ends array<long>, edits array<array<string>>, tails array<string>"))
    starts = saved(_scan(ways.where("size(ends) > 1").select("key", "segment", "ends"), False, before, "key string, segment long, start long", states))
    way = F.coalesce("start", F.lit(0)).cast("int")
    return ways.join(starts, ["key", "segment"], "left").select("key", "segment", F.col("edits")[way].alias("edits"), F.col("tails")[way].alias("tail"))


def edited(rows: DataFrame) -> DataFrame:
    """diagnosed rows with `edits` (the state before the row, then its edits) and, on a conversation's last row, `tail`."""
    counts = rows.groupBy("key").agg((F.max("place_") + 1).alias("n"))
    segment = F.floor(F.col("place_") / SEGMENT)
    grouped = rows.groupBy("key", segment.alias("segment")).agg(F.sort_array(F.collect_list(F.struct("place_", symbol().alias("s")))).alias("rows"))
    last = F.col("segment") == F.floor((F.col("n") - 1) / SEGMENT)
    segments = saved(grouped.join(counts, "key").select("key", "segment", last.alias("last"), F.col("rows.s").alias("symbols")))
    each = traced(segments).select("key", "segment", "tail", F.size("edits").alias("n"), F.posexplode("edits").alias("at", "edits"))
    found = saved(each.select("key", (F.col("segment") * SEGMENT + F.col("at")).alias("place_"), "edits", F.when(F.col("at") == F.col("n") - 1, F.col("tail")).alias("tail")))
    return rows.join(found, ["key", "place_"])


def new_turns(role: str, text: str, edits: str, tail: str | None) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns a row becomes."""
    for part in (edits, tail or "0"):
        state = int(part[0])
        for letter in part[1:]:
            if letter == "K":
                state = kept_to(state, "sua".index(role[0]))
                yield role, text
            elif letter != "D":
                state = TURN[state]
                yield ROLE_NAMES[state], text if letter == "R" else ""


def repaired(rows: DataFrame) -> DataFrame:
    """Edited rows -> the turns of the repaired conversations: key, place_ of the row they come from, part, role, text."""
    schema = pa.schema([("key", pa.string()), ("place_", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _arrow([(r["key"], r["place_"], i, *turn) for r in batch.slice(at, 1024).to_pylist()
                              for i, turn in enumerate(new_turns(r["role"], r["text"], r["edits"], r["tail"]))], schema)

    return rows.select("key", "place_", "role", "text", "edits", "tail").mapInArrow(
        run, "key string, place_ long, part int, role string, text string")


class Tally:
    """What is told of one conversation, turn by turn."""

    PRICE = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}

    def __init__(self):
        self.faults, self.illegal, self.cost, self.distinct = [0, 0, 0, 0], 0, 0, 0
        self.first = self.last = self.role = None
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, turn, role, text, fault, edits, tail) -> None:
        self.faults[fault] += 1
        if self.role is not None and self.role + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role[:1]
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        letters = edits[1:] + (tail or "0")[1:]
        self.audit.append(letters)
        self.cost += sum(self.PRICE[c] for c in letters) + CUT * (fault == TRUNCATED and "D" not in letters)
        for line in new_turns(role, text, edits, tail):
            self.hash.update(("\n" * bool(self.lines) + ":".join(line)).encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def audit(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per conversation of turns (conv_id, ...), told from edited rows, which go by in order. The hash runs over a whole
    conversation by definition; a task holds a row, the counts and the edits' letters of one conversation."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in names], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tally = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["key"] != key:
                    if tally:
                        out.append((key, *tally.row()))
                    key, tally = row["key"], Tally()
                tally.add(*(row[c] for c in ("turn", "role", "text", "fault", "edits", "tail")))
            yield _arrow(out, schema)
        if tally:
            yield _arrow([(key, *tally.row())], schema)

    told = rows.repartition("key").sortWithinPartitions("key", "place_").select("key", "turn", "role", "text", "fault", "edits", "tail").mapInArrow(
        run, f"key string, {', '.join(f'{c} long' for c in names)}, audit string, repaired_sha256 string")
    every = fields(turns).select("key").distinct().join(told, "key", "left")
    return every.select(F.when(F.col("key") != " ", F.col("key").cast("long")).alias("conv_id"),
                        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def repair(turns: DataFrame, damage: bool = False) -> DataFrame:
    """turns (conv_id, turn, role, text) -> edited rows: key, place_, turn, role, text, fault, edits, tail.

    Rows of a conversation go by turn (null first), then role, then text. Null roles and texts are one space, so they are neither legal
    roles nor text; an empty role has no legal initial either. A null conv_id is a conversation. A repeated row is a duplicate of the
    first. An empty table gives an empty result; other columns do not matter. damage plants faults first.
    A conversation of any length is cut into segments of SEGMENT turns, which are traced side by side.
    """
    rows = fields(turns)
    return edited(diagnosed(damaged(rows) if damage else rows))
