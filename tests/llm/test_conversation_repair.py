import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from panelflume.llm import conversation_repair as repair
from tests.llm.helpers import clashing

TURNS = "conv_id long, turn long, role string, text string"
TABLES = repair.BlockTables()


def least(roles, faults):
    """(cost, edits) by trying every edit at every turn, the least string among the cheapest of each state kept."""
    turn = {0: 2, 1: 2, 2: 3, 3: 2}

    def with_inserts(best):
        for _ in range(3):
            for p, (c, a) in list(best.items()):
                best[turn[p]] = min(best.get(turn[p], (9999, "")), (c + 5, a + "I"))
        return best

    best = with_inserts({0: (0, "")})
    for role, fault in zip(roles, faults):
        new = {}
        for p, (c, a) in best.items():
            ways = [(p, c + 2, "D")]
            if fault not in (1, 2):
                cut = 5 * (fault == 3)
                ways.append((turn[p], c + cut + 1, "R"))
                if role[:1] == "s" and p == 0:
                    ways.append((1, c + cut, "K"))
                elif role[:1] == {2: "u", 3: "a"}[turn[p]]:
                    ways.append((turn[p], c + cut, "K"))
            for q, cost, letter in ways:
                new[q] = min(new.get(q, (9999, "")), (cost, a + letter))
        best = with_inserts(new)
    return min(best[q] for q in (0, 3) if q in best)


def plain(turns, damage=True):
    out, by = [], {}
    for conv, turn, role, text in turns:
        rows = by.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append(1 if not last else 2 if (role, text) in seen else 3 if last[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, edits = least([r[1] for r in rows], faults)
        lines, state, at = [], 0, 0
        for letter in edits:
            if letter == "I":
                state = repair.TURN[state]
                lines.append(f"{repair.ROLE_NAMES[state]}:")
                continue
            _, role, text = rows[at]
            at += 1
            if letter == "K":
                state = 1 if role[0] == "s" else repair.TURN[state]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = repair.TURN[state]
                lines.append(f"{repair.ROLE_NAMES[state]}:{text}")
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame, damage=True):
    return sorted(map(tuple, repair.audit(frame, repair.repair(frame, damage)).collect()), key=str)


def some_turns(convs, most, seed):
    rng = random.Random(seed)
    return [(c, t if rng.random() < 0.95 else None, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             rng.choice(["Yes.", "No!", "and then", " ", None, "Why? ", f"Turn {t}.", f"It is {rng.random()}."]))
            for c in range(convs) for t in range(rng.randint(1, most))]


def test_traces_are_the_least_of_the_cheapest():
    rng = random.Random(1)
    for _ in range(1500):
        roles = [rng.choice(["system", "user", "assistant", "tool"]) for _ in range(rng.randint(1, 14))]
        faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in roles]
        symbols = np.array([8 if f in (1, 2) else {"s": 0, "u": 1, "a": 2}.get(r[0], 3) + 4 * (f == 3) for r, f in zip(roles, faults)])
        edits, tail, _ = TABLES.trace(symbols, TABLES.find(repair.end_costs()), 0, True)
        assert "".join(e[1:] for e in edits) + tail[1:] == least(roles, faults)[1]


def test_block_tables_equal_single_steps():
    rng = np.random.default_rng(3)
    for _ in range(200):
        symbols, vector = rng.integers(0, repair.SYMBOLS, 4 * rng.integers(1, 5)), int(rng.integers(0, len(TABLES.vectors)))
        _, before, cost = TABLES.passed(symbols, vector)
        single, total = vector, 0
        for s in symbols[::-1]:
            total, single = total + TABLES.grew[single, s], TABLES.step[single, s]
        assert (before, cost) == (single, total)


@pytest.mark.parametrize("damage", [True, False])
def test_random_conversations(spark, damage):
    turns = some_turns(120, 12, 4)
    assert result(spark.createDataFrame(turns, TURNS), damage) == plain(turns, damage)


def test_long_conversations_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 8)
    turns = some_turns(12, 90, 5)
    assert result(spark.createDataFrame(turns, TURNS)) == plain(turns)


def test_odd_rows(spark):
    turns = [(None, None, None, None), (None, 1, "user", "Hm."), (7, None, "user", None), (7, 2, "user", "a" * 50000), (7, 2, "user", "a" * 50000),
             (8, 0, "", ""), (9, 5, "system", "Be kind."), (9, 5, "system", "Be kind."), (9, -3, "assistant", "Ok.\n")]
    frame = spark.createDataFrame(turns, TURNS)
    assert result(frame) == plain(turns)
    extra = clashing(frame).selectExpr("*", "'x' as key", "'x' as place_", "'x' as fault", "'x' as segment", "'x' as digest")
    assert result(extra) == plain(turns)
    assert result(spark.createDataFrame([], TURNS)) == []


def test_repaired_turns_alternate(spark):
    frame = spark.createDataFrame(some_turns(40, 9, 6), TURNS)
    rows = repair.repaired(repair.repair(frame)).orderBy("key", "place_", "part").collect()
    by = {}
    for r in rows:
        by.setdefault(r["key"], []).append(r["role"][0])
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in by.values())
