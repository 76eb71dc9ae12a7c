"""Checking SQL of the manifest and of the conversation repair."""
from __future__ import annotations

from panelflume.llm.merkle import FANOUT, FIELDS, LOWER, UPPER

SPACES = r"\x20\x09-\x0D"


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII string, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    bits = "lambda v, i: xor(v >> 1, 3988292384 * (v & 1))"
    byte = f"lambda c, x: list_reduce(list_prepend(xor(c, x), CAST([0, 1, 2, 3, 4, 5, 6, 7] AS BIGINT[])), {bits})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}), 4294967295)"


def _leaf(text: str) -> str:
    parts = []
    for c in FIELDS:
        value = text if c == "text" else f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce(strlen({value}) || ':' || {value}, '-')")
    return f"sha256({' || '.join(parts)})"


def _levels(name: str, leaves: str, count: int) -> str:
    """name0 (tree, idx, digest, total) and up; name_r: runs (tree, run, joined, total)."""
    out = [f"{name}0 AS ({leaves})"]
    for k in range(count):
        out.append(f"{name}r{k} AS (SELECT tree, idx // {FANOUT} AS run, string_agg(digest, '' ORDER BY idx) AS joined, any_value(total) AS total "
                   f"FROM {name}{k} GROUP BY ALL)")
        out.append(f"{name}{k + 1} AS (SELECT tree, run AS idx, CASE WHEN total > 1 THEN sha256(joined) ELSE joined END AS digest, "
                   f"(total + {FANOUT - 1}) // {FANOUT} AS total FROM {name}r{k})")
    return ",\n".join(out)


def _folds(name: str, tree: str, first: str, count: int) -> str:
    """name0 (doc, at, value, proof, ...) folded through the runs of a tree: name{count}."""
    out = [f"{name}0 AS ({first})"]
    for k in range(count):
        left, right = f"substr(joined, 1, 64 * CAST(pos % {FANOUT} AS INT))", f"substr(joined, 64 * CAST(pos % {FANOUT} AS INT) + 65)"
        out.append(f"{name}{k + 1} AS (SELECT f.* EXCLUDE (pos, value, proof), pos // {FANOUT} AS pos, "
                   f"CASE WHEN total > 1 THEN sha256({left} || value || {right}) ELSE value END AS value, "
                   f"proof || CASE WHEN total > 1 THEN {left} || {right} ELSE '' END AS proof "
                   f"FROM {name}{k} f JOIN {tree}r{k} r ON r.tree = f.tree AND r.run = f.pos // {FANOUT})")
    return ",\n".join(out)


DEEP, WIDE = 5, 3
OP12_SQL = f"""
WITH l AS (SELECT *, coalesce('=' || source, '') AS tree, {_leaf('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc32("CAST(coalesce(doc_id, 0) AS VARCHAR)")} % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed
  FROM documents),
n AS (SELECT doc_id, tree, leaf, changed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY tree) AS total FROM l),
{_levels('s', 'SELECT tree, idx, leaf AS digest, total FROM n', DEEP)},
o AS (SELECT tree AS source, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS total FROM s{DEEP}),
{_levels('t', "SELECT '' AS tree, idx, digest, total FROM o", WIDE)},
{_folds('f', 's', "SELECT doc_id, tree, leaf, idx AS pos, coalesce(changed, leaf) AS value, '' AS proof FROM n", DEEP)},
{_folds('g', 't', f"SELECT doc_id, leaf, digest AS subroot, '' AS tree, o.idx AS pos, value, proof FROM f{DEEP} f JOIN o ON o.source = f.tree", WIDE)}
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, value AS folded_root, value = t.digest AS verified
FROM g{WIDE}, t{WIDE} t"""


def _add(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _insert(state: str, role: str) -> str:
    return _add(state, "5", "I", f"chr(10) || '{role}:'")


NEVER = "{'c': 1000000, 'a': '', 't': ''}"


def _stays(state: str, initial: str) -> str:
    return f"CASE WHEN f NOT IN (1, 2) AND s = '{initial}' THEN {_add(state, 'pen', 'K', 'line')} ELSE {NEVER} END"


def _becomes(state: str, role: str) -> str:
    turned = _add(state, "pen + 1", "R", f"chr(10) || '{role}:' || x")
    return f"CASE WHEN f NOT IN (1, 2) THEN {turned} ELSE {NEVER} END"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _deleted(state: str) -> str:
    return _add(state, "2", "D")


OP13_SQL = f"""
WITH RECURSIVE t AS (SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS k, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x FROM conversations),
z AS (SELECT *, {crc32("(k || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS z FROM t),
d AS (SELECT k, turn, CASE z WHEN 4 THEN 'user' ELSE r END AS r, CASE z WHEN 1 THEN '' WHEN 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x,
  unnest(CASE z WHEN 3 THEN [0, 1] ELSE [0] END) AS p FROM z WHERE z <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, r, x, p) AS i,
  row_number() OVER (PARTITION BY k, r, x ORDER BY turn NULLS FIRST, p) AS j FROM d),
f AS (SELECT k, i, turn, r, x, left(r, 1) AS s, lag(left(r, 1)) OVER (PARTITION BY k ORDER BY i) AS q,
  CASE WHEN NOT regexp_matches(x, '[^{SPACES}]') THEN 1 WHEN j > 1 THEN 2 WHEN NOT regexp_matches(x, '[.!?][{SPACES}]*$') THEN 3 ELSE 0 END AS f FROM o),
e AS (SELECT *, CASE f WHEN 3 THEN 5 ELSE 0 END AS pen, chr(10) || r || ':' || x AS line FROM f),
m AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS s0, {NEVER} AS s1,
    {{'c': 5, 'a': 'I', 't': chr(10) || 'user:'}} AS s2, {{'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3 FROM t
  UNION ALL
  SELECT k, i, n0, n1, n2, {_least('n3', _insert('n2', 'assistant'))} FROM (
    SELECT k, i, n0, n1, {_least('n2', _insert('n0', 'user'), _insert('n1', 'user'), _insert('n3', 'user'))} AS n2, n3 FROM (
      SELECT e.k, e.i, {_deleted('s0')} AS n0, {_least(_deleted('s1'), _stays('s0', 's'))} AS n1,
        {_least(_deleted('s2'), *[g(p, a) for p in ('s0', 's1', 's3') for g, a in ((_stays, 'u'), (_becomes, 'user')) ])} AS n2,
        {_least(_deleted('s3'), _stays('s2', 'a'), _becomes('s2', 'assistant'))} AS n3
      FROM m JOIN e ON e.k = m.k AND e.i = m.i + 1))),
b AS (SELECT k, {_least('s0', 's3')} AS b FROM (SELECT k, arg_max(s0, i) AS s0, arg_max(s3, i) AS s3 FROM m GROUP BY k)),
g AS (SELECT k, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE f = 1) AS blank, count(*) FILTER (WHERE f = 2) AS duplicate,
  count(*) FILTER (WHERE f = 3) AS truncated, count(*) FILTER (WHERE q IS NOT NULL AND q || s NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY k)
SELECT CASE WHEN b.k <> ' ' THEN CAST(b.k AS BIGINT) END AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.c AS BIGINT) AS cost,
  b.a AS audit, sha256(substr(b.t, 2)) AS repaired_sha256
FROM b LEFT JOIN g ON g.k = b.k"""
