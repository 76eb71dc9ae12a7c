"""Near duplicates against brute force."""
import random
from itertools import combinations

import numpy as np

from panelflume.llm import near_dedup
from panelflume.llm.components import components
from tests.llm.helpers import docs_frame, odd_docs, prose

SPACE = " \t\n\x0b\x0c\r"


def shingles(text):
    words, word = [], ""
    for ch in (text or "") + " ":
        if ch in SPACE:
            words, word = words + [word] * bool(word), ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        both = len(x & y)
        if x and y and a is not None and b is not None and 100 * both >= 75 * len(x | y):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {(i, len(s), find(i)) for i, s in sets}


def varied(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, int(len(words) * share))):
        words[i] = prose(rng, 1)
    return " ".join(words)


def got(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


def test_against_brute_force(spark):
    rng = random.Random(1)
    common = prose(rng, 60)
    bases = [prose(rng, rng.randint(5, 200)) for _ in range(40)]
    texts = bases + [varied(rng, rng.choice(bases), rng.choice([.005, .02, .03, .05])) for _ in range(120)]
    texts += [varied(rng, bases[0] + " " + common, .01) for _ in range(80)]    # a large group of near copies
    texts += [common + " " + prose(rng, 25) for _ in range(60)]                # a passage that many texts share
    texts += [bases[3]] * 30
    rows = list(enumerate(texts, 100))
    df = docs_frame(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    # nodes of more than 24 members take the branching path
    assert got(near_dedup.link_documents(df, small=24)) == brute(rows)


def test_odd_rows(spark):
    rows = odd_docs()
    out = near_dedup.link_documents(docs_frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out} == brute([(r[0], r[1]) for r in rows])
    left = near_dedup.drop_near_copies(docs_frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "10", "2", "3", "4", "6", "None"]


def test_sets_do_not_depend_on_neighbours():
    h = near_dedup.Hasher()
    texts = [b"a b c d e f", b"", b"x", b"a b c d e f", "É b c".encode()]
    many = h.sets(texts)
    assert all((a == near_dedup.Hasher().sets([t])[0]).all() for a, t in zip(many, texts))
    assert [len(s) for s in many] == [2, 0, 1, 2, 1]


def test_components_of_chains(spark):
    rng = np.random.default_rng(3)
    order = [int(x) for x in rng.permutation(60)]
    chain = list(zip(order, order[1:]))
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    out = {r.id: r.component_id for r in components(spark.createDataFrame(chain + hub + [(5, 5), (7, None)], "a long, b long")).collect()}
    assert out == {**{i: 0 for i in order}, **{1000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pairs_at_the_threshold_among_template_pages(spark):
    rng = random.Random(11)
    template = prose(rng, 124)
    pages = [template + " " + prose(rng, 30) for _ in range(1500)]
    longer = [p + " " + prose(rng, 50) for p in pages[:60]]    # 150 of 200 shingles
    rows = list(enumerate(pages + longer))
    assert all(100 * len(shingles(p) & shingles(q)) == 75 * len(shingles(p) | shingles(q)) for p, q in zip(pages, longer))
    df = docs_frame(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    expected = {i: i for i in range(1500)} | {1500 + i: i for i in range(60)}
    assert {i: c for i, _, c in got(near_dedup.link_documents(df, small=16))} == expected


def test_blocks_of_a_large_node_compare_all(spark):
    rng = np.random.default_rng(2)
    sketch = bytes(rng.integers(0, 256, near_dedup.SKETCH, dtype=np.uint8))
    far = bytes(rng.integers(0, 256, near_dedup.SKETCH, dtype=np.uint8))
    rows = [(1, i, i, bytearray(far if i == 7 else sketch), 9, 40.0, 0, 1.0) for i in range(40)]
    members = spark.createDataFrame(rows, "node long, rep long, component long, sketch binary, n long, weight double, main long, main_weight double")
    out = near_dedup.alike_members(members, 8).collect()
    met = {}
    for r in out:
        met.setdefault(r.group_, ([], []))[r.probe].append(r.rep)
    assert {(a, b) for base, probes in met.values() for a in probes for b in base if a != b} == {
        (a, b) for a in range(1, 40) for b in range(40) if a != b and 7 not in (a, b)}
    assert len(out) <= 2 * 40 * 5


def test_forests_join_all_that_links():
    rng = np.random.default_rng(5)
    for _ in range(30):
        bases = [rng.choice(400, 60, replace=False) for _ in range(4)]
        sets = [np.unique(np.where(rng.random(60) < rng.choice([0, .05, .15]), rng.integers(1000, 9999, 60), bases[rng.integers(4)])) for _ in range(25)]
        rows = [(i, i, s) for i, s in enumerate(sets)]
        links = near_dedup.linked_forest(rows, rows, 75)
        root = list(range(25))

        def joined(pairs):
            root[:] = range(25)
            for a, b in pairs:
                x, y = root[a], root[b]
                root[:] = [min(x, y) if r in (x, y) else r for r in root]
            return list(root)

        full = [(a, b) for a in range(25) for b in range(a) if 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))]
        assert joined(links) == joined(full) and len(links) < 25


def test_what_is_compared_grows_in_proportion(spark, monkeypatch):
    rng = random.Random(17)
    template = prose(rng, 100)
    handed = []
    plain = near_dedup.compared
    monkeypatch.setattr(near_dedup, "compared", lambda m, s, p: (handed.append(m.count()), plain(m, s, p))[1])
    for n in (200, 400):
        pages = [(i, template + " " + prose(rng, 40), "en", "s", 1) for i in range(n)]    # about 0.55 alike, none link
        assert {c for _, _, c in got(near_dedup.link_documents(docs_frame(spark, pages)))} == set(range(n))
    assert handed[1] <= 3 * max(handed[0], 200 * 10)


def test_a_round_of_stars_writes_four_tables(spark, monkeypatch):
    """Small tables cost a fixed time each, which held up a run over many partitions."""
    import panelflume.llm.components as module
    plain, written = module.saved, []
    monkeypatch.setattr(module, "saved", lambda df: written.append(1) or plain(df))
    links = spark.createDataFrame([(5, 9), (9, 5), (9, 7), (7, 7), (None, 3), (2, None), (20, 30), (20, 30), (20, 40)], "a long, b long")
    assert sorted(map(tuple, components(links).collect())) == [(5, 5), (7, 5), (9, 5), (20, 20), (30, 20), (40, 20)]
    assert len(written) <= 1 + 4 + 1


def join_rows(df):
    """Runs df and returns the number of rows that its joins made."""
    def walk(p):
        name, kids = p.nodeName(), p.children()
        inner = [p.executedPlan()] if "Adaptive" in name else [p.plan()] if "QueryStage" in name else [kids.apply(i) for i in range(kids.size())]
        return (p.metrics().apply("numOutputRows").value() if "Join" in name else 0) + sum(map(walk, inner))

    rows = df.collect()
    return rows, walk(df._jdf.queryExecution().executedPlan())


def test_joins_by_document_make_a_row_for_each_document(spark):
    """However many nodes and groups a document is in."""
    rows = [(node % 10, node, rep, rep, 9) for node in range(20) for rep in range(30)]
    members = spark.createDataFrame(rows, "tree int, node long, rep long, component long, n long")
    size = near_dedup.TREES * near_dedup.DEPTH * max(near_dedup.BRANCHES)
    tokens = spark.createDataFrame([(rep, [rep % 3] * size) for rep in range(30)], "id long, tokens array<int>")
    out, made = join_rows(near_dedup.children(members, tokens, 0))
    assert made == 30 and len(out) == 20 * 30 * near_dedup.BRANCHES[0]
    assert len({r.node for r in out}) == 20 * 3 * near_dedup.BRANCHES[0]
    groups = [(g, rep, rep, probe) for g in range(20) for rep in range(30) for probe in (False, True)]
    members = spark.createDataFrame(groups, "group_ long, rep long, component long, probe boolean")
    sets = spark.createDataFrame([(rep, list(range(rep % 3 * 50, rep % 3 * 50 + 40))) for rep in range(30)], "id long, set array<long>")
    links, made = join_rows(near_dedup.compared(members, sets, 75))
    assert made == 30 and len(links) == 20 * 27 and all(a % 3 == b % 3 for a, b in links)
