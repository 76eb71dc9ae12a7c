"""Packing, mixing, copies, languages, licences, chat, vectors and PII on small tables."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelflume.llm import chat, embedding_dedup, exact_dedup, langid, licenses, mixing, packing, pii, quality
from tests.llm.helpers import docs_frame, odd_docs, prose


# --- packing

def plain_best_fit(items, capacity):
    room, inside, out = [], [], []
    for size, source, cluster in items:
        fits = [(room[b], b) for b in range(len(room)) if room[b] >= size and room[b] > 0
                and source not in {s for s, _ in inside[b]} and cluster not in {c for _, c in inside[b]}]
        b = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(capacity)
            inside.append([])
        room[b] -= size
        inside[b].append((source, cluster))
        out.append(b)
    return out


def test_best_fit_against_plain_search():
    rng = random.Random(2)
    for _ in range(30):
        items = sorted([(rng.randint(1, 60), rng.randint(0, 4), rng.randint(0, 40)) for _ in range(150)], reverse=True)
        assert packing.best_fit(items, 64) == plain_best_fit(items, 64)


def test_packing_keeps_every_word(spark):
    rng = random.Random(3)
    rows = odd_docs() + [(100 + i, prose(rng, rng.randint(1, 300)), "en", f"s{min(i % 9, 4)}", 0) for i in range(150)]
    out = packing.pack(docs_frame(spark, rows), capacity=128, shard_rows=50).collect()
    placed, want = Counter(), Counter()
    for r in out:
        placed[r.doc_id] += r.n_words
    for r in rows:
        want[r[0]] += len((r[1] or "").split())
    assert placed == want
    bins = defaultdict(list)
    for r in out:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
        else:
            assert r.n_words == 0
    source = {r[0]: r[3] for r in rows}
    for b in bins.values():
        assert sum(r.n_words for r in b) <= 128
        spans = sorted((r.bin_offset, r.n_words) for r in b)
        assert all(a + n == c for (a, n), (c, _) in zip(spans, spans[1:])) and spans[0][0] == 0
        assert len({source[r.doc_id] for r in b}) == len(b)
    again = packing.pack(docs_frame(spark, rows).repartition(7), capacity=128, shard_rows=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_near_copies_and_null_ids_are_packed_apart(spark):
    rng = random.Random(6)
    text = prose(rng, 60)
    near = [(i, text + " " + prose(rng, 1), "en", f"s{i}", 0) for i in range(8)]
    docs = docs_frame(spark, near + [(100 + i, prose(rng, 30), "en", f"t{i}", 0) for i in range(20)])
    out = packing.pack(docs, capacity=512, near=packing.near_clusters(docs)).collect()
    assert len({r.bin_id for r in out if r.doc_id < 100}) == 8
    nulls = docs_frame(spark, [(None, prose(rng, 5), "en", "s", 0) for _ in range(200)] + [(7, "same words", "en", "s", 0)] * 200)
    out = packing.pack(nulls, capacity=64, shard_rows=20).collect()
    for doc in (None, 7):
        shards = Counter(r.bin_id >> 32 for r in out if r.doc_id == doc)
        assert sum(shards.values()) == 200 and len(shards) > 10 and max(shards.values()) < 40


def test_words_are_counted_without_lists_of_them(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(" \t\n\x0b\x0c\rab \u00e9\x1c\u2003\x85") for _ in range(rng.randint(0, 30))) for _ in range(600)] + [None, "", " ", "x"]
    out = packing.pack(docs_frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]))
    assert "regexp" not in out._jdf.queryExecution().toString()
    sizes = {r.doc_id: r.n_words for r in out.collect()}
    assert sizes == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


# --- mixing

def test_mix_reaches_targets(spark):
    rng = random.Random(4)
    rows = odd_docs() + [(100 + i, prose(rng, rng.randint(1, 60)), "en", rng.choice(["hot"] * 6 + ["a", "b", "c", None]), 0) for i in range(600)]
    out = mixing.mix(docs_frame(spark, rows)).collect()
    assert len(out) == len(rows)
    taken, sizes, longest = Counter(), {}, Counter()
    for r in out:
        taken[r.source] += r.taken
        sizes[r.source] = (r.source_size, r.target)
        longest[r.source] = max(longest[r.source], r.size)
        assert r.taken <= 2 * r.size
    for s, (size, target) in sizes.items():
        assert abs(taken[s] - target) <= longest[s] / 2 + 1 and target <= 2 * size + 1e-9
    assert math.isclose(sum(t for _, t in sizes.values()), 1.5 * sum(s for s, _ in sizes.values()))
    again = mixing.mix(docs_frame(spark, rows).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    copies = Counter(r.doc_id for r in mixing.mixed(docs_frame(spark, rows)).collect())
    epochs = Counter()
    for r in out:
        epochs[r.doc_id] += r.epochs
    assert copies == +epochs


def test_targets_match_resharing_by_rounds(spark):
    rng = random.Random(6)
    for _ in range(3):
        sizes = [rng.choice([0, 1, 5, 50, 1000]) for _ in range(9)]
        rows = [(None if i == 8 else False, f"s{i}", n) for i, n in enumerate(sizes)]
        frame = spark.createDataFrame([(bool(a is None), b, c) for a, b, c in rows], "none_ boolean, source_ string, size_ long")
        got = {r.source_: r.target_ for r in mixing.source_targets(frame).collect()}
        weights, free, left, target = [(5, 2, 1)[i % 3] for i in range(9)], set(range(9)), 1.5 * sum(sizes), {}
        while free:
            level = left / sum(weights[i] for i in free)
            over = [i for i in free if level * weights[i] > 2 * sizes[i]]
            if not over:
                target |= {i: level * weights[i] for i in free}
                break
            for i in over:
                target[i] = 2 * sizes[i]
                left -= target[i]
                free.discard(i)
        assert all(math.isclose(got[f"s{i}"], t, abs_tol=1e-6) for i, t in target.items())


# --- exact copies

def test_copies_with_a_crowded_filter(spark):
    rows = odd_docs() + [(100 + i, f"text {i % 40}", "en", "a", 0) for i in range(200)]
    for slots in (1 << 26, 64):
        out = exact_dedup.mark_copies(docs_frame(spark, rows), slots=slots).collect()
        assert len(out) == len(rows)
        groups = defaultdict(list)
        for r in rows:
            groups[r[1] or ""].append(r[0])
        for r in out:
            ids = groups[r.text or ""]
            assert r.group_size == len(ids) and r.keep_id == max(i for i in ids if i is not None) if any(i is not None for i in ids) else True
        assert sum(r.kept for r in out) == len(groups)
    left = exact_dedup.drop_copies(docs_frame(spark, rows)).collect()
    assert len(left) == len({r[1] or "" for r in rows}) and set(left[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}


# --- languages

def plain_phrases(codes, sample):
    n, i, longest = 0, 0, "".join(map(chr, sample))
    while i < len(codes):
        j = i + 1
        while j <= len(codes) and "".join(map(chr, codes[i:j])) in longest:
            j += 1
        i = max(j - 1, i + 1)
        n += 1
    return n


def test_phrases_against_plain_search(monkeypatch):
    """Blocks of 7 and 64 letters: phrases run on across them, also in periodic texts, where parses never fall into step."""
    rng = random.Random(7)
    samples = {"x": langid.normalise(prose(rng, 150)), "y": langid.normalise(prose(rng, 100).replace("a", "z")), "z": "q",
               "p": "aaa b", "han": "".join(chr(0x4e00 + rng.randint(0, 400)) for _ in range(600))}
    model = langid.train(samples)
    table = langid.code_table(model)
    texts = [langid.normalise(prose(rng, n)) for n in (1, 5, 40, 200)] + ["ß x", "abq", "a" * 300, samples["x"], samples["han"][50:220]]
    coded = [langid.encode(t, table) for t in texts]
    for block in (7, 64, langid.BLOCK):
        monkeypatch.setattr(langid, "BLOCK", block)
        for t, b, row in zip(texts, coded, langid.phrase_counts(coded, model)):
            for lang, c in zip(model.langs, row):
                assert c == plain_phrases(list(b), [langid.letter_code(ch, model.alphabet) for ch in samples[lang]])
            if t in samples.values():
                assert min(row) == 1


def test_slots_hold_every_transition():
    rng = random.Random(9)
    samples = {lang: "".join(chr(0x3041 + rng.randint(0, span)) for _ in range(1500)) for lang, span in (("a", 5), ("b", 80), ("c", 1200))}
    model = langid.train(samples)
    for lang, start in zip(model.langs, model.starts):
        rows = langid.suffix_automaton([langid.letter_code(c, model.alphabet) for c in samples[lang]])
        for s, row in enumerate(rows):
            for c in range(len(model.alphabet) + 2) if s and s % 50 == 0 else row:
                entry = int(model.slots[model.base[start + s] + c])
                assert not s or (entry >> 32 == start + s) == (c in row) and (c not in row or entry & 0xFFFFFFFF == start + row[c])
    assert len(model.slots) < 3 * 3 * sum(map(len, samples.values())) + 3 * len(model.alphabet)


def test_encode_is_normalise(monkeypatch):
    model = langid.train({"x": "abc def é"})
    table = langid.code_table(model)
    for piece in (1, 3, langid.PIECE):
        monkeypatch.setattr(langid, "PIECE", piece)
        for t in ("Abc, DEF!!  é", "", "  ", "1 2", "a\U00010400b", "İx", "ab\ud7ffc", " a  b ", "ΟΔΟΣ", "क्या"):
            want = [langid.letter_code(c, model.alphabet) for c in langid.normalise(t)]
            assert list(langid.encode(t, table)) == want


def script(rng: random.Random, first: int, span: int, words: int):
    """A vocabulary drawn from a script, and texts of it."""
    vocabulary = ["".join(chr(first + rng.randint(0, span - 1)) for _ in range(rng.randint(1, 3))) for _ in range(words)]
    return lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))


def test_scripts_rare_and_repeated_languages(spark):
    """Han twice (only the words differ), kana, Hangul; a language of one short text; languages in which one text is most of the rows."""
    rng = random.Random(12)
    say = {"zh": script(rng, 0x4e00, 900, 150), "yue": script(rng, 0x4e00, 900, 150), "ja": script(rng, 0x3041, 80, 150),
           "ko": script(rng, 0xac00, 2000, 150), "de": script(rng, 0x61, 20, 150), "fr": script(rng, 0x61, 20, 150), "rare": script(rng, 0x61, 20, 30)}
    rows = [(say[lang](60), lang) for lang in ("zh", "yue", "ja", "ko", "fr") for _ in range(120)]
    rows += [(say["rare"](60), "rare")] + [(say["de"](600), "de")] * 3000 + [(say["fr"](80), "fr")] * 3000
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    samples = langid.sample_texts(docs)
    assert set(samples) == set(say) and all(len(s) <= langid.SAMPLE_LETTERS for s in samples.values())
    whole = {lang: sum(len(langid.normalise(t)) for t in {t for t, l in rows if l == lang}) for lang in say}
    assert all(len(samples[lang]) >= 0.98 * min(whole[lang], langid.SAMPLE_LETTERS) for lang in say)
    asked = [(i, say[lang](25), lang) for i, lang in enumerate(list(say) * 20)]
    out = langid.predict_language(spark.createDataFrame(asked, "doc_id long, text string, truth string"), samples).collect()
    right = {lang: np.mean([r.lang_pred == lang for r in out if r.truth == lang]) for lang in say}
    assert min(right.values()) >= 0.9, right


def test_sample_is_full_and_ignores_copies(spark):
    rng = random.Random(13)
    few = [(prose(rng, 40), "few") for _ in range(4)]
    many = [(prose(rng, 40), "many") for _ in range(900)]
    docs = spark.createDataFrame(few * 500 + many, "text string, lang string")
    got = langid.sample_texts(docs, letters=20_000)
    assert len(got["many"]) == 20_000
    assert sorted(got["few"].split()) == sorted(w for t, _ in few for w in t.split())  # each text is one slice
    assert got == langid.sample_texts(docs.repartition(5), letters=20_000)


def test_language_held_out_accuracy(spark):
    from panelflume.llm.queries import op6_language_id
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = [r for r in op6_language_id(spark, sf).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_undetermined(spark):
    out = langid.predict_language(docs_frame(spark, odd_docs()), {"en": "one two three", "de": "eins zwei"}).collect()
    assert {r.doc_id: r.lang_pred for r in out}[1] == "und" and {r.doc_id: r.lang_pred for r in out}[3] == "und"
    assert {r.lang_pred for r in langid.predict_language(docs_frame(spark, odd_docs()), {}).collect()} == {"und"}


# --- licences

def plain_scan(text, templates, threshold):
    found = {}
    lines = text.split("\n")
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            a = Counter(licenses.bigrams(licenses.normal_words("\n".join(lines[i:j + 1]))))
            for name, body in templates:
                b = Counter(licenses.bigrams(licenses.normal_words(body)))
                both = sum((a & b).values())
                if both and 2 * both / (sum(a.values()) + sum(b.values())) >= threshold:
                    d = 2 * both / (sum(a.values()) + sum(b.values()))
                    found[name] = max(found.get(name, 0), d)
    return found


def test_licences_against_every_span():
    rng = random.Random(8)
    t = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD)
    for _ in range(60):
        lines = [prose(rng, rng.randint(0, 12)) for _ in range(rng.randint(1, 5))]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = "other"
            cut = rng.randint(1, len(words))
            lines[rng.randint(0, len(lines)):0] = [" ".join(words[:cut]), " ".join(words[cut:])]
        text = "\n".join(lines)
        got = {name: d for name, d, _, _ in licenses.scan(text, t)}
        want = plain_scan(text, licenses.TEMPLATES, licenses.THRESHOLD)
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in got)


def test_licence_lines_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    want = {(r.doc_id, k) for r in docs.collect() for k, line in marks.items() if line in r.text.split("\n")}
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs).collect()}
    assert want and want <= got


def test_licences_within_lines(spark):
    rng = random.Random(9)
    line = "Copyright 2020 Jane Roe. Released under the MIT License. See the file for more."
    longest = max(licenses.TEMPLATES, key=lambda x: len(x[1]))
    folded = f"{prose(rng, 90)} {longest[1]} {prose(rng, 90)}"
    rows = [(1, line, "en", "s", 0), (2, f"{prose(rng, 20)}\n{folded}\nend", "en", "s", 0), (3, prose(rng, 300), "en", "s", 0)]
    got = {(r.doc_id, r.license): r for r in licenses.scan_licenses(docs_frame(spark, rows)).collect()}
    assert set(got) == {(1, "MIT"), (2, longest[0])}
    assert all(r.dice == 1 for r in got.values()) and (got[2, longest[0]].first_line, got[2, longest[0]].last_line) == (1, 1)


def test_licence_words_against_every_span():
    rng = random.Random(10)
    t = licenses.Templates([x for x in licenses.TEMPLATES if len(x[1]) < 110], licenses.THRESHOLD)
    for _ in range(20):
        words = prose(rng, 8).split()
        notice = rng.choice([x for x in licenses.TEMPLATES if len(x[1]) < 110])[1].split()
        notice[rng.randrange(len(notice))] = rng.choice([notice[0], "other"])
        words[4:4] = notice
        words = licenses.normal_words(" ".join(words))
        want = {}
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                a = Counter(licenses.bigrams(words[i:j + 1]))
                for k, (_, b) in enumerate(t.items):
                    d = 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))
                    if d >= t.threshold:
                        want[k] = max(want.get(k, 0), d)
        got = {}
        for k, _, d, _, _ in licenses.spans(words, t):
            got[k] = max(got.get(k, 0), d)
        assert got == want


def test_licence_relatives():
    t = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD)
    for name, text in licenses.TEMPLATES:
        assert [(n, d) for n, d, _, _ in licenses.scan_words(f"zz yy {text}\nxx ww", t)] == [(name, 1)]
    gpl = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
           "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.")
    texts = {"GPL-2.0": gpl, "AGPL-3.0": gpl.replace("GNU", "GNU Affero").replace("version 2", "version 3"),
             "LGPL-2.1": gpl.replace("GNU", "GNU Lesser").replace("program", "library").replace("version 2", "version 2.1"),
             "CC-BY-3.0": "Licensed under CC BY 3.0.", "CC-BY-SA-4.0": "licensed under CC BY-SA 4.0"}
    for name, text in texts.items():
        assert [n for n, _, _, _ in licenses.scan_words(text, t)] == [name]
    both = licenses.scan_words(texts["GPL-2.0"] + " or " + texts["AGPL-3.0"], t)
    assert [n for n, _, _, _ in both] == ["AGPL-3.0", "GPL-2.0"]


# --- chat

@pytest.mark.parametrize("text", ["", "a", "<|done|>", "\\<|", "<\\|turn|>", "\\\\<<||", "é\U0001F600<|says|>\n"])
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    turns = [(text, text), ("assistant", text), ("user", "x" + text)]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [text] * bool(text)


def test_masks_are_exactly_the_assistant_texts(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "é\U0001F600 <|done|> ok"), (1, 2, None, None), (1, 3, "assistant", ""), (1, 4, "assistant", "\n\n"),
            (2, None, "assistant", "first"), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 1, "assistant", "no id"), (3, 0, "assistant", "w " * 5000)]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(out) == 4
    for conv, r in out.items():
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert chat.parse(r.formatted) == [(x[2] or "", x[3] or "") for x in mine]
        text = "".join(chat.unescape(r.formatted[s.start:s.end]) for s in r.loss_spans)
        assert text == "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r.loss_tokens == sorted(set(r.loss_tokens)) and (not r.loss_tokens or r.loss_tokens[-1] < len(r.token_ids))


def test_loss_pieces_cut_tokens_at_span_edges():
    assert chat.loss_pieces([(0, 3), (3, 4), (3, 4), (4, 9)], [(2, 4), (6, 8)]) == ([0, 1, 2, 3], [(2, 4), (6, 8)])
    assert chat.loss_pieces([(0, 3)], []) == ([], [])


# --- vectors

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows, n = [], 0
    for label in (1, 1, 2, None):
        centres = rng.normal(size=(6, 8))
        for c in centres:
            for _ in range(12):
                rows.append((n, [float(x) for x in c + rng.normal(size=8) * 0.18], label))
                n += 1
    hot = [float(x) for x in rng.normal(size=8)]
    rows += [(1000 + i, hot, 2) for i in range(40)] + [(1100, [2 * x for x in hot], 2), (1101, hot[:7], 2), (1102, [-x for x in hot], 2)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [float("nan")] + hot[1:], 2), (2004, [float("inf")] + hot[1:], 2),
             (2005, [None] + hot[1:], 2), (None, hot, 2)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
           embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block_rows=16).collect()}
    fine = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: {j for j, w, k in fine if j != i and k == lab and len(w) == len(v) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.93}
             for i, v, lab in fine}
    for i, v, lab in rows:
        seen, todo = {i}, [i]
        while todo and i is not None:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = None if i is None else min(seen)
        assert got[i] == (len(links.get(i, ())), low, low == i)


# --- quality

def test_quality_of_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    good = {r.doc_id: r.good for r in quality.classify(docs, train).collect()}
    truth = {r.doc_id: r.quality for r in test.collect()}
    assert np.mean([good[i] == bool(q) for i, q in truth.items()]) >= 0.97
    assert np.mean([good[i] for i, q in truth.items() if q]) >= 0.99


def test_sparse_sites_are_shrunk(spark):
    rows = [("a", "x", 900_000)] * 50 + [("a", "y", 0)] + [("b", "x", 100_000)] * 50 + [(None, None, 500_000)] * 3
    proof = spark.createDataFrame([(h is None, h or "", p is None, p or "", s) for h, p, s in rows],
                                  "no_host_ boolean, host_ string, no_path_ boolean, path_ string, proof_ long")
    out = {(r.host_, r.path_): r for r in quality.site_posteriors(proof).collect()}
    assert 0 < out["a", "y"].path_mean_ < out["a", "x"].path_mean_ < 0.9
    assert out["b", "x"].path_mean_ < out["a", "x"].path_mean_
    plain = sum(s for _, _, s in rows) / len(rows) / 1e6
    assert math.isclose(out["a", "x"].prior_, plain)


# --- PII

def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + (k % 2)), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def test_entities_are_replaced_and_the_rest_kept(spark):
    texts = [
        "Write to jane.doe@mail.example.com or JANE.DOE@MAIL.EXAMPLE.COM, not to x@y.", "Call +1 (017) 555-7713 or 017-555-7713.",
        "Card 4111 1111 1111 1111 and 4111111111111111, not 41111111111111112.", "Host 10.0.0.7, v2.0 of 300.1.1.1.",
        "Mr. John Smith met Mrs. Smith and Frau Müller.", 'token = "0123456789abcdef0123"', "nothing here", "", None,
        "Herr Иван wrote to иван", "4003036626649763"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(0, texts[0], None, None, None)]
    out = pii.replace_entities(docs_frame(spark, rows), "k").collect()
    assert len(out) == len(rows)
    new = {r.doc_id: r.text for r in out}
    n = {r.doc_id: r.n_entities for r in out}
    mail = re.fullmatch(r"Write to (\S+@\S+\.com) or (\S+@\S+\.COM), not to x@y\.", new[0])
    assert mail[1].upper() == mail[2] and mail[1] != "jane.doe@mail.example.com" and n[0] == 2
    phone = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})\.", new[1])
    assert phone.groups()[:3] == phone.groups()[3:] and phone[0] != texts[1]
    card = re.fullmatch(r"Card (4\d{3} \d{4} \d{4} \d{4}) and (4\d{15}), not 41111111111111112\.", new[2])
    assert card[1].replace(" ", "") == card[2] != "4111111111111111" and luhn(card[2])
    assert re.fullmatch(r"Host [1-2]\d\.\d\.\d\.\d, v2\.0 of 300\.1\.1\.1\.|Host \d\d\.\d\.\d\.\d, v2\.0 of 300\.1\.1\.1\.", new[3]) and new[3] != texts[3]
    name = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) and Frau (\w+)\.", new[4])
    assert name[1] in pii.MALE_NAMES and "Smith" not in new[4] and "Müller" not in new[4] and len(name[3]) == 5
    assert re.fullmatch(r'token = "[0-9a-z]{20}"', new[5]) and new[5] != texts[5]
    assert (new[6], new[7], new[8]) == ("nothing here", "", None) and n[6] == n[7] == n[8] == 0
    assert re.fullmatch(r"Herr [А-Я][а-я]{3} wrote to иван", new[9])
    assert new[10] != texts[10] and luhn(new[10]) == luhn(texts[10])


def test_collisions_are_drawn_again(spark):
    """All 9 x 9 addresses of one form and many two-letter mails compete for few stand-ins."""
    ips = [(100 + i, f"{a}.{b}.1.1") for i, (a, b) in enumerate((a, b) for a in range(1, 10) for b in range(1, 10))]
    mails = [(500 + i, f"{c}@{d}.io") for i, (c, d) in enumerate((c, d) for c in "aeiou" for d in "bcd")]
    rows = [(i, t, None, None, None) for i, t in ips + mails]
    out = {r.doc_id: r.text for r in pii.replace_entities(docs_frame(spark, rows), "k").collect()}
    assert len(set(out.values())) == len(rows)
    assert not set(out.values()) & {t for _, t in ips + mails}


def replaced(spark, texts, key="k"):
    rows = pii.replace_entities(docs_frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), key).collect()
    return {r.doc_id: r.text for r in rows}, {r.doc_id: r.n_entities for r in rows}


def test_no_script_passes_through(spark):
    names = ["Արամ Խաչատրյան", "王 伟明", "محمد علي", "דוד כהן", "राम कुमार", "ᏣᎳᎩ ᎠᏂᏴᏫ", "გიორგი ბერიძე", "김 민준"]
    new, n = replaced(spark, [f"Mr. {x} came, {x.split()[1]} said." for x in names])
    for i, x in enumerate(names):
        assert n[i] == 2 and not any(part in new[i] for part in x.split()), (x, new[i])
        name = re.fullmatch(r"Mr\. (\S+) (\S+) came, (\S+) said\.", new[i])
        assert name[2] == name[3]


def test_short_forms_follow_the_full_name(spark):
    texts = ["Mr. John Smith met Dr. Jane Roe. Mr. Smith left. Roe stayed, SMITH too; Smith's and Mrs. Roe. Smithson.", "Mr. Smith and Smith.",
             "Mrs. Ann Lee and Mr. Bob Lee: Mr. Lee, Mrs. Lee."]
    new, n = replaced(spark, texts)
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Dr\. (\w+) (\w+)\. Mr\. (\w+) left\. (\w+) stayed, SMITH too; (\w+)'s and Mrs\. (\w+)\. Smithson\.", new[0])
    assert m and m[1] in pii.MALE_NAMES and m[2] == m[5] and m[4] == m[6] == m[8] and "Roe" not in new[0]
    assert n[0] == 5 + (m[7] != "Smith") and m[7] == "Smith"    # an apostrophe makes it another word
    m = re.fullmatch(r"Mr\. (\w+) and (\w+)\.", new[1])
    assert m[1] == m[2] != "Smith" and n[1] == 2
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) and Mr\. (\w+) (\w+): Mr\. (\w+), Mrs\. (\w+)\.", new[2])
    assert m[1] in pii.FEMALE_NAMES and m[3] in pii.MALE_NAMES and m[4] == m[5] and m[2] == m[6]


def iban_ok(v):
    v = v.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def test_wider_patterns(spark):
    texts = ["Call +49 30 1234567 or +49 (30) 123-4567, +33 1 23 45 67 89.", "Card 378282246310005, 3782 822463 10005 and 30569309025904; id 123456789012345.",
             "Pay DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432.", "At 2001:db8:85a3::8a2e:370:7334 and FE80::1, not 10:30:45 or std::a."]
    new, n = replaced(spark, texts)
    m = re.fullmatch(r"Call \+49 (\d\d) (\d{7}) or \+49 \((\d\d)\) (\d{3})-(\d{4}), \+33 (\d) (\d\d) (\d\d) (\d\d) (\d\d)\.", new[0])
    assert m[1] + m[2] == m[3] + m[4] + m[5] != "301234567" and n[0] == 3
    m = re.fullmatch(r"Card (3\d{14}), (3\d{3}) (\d{6}) (\d{5}) and (3\d{13}); id 123456789012345\.", new[1])
    assert m[1] == m[2] + m[3] + m[4] != "378282246310005" and luhn(m[1]) and luhn(m[5]) and n[1] == 3
    m = re.fullmatch(r"Pay (DE\d\d(?: \d{4}){4} \d\d) or (GB\d\d[A-Z]{4}\d{14})\.", new[2])
    assert iban_ok(m[1]) and iban_ok(m[2]) and "3704" not in m[1] and n[2] == 2
    assert re.fullmatch(r"At [0-9]{4}:[a-f0-9]{3}:[a-f0-9]{4}::[a-f0-9]{4}:\d{3}:\d{4} and [A-F]{2}\d\d::\d, not 10:30:45 or std::a\.", new[3]) and n[3] == 2
    assert not any(x in new[3] for x in ("85a3", "FE80::1"))


def test_the_key_decides(spark):
    import hashlib
    import hmac
    texts = ["Mail jane@site.org, card 4111111111111111."]
    one, two = (replaced(spark, texts, k)[0][0] for k in ("a", "b" * 300))
    assert one != two and one == replaced(spark, texts, "a")[0][0]
    for key in ("a", "b" * 300):
        got = spark.range(1).select(pii.keyed_digest(key, F.lit("email"), F.lit("é@x.y")).alias("d")).first()["d"]
        assert got == hmac.new(key.encode(), "email|é@x.y".encode(), hashlib.sha512).hexdigest()


def test_corpus_wide_distinctness_and_coreference(spark):
    rng = random.Random(9)
    people = [f"{t} {g} {f}" for t in ("Mr.", "Mrs.", "Dr.") for g in ("Al", "Bo", "Cy") for f in ("Orr", "Ash", "Ely")]
    texts = [" ".join(rng.choice(people) + "," for _ in range(4)) for _ in range(60)]
    new, _ = replaced(spark, texts)
    seen = {}
    for i, t in enumerate(texts):
        for a, b in zip(t.split(","), new[i].split(",")):
            if a.strip():
                assert seen.setdefault(a.strip(), b.strip()) == b.strip() != a.strip()
    assert len(set(seen.values())) == len(seen)


def test_vectors_with_clashing_columns(spark):
    """Nulls in every column, repeated rows, columns named like working ones, an empty table."""
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (2, [1.0, 0.01], "a"), (3, None, "a"), (4, [1.0, 0.0], None), (None, [1.0, 0.0], "a"), (5, [0.0, 0.0], "a")]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    extra = plain.withColumns({c: F.lit("x") for c in ("id", "v", "rep", "copies", "cell", "part", "n_links", "kept")})
    want = sorted(embedding_dedup.link_vectors(plain).collect(), key=str)
    assert sorted(embedding_dedup.link_vectors(extra).collect(), key=str) == want
    assert {(r.vec_id, r.n_links, r.component_id) for r in want} == {(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (None, 0, None), (5, 0, 5)}
    assert embedding_dedup.link_vectors(plain.limit(0)).count() == 0
