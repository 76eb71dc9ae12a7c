import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from panelflume.llm import token_files
from panelflume.llm.queries import QUERIES
from tests.llm.helpers import clashing, docs_frame, odd_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_files.TOKENIZER)


def plain(tokenizer, rows):
    """doc_id, start, n_tokens, ids_crc32 of (doc_id, text) rows, encoded one by one."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(2)
    atoms = ["a", "b'", " ", "  ", "\n", "é", "1", "<|endoftext|>", ".", "\x1c", "\x85", "　", "字", "'s", "\U0001F600"]
    texts = ["", " ", "a  b", "a   b", "a \n b", "it's  'll", *["".join(rng.choice(atoms) for _ in range(rng.randint(0, 60))) for _ in range(800)]]
    encoder = token_files.WordEncoder(tokenizer.to_str())
    for k in range(0, len(texts), 97):
        for text, ids in zip(texts[k:k + 97], encoder.ids(pa.array(texts[k:k + 97]))):
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, token_files.END], repr(text)


@pytest.mark.parametrize("base", [4, 50257, 80000])
def test_grammar_round_trip_and_random_access(base):
    rng = random.Random(base)
    for _ in range(60):
        n = rng.randint(1, 4000)
        ids = np.array([base - 1 - min(int(rng.expovariate(0.8)), 3) for _ in range(n)], dtype=np.uint32)
        sizes = np.diff([0, *sorted(rng.sample(range(1, n), min(n - 1, 3))), n])
        shard = token_files.Shard(token_files.compress(ids, sizes, base))
        assert (shard.expand(shard.symbols) == ids).all()
        for doc, begin in enumerate(np.cumsum(sizes) - sizes):
            a, b = rng.randint(0, int(sizes[doc])), rng.randint(0, int(sizes[doc]) + 5)
            assert shard.read(doc, a, b).tolist() == ids[begin:begin + sizes[doc]][a:b].tolist()


def test_repeats_shrink_and_runs_pair_up():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    payload = token_files.compress(ids, np.array([len(ids)]), 50)
    assert len(payload) < len(ids) // 4
    same = np.zeros(1001, dtype=np.uint32)
    shard = token_files.Shard(token_files.compress(same, np.array([1001]), 1))
    assert len(shard.symbols) < 40 and (shard.read(0) == same).all()


def test_checksums_join():
    for a, b in ((b"", b"xyz"), (b"abc", b""), (b"abcd", b"0123456789" * 7)):
        assert token_files.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_query_is_the_plain_encoding(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_token_files"].run(spark, SF).collect()), key=str) == plain(tokenizer, rows)


def test_odd_documents_and_clashing_columns(spark, tokenizer):
    docs = docs_frame(spark, [r for r in odd_docs() if r[0] is not None])
    for df in (docs, clashing(docs).withColumns({c: docs["lang"] for c in ("part_", "order", "shard", "start", "payload")})):
        got = token_files.read_back(token_files.write(df))
        expected = plain(tokenizer, [(r[0], r[1]) for r in docs.collect()])
        assert sorted(map(tuple, got.collect()), key=str) == expected
    assert token_files.read_back(token_files.write(docs_frame(spark, []))).collect() == []
    null = docs_frame(spark, [(None, "a b", "en", "x", 1), (None, None, "en", "x", 1), (3, "c", "en", "x", 1)])
    rows = token_files.read_back(token_files.write(null)).collect()
    assert {r["doc_id"] for r in rows if r["start"] < 3} == {None} and [r["start"] for r in rows if r["doc_id"] == 3] == [4]


def test_long_documents_span_shards(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 1000)
    docs = docs_frame(spark, odd_docs()).where("doc_id is not null and doc_id <> 5")
    shards = token_files.write(docs)
    assert shards.agg({"n_ids": "max"}).first()[0] == 1000 and shards.count() > 10
    expected = plain(tokenizer, [(r[0], r[1]) for r in docs.collect()])
    assert sorted(map(tuple, token_files.read_back(shards).collect()), key=str) == expected


@pytest.mark.parametrize("kind", [np.uint32, np.uint64])
def test_wanted_pairs_are_all_found(kind):
    """More wanted codes than a small table has room for, so that many lose their slot; the rest by a plain search."""
    rng = np.random.default_rng(4)
    wanted = rng.permutation(np.unique(rng.integers(0, 1 << 20, 8000)))[:7000].astype(kind)
    codes, inside = rng.integers(0, 1 << 20, 50_000).astype(kind), rng.random(50_000) < .9
    codes[:7000] = wanted
    place = {int(w): i for i, w in enumerate(wanted)}
    expected = [(i, place[int(c)]) for i, c in enumerate(codes) if inside[i] and int(c) in place]
    at, rank = token_files._matches(codes, inside, wanted)
    assert list(zip(at.tolist(), rank.tolist())) == expected and len(expected) > 6000
    at, rank = token_files._matches(codes[:0], inside[:0], wanted)
    assert len(at) == len(rank) == 0
