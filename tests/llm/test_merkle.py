import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelflume.llm import merkle
from panelflume.llm.ordering import numbered
from tests.llm.helpers import clashing, docs_frame, odd_docs

SF = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def plain(rows):
    """The result by rehashing everything, rows being (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, digest(*map(field, r)), r))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {k: levels([leaf for _, _, leaf, _ in sorted(by[k], key=lambda x: x[:3])]) for k in keys}
    over = levels([trees[k][-1][0] for k in keys])
    out = []
    for at, k in enumerate(keys):
        for i, (_, _, leaf, r) in enumerate(sorted(by[k], key=lambda x: x[:3])):
            value, siblings = leaf, []
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                value = digest(*map(field, (*r[:4], r[4].translate(str.maketrans(merkle.UPPER, merkle.LOWER)))))
            for tree, p in ((trees[k], i), (over, at)):
                for level in tree[:-1]:
                    run = level[p // 16 * 16:p // 16 * 16 + 16]
                    siblings += run[:p % 16] + run[p % 16 + 1:]
                    value = digest(*run[:p % 16], value, *run[p % 16 + 1:])
                    p //= 16
            root = over[-1][0]
            out.append((r[0], leaf, trees[k][-1][0], root, digest(*siblings), value, value == root))
    return sorted(out, key=str)


def verified(docs):
    made = merkle.manifest(docs, lambda i: F.crc32(i.cast("string").cast("binary")) % 5 == 0)
    return sorted(map(tuple, merkle.verify(made).collect()), key=str)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]


def test_one_deep_source_beside_small_ones(spark):
    deep = spark.range(5000).selectExpr("id as doc_id", "concat('Text ', id) as text", "'en' as lang", "if(id < 4700, null, concat('s', id % 40)) as source", "id as n_chars")
    assert verified(deep) == plain(rows_of(deep))


@pytest.mark.parametrize("rows", [[], [(1, "Aé", "en", "s", 2)], odd_docs(), odd_docs() * 3])
def test_odd_tables(spark, rows):
    docs = docs_frame(spark, rows)
    assert verified(docs) == plain(rows_of(docs))


def test_clashing_columns(spark):
    docs = docs_frame(spark, odd_docs())
    extra = clashing(docs).withColumns({c: F.lit("x") for c in ("tree", "digest", "place_", "total", "path", "leaf", "root")})
    assert verified(extra) == plain(rows_of(docs))


def test_fold_resumes_the_kept_state():
    children = [digest(str(i)) for i in range(16)]
    run = merkle.Run(children)
    assert run.digest == digest(*children)
    for i in (0, 7, 15):
        assert run.fold(i, digest("new")) == digest(*children[:i], digest("new"), *children[i + 1:])
        assert run.fold(i, children[i]) == run.digest


def test_numbered_spreads_one_key(spark):
    rows = spark.range(20000).selectExpr("if(id % 3 = 0, null, cast(id % 2 as string)) as k", "cast(null as int) as o")
    places = numbered(rows, "k", ["o"]).groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("place_").alias("d"), F.max("place_").alias("m"))
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in places.collect())
