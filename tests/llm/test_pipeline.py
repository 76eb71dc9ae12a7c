"""The corpus pipeline stage by stage against brute force."""
import hashlib
from collections import Counter

import corpus_pipeline
from panelflume.llm.common import scratch
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        folder = scratch(spark)
        stage(spark, frames[-1], SF).write.parquet(folder)
        frames.append(spark.read.parquet(folder))
    rows = [f.collect() for f in frames]
    assert all(f.columns == columns for f in frames[1:-1])
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows[1]}
    assert all((r.doc_id in kept) == bool(quality[r.doc_id]) for r in rows[0] if r.doc_id in quality)
    best = {}
    for r in rows[1]:
        h = hashlib.sha256(r.text.encode()).hexdigest()
        best[h] = max(best.get(h, -1), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(best.values())
    assert sorted(r.doc_id for r in rows[3]) == sorted({c for _, _, c in brute([(r.doc_id, r.text) for r in rows[2]])})
    words = Counter()
    for r in rows[4]:
        words[r.doc_id] += len(r.text.split())
    whole = sum(len(r.text.split()) for r in rows[3])
    assert abs(sum(words.values()) - 1.5 * whole) < 0.02 * whole + 20 * max(len(r.text.split()) for r in rows[3])
    placed = Counter()
    for r in rows[5]:
        placed[r.doc_id] += r.n_words
    assert placed == words
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, rows[5]))
