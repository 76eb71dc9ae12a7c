"""Every corpus query against its SQL, and on odd, empty and clashing tables."""
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from panelflume.llm import chat, embedding_dedup, exact_dedup, langid, licenses, mixing, near_dedup, packing, pii, quality
from panelflume.llm.queries import QUERIES
from tests.llm.helpers import clashing, docs_frame, odd_docs
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"

ON_DOCS = {
    "pii": lambda d: pii.replace_entities(d, "k"), "near": near_dedup.link_documents, "exact": exact_dedup.mark_copies,
    "quality": lambda d: quality.classify(d, d.sparkSession.createDataFrame([(4, 1, 0), (6, 0, 0), (6, 1, 0), (None, 1, 1), (5, None, 0)], LABELS)),
    "langid": lambda d: langid.predict_language(d, langid.sample_texts(d.select("text", "lang"))),
    "licenses": licenses.scan_licenses, "mixing": mixing.mix, "packing": packing.pack,
}


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, name):
    ok, note = compare(QUERIES[name].run(spark, SF), connect(SF), QUERIES[name].sql)
    assert ok, note


def test_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "minhash near-dedup", "source mixing", "best-fit packing"]


@pytest.mark.parametrize("name", ON_DOCS)
def test_empty_table(spark, name):
    assert ON_DOCS[name](docs_frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", ON_DOCS)
def test_clashing_columns(spark, name):
    rows = odd_docs()
    plain, extra = ON_DOCS[name](docs_frame(spark, rows)), ON_DOCS[name](clashing(docs_frame(spark, rows)))
    columns = plain.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, plain.collect()), key=key) == sorted(map(tuple, extra.select(*columns).collect()), key=key)


def test_empty_vectors_and_conversations(spark):
    assert embedding_dedup.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).collect() == []
