"""The corpus operators as named queries over whole tables, with checking SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflume.llm import (chat, conversation_repair, embedding_dedup, exact_dedup, langid, licenses, merkle, mixing, near_dedup, packing, pii,
                            quality, token_files)
from panelflume.llm.manifest_sql import OP12_SQL, OP13_SQL


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, "key of the registered query").select("doc_id", "text", "n_entities")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link_documents(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "evidence", "host_mean", "path_mean", "quality_score", "good")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    samples = langid.sample_texts(docs.where(~F.coalesce(held_out, F.lit(False))).select("text", "lang"))
    return langid.predict_language(docs.select("doc_id", "text"), samples).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(f"select cast(-1 as bigint) conv_id, cast(t as bigint) turn, r role, '{control}' text "
                        "from values (0, 'user'), (1, 'assistant') as v(t, r)")
    return chat.digests(chat.format_conversations(turns.unionByName(planted))).drop("n_tokens", "n_loss_tokens")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, near=packing.near_clusters(docs))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_back(token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = merkle.manifest(table(spark, sf_dir, "documents"), lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0)
    return merkle.verify(made)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.audit(turns, conversation_repair.repair(turns, damage=True))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


WORDS = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM l JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n_shingles + nb.n_shingles - i)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT n.doc_id, n_shingles, least(n.doc_id, coalesce(c.b, n.doc_id)) AS component_id,
       n.doc_id = least(n.doc_id, coalesce(c.b, n.doc_id)) AS kept
FROM n LEFT JOIN c ON c.a = n.doc_id"""

OP3_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)"""

OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id"""

OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {WORDS})), 0) AS BIGINT) AS size, coalesce(length(text), 0) AS chars
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, ss * 2 AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST) AS k, (sum(ss) OVER ()) * 1.5::DOUBLE AS whole FROM w),
f AS (SELECT *, (whole - (SELECT coalesce(sum(p.cap), 0) FROM o p WHERE p.k < o.k)) / (SELECT sum(p.weight) FROM o p WHERE p.k >= o.k) AS level FROM o),
t AS (SELECT *, CASE WHEN level > cap / weight THEN CAST(cap AS DOUBLE)
      ELSE weight * (SELECT level FROM f q WHERE NOT q.level > q.cap / q.weight ORDER BY k LIMIT 1) END AS target FROM f),
u AS (SELECT d.*, ss, target, -ln((CAST(CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
             / 4503599627370496.0::DOUBLE) / CASE WHEN chars BETWEEN size * 3 AND size * 12 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS key
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before,
      CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS BIGINT) ELSE 0 END AS epochs FROM u)
SELECT doc_id, size, ss AS source_size, target,
       CAST(CASE WHEN size > 0 THEN size * (epochs + CASE WHEN before * 2 + size <= (target - epochs * ss) * 2 THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM p"""


def _escaped(x: str) -> str:
    return f"replace(replace({x}, '\\', '\\\\'), '<|', '<\\|')"


OP9_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_escaped('role')}) + length({_escaped('text')}) + {len(chat.OPEN + chat.MIDDLE + chat.CLOSE)}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

QUERIES = {
    "op1_pii_surrogates": Query(op1_pii_surrogates, None),
    "op2_minhash_near_dedup": Query(op2_minhash_near_dedup, OP2_SQL),
    "op3_exact_dedup": Query(op3_exact_dedup, OP3_SQL),
    "op4_quality_classifier": Query(op4_quality_classifier, None),
    "op5_embedding_near_dedup": Query(op5_embedding_near_dedup, OP5_SQL),
    "op6_language_id": Query(op6_language_id, None),
    "op7_license_scan": Query(op7_license_scan, None),
    "op8_source_mixing": Query(op8_source_mixing, OP8_SQL),
    "op9_chat_format": Query(op9_chat_format, OP9_SQL),
    "op10_best_fit_packing": Query(op10_best_fit_packing, None),
    "op11_token_files": Query(op11_token_files, None),
    "op12_merkle_manifest": Query(op12_merkle_manifest, OP12_SQL),
    "op13_conversation_repair": Query(op13_conversation_repair, OP13_SQL),
    "pipeline": Query(pipeline, None),
}
