"""Quality classifier: a document's own evidence, corrected by what its host and path are like (empirical Bayes)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelflume.llm.common import opened, saved, sealed

SAMPLE_ROWS = 20_000
SLICE_ROWS = 256
THRESHOLD = 0.5
CLIP = 1e-4
MARKS = "|!*$#%&"
FEATURES = 11


def _byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte: 0 lower case or beyond ASCII, 1 upper case, 2 digit, 3 white space, 4 other, 5 and up MARKS."""
    table = np.zeros(256, dtype=np.uint8)
    for b in range(128):
        ch = chr(b)
        table[b] = (5 + MARKS.index(ch) if ch in MARKS else 1 if ch.isupper() else 2 if ch.isdigit() else
                    3 if ch.isspace() else 0 if ch.islower() else 4)
    return table


CLASSES = _byte_classes()


def features(text: str | None) -> list[float]:
    """Shares of byte classes, word lengths and repetition of a whole text; an empty one has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    tokens = (text or "").split()
    if not tokens:
        return [0.0] * FEATURES
    counts = np.bincount(CLASSES[np.frombuffer(raw, dtype=np.uint8)], minlength=5 + len(MARKS)) / len(raw)
    n, distinct = len(tokens), len(set(tokens))
    repeats = sum(a == b for a, b in zip(tokens, tokens[1:])) / n
    return [1.0, np.log1p(n) / 10, counts[1] * 5, counts[2] * 5, counts[4] * 5, counts[5] * 10, counts[6] * 10,
            counts[7:].sum() * 10, min(distinct / n ** 0.8, 2.0), repeats, min(len(raw) / n / 10, 3.0)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights by Newton's method with a ridge penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    """Weights from a bounded sample: the labelled documents with the smallest hashes of their ids.

    The sample's ids and labels (at most sample_rows, 16 bytes each) are broadcast, its features collected. None if there
    are no labelled documents. Of an id labelled more than once the smallest label counts.
    """
    spark = docs.sparkSession
    chosen = (labels.select(F.col("doc_id").alias("id_"), F.col("quality").alias("y_")).dropna()
              .groupBy("id_").agg(F.min("y_").alias("y_")).orderBy(F.xxhash64("id_"), "id_").limit(sample_rows))
    rows, names = sealed(docs.select("doc_id", "text"))
    picked = rows.join(F.broadcast(saved(chosen)), F.col(names["doc_id"]) == F.col("id_")).select(F.col(names["text"]).alias("t_"), "y_")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"x": [features(t) for t in pdf["t_"]], "y_": pdf["y_"].astype(float)})

    got = spark.createDataFrame([], "x array<double>, y_ double").unionByName(
        picked.mapInPandas(measure, "x array<double>, y_ double")).collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["y_"], r["x"]))  # the fit doesn't depend on the order of tasks
    return fit_logistic(np.array([r["x"] for r in got]), np.array([r["y_"] for r in got]))


def _with_evidence(rows: DataFrame, text: str, weights: np.ndarray | None) -> DataFrame:
    """rows with proof_: the classifier's probability of good quality in millionths."""
    at = rows.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t for first in range(0, batch.num_rows, SLICE_ROWS) for t in batch.column(at).slice(first, SLICE_ROWS).to_pylist())
            x = np.array([features(t) for t in texts]).reshape(-1, FEATURES)
            p = np.full(len(x), 0.5) if weights is None else 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            millionths = pa.array(np.rint(p * 1e6).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, millionths], names=[*batch.schema.names, "proof_"])
            pa.default_memory_pool().release_unused()

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", proof_ long"
    return rows.mapInArrow(score, schema)


def _shrunk(total, n, prior, strength):
    return (total + strength * prior) / (n + strength)


def site_posteriors(proof: DataFrame) -> DataFrame:
    """host_, path_ (with nulls told apart by flags) -> mean_ (the path's posterior mean) and prior_ (the global one).

    Counts and sums of evidence per path, rolled up to hosts and to the whole. How strongly a level is drawn to the level
    above comes from moments: the spread of group means beyond what sampling explains. Sums are of whole millionths, so
    they do not depend on the order of rows.
    """
    keys = ["no_host_", "host_", "no_path_", "path_"]
    paths = saved(proof.groupBy(*keys).agg(F.count("*").alias("n_"), F.sum("proof_").alias("s_")))
    hosts = paths.groupBy("no_host_", "host_").agg(F.sum("n_").alias("hn_"), F.sum("s_").alias("hs_"))
    whole = hosts.agg((F.sum("hs_") / F.sum("hn_") / 1e6).alias("prior_"))

    def strength(groups: DataFrame, n: str, s: str, centre: str) -> DataFrame:
        """One row: pseudo-counts by which a group is shrunk to its centre, between 1 and 1e6."""
        mean = F.col(s) / F.col(n) / 1e6
        seen = groups.agg((F.sum(F.col(n) * (mean - F.col(centre)) ** 2) / F.sum(n)).alias("var_"),
                          (F.count("*") / F.sum(n)).alias("inv_"), F.avg(F.col(centre) * (1 - F.col(centre))).alias("own_"))
        between = F.col("var_") - F.col("own_") * F.col("inv_")
        return seen.select(F.when(between > 0, F.least(F.greatest(F.col("own_") / between, F.lit(1.0)), F.lit(1e6)))
                           .otherwise(F.lit(1e6)).alias("k_"))

    one = F.lit(1)
    hosts = hosts.withColumn("one_", one).join(F.broadcast(whole.withColumn("one_", one)), "one_")  # one row, by aggregate
    hosts = hosts.join(F.broadcast(strength(hosts, "hn_", "hs_", "prior_").withColumn("one_", one)), "one_").drop("one_")
    hosts = hosts.select("no_host_", "host_", "prior_", _shrunk(F.col("hs_") / 1e6, F.col("hn_"), F.col("prior_"), F.col("k_"))
                         .alias("host_mean_"))
    paths = paths.join(hosts, ["no_host_", "host_"]).withColumn("one_", one)
    paths = paths.join(F.broadcast(strength(paths, "n_", "s_", "host_mean_").withColumn("one_", one)), "one_").drop("one_")
    return paths.select(*keys, "prior_", "host_mean_", _shrunk(F.col("s_") / 1e6, F.col("n_"), F.col("host_mean_"), F.col("k_"))
                        .alias("path_mean_"))


def logit(p):
    p = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", text: str = "text",
             doc_id: str = "doc_id", threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every row of docs with evidence, host_mean, path_mean, quality_score and good.

    evidence: a logistic model of the whole text, fitted on a bounded sample of labelled rows. Host and path means are
    posteriors of the evidence over all documents: a path's few documents are drawn to its host's mean, a host's to the
    global one. The score adds to the document's log odds what its path's log odds exceed the global ones by; good is
    score >= threshold. Where documents have no URL, host is their source and path their language within it.

    Null and empty texts have evidence from length alone; null hosts or paths are groups of their own; without labels all
    evidence is one half and everything is good. Repeated rows score alike. An empty table gives an empty result. Columns
    of docs named like a result column are replaced by it.
    """
    results = ["evidence", "host_mean", "path_mean", "quality_score", "good"]
    docs = docs.drop(*results)
    weights = fit(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), labels, sample_rows)
    rows, names = sealed(docs)

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"no_host_": F.col(names[host]).isNull(), "host_": F.coalesce(F.col(names[host]).cast("string"), F.lit("")),
                               "no_path_": F.col(names[path]).isNull(), "path_": F.coalesce(F.col(names[path]).cast("string"), F.lit(""))})

    keys = ["no_host_", "host_", "no_path_", "path_"]
    proof = _with_evidence(rows.select(*dict.fromkeys([names[host], names[path], names[text]])), names[text], weights)
    sites = saved(site_posteriors(keyed(proof).select(*keys, "proof_")))
    used = keyed(rows).withColumn("salt_", F.pmod(F.xxhash64(F.col(names[doc_id])), F.lit(16)).cast("int"))
    spread = sites.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(15))))
    scored = _with_evidence(used, names[text], weights).join(spread, [*keys, "salt_"])
    scored = scored.withColumn("own_", F.col("proof_") / 1e6)
    log_odds = logit(F.col("own_")) + logit(F.col("path_mean_")) - logit(F.col("prior_"))
    scored = scored.withColumn("score_", 1 / (1 + F.exp(-log_odds)))
    return opened(scored, names, F.col("own_").alias("evidence"), F.col("host_mean_").alias("host_mean"),
                  F.col("path_mean_").alias("path_mean"), F.col("score_").alias("quality_score"),
                  (F.col("score_") >= threshold).alias("good"))
