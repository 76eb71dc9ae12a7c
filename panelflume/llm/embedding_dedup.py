"""Near-duplicate vectors: an exact range join in a metric space partitioned by pivots."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelflume.llm.common import attach, salt, saved
from panelflume.llm.components import components

COSINE = 0.93
PIVOTS = 8
BLOCK_ROWS = 4096
SLACK = 1e-9


def usable(vector: str) -> str:
    """SQL: the vector has components, none of them null or non-finite, and is not zero."""
    return (f"coalesce({vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and "
            f"abs(x) < cast('Infinity' as double)) and exists({vector}, x -> x <> 0), false)")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by their largest component first, so that squares neither overflow nor vanish."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cells_of(v: np.ndarray, pivots: np.ndarray, reach: float) -> list[np.ndarray]:
    """For each unit vector its home cell (the nearest pivot's), then the cells within reach of it.

    Seen from y in cell j and at most `reach` from x, the triangle inequality gives d(x, p_j) <= d(x, p_home) + 2 reach; the
    plane midway between the two pivots gives the sharper (d(x, p_j)^2 - d(x, p_home)^2) <= 2 reach d(p_j, p_home).
    """
    d = np.sqrt(np.maximum(((v[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0))
    home = d.argmin(axis=1)
    own = d[np.arange(len(v)), home][:, None]
    apart = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))[home]
    near = (d <= own + 2 * reach + SLACK) & (d * d - own * own <= 2 * reach * apart + SLACK)
    near[np.arange(len(v)), home] = False
    return [np.concatenate(([h], np.flatnonzero(n))) for h, n in zip(home, near)]


def choose_pivots(vectors: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """For each dimension up to `pivots` vectors, chosen by hash: a bounded sample, whatever the number of labels."""
    few = (vectors.withColumn("at_", F.pmod(F.xxhash64("v"), F.lit(pivots)).cast("int"))
           .groupBy("dim", "at_").agg(F.min_by("v", F.xxhash64("v", F.lit(1))).alias("v")).collect())
    out: dict[int, list] = {}
    for r in sorted(few, key=lambda r: (r["dim"], r["at_"])):
        out.setdefault(r["dim"], []).append(r["v"])
    return {k: unit(np.array(v, dtype=np.float64)) for k, v in out.items()}


def linked_roots(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a boolean matrix the first row of their connected part, -1 where nothing is hit."""
    rows, cols = np.full(hit.shape[0], -1), np.full(hit.shape[1], -1)
    for i in np.flatnonzero(hit.any(axis=1)):
        if rows[i] >= 0:
            continue
        front = np.array([i])
        rows[i] = i
        while len(front):
            new = np.flatnonzero(hit[front].any(axis=0) & (cols < 0))
            cols[new] = i
            front = np.flatnonzero(hit[:, new].any(axis=1) & (rows < 0))
            rows[front] = i
    return rows, cols


def join_block(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one pair of blocks of a cell: per home row the copies it meets (n), and for every linked vector another of
    its connected part (to), never all pairs.

    Rows of part 0 stand on the left, of part 1 on the right. Only home rows are on the left, each in its own cell, so every
    row counts each of its links once.
    """
    left, right = pdf[pdf.part == 0], pdf[pdf.part == 1]
    none = np.zeros(0, dtype="int64")
    if left.empty or right.empty:
        return pd.DataFrame({"rep": none, "n": none, "to": none})
    a, b = np.stack(left.v.to_numpy()).astype(np.float64), np.stack(right.v.to_numpy()).astype(np.float64)
    ua, ub = unit(a), unit(b)
    ids, others, copies = left.rep.to_numpy(), right.rep.to_numpy(), right.copies.to_numpy()
    parts = [(none, none, none)]
    for at in range(0, len(ua), 512):
        mine = ids[at:at + 512]
        sims = ua[at:at + 512] @ ub.T
        hit = sims >= cosine
        for i, j in np.argwhere(np.abs(sims - cosine) < SLACK):
            x, y = a[at + i], b[j]
            hit[i, j] = float(x @ y) / (float(np.sqrt(x @ x)) * float(np.sqrt(y @ y))) >= cosine
        hit &= mine[:, None] != others[None, :]
        n, (rows, cols) = hit @ copies, linked_roots(hit)
        r, c = np.flatnonzero(rows >= 0), np.flatnonzero(cols >= 0)
        parts += [(mine[r], n[r], mine[rows[r]]), (others[c], np.zeros(len(c), dtype="int64"), mine[cols[c]])]
    rep, n, to = (np.concatenate(x).astype("int64") for x in zip(*parts))
    return pd.DataFrame({"rep": rep, "n": n, "to": to})


def link_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 cosine: float = COSINE, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept. Vectors of equal label and dimension link at cosine or more.

    Cosine c of two vectors is the distance sqrt(2 - 2c) of their unit vectors, so the join is a range join in a metric
    space. Equal vectors of a label are one class first and counted by weight. Pivots divide the space into cells; a vector is
    at home in its nearest pivot's cell and copied to the cells that the triangle inequality leaves within reach. Cells join
    independently. A cell of more than block_rows rows is cut into blocks by hash and its pairs of blocks join independently, so
    a task holds at most two blocks. A pair's similarity near the threshold is computed again from the vectors as they are.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or id, link with
    nothing. Repeated rows are equal vectors and link. An empty table gives an empty result. Other columns do not matter. Where
    an id repeats with different vectors, their links are those of the id.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"),
                          F.col(embedding).cast("array<double>").alias("v"))
    good = F.expr(usable("v")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    classes = saved(rows.where(good).withColumn("dim", F.size("v")).groupBy("label", "dim", "v")
                    .agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    chosen, reach = choose_pivots(classes, pivots), float(np.sqrt(2 - 2 * cosine))

    def assign(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                for at in range(0, len(part), 1024):
                    some = part.iloc[at:at + 1024]
                    cells = cells_of(unit(np.stack(some.v.to_numpy()).astype(np.float64)), chosen[dim], reach)
                    yield some.assign(cells=cells)[["label", "dim", "rep", "copies", "v", "cells"]]

    kind = dict(classes.dtypes)["label"]
    placed = classes.mapInPandas(assign, f"label {kind}, dim int, rep long, copies long, v array<double>, cells array<int>")
    placed = saved(placed.select("label", "dim", "rep", "copies", "v", F.posexplode("cells").alias("ghost", "cell")))
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    placed = attach(placed, sizes, cell, ["rep"]).withColumn("block", salt(2 ** 31 - 1, F.col("rep")) % F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["rep", "copies", "v", "part"]
    left = placed.where("ghost = 0").withColumn("part", F.lit(0)).withColumn("other", every)
    right = placed.withColumn("part", F.lit(1)).withColumn("other", every)
    both = left.select(*cell, F.col("block").alias("i"), F.col("other").alias("j"), *columns).unionByName(
        right.select(*cell, F.col("other").alias("i"), F.col("block").alias("j"), *columns))
    met = saved(both.groupBy(*cell, "i", "j").applyInPandas(lambda pdf: join_block(pdf, cosine), "rep long, n long, to long"))
    counts = met.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = components(met.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    reps = classes.join(counts, "rep", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    reps = reps.select("label", "v", F.col("rep"), "copies", F.coalesce("n", F.lit(0)).alias("n"),
                       F.coalesce("component_id", "rep").alias("component"))
    linked = attach(rows.where(good), reps, ["label", "v"], ["id"])
    n, comp = F.col("copies") - 1 + F.col("n"), F.col("component")
    out = linked.select(F.col("id").alias("vec_id"), n.alias("n_links"), comp.alias("component_id"))
    alone = rows.where(~good).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
