"""Connected components of a link table, by alternating star operations on edges."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelflume.llm.common import discard, saved


def _low(pairs: DataFrame) -> DataFrame:
    """The smallest of every node a and its neighbours b, written."""
    return saved(pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Around every node, its larger neighbours linked to the smallest of it and its neighbours: as many edges as before, a above b."""
    pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _low(pairs)
    out = saved(pairs.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
    discard(low)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    """Around every node, it and its smaller neighbours linked to the smallest of them: distinct edges, a above b."""
    low = _low(edges)
    met = edges.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    out = saved(met.where("a <> b").distinct())
    discard(low)
    return out


def _unfinished(edges: DataFrame) -> DataFrame:
    """Ids with two edges to smaller ones, or with one to a smaller and one to a larger id."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("below")), F.struct(F.col("b").alias("id"), F.lit(0).alias("below")))).alias("e"))
    ends = ends.groupBy("e.id").agg(F.sum("e.below").alias("n"), F.min("e.below").alias("least"))
    return ends.where("n > 1 or n = 1 and least = 0")


def stars(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (a, b), a written table: for every id that has a link, but the smallest of its component, that smallest id.

    Large-star and small-star steps alternate until every id has one edge, to an id that has none: a number of rounds that
    grows with the logarithm of the longest chain. Each step's edges are a written table, so lineage stays short and no component is
    ever gathered in one place; joins are between scans of written tables, so adaptive execution can split ids with many neighbours.
    Null ids and self links are ignored.
    """
    edges = saved(links.select("a", "b").where("a is not null and b is not null and a <> b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _unfinished(edges).isEmpty():
        large = _large_star(edges)
        discard(edges)
        edges = _small_star(large)
        discard(large)
    return edges


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (id, component_id) for every id that has a link, component_id being the smallest id reachable."""
    edges = stars(links)
    ids = edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    roots = ids.select(F.col("component_id").alias("id")).distinct().withColumn("component_id", F.col("id"))
    out = saved(ids.unionByName(roots))
    discard(edges)
    return out
