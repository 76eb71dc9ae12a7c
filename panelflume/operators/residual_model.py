"""Boosted forests of Spark ML trees: one model of the residuals of all entities.

Trees in a row cost a pass over the data for every tree and level. Here boosting goes in a few stages, each a forest of
trees that are grown together level by level, so a model of hundreds of trees reads the data some dozens of times, however many
entities there are. Entities share the model; their level is a feature, and residuals are modelled as shares of it.
"""
from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

PARTS = 16
STAGE_TREES = 50
RATE = 0.4
MISSING = -1e12
GRAIN = 2.0 ** 20


class Boosted(NamedTuple):
    """Forests of the stages, in order; each adds `rate` of its prediction."""
    stages: list[RandomForestRegressionModel]
    rate: float

    def used(self) -> set[int]:
        """Positions in x of the features that some tree splits on."""
        return {int(i) for s in self.stages for i in s.featureImportances.indices}

    def node_table(self) -> DataFrame | None:
        """stage, tree, id, prediction, split (feature, threshold), left and right child of every node."""
        tables = []
        for k, s in enumerate(self.stages):
            nodes = _nodes(s)
            tables.append(nodes.withColumn("stage", F.lit(k)))
        return reduce(DataFrame.unionByName, tables) if tables else None


def _nodes(model: RandomForestRegressionModel) -> DataFrame:
    """The nodes of a forest; their number is bounded by trees and depth, so they are listed on the driver."""
    rows = []

    def walk(tree: int, node) -> int:
        here = len(rows)
        rows.append(None)
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            left, right = walk(tree, node.leftChild()), walk(tree, node.rightChild())
            rows[here] = (tree, here, float(node.prediction()), int(split.featureIndex()), float(split.threshold()), left, right)
        else:
            rows[here] = (tree, here, float(node.prediction()), None, None, None, None)
        return here

    roots = [walk(t, tree.rootNode()) for t, tree in enumerate(model._call_java("trees"))]
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    out = spark.createDataFrame(rows, "tree int, id int, prediction double, feature int, threshold double, left int, right int")
    return out.withColumn("root", F.col("id").isin(roots))


def scale(x: str = "x") -> Column:
    """The entity's level, the last entry of x, where it is positive."""
    level = F.element_at(x, -1)
    return F.when(level > 0, level).otherwise(F.lit(1.0))


def vector(x: str = "x") -> Column:
    """x as Spark ML takes it. A missing value sorts below all others."""
    return array_to_vector(F.transform(x, lambda v: F.when(v.isNull() | F.isnan(v), F.lit(MISSING)).otherwise(v)))


def laid_out(rows: DataFrame, *keys: str) -> DataFrame:
    """rows in PARTS partitions by a hash of keys, sorted: the same rows give the same layout, and so the same samples of every tree,
    whatever their partitions were and whichever tasks are run again."""
    spread = F.xxhash64(*keys)
    return rows.withColumn("spread_", spread).repartition(PARTS, "spread_").sortWithinPartitions("spread_", *keys).drop("spread_")


def fit(train: DataFrame, trees: int, depth: int, subsample: float, min_leaf: int, seed: int, keys: tuple[str, ...] = ("route", "date"),
        stage_trees: int = STAGE_TREES, rate: float = RATE) -> Boosted:
    """Forests for train (keys, x array<double> ending in the entity's level, residual). Without rows, no stages.

    Shares are rounded to 2^-20, so sums of them are exact in any order.
    """
    share = F.round(F.col("residual") / scale() * GRAIN) / GRAIN
    rows = laid_out(train.where("residual is not null").select(*keys, vector().alias("features"), share.alias("target")), *keys)
    if rows.isEmpty():
        return Boosted([], rate)
    stages: list[RandomForestRegressionModel] = []
    for k in range(-(-trees // stage_trees)):
        left = F.round((F.col("target") - rate * _sum(len(stages))) * GRAIN) / GRAIN
        data = _scored(rows, stages).select("features", left.alias("label"))
        forest = RandomForestRegressor(
            featuresCol="features", labelCol="label", numTrees=min(stage_trees, trees - k * stage_trees), maxDepth=depth, minInstancesPerNode=min_leaf,
            subsamplingRate=subsample, bootstrap=False, featureSubsetStrategy="all", seed=seed + k, cacheNodeIds=False)
        stages.append(forest.fit(data))
    return Boosted(stages, rate)


def _sum(n: int) -> Column:
    return reduce(add, [F.col(f"stage_{k}_") for k in range(n)], F.lit(0.0))


def _scored(rows: DataFrame, stages: list[RandomForestRegressionModel]) -> DataFrame:
    for k, stage in enumerate(stages):
        rows = stage.setPredictionCol(f"stage_{k}_").transform(rows)
    return rows


def predict(model: Boosted, rows: DataFrame) -> DataFrame:
    """rows with boost, the modelled residual."""
    scored = _scored(rows.withColumn("features", vector()), model.stages)
    out = scored.withColumn("boost", scale() * model.rate * _sum(len(model.stages)))
    return out.drop("features", *[f"stage_{k}_" for k in range(len(model.stages))])
