"""Spark ML learners on the daily table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stable, work_folder
from .mining import assign_centroid, stratified_folds

# Settings of the published workflows. Spark caps the depth at 30. ``*_STOPS``: a node of fewer rows, or in which
# one class has that share, is not split; Spark's learners lack both stops.
TREE, TREE_STOPS = {"maxDepth": 5, "minInstancesPerNode": 10, "seed": 7}, {"min_parent": 20, "majority": 0.95}
FOREST, FOREST_STOPS = {"numTrees": 100, "maxDepth": 30, "seed": 7}, {"min_parent": 5}
LOGIT_C = 1.0
FOLDS, CLUSTERS, RESTARTS, ITERATIONS = 10, 3, 10, 300


@dataclass(frozen=True)
class Learner:
    """``make`` gives the estimator for a number of training rows; stops prune what it has grown."""

    make: Callable[[int], Estimator]
    min_parent: int = 0
    majority: float | None = None

    @property
    def prunes(self) -> bool:
        return bool(self.min_parent or self.majority)


def tree() -> Learner:
    return Learner(lambda rows: DecisionTreeClassifier(labelCol="label", **TREE), **TREE_STOPS)


def forest(trees: int = FOREST["numTrees"]) -> Learner:
    return Learner(lambda rows: RandomForestClassifier(labelCol="label", **{**FOREST, "numTrees": trees}), **FOREST_STOPS)


def logistic(c: float = LOGIT_C) -> Learner:
    """Ridge penalty as the inverse of C: the mean loss of Spark's objective makes that 1 / (C n)."""
    return Learner(lambda rows: LogisticRegression(labelCol="label", elasticNetParam=0.0, regParam=1.0 / (c * max(rows, 1)), standardization=False))


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees side by side; ``feature`` is -1 at a leaf, ``value`` the share of the positive class there."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean share of the leaves that each row reaches."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        while (inner := self.feature[at] >= 0).any():
            below = x[row, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(below, self.left[at], self.right[at]), at)
        return self.value[at].mean(1)


def grown_trees(spark: SparkSession, model, learner: Learner) -> Trees:
    """The trees of a fitted model, cut where a stop holds. Growing is greedy, so what stays is what growing with the stops would have given.

    Nodes come from the model's stored form: a few thousand rows, bounded by trees and training rows.
    """
    with work_folder(spark, "model") as folder:
        model.write().session(spark).overwrite().save(folder)
        nodes = spark.read.parquet(f"{folder}/data")
        nodes = nodes.select("treeID", "nodeData.*") if "treeID" in nodes.columns else nodes.withColumn("treeID", F.lit(0))
        nodes = nodes.select("treeID", "id", "impurityStats", "rawCount", "leftChild", "rightChild", "split.featureIndex",
                             F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).toPandas().sort_values(["treeID", "id"], ignore_index=True)
    start = nodes.groupby("treeID")["id"].transform("size").groupby(nodes["treeID"]).first().cumsum().shift(fill_value=0)
    first = nodes["treeID"].map(start).to_numpy()  # ids count from 0 in each tree
    stats = np.asarray(nodes["impurityStats"].tolist(), float)
    share = stats / stats.sum(1, keepdims=True)
    leaf = (nodes["leftChild"].to_numpy() < 0) | (nodes["rawCount"].to_numpy() < learner.min_parent)
    if learner.majority:
        leaf |= share.max(1) >= learner.majority
    return Trees(start.to_numpy(), np.where(leaf, -1, nodes["featureIndex"].to_numpy()), nodes["threshold"].fillna(0.0).to_numpy(),
                 first + nodes["leftChild"].to_numpy(), first + nodes["rightChild"].to_numpy(), share[:, 1])


def vectors(features: list[str], scale: bool = False) -> list:
    """Mean imputation, one vector, optional unit deviation."""
    filled = [f"{c}_f" for c in features]
    stages = [Imputer(inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="vector" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="vector", outputCol="features", withMean=True, withStd=True))
    return stages


def _score(fitted: PipelineModel, learner: Learner, rows: DataFrame) -> DataFrame:
    """``score``: probability of the positive class; ``prediction``: 1 if above one half. Pruned trees are walked for a batch of rows at once."""
    if not learner.prunes:
        return fitted.transform(rows).withColumn("score", vector_to_array("probability")[1]).withColumn("prediction", F.col("prediction").cast("int"))
    trees = grown_trees(rows.sparkSession, fitted.stages[-1], learner)

    @F.pandas_udf("double")
    def walk(features: pd.Series) -> pd.Series:
        return pd.Series(trees.scores(np.stack(features.to_numpy())) if len(features) else [], dtype=float)

    prepared = PipelineModel(stages=fitted.stages[:-1]).transform(rows)
    return prepared.withColumn("score", walk(vector_to_array("features"))).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def labelled(days: DataFrame, features: list[str]) -> DataFrame:
    """Days with a target, as label 0/1 and double features."""
    return days.where("restriccion IS NOT NULL").select(
        "fecha", "anio", "mes", (F.col("restriccion") == "Si").cast("int").alias("label"),
        *[F.col(c).cast("double").alias(f"f_{c}") for c in features])


def cross_validate(days: DataFrame, features: list[str], learner: Learner, k: int = FOLDS, parallel: int = 4) -> DataFrame:
    """Out-of-fold predictions of every day: fecha, label, score, prediction, fold. Folds are fitted side by side."""
    names = [f"f_{c}" for c in features]
    rows = stable(stratified_folds(labelled(days, features), "label", ["fecha"], k))

    sizes = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}  # k rows

    def fold(i: int) -> DataFrame:
        training = sum(sizes.values()) - sizes.get(i, 0)
        model = Pipeline(stages=[*vectors(names), learner.make(training)]).fit(rows.where(F.col("fold") != i))
        return _score(model, learner, rows.where(F.col("fold") == i)).select("fecha", "anio", "label", "score", "prediction", "fold")

    with ThreadPool(parallel) as pool:
        parts = pool.map(fold, range(k))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def holdout(days: DataFrame, features: list[str], learner: Learner, last_train_year: int) -> DataFrame:
    """Train on the early years, predict the later ones."""
    names = [f"f_{c}" for c in features]
    rows = stable(labelled(days, features))
    early = rows.where(F.col("anio") <= last_train_year)
    model = Pipeline(stages=[*vectors(names), learner.make(early.count())]).fit(early)
    return _score(model, learner, rows.where(F.col("anio") > last_train_year)).select("fecha", "anio", "label", "score", "prediction")


def kmeans(days: DataFrame, features: list[str], k: int = CLUSTERS, restarts: int = RESTARTS, parallel: int = 4):
    """Best of several seeds by cost. Returns (clustered rows, model)."""
    names = [f"f_{c}" for c in features]
    prepared = Pipeline(stages=vectors(names, scale=True)).fit(base := labelled(days, features)).transform(base)
    rows = stable(prepared.drop("vector", *[f"{n}_f" for n in names]))

    def run(seed: int):
        return KMeans(k=k, maxIter=ITERATIONS, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)

    with ThreadPool(parallel) as pool:
        models = pool.map(run, range(restarts))
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(rows), best


def silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster", distanceMeasure="squaredEuclidean").evaluate(clustered)


def silhouette_rows(clustered: DataFrame) -> DataFrame:
    """Silhouette of each row from cluster sums: squared distances need no pairs.

    Sum over a cluster of |x - y|^2 = n|x|^2 - 2 x.S + Q, with S the sum of the members and Q the
    sum of their squared lengths. The sums are one row per cluster, carried as one array.
    """
    rows = clustered.withColumn("_v", vector_to_array("features")).withColumn(
        "_q", F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
    size = F.size("_v")
    long = rows.select("cluster", "_q", F.posexplode("_v").alias("_i", "_x"))
    sums = long.groupBy("cluster", "_i").agg(F.sum("_x").alias("s"), F.count(F.lit(1)).alias("n"), F.sum("_q").alias("q"))
    per_cluster = sums.groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "s"))), lambda e: e["s"]).alias("s"), F.max("n").alias("n"), F.max("q").alias("q"))
    packed = per_cluster.agg(F.collect_list(F.struct("cluster", "s", "n", "q")).alias("_c"))

    def mean_distance(c):
        dot = F.aggregate(F.zip_with("_v", c["s"], lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        total = F.col("_q") * c["n"] - 2 * dot + c["q"]
        own = c["cluster"] == F.col("cluster")
        return F.struct(own.alias("own"), (total / F.when(own, F.greatest(c["n"] - 1, F.lit(1))).otherwise(c["n"])).alias("d"), c["n"].alias("n"))

    with_means = rows.join(F.broadcast(packed)).withColumn("_m", F.transform("_c", mean_distance))
    own = F.filter("_m", lambda m: m["own"])[0]
    other = F.array_min(F.transform(F.filter("_m", lambda m: ~m["own"]), lambda m: m["d"]))
    a, b = own["d"], other
    value = F.when(own["n"] == 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return with_means.withColumn("silhouette", value).drop("_v", "_q", "_c", "_m")


# What must hold of any clustering, as rows

def cluster_checks(clustered: DataFrame, centres: list) -> DataFrame:
    """Rows, sum of the clusters' sizes, clusters, and rows that lie nearer to another centre than to their own: one row."""
    width = len(centres[0])
    names = [f"x{i}" for i in range(width)]
    table = clustered.sparkSession.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centres)], ", ".join(["nearest int", *[f"{n} double" for n in names]]))
    rows = clustered.select("cluster", vector_to_array("features").alias("v")).select("cluster", *[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    judged = assign_centroid(rows, table, names, "nearest").join(
        F.broadcast(table.select(F.col("nearest").alias("cluster"), F.array(*names).alias("own"))), "cluster", "left")  # k rows
    distance = sum((F.pow(F.col(n) - F.col("own")[i], F.lit(2.0)) for i, n in enumerate(names)), F.lit(0.0))
    per_cluster = judged.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(distance <= F.col("distancia") + 1e-9, F.lit(False))).alias("far"))
    return clustered.agg(F.count(F.lit(1)).alias("dias")).join(F.broadcast(per_cluster.agg(  # two one-row aggregates
        F.coalesce(F.sum("n"), F.lit(0)).alias("suma"), F.count(F.lit(1)).alias("grupos"), F.coalesce(F.sum("far"), F.lit(0)).alias("en_otro"))))


def silhouette_checks(clustered: DataFrame) -> DataFrame:
    """Rows, rows whose silhouette lies in [-1, 1], and whether its mean is above 0: one row."""
    value = F.col("silhouette")
    return silhouette_rows(clustered).agg(
        F.count(F.lit(1)).alias("dias"), F.count_if(value.between(-1.0, 1.0)).alias("en_rango"), F.coalesce(F.avg(value) > 0, F.lit(False)).alias("media_positiva"))
