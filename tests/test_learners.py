"""Learners on days whose restriction follows from storage and rain, with noise; pruning; checks of clusterings."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hydrolap.operators import learners as ml, mining as mn

FEATURES = ["storage", "rain", "mes"]


@pytest.fixture(scope="module")
def days(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(600):
        storage, rain = rnd.uniform(20, 90), None if i % 40 == 0 else rnd.uniform(0, 15)
        risky = 55 - storage - (rain or 7) + rnd.gauss(0, 6) > 0
        rows.append((f"d{i:04d}", 2018 + i // 100, 1 + i % 12, storage, rain, None if i % 97 == 0 else "Si" if risky else "No"))
    return spark.createDataFrame(rows, "fecha string, anio int, mes int, storage double, rain double, restriccion string")


@pytest.mark.parametrize("learner", [ml.tree(), ml.forest(20), ml.logistic()], ids=["tree", "forest", "logit"])
def test_learners_beat_the_constant_model(days, learner):
    scored = ml.cross_validate(days, FEATURES, learner, k=5)
    clipped = scored.withColumn("score", F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("score"))))
    m, area = mn.classification_metrics(clipped).first(), mn.auc(clipped).first().auc
    total, positives = m.tp + m.fp + m.tn + m.fn, m.tp + m.fn
    known = days.where("restriccion IS NOT NULL")
    assert (total, positives) == (known.count(), known.where("restriccion = 'Si'").count())
    assert m.tp + m.fp > 0 and m.ca > 1 - positives / total + 0.1 and area > 0.85
    assert scored.select("fecha").distinct().count() == total


def test_holdout_learns_from_early_years_only(days):
    scored = ml.holdout(days, FEATURES, ml.tree(), 2021)
    assert {r.anio for r in scored.select("anio").distinct().collect()} == {2022, 2023}


@pytest.mark.parametrize("make", [ml.tree, lambda: ml.forest(7)], ids=["tree", "forest"])
def test_walk_and_stops(spark, days, make):
    """Without stops the walk gives the model's own probabilities; with them no node that they forbid is left, and no other is gone."""
    rows = ml.labelled(days, FEATURES)
    names = [f"f_{c}" for c in FEATURES]
    learner = make()
    fitted = Pipeline(stages=[*ml.vectors(names), learner.make(rows.count())]).fit(rows)
    free = ml.grown_trees(spark, fitted.stages[-1], ml.Learner(learner.make))
    found = fitted.transform(rows).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).toPandas()
    assert np.allclose(free.scores(np.stack(found.x.to_numpy())), found.p)
    cut = ml.grown_trees(spark, fitted.stages[-1], ml.Learner(learner.make, min_parent=60, majority=0.9))
    inner = cut.feature >= 0
    assert inner.any() and inner.sum() < (free.feature >= 0).sum()
    assert np.maximum(cut.value, 1 - cut.value)[inner].max() < 0.9
    scored = ml._score(fitted, ml.Learner(learner.make, min_parent=60, majority=0.9), rows).select("score").toPandas().score
    assert np.allclose(scored, cut.scores(np.stack(found.x.to_numpy())))


def test_penalty_is_the_inverse_of_c_times_rows():
    estimator = ml.logistic(4.0).make(50)
    assert estimator.getRegParam() == pytest.approx(1 / 200) and not estimator.getStandardization()


def test_cluster_checks(days):
    rows, model = ml.kmeans(days, ["storage", "rain"], restarts=2)
    n = days.where("restriccion IS NOT NULL").count()
    assert tuple(ml.cluster_checks(rows, model.clusterCenters()).first()) == (n, n, 3, 0)
    moved = rows.withColumn("cluster", F.when(F.col("fecha") < "d0100", (F.col("cluster") + 1) % 3).otherwise(F.col("cluster")))
    assert ml.cluster_checks(moved, model.clusterCenters()).first().en_otro == rows.where("fecha < 'd0100'").count()
    assert tuple(ml.silhouette_checks(rows).first()) == (n, n, True)
