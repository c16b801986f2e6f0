"""Gradient boosting for more than two classes, on Spark's tree learner.

A round computes each row's class shares (the softmax of its scores) and grows
one regression tree a class. The trees learn the Newton step: the target is the
softmax residual over its curvature, the row's weight that curvature, so the
weighted mean that Spark's tree learner puts in a leaf is the leaf's Newton
value, and its splits minimise the loss's second-order form. Scores start at the
log shares of the classes. Rows keep their scores as columns beside the feature
vector; the table is checkpointed to the shared folder every few rounds, which
bounds the plan and what a lost executor costs.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: Least curvature and largest step of a row (Friedman, Hastie, Tibshirani 2000).
LEAST_CURVATURE, LARGEST_STEP = 1e-6, 4.0
#: Rounds between two checkpoints of the scores.
CHECKPOINT_ROUNDS = 10


def _share(k: int, n_classes: int, score) -> F.Column:
    """Softmax of class ``k``: 1 / sum_j exp(score_j - score_k)."""
    total = F.lit(0.0)
    for j in range(n_classes):
        total = total + F.exp(score(j) - score(k))
    return 1.0 / total


def _joined(trees: list, weight: float, output: str) -> GBTRegressionModel:
    """The trees as one ensemble whose prediction is ``weight`` times their sum."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.regression
    many = sc._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    weights = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, t in enumerate(trees):
        many[i], weights[i] = t._java_obj, weight
    java = kind.GBTRegressionModel(f"boosted_{output.strip('_')}", many, weights)
    return GBTRegressionModel(java).setFeaturesCol(trees[0].getFeaturesCol()).setPredictionCol(output)


def fit_softmax_boosting(df: DataFrame, n_classes: int, features: str, label: str, rounds: int, step: float, depth: int,
                         min_rows: int = 1, subset: str = "all", sample: float = 1.0, seed: int = 42) -> PipelineModel:
    """A model that adds ``probability`` (array of double, one share a class)
    and ``prediction`` (the class number with the largest share; the least of
    equal ones) to a table with the vector column ``features``.

    ``label`` holds class numbers 0 .. n_classes - 1; every class must occur.
    ``sample`` below 1 grows each tree on that share of the rows."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = {int(r[0]): r[1] for r in df.groupBy(label).count().collect()}  # one row a class
    total = sum(counts.values())
    start = [math.log(counts[k] / total) for k in range(n_classes)]
    at = df.select(features, F.col(label).alias("__y"), *[F.lit(s).alias(f"__s{k}") for k, s in enumerate(start)])
    at = at.persist(StorageLevel.MEMORY_AND_DISK)
    weight = step * (n_classes - 1) / n_classes
    trees: list[list] = [[] for _ in range(n_classes)]
    try:
        for r in range(rounds):
            for k in range(n_classes):
                p = _share(k, n_classes, lambda j: F.col(f"__s{j}"))
                curvature = F.greatest(p * (1.0 - p), F.lit(LEAST_CURVATURE))
                target = ((F.col("__y") == k).cast("double") - p) / curvature
                rows = at.select(features, F.greatest(F.least(target, F.lit(LARGEST_STEP)), F.lit(-LARGEST_STEP)).alias("__t"), curvature.alias("__w"))
                learner = RandomForestRegressor(featuresCol=features, labelCol="__t", weightCol="__w", numTrees=1, bootstrap=False, maxDepth=depth,
                                                minInstancesPerNode=min_rows, featureSubsetStrategy=subset, subsamplingRate=sample,
                                                seed=seed + r * n_classes + k)
                trees[k].append(learner.fit(rows).trees[0].setFeaturesCol(features))
            if r + 1 == rounds:
                break
            after = at
            for k in range(n_classes):
                after = trees[k][-1].setPredictionCol(f"__d{k}").transform(after)
            after = after.select(features, "__y", *[(F.col(f"__s{k}") + weight * F.col(f"__d{k}")).alias(f"__s{k}") for k in range(n_classes)])
            if (r + 1) % CHECKPOINT_ROUNDS == 0:
                after = after.checkpoint(eager=True)
            after = after.persist(StorageLevel.MEMORY_AND_DISK)
            after.count()
            at.unpersist()
            at = after
    finally:
        at.unpersist()
    return PipelineModel([*[_joined(t, weight, f"__s{k}") for k, t in enumerate(trees)], _softmax(start)])


def _softmax(start: list[float]) -> SQLTransformer:
    """Scores to ``probability`` and ``prediction``; a stage that is saved with the model."""
    score = [f"(__s{k} + {s!r}D)" for k, s in enumerate(start)]
    shares = [f"1.0D / ({' + '.join(f'exp({other} - {own})' for other in score)})" for own in score]
    return SQLTransformer(statement=f"SELECT *, CAST(array_position(probability, array_max(probability)) - 1 AS DOUBLE) AS prediction "
                                    f"FROM (SELECT *, array({', '.join(shares)}) AS probability FROM __THIS__)")
