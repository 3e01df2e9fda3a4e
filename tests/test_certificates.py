"""Fits and their proofs of being optimal."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tideguard.config import ModerationConfig
from tideguard.operators import training
from tideguard.operators.certificates import TOLERANCE, Fit, certify, certify_training
from tideguard.plans import fixtures


@pytest.fixture(scope="module")
def comments(spark, sf):
    return fixtures.training_comments(spark, sf).cache()


def certificate(comments, trained, **settings):
    stages = trained.model.stages
    return certify_training(comments, PipelineModel(stages[:-1]), {"toxic": stages[-1]}, **settings)["toxic"]


@pytest.mark.parametrize("fit, settings", [
    (training.train_plain, {"weighted": False}), (training.train_weighted, {}),
    (training.train_final, {"reg_param": 0.01, "elastic_net": 0.5, "on_all": True})])
def test_fits_are_optimal_and_the_proof_notices_what_is_not(comments, fit, settings):
    found = certificate(comments, fit(comments), **settings)
    assert found.residual <= TOLERANCE and 0 <= found.loss < found.null_loss
    short = certificate(comments, fit(comments, config=ModerationConfig(max_iter=1)), **settings)
    assert short.residual > TOLERANCE and short.loss > found.loss
    other = certificate(comments, fit(comments, "severe_toxic"), **settings)   # a model of something else
    assert other.residual > TOLERANCE
    if settings.get("reg_param"):
        wrong = certificate(comments, fit(comments), **settings | {"reg_param": 0.2})   # a loss it was not fitted for
        assert wrong.residual > TOLERANCE


def test_residual_falls_with_the_iterations(comments):
    settings = {"reg_param": 0.01, "elastic_net": 0.5, "on_all": True}
    found = [certificate(comments, training.train_final(comments, config=ModerationConfig(max_iter=n)), **settings) for n in (3, 20, 300)]
    assert found[0].residual > found[1].residual > found[2].residual and found[2].residual < 1e-3
    assert found[0].gap > found[1].gap > found[2].gap >= 0
    # The bound holds: no loss is further above the least one than its gap says.
    assert all(c.loss - found[2].loss <= c.gap * c.null_loss for c in found)


def test_gradient_is_that_of_plain_numpy(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(1)
    x = rng.poisson(1.0, (60, 5)) * rng.uniform(0.5, 3, 5)
    y = (x @ [1, -1, 0.5, 0, 0] + rng.standard_normal(60) > 0.5).astype(int)
    w = np.where(y == 1, 2.5, 1.0)
    df = spark.createDataFrame(
        [(Vectors.dense(a.tolist()), int(b)) for a, b in zip(x, y, strict=True)], ["features", "y"])
    df = df.withColumn("w", F.when(F.col("y") == 1, 2.5).otherwise(1.0))
    head = LogisticRegression(labelCol="y", weightCol="w", maxIter=4, regParam=0.05, elasticNetParam=0.0).fit(df)
    got = certify(df, {"y": Fit(head, F.col("w"), 0.05, 0.0)})["y"]
    beta, start = head.coefficients.toArray(), head.intercept
    p = 1 / (1 + np.exp(-(x @ beta + start)))
    mean = (w @ x) / w.sum()
    std = np.sqrt((w @ (x - mean) ** 2) / (w.sum() - (w @ w) / w.sum()))
    g = (w * (p - y)) @ x / w.sum() / std + 0.05 * beta * std
    null = (w * (w @ y / w.sum() - y)) @ x / w.sum() / std
    assert got.residual == pytest.approx(max(np.abs(g).max(), abs((w * (p - y)).sum() / w.sum())) / np.abs(null).max(), rel=1e-9)
