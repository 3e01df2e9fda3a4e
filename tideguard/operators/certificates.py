"""Proof that a fitted regression is (nearly) the best one for its rows.

The loss of a weighted, elastic-net regression is convex, so its fit can be judged
without fitting again: at the optimum every coefficient's sub-gradient is zero. The
gradient over the rows is a few vector aggregates of the features, combined map-side,
one pass for all labels; the driver gets vectors of the fixed hashed width.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideguard.functions.hashing import whole_number
from tideguard.operators.sampling import class_balance, in_train


@dataclass(frozen=True)
class Fit:
    """A fitted head, with what it was fitted for."""

    head: LogisticRegressionModel
    weight: Column             #: of a row
    reg_param: float = 0.0
    elastic_net: float = 0.0


@dataclass(frozen=True)
class Certificate:
    """How far a fit is from the optimum of its loss.

    ``residual`` is the largest violation of the optimality conditions over all
    coefficients and the intercept, as a share of the largest gradient of a model
    without coefficients: 0 at the optimum, about 1 for a model that has learned
    nothing. ``gap`` bounds loss - least loss from above, as a share of that model's
    loss; it is NULL without a ridge part, when the loss has no such bound.
    """

    rows: int
    residual: float
    loss: float
    null_loss: float
    gap: float | None


def certify(rows: DataFrame, fits: Mapping[str, Fit], features: str = "features") -> dict[str, Certificate]:
    """A certificate per label for the rows that its head was fitted on.

    Coefficients are compared on the scale on which MLlib penalises them, that of
    features with unit deviation; features that do not vary take no part.
    """
    scored = rows.select(features, *fits, *[fit.weight.alias(f"w_{x}") for x, fit in fits.items()])
    for x, fit in fits.items():
        p = F.get(vector_to_array(F.col(fit.head.getProbabilityCol())), 1)
        scored = fit.head.transform(scored).select(*scored.columns, p.alias(f"p_{x}"))
    v = F.col(features)
    parts = []
    for x, fit in fits.items():
        w, p, y = F.col(f"w_{x}"), F.col(f"p_{x}"), F.col(x).cast("double")
        base = F.lit(0.0)
        for name, e in (("up", F.greatest(w * (p - y), base)), ("down", F.greatest(w * (y - p), base)),
                        ("pos", w * y), ("neg", w * (1 - y))):
            parts += [Summarizer.mean(v, e).alias(f"{name}_{x}"), F.sum(e).alias(f"{name}_sum_{x}")]
        chosen = F.greatest(F.when(y == 1, p).otherwise(1 - p), F.lit(1e-300))
        parts += [Summarizer.std(v, w).alias(f"std_{x}"), F.sum(w).alias(f"weight_{x}"), F.sum(-w * F.log(chosen)).alias(f"loss_{x}")]
    one = scored.agg(F.count("*").alias("rows"), *parts).first()   # vectors of the features' width
    return {x: _judged(one, x, fit) for x, fit in fits.items()}


def _judged(one, x: str, fit: Fit) -> Certificate:
    total = one[f"weight_{x}"]

    def summed(name):
        return one[f"{name}_{x}"].toArray() * one[f"{name}_sum_{x}"] / total

    std = one[f"std_{x}"].toArray()
    varies = std > 0
    scale = np.where(varies, std, 1.0)
    share = one[f"pos_sum_{x}"] / total
    gradient = (summed("up") - summed("down")) / scale
    null = (share * (summed("pos") + summed("neg")) - summed("pos")) / scale
    beta = fit.head.coefficients.toArray() * std
    ridge, lasso = fit.reg_param * (1 - fit.elastic_net), fit.reg_param * fit.elastic_net
    smooth = gradient + ridge * beta
    violation = np.where(beta != 0, np.abs(smooth + lasso * np.sign(beta)), np.maximum(np.abs(smooth) - lasso, 0.0))
    violation = np.append(violation[varies], abs(one[f"up_sum_{x}"] - one[f"down_sum_{x}"]) / total)
    null_loss = -(share * np.log(share) + (1 - share) * np.log(1 - share)) if 0 < share < 1 else 0.0
    loss = one[f"loss_{x}"] / total + ridge / 2 * float(beta @ beta) + lasso * float(np.abs(beta).sum())
    largest = float(np.abs(null[varies]).max(initial=0.0)) or 1.0
    # A function with curvature c lies within |sub-gradient|^2 / (2 c) of its least value.
    gap = float(violation[:-1] @ violation[:-1]) / (2 * ridge) / null_loss if ridge and null_loss else None
    return Certificate(one["rows"], float(violation.max()) / largest, float(loss), float(null_loss), gap)


#: Residuals up to which a fit of ``ModerationConfig.max_iter`` (20) iterations counts as one.
TOLERANCE = 0.05


def certify_training(df: DataFrame, features: PipelineModel, heads: Mapping[str, LogisticRegressionModel], weighted: bool = True,
                     reg_param: float = 0.0, elastic_net: float = 0.0, on_all: bool = False, weights_of_all: bool = False) -> dict[str, Certificate]:
    """Certificates of the heads that ``training`` has fitted on the training part of ``df`` (``on_all``: on all of it).

    ``weights_of_all`` takes the class weights from the whole table, as the six-label training does.
    """
    text = df.filter(F.col("comment_text").isNotNull())
    part = text if on_all else text.filter(in_train(whole_number(F.col("id"), df.schema["id"].dataType)))
    balance = class_balance(text if weights_of_all else part, list(heads)).first()
    rows = features.transform(part)
    weight = lambda x: F.when(F.col(x) == 1, F.lit(float(balance[f"weight_{x}"]))).otherwise(1.0) if weighted else F.lit(1.0)
    return certify(rows, {x: Fit(head, weight(x), reg_param, elastic_net) for x, head in heads.items()})
