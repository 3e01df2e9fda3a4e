"""Scoring with linear models, as models and as tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import LABELS
from tideguard.functions.scoring import sigmoid
from tideguard.operators.joins import HOT_KEY_ROWS, lookup_even


def score_multilabel(df: DataFrame, features_model, heads: Mapping[str, object],
                     keep: Sequence[str]) -> DataFrame:
    """Every label's prediction and probability in one pass.

    The feature stages run once per row and the label models append their own
    columns, so nothing is joined or shuffled.
    """
    scored = features_model.transform(df)
    for model in heads.values():
        scored = model.transform(scored)
    return scored.select(*keep, *[c for x in heads for c in (f"pred_{x}", f"prob_{x}")])


def score_pipelines(df: DataFrame, models: Mapping[str, object],
                    keep: Sequence[str]) -> DataFrame:
    """Prediction and probability of whole saved pipelines, one per label.

    Each appends its columns to the same rows and its intermediate columns are
    dropped before the next one, so here too nothing is joined.
    """
    scored = df
    for label, model in models.items():
        head = model.stages[-1]
        scored = model.transform(scored).select(
            *scored.columns, F.col(head.getPredictionCol()).alias(f"pred_{label}"),
            F.col(head.getProbabilityCol()).alias(f"prob_{label}"))
    return scored.select(*keep, *[c for x in models for c in (f"pred_{x}", f"prob_{x}")])


def linear_scores(term_counts: DataFrame, weights: DataFrame, key: str = "id",
                  term: str = "term", count: str = "tf", rows: str = "df",
                  labels: Sequence[str] = LABELS,
                  intercepts: Mapping[str, float] | None = None,
                  hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """A linear model kept as a table, applied by a join on the term.

    ``weights``: (term, rows, ``w_L`` per label). The sum per key combines
    map-side. Terms without a weight add nothing; a row needs at least one
    (possibly NULL) term to appear.
    """
    starts = intercepts or {}
    joined = lookup_even(term_counts, weights, term, rows, key, how="left", hot_rows=hot_rows)
    sums = joined.groupBy(key).agg(*[
        F.sum(F.coalesce(F.col(count) * F.col(f"w_{x}"), F.lit(0.0))).alias(f"z_{x}")
        for x in labels])
    return sums.select(key, *[
        sigmoid(F.col(f"z_{x}") + float(starts.get(x, 0.0))).alias(f"prob_{x}")
        for x in labels])


def vector_entries(df: DataFrame, vector: str, key: str) -> DataFrame:
    """Stored entries of a sparse vector column as (key, idx, value) rows; a row
    without entries gives one with NULLs."""
    stored = F.unwrap_udt(F.col(vector))
    pairs = F.arrays_zip(stored["indices"].alias("idx"), stored["values"].alias("value"))
    return df.select(key, F.inline_outer(pairs).alias("idx", "value"))


def linear_scores_hashed(df: DataFrame, vector: str, coefficients: DataFrame,
                         intercept: float, key: str = "id") -> DataFrame:
    """One hashed linear model as a join: vector entries with (idx, weight).

    The coefficient table has one row per hashed column, a fixed number,
    hence the broadcast. A row without any entry scores the intercept.
    """
    entries = vector_entries(df, vector, key).join(F.broadcast(coefficients), "idx", "left")
    part = F.coalesce(F.col("value") * F.col("weight"), F.lit(0.0))
    return entries.groupBy(key).agg(F.sum(part).alias("z")).select(
        key, sigmoid(F.col("z") + float(intercept)).alias("probability"))


def dot(vector: Column, weights: Sequence[float]) -> Column:
    literal = F.array(*[F.lit(float(w)) for w in weights])
    products = F.zip_with(vector, literal, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def dense_head(df: DataFrame, vector: str, heads: Mapping[str, tuple[Sequence[float], float]],
               keep: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Six independent sigmoids over a dense vector, one threshold for all."""
    scored = df.select(*keep, *[
        sigmoid(dot(F.col(vector), w) + float(b), clip=None).alias(f"prob_{x}")
        for x, (w, b) in heads.items()])
    return scored.withColumns({f"flag_{x}": F.col(f"prob_{x}") >= threshold for x in heads})


def batch_model(make_predict: Callable, width: int, batch_size: int = 256) -> Callable:
    """Bring your own model: ``make_predict()`` loads it once per Python worker
    and returns a function from a (rows, width) batch to one row of logits per input."""
    return predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()),
                             batch_size=batch_size, input_tensor_shapes=[[width]])
