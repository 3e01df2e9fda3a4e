"""Samples, splits and class weights that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideguard.config import LABELS
from tideguard.functions.hashing import bucket, whole_number
from tideguard.operators.reports import _total

_PARTS = 10_000
_PERCENT = 100


def hash_sample(df: DataFrame, fraction: float, key: str = "id") -> DataFrame:
    """A repeatable share of the rows; a smaller sample lies inside a larger one."""
    number = whole_number(F.col(key), df.schema[key].dataType)
    return df.filter(bucket(number, _PARTS) < int(round(fraction * _PARTS)))


def in_train(key: Column, share: float = 0.8) -> Column:
    return bucket(key, _PERCENT) < int(round(share * _PERCENT))


def train_test(df: DataFrame, share: float = 0.8, key: str = "id") -> tuple[DataFrame, DataFrame]:
    train = in_train(whole_number(F.col(key), df.schema[key].dataType), share)
    return df.filter(train), df.filter(~train)


def class_balance(df: DataFrame, labels=LABELS) -> DataFrame:
    """One row: ``n_pos_L``, ``n_neg_L`` and ``weight_L`` = n_neg / n_pos.

    One aggregate for all labels. A label without positives has no weight (NULL).
    """
    counted = df.agg(*[c for x in labels for c in (
        _total(F.col(x) == 1).alias(f"n_pos_{x}"), _total(F.col(x) == 0).alias(f"n_neg_{x}"))])
    return counted.withColumns({
        f"weight_{x}": F.try_divide(F.col(f"n_neg_{x}"), F.col(f"n_pos_{x}")) for x in labels})


def class_weight_summary(df: DataFrame, labels=LABELS) -> DataFrame:
    """One row per label; ``status`` names the labels that cannot be trained."""
    return class_balance(df, labels).select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("label"), F.col(f"n_pos_{x}").alias("n_pos"),
                 F.col(f"n_neg_{x}").alias("n_neg"), F.col(f"weight_{x}").alias("weight"),
                 F.when(F.col(f"n_pos_{x}") == 0, "no_positives").otherwise("ok").alias("status"))
        for x in labels])))


def with_class_weights(df: DataFrame, labels=LABELS, source: DataFrame | None = None) -> DataFrame:
    """Adds ``w_L`` per row: the class weight for positives, else 1.0.

    The weights come from ``source`` (by default ``df``) as a scalar subquery:
    one row, one aggregate.
    """
    weights = class_balance(source if source is not None else df, labels)
    packed = weights.select(F.struct(*[f"weight_{x}" for x in labels]).alias("w")).scalar()
    return df.withColumn("__w", packed).withColumns({
        f"w_{x}": F.when(F.col(x) == 1, F.col(f"__w.weight_{x}")).otherwise(1.0)
        for x in labels}).drop("__w")
