"""Probabilities, thresholds and flags as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.config import DEFAULTS, ModerationConfig


def sigmoid(x: Column, clip: float | None = 500.0) -> Column:
    bounded = x if clip is None else F.least(F.greatest(x, F.lit(-clip)), F.lit(clip))
    return 1.0 / (1.0 + F.exp(-bounded))


def positive_probability(schema: T.StructType, label: str) -> Column:
    """P(label) as a double, whatever form the table stores it in.

    Vector and array columns hold (P(no), P(yes)); a missing column falls back
    on the hard prediction.
    """
    name = f"prob_{label}"
    if name not in schema.names:
        return F.col(f"pred_{label}").cast("double")
    kind = schema[name].dataType
    if isinstance(kind, VectorUDT):
        return F.get(vector_to_array(F.col(name)), 1)
    if isinstance(kind, T.ArrayType):
        return F.get(F.col(name), 1).cast("double")
    return F.col(name).cast("double")


def with_probabilities(df: DataFrame, config: ModerationConfig = DEFAULTS) -> DataFrame:
    return df.withColumns({f"prob1_{label}": positive_probability(df.schema, label)
                           for label in config.labels})


def flag_count(flags: list[Column]) -> Column:
    """How many flags are set; NULL as soon as one flag is NULL."""
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])


def apply_thresholds(df: DataFrame, config: ModerationConfig = DEFAULTS) -> DataFrame:
    """Adds ``prob1_L``, ``flag_L``, ``flagged_label_count`` and ``any_flagged``.

    Thresholds are inclusive and meet the unrounded probability.
    """
    flagged = with_probabilities(df, config).withColumns({
        f"flag_{label}": F.col(f"prob1_{label}") >= F.lit(config.thresholds[label])
        for label in config.labels})
    counted = flagged.withColumn(
        "flagged_label_count", flag_count([F.col(f"flag_{x}") for x in config.labels]))
    return counted.withColumn("any_flagged", F.col("flagged_label_count") > 0)
