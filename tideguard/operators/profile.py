"""Data-quality profiles: one aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideguard.config import LABELS
from tideguard.operators.reports import _per_label, _percent, _total


def null_counts(df: DataFrame) -> DataFrame:
    counted = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])))


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: its type, how many rows, how many NULLs."""
    counted = df.agg(F.count("*").alias("__rows"),
                     *[F.count(F.col(c)).alias(c) for c in df.columns])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"),
                 F.col("__rows").alias("row_count"),
                 (F.col("__rows") - F.col(c)).alias("nulls"))
        for c, kind in df.dtypes])))


def label_distribution(df: DataFrame) -> DataFrame:
    """Positives per label and their share of the rows."""
    counted = df.agg(F.count("*").alias("total"),
                     *[_total(F.col(x) == 1).alias(f"n_{x}") for x in LABELS])
    tall = _per_label(counted, {"positives": "n_{}"}, "total")
    return tall.select("label", "positives",
                       _percent(F.col("positives"), F.col("total")).alias("pct"))


def source_breakdown(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n")).orderBy("source")
