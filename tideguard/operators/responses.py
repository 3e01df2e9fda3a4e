"""The nested scoring record, for a table or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideguard.config import DEFAULTS, LABELS, ModerationConfig
from tideguard.functions.labels import set_array
from tideguard.functions.text import model_tokens


def _label_score(df: DataFrame, label: str, config: ModerationConfig) -> Column:
    by = f"flagged_by_{label}"
    return F.struct(
        F.round(F.col(f"prob1_{label}") * 100, 2).alias("probability"),
        F.lit(config.thresholds[label] * 100).alias("threshold"),
        F.col(f"flag_{label}").alias("flagged"),
        (F.col(by) if by in df.columns else F.lit(None).cast("string")).alias("flagged_by"))


def score_response(flags: DataFrame, config: ModerationConfig = DEFAULTS,
                   key: str = "id") -> DataFrame:
    """(key, response): comment, cleaned words, verdict, categories, score per label."""
    categories = set_array([F.col(f"flag_{x}") for x in LABELS], LABELS)
    scores = F.map_from_arrays(
        F.array(*[F.lit(x) for x in LABELS]),
        F.array(*[_label_score(flags, x, config) for x in LABELS]))
    return flags.select(key, F.struct(
        F.col("comment_text").alias("comment"),
        F.array_join(model_tokens(F.col("comment_text")), " ").alias("cleaned"),
        (F.size(categories) > 0).alias("is_toxic"),
        categories.alias("flagged_categories"),
        scores.alias("scores")).alias("response"))


def flatten_response(responses: DataFrame, key: str = "id") -> DataFrame:
    """One row per comment and label, for sinks without nested types."""
    r = "response"
    return responses.select(
        key, f"{r}.comment", f"{r}.cleaned", f"{r}.is_toxic",
        F.array_join(f"{r}.flagged_categories", ",").alias("flagged_categories"),
        F.explode(f"{r}.scores").alias("label", "score"),
    ).select(key, "comment", "cleaned", "is_toxic", "flagged_categories", "label", "score.*")


def response_json(responses: DataFrame, key: str = "id") -> DataFrame:
    return responses.select(key, F.to_json("response").alias("value"))
