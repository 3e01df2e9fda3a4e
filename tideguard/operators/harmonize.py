"""Bringing differently labelled corpora to one six-label schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideguard.config import LABELS
from tideguard.functions.labels import (
    CLASS_CODE_LABELS, VOTE_LABELS, labels_from_class, labels_from_grades, majority_of,
)
from tideguard.functions.text import clean_text, has_letters
from tideguard.sources.readers import HARMONISED_SCHEMA


def _finish(df: DataFrame, source: str, drop_empty: bool) -> DataFrame:
    """Drop NULL (and on request empty) text, clean, tag, put in schema order.

    The conditions look at the raw text: put on the cleaned text, the optimizer
    would push them below the cleaning and clean every row twice.
    """
    raw = F.col("comment_text")
    kept = df.filter(has_letters(raw) if drop_empty else raw.isNotNull())
    return conform(kept.withColumns({"comment_text": clean_text(raw), "source": F.lit(source)}))


def conform(df: DataFrame) -> DataFrame:
    """The harmonised schema by name; a missing column is an error here, not later."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in HARMONISED_SCHEMA.fields])


def from_six_labels(df: DataFrame, source: str, drop_empty: bool = False) -> DataFrame:
    return _finish(df.select("comment_text", *LABELS), source, drop_empty)


def from_graded(df: DataFrame, source: str, drop_empty: bool = False) -> DataFrame:
    return _finish(df.select("comment_text", *labels_from_grades()), source, drop_empty)


def from_class_code(df: DataFrame, source: str, text: str = "tweet", code: str = "class",
                    drop_empty: bool = False) -> DataFrame:
    labels = labels_from_class(F.col(code), CLASS_CODE_LABELS)
    return _finish(df.select(F.col(text).alias("comment_text"), *labels), source, drop_empty)


def with_vote_labels(posts: DataFrame) -> DataFrame:
    """Posts with ``post_tokens`` and ``votes`` to text, majority vote and labels.

    A post carries its few votes with it, so this needs no shuffle.
    """
    voted = posts.withColumn("majority", majority_of(F.col("votes")))
    return voted.select("post_id", F.array_join("post_tokens", " ").alias("comment_text"),
                        "majority", *labels_from_class(F.col("majority"), VOTE_LABELS))


def from_posts(posts: DataFrame, source: str, drop_empty: bool = False) -> DataFrame:
    return _finish(with_vote_labels(posts), source, drop_empty)


def majority_vote(votes: DataFrame, key: str, vote: str, order: list[str]) -> DataFrame:
    """Majority per key when every vote is a row; ties go to the earliest vote.

    Two aggregates that combine map-side: a key with very many votes sends one
    row per task and distinct vote.
    """
    counted = votes.groupBy(key, vote).agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), "first", F.col(vote).alias("vote")))
    return counted.groupBy(key).agg(best.alias("best")).select(
        key, F.col("best.vote").alias("majority"), (-F.col("best.rank")).alias("votes"),
        *labels_from_class(F.col("best.vote"), VOTE_LABELS))


def union_sources(*sources: DataFrame) -> DataFrame:
    """All harmonised sources, duplicates kept, columns matched by name."""
    first, *rest = [conform(s) for s in sources]
    for other in rest:
        first = first.unionByName(other)
    return first
