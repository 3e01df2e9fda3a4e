"""Row filters and row checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideguard.config import (
    DEFAULT_LEXICON, DEFAULTS, LABELS, LEXICON_LABELS, LEXICON_MARK, ModerationConfig,
)
from tideguard.functions.rows import one_row_each
from tideguard.functions.text import clean_text, has_letters, raw_words, strip_blanks


def drop_null_text(df: DataFrame, column: str = "comment_text") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def drop_empty_clean(df: DataFrame, column: str = "comment_text") -> DataFrame:
    """Cleans the text and keeps the rows in which something is left."""
    return df.filter(has_letters(F.col(column))).withColumn(column, clean_text(F.col(column)))


def rejection_reason(text: Column, config: ModerationConfig = DEFAULTS) -> Column:
    """Why a comment may not be scored; NULL when it may."""
    stripped = strip_blanks(text)
    return (F.when(text.isNull(), "missing")
            .when(stripped == "", "empty")
            .when(F.char_length(stripped) > config.max_comment_chars, "too_long"))


def validate_comments(df: DataFrame, column: str = "comment_text",
                      config: ModerationConfig = DEFAULTS) -> DataFrame:
    """Adds ``reason`` and ``accepted``; nothing is dropped, so the rejected
    rows can be kept aside."""
    checked = df.withColumn("reason", rejection_reason(F.col(column), config))
    return checked.withColumn("accepted", F.col("reason").isNull())


def admit_messages(df: DataFrame, column: str = "text", always: Column | None = None) -> DataFrame:
    """Text messages that are not commands, and the rows for which ``always`` holds."""
    text = F.col(column)
    admitted = text.isNotNull() & (strip_blanks(text) != "") & ~text.startswith("/")
    return df.filter(admitted if always is None else admitted | always)


def lexicon_hit(text: Column, lexicon: Sequence[str] = DEFAULT_LEXICON) -> Column:
    """Does any word of the uncleaned text stand in a word list that fits a plan?"""
    words = list(lexicon)
    return F.exists(F.split(F.lower(text), r"(?U)\W+"), lambda w: w.isin(words))


def lexicon_matches(df: DataFrame, lexicon: DataFrame, key: str, text: str,
                    word: str = "word") -> DataFrame:
    """Keys of the rows with at least one word of a lexicon *table* of any size.

    Only (key, word) pairs move. The words of a row are made distinct first;
    Spark broadcasts the lexicon when it is small and otherwise shuffles both
    sides, splitting words that very many rows contain (AQE skew join).
    """
    pairs = one_row_each(df, word, raw_words(F.col(text)), key)
    return pairs.join(lexicon.select(word).distinct(), word, "left_semi").select(key).distinct()


def override_by_lexicon(flags: DataFrame, hit: Column) -> DataFrame:
    """Forces the lexicon's labels on where ``hit``; probabilities stay.

    ``flagged_by_L`` names the lexicon only where the model had not flagged L.
    """
    changed = {}
    for label in LABELS:
        flag = F.col(f"flag_{label}")
        if label in LEXICON_LABELS:
            changed[f"flagged_by_{label}"] = F.when(
                hit & ~F.coalesce(flag, F.lit(False)), F.lit(LEXICON_MARK))
            changed[f"flag_{label}"] = F.when(hit, F.lit(True)).otherwise(flag)
        else:
            changed[f"flagged_by_{label}"] = F.lit(None).cast("string")
    return flags.withColumns(changed)
