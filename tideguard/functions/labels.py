"""Label arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideguard.config import (
    DISPLAY_NAMES, GRADED_CUT, LABELS, NO_CATEGORY_PHRASE,
)

# --- Fixed values -----------------------------------------------------------
# Which labels a foreign class sets; classes not named here set none.
CLASS_CODE_LABELS = {
    0: ("toxic", "identity_hate"),
    1: ("toxic", "obscene", "insult"),
}
VOTE_LABELS = {
    "hatespeech": ("toxic", "identity_hate"),
    "offensive": ("toxic", "insult"),
}
# Where each label is found in a table of graded scores.
GRADED_COLUMNS = {
    "toxic": "target",
    "severe_toxic": "severe_toxicity",
    "obscene": "obscene",
    "threat": "threat",
    "insult": "insult",
    "identity_hate": "identity_attack",
}
# --- End of fixed values ----------------------------------------------------


def _indicator(condition: Column) -> Column:
    # when/otherwise, so that NULL counts as "not set"
    return F.when(condition, 1).otherwise(0).cast("int")


def labels_from_class(value: Column, mapping: dict) -> list[Column]:
    """Six 0/1 columns from a class value; unknown classes set nothing."""
    columns = []
    for label in LABELS:
        setting = [key for key, names in mapping.items() if label in names]
        on = value.isin(setting) if setting else F.lit(False)
        columns.append(_indicator(on).alias(label))
    return columns


def labels_from_grades() -> list[Column]:
    """Six 0/1 columns from graded scores; a NULL score gives 0."""
    return [_indicator(F.col(GRADED_COLUMNS[label]) >= GRADED_CUT).alias(label)
            for label in LABELS]


def majority_of(votes: Column) -> Column:
    """Most frequent value of a short array; ties go to the one seen first."""
    options = F.array_distinct(votes)
    counts = F.transform(options, lambda o: F.size(F.filter(votes, lambda v: v == o)))
    return F.get(options, (F.array_position(counts, F.array_max(counts)) - 1).cast("int"))


def first_max(columns: Sequence[Column], names: Sequence[str]) -> tuple[Column, Column]:
    """(name of the largest column, its value); ties go to the earlier name.

    NULLs are skipped by ``greatest`` and never equal it.
    """
    top = F.greatest(*columns)
    return F.coalesce(*[F.when(c == top, F.lit(n)) for c, n in zip(columns, names)]), top


def set_names(flags: Sequence[Column], names: Sequence[str]) -> Column:
    """Comma list of the names whose flag is true."""
    return F.concat_ws(",", *[F.when(f, F.lit(n)) for f, n in zip(flags, names)])


def set_array(flags: Sequence[Column], names: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(f, F.lit(n)) for f, n in zip(flags, names)]))


def category_phrase(categories: Column) -> Column:
    """Array of label names to ``"a, b and c"`` in display wording."""
    named = F.transform(
        categories,
        lambda c: reduce(lambda rest, item: F.when(c == item[0], item[1]).otherwise(rest),
                         reversed(DISPLAY_NAMES.items()), c))
    n = F.size(categories)
    head = F.array_join(F.slice(named, F.lit(1), F.greatest(n - 1, F.lit(0))), ", ")
    last = F.get(named, n - 1)
    return (
        F.when(F.coalesce(n, F.lit(0)) <= 0, F.lit(NO_CATEGORY_PHRASE))
        .when(n == 1, last)
        .otherwise(F.concat(head, F.lit(" and "), last))
    )
