"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this on the many-side is joined apart ...
HOT_KEY_ROWS = 1_000_000
# ... and so is one with more than this share of all rows: there are no more than so many.
# A key beyond these is joined like any other.
MAX_HOT_KEYS = 100_000


def join_predictions(base: DataFrame, tables: Sequence[DataFrame], on: str = "id") -> DataFrame:
    """Per-label prediction tables back onto their comments.

    All sides hash on the same key, so the running result keeps its
    partitioning and only the next table is shuffled.
    """
    joined = base
    for other in tables:
        joined = joined.join(other, on, "left")
    return joined


def _place(column: str) -> Column:
    """One of enough places for any shuffle, in few bytes.

    Never NULL, also by its form: else Spark would filter the look-up for it below
    the counts, which could not be shared any more.
    """
    return F.xxhash64(F.col(column)).bitwiseAND(F.lit((1 << 16) - 1)).cast("int")


def lookup_even(facts: DataFrame, lookup: DataFrame, key: str, rows: str,
                spread: str, how: str = "inner", hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Join ``facts`` to ``lookup`` (unique on ``key``) without a hot partition.

    ``lookup[rows]`` says how many fact rows a key has. Hot are the keys with
    more than ``hot_rows`` rows or more than a ``MAX_HOT_KEYS``-th of all rows, at
    most the first ``MAX_HOT_KEYS`` of them, so the list of hot keys is of bounded
    length and can be broadcast. Fact rows with a hot key are spread over the
    shuffle by ``spread`` instead of piling up under the one key, and take their
    values from the list behind it, so that no value is shuffled with them; rows
    whose key is NULL are spread as well. Most rows have a hot key where few keys
    hold most rows, as words do: sums by ``spread`` then combine before they are
    shuffled. ``how``: "inner" or "left".
    """
    values = [c for c in lookup.columns if c != key]
    share = lookup.agg(F.sum(rows) / F.lit(MAX_HOT_KEYS)).scalar()
    hot = (lookup.filter((F.col(rows) > hot_rows) | (F.col(rows) > share))
           .orderBy(F.col(rows).desc(), key).limit(MAX_HOT_KEYS)
           .select(F.col(key).alias("__hot_key"), F.struct(*values).alias("__hot")))
    marked = facts.join(F.broadcast(hot.select(F.col("__hot_key").alias("__mark"))), F.col(key) == F.col("__mark"), "left")
    settled = F.col("__mark").isNotNull() | F.col(key).isNull()
    # Settled rows match nothing further in the shuffle. Both sides say where a row goes by a
    # hash: a constant would be folded into the condition, and all settled rows meet in one task.
    marked = marked.withColumns({
        "__join_key": F.when(~settled, F.col(key)),
        "__spread": F.when(settled, _place(spread)).otherwise(_place(key))})
    # Hot keys may stand here too: their rows are settled and find nothing.
    cold = lookup.select(F.col(key).alias("__cold_key"), F.struct(*values).alias("__cold"))
    joined = marked.join(
        cold.withColumn("__place", _place("__cold_key")),
        F.expr("__join_key = __cold_key AND __spread = __place"), "left")
    joined = joined.join(F.broadcast(hot), F.col("__mark") == F.col("__hot_key"), "left")
    found = F.coalesce("__hot", "__cold")
    if how == "inner":
        joined = joined.filter(found.isNotNull())
    return joined.select(*facts.columns, *[found[v].alias(v) for v in values])
