"""Ids for rows that have none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideguard.functions.hashing import stable_row_id
from tideguard.session import materialise


def number_copies(df: DataFrame, content: Sequence[str], out: str = "id") -> DataFrame:
    """Adds an id that no two rows share: that of the content, and for its copies a number behind it.

    The first of equal rows keeps ``stable_row_id``, the others get ``-1``, ``-2`` and
    so on, so the ids of a table do not depend on how it lies. The rows are stored once
    with their places; copies are numbered within each stored part, from an offset that
    is the sum of the counts in the parts before. So a text that very many rows share is
    spread over as many tasks as hold it, with one offset each.
    """
    placed = materialise(df.withColumns({"__content": stable_row_id(*[F.col(c) for c in content]),
                                         "__row": F.monotonically_increasing_id()}), "numbered-rows")
    placed = placed.withColumn("__part", F.shiftright("__row", 33))
    before = Window.partitionBy("__content").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("__content", "__part").agg(F.count("*").alias("n"))
               .withColumn("__offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    here = F.row_number().over(Window.partitionBy("__content", "__part").orderBy("__row")) - 1
    numbered = placed.withColumn("__here", here).join(offsets, ["__content", "__part"])
    copy = F.col("__offset") + F.col("__here")
    named = F.when(copy == 0, F.col("__content")).otherwise(F.concat_ws("-", "__content", copy))
    return numbered.withColumn(out, named).select(*df.columns, out)
