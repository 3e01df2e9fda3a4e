"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row_each(df: DataFrame, name: str, array: Column, *keep: str) -> DataFrame:
    """One row per array element; rows with an empty or NULL array vanish.

    A plain ``explode`` makes the optimizer add a filter on the array's size
    underneath, and so compute a costly array twice. The outer form does not,
    and dropping its NULL rows afterwards costs nothing. Elements that are NULL
    themselves go too.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
