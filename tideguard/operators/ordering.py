"""Results that depend on a global order, without a global sort.

Equal-count buckets need the exact places of a few borders only. A histogram with a
fixed number of cells is counted with a map-side aggregate; a cell that lies inside
one bucket is done, and the few cells on a border, fewer than there are buckets, are
cut into as many cells again, until a border lies in a single value. Each level reads
the rows of those cells alone (a range filter that reaches the scan). What the driver
holds, and the size of a plan, depend on the number of buckets, not on the rows.

A running sum over all distinct values needs them in ranges: ``in_ranges``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.session import materialise

#: Cells of a histogram.
CELLS = 65_536
_RESULT = "bucket_index int, comment_count bigint, flagged_count bigint"


@dataclass(frozen=True)
class _Range:
    """Values from ``low`` to ``high``, with the position of the first row."""

    low: Any
    high: Any
    start: int


def _order_class(k: Column, kind: T.DataType) -> Column:
    """0 for NULL, then the parts of the order that a linear scale can and cannot take."""
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(k.isNull(), 0).otherwise(2)
    return (F.when(k.isNull(), 0).when(F.isnan(k), 4).when(k == float("-inf"), 1)
            .when(k == float("inf"), 3).otherwise(2))


def _cell(k: Column, kind: T.DataType, part: _Range, cells: int) -> Column:
    """The number of the cell on a linear scale; rising with ``k``, 0 for the lowest value and cells - 1 for the highest."""
    low, high = F.lit(part.low).cast(kind), F.lit(part.high).cast(kind)
    # The difference is taken in the type of the column, which is exact, unless it overflows there.
    if isinstance(kind, T.IntegralType) and part.high - part.low < 1 << 62:
        k, low, high = k.cast("long"), low.cast("long"), high.cast("long")
    elif not isinstance(kind, T.DecimalType):
        scale = 1.0 if part.high - part.low < float("inf") else 0.5
        k, low, high = (c.cast("double") * scale for c in (k, low, high))
    share = (k - low).cast("double") / (high - low).cast("double")
    return F.least(F.floor(share * cells), F.lit(cells - 1)).cast("int")


@dataclass
class _Totals:
    """Rows and flags of the buckets, filled as cells are placed."""

    total: int
    n_buckets: int

    def __post_init__(self) -> None:
        self.small, self.n_big = divmod(self.total, self.n_buckets)
        self.found = [[0, 0] for _ in range(self.n_buckets)]

    def first_row(self, bucket: int) -> int:
        return bucket * self.small + min(bucket, self.n_big)

    def add(self, bucket: int, rows: int, flags: int) -> None:
        self.found[bucket][0] += rows
        self.found[bucket][1] += flags

    def spread(self, start: int, rows: int, flag: int) -> None:
        """Rows that are all alike, over the buckets they reach."""
        for bucket in range(self.n_buckets):
            share = min(start + rows, self.first_row(bucket + 1)) - max(start, self.first_row(bucket))
            if share > 0:
                self.add(bucket, share, share * flag)

    def bucket_at(self, position: Column) -> Column:
        big = F.lit(self.n_big * (self.small + 1))
        return F.when(position < big, F.floor(position / (self.small + 1))).otherwise(
            self.n_big + F.floor((position - big) / max(self.small, 1))).cast("int")


def _place(counted: DataFrame, totals: _Totals) -> list[tuple[Any, Any, int, int, int]]:
    """Adds the cells that lie in one bucket; (low, high, start, rows, flags) of those on a border.

    ``counted`` (part, start, cell, n, flags, low, high) has at most a histogram's
    cells for each part.
    """
    upto = Window.partitionBy("part").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(upto), F.lit(0)))
    placed = placed.withColumns({"bucket": totals.bucket_at(F.col("start")), "last": totals.bucket_at(F.col("start") + F.col("n") - 1)})
    whole = F.col("bucket") == F.col("last")
    # Cells of a bucket become one row; those on a border are fewer than there are buckets.
    rows = (placed.groupBy("bucket", F.when(~whole, F.struct("start", "low", "high")).alias("border"))
            .agg(F.sum("n").alias("n"), F.sum("flags").alias("flags")).collect())
    borders = []
    for r in rows:
        if r["border"] is None:
            totals.add(r["bucket"], r["n"], r["flags"])
        else:
            borders.append((r["border"]["low"], r["border"]["high"], r["border"]["start"], r["n"], r["flags"]))
    return borders


def ntile_totals(df: DataFrame, order: str, flag: str, n_buckets: int, cells: int = CELLS) -> DataFrame:
    """``ntile(n_buckets)`` over a numeric ``order``: rows and set flags per zero-based bucket.

    NULLs come first and NaN last; among equal values unset flags come first. Runs a
    job for each level, three or four for whole numbers; the result has a row per bucket.
    """
    kind = df.schema[order].dataType
    k = F.col("k")
    rows = df.select(F.col(order).alias("k"), F.coalesce(F.col(flag).cast("int"), F.lit(0)).alias("f"))
    stats = (F.count("*").alias("n"), F.sum("f").alias("flags"), F.min("k").alias("low"), F.max("k").alias("high"))
    classes = {r["cell"]: r for r in rows.groupBy(_order_class(k, kind).alias("cell")).agg(*stats).collect()}  # five rows at most
    totals = _Totals(sum(r["n"] for r in classes.values()), n_buckets)
    open_, at = [], 0
    for c in sorted(classes):
        r = classes[c]
        if c == 2 and r["low"] < r["high"]:
            open_.append(_Range(r["low"], r["high"], at))
        else:
            totals.spread(at, r["n"] - r["flags"], 0)
            totals.spread(at + r["n"] - r["flags"], r["flags"], 1)
        at += r["n"]
    while open_:
        inside = [k.between(F.lit(p.low).cast(kind), F.lit(p.high).cast(kind)) for p in open_]
        part = cell = start = F.lit(None)
        for i, p in enumerate(open_):
            part, start = F.when(inside[i], i).otherwise(part), F.when(F.col("part") == i, F.lit(p.start).cast("bigint")).otherwise(start)
            cell = F.when(inside[i], _cell(k, kind, p, cells)).otherwise(cell)
        any_of = inside[0]
        for condition in inside[1:]:
            any_of = any_of | condition
        counted = rows.filter(any_of & (_order_class(k, kind) == 2)).groupBy(part.alias("part"), cell.alias("cell")).agg(*stats)
        open_ = []
        for low, high, at, n, flags in _place(counted.withColumn("start", start), totals):
            if low == high:
                totals.spread(at, n - flags, 0)
                totals.spread(at + n - flags, flags, 1)
            else:
                open_.append(_Range(low, high, at))
    found = [(i, *x) for i, x in enumerate(totals.found) if x[0]]
    return df.sparkSession.createDataFrame(found, _RESULT)


def in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """Stored rows with ``part``: all of one part come before all of the next in ``order``.

    Rows that are equal in ``order`` are in one part, so make them distinct first.
    The table is stored, as a range partitioning is sampled and would differ from
    one run to the next.
    """
    return materialise(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
