"""Repeatable buckets and ids: the same row always gets the same value,
however the table is partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Multiplicative hashing constant, 2**32 divided by the golden ratio.
_GOLDEN = 2654435761


def bucket(key: Column, n: int) -> Column:
    """Bucket ``0..n-1`` of an integer key; plain 64-bit arithmetic, no overflow."""
    mixed = (F.pmod(key.cast("bigint"), F.lit(2**31)) * F.lit(_GOLDEN)) % F.lit(2**32)
    return F.shiftright(mixed * F.lit(n).cast("bigint"), 32)


def stable_row_id(*columns: Column) -> Column:
    """Content id for rows without a natural key; equal rows share it.

    128 bits: 64 would collide within the rows of one large table. NULL and ''
    differ, and so do values moved from one column to the next.
    """
    parts = [F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\u0001", *parts))


def whole_number(key: Column, kind: T.DataType) -> Column:
    """The key itself if it is a whole number, else a number made from it."""
    return key if isinstance(kind, T.IntegralType) else F.xxhash64(key)


def synthetic_user(key: Column, users: int) -> Column:
    """A stand-in user for rows that carry none."""
    return bucket(key, users).cast("int")
