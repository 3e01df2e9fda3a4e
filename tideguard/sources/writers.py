"""Writers, staged publishing and read-back checks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MARKER = "_published.json"


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, column: str) -> None:
    """Hive-partitioned Parquet with files of an even size.

    The rebalance hint groups rows by the partition column but lets AQE split
    a value that holds most of the rows over many tasks.
    """
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)


def write_report(df: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with a header. ``single_file`` is for reports of bounded size; row
    reports such as flagged comments keep one file per task."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite")
     .options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
              ignoreTrailingWhiteSpace=False).csv(path))


def count_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n"))


def verify_readback(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    """Rows per source: expected, found in the stored table, and whether they agree."""
    expected = count_by_source(written).select(
        "source", F.col("n").alias("expected"), F.lit(0).cast("bigint").alias("found"))
    found = count_by_source(spark.read.parquet(path)).select(
        "source", F.lit(0).cast("bigint").alias("expected"), F.col("n").alias("found"))
    return (expected.unionByName(found).groupBy("source")
            .agg(F.sum("expected").alias("expected"), F.sum("found").alias("found"))
            .withColumn("matches", F.col("expected") == F.col("found")))


@dataclass(frozen=True)
class Published:
    """What a publication has written: rows, and rows per source where sources are known."""

    rows: int
    by_source: dict[str, int]


def _path(spark: SparkSession, name: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _mark(spark: SparkSession, folder: str, published: Published) -> None:
    """The commit marker: a folder with it holds a whole, counted version. Readers skip names that begin with an underscore."""
    where, fs = _path(spark, f"{folder}/{MARKER}")
    out = fs.create(where, True)
    out.write(bytearray(json.dumps({"rows": published.rows, "by_source": published.by_source}).encode()))
    out.close()


def marker(spark: SparkSession, folder: str) -> Published | None:
    """The marker of a published table, or None."""
    where, fs = _path(spark, f"{folder}/{MARKER}")
    if not fs.exists(where):
        return None
    stored = fs.open(where)
    size = int(fs.getFileStatus(where).getLen())
    text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stored, size)).decode()
    stored.close()
    return Published(**json.loads(text))


@contextmanager
def _apart(tables: Sequence[DataFrame]) -> Iterator[list[DataFrame]]:
    """The same tables in a session of their own, with the same settings.

    A session that has observed metrics can no longer ship MLlib models that hold a
    training summary, so the user's session does not observe any.
    """
    spark = tables[0].sparkSession
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    names = [f"published_{uuid.uuid4().hex}" for _ in tables]
    views = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    for name, df in zip(names, tables, strict=True):
        df.createGlobalTempView(name)
    try:
        yield [own.table(f"{views}.{name}") for name in names]
    finally:
        for name in names:
            spark.catalog.dropGlobalTempView(name)


def publish(df: DataFrame, target: str, keep_previous: bool = False) -> int:
    """Replace the table at ``target`` with ``df``; returns the row count.

    ``df`` runs once: its rows are counted while they are written. The new version
    lies next to the target until the stored rows (from the files' footers) have been
    found to be as many and a marker says so. Then the old version is renamed aside,
    the new one renamed in, and only after that the old one removed: at any moment
    a whole version exists under one of the names, and ``recover`` puts it in place
    after a crash.
    """
    seen = Observation()
    staged = f"{target}__staged"
    with _apart([df]) as (rows,):
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staged)
    expected, stored = seen.get["rows"], df.sparkSession.read.parquet(staged).count()
    if expected != stored:
        raise RuntimeError(f"staged table has {stored} rows instead of {expected}")
    _swap_in(df.sparkSession, target, Published(stored, {}), keep_previous)
    return stored


def publish_sources(sources: Sequence[DataFrame], target: str, keep_previous: bool = False) -> DataFrame:
    """The union of tables with the same columns, published; (source, expected, found, matches) of what was written.

    Every table is computed once: its rows are counted by ``source`` on their way to
    the files, as are those of the files, which is a scan of that one stored column.
    A table has one value of ``source``, or else is counted apart.
    """
    spark = sources[0].sparkSession
    seen = [Observation() for _ in sources]
    staged = f"{target}__staged"
    with _apart(sources) as tables:
        union = None
        for rows, o in zip(tables, seen, strict=True):
            watched = rows.observe(o, F.count(F.lit(1)).alias("rows"), F.min("source").alias("low"), F.max("source").alias("high"),
                                   F.count("source").alias("named"))
            union = watched if union is None else union.unionByName(watched)
        union.write.mode("overwrite").parquet(staged)
    expected: dict[str | None, int] = {}
    for source, found in zip(sources, (o.get for o in seen), strict=True):
        if found["low"] == found["high"] and found["named"] in (0, found["rows"]):
            counts = {found["low"]: found["rows"]} if found["rows"] else {}
        else:
            counts = {r["source"]: r["n"] for r in count_by_source(source).collect()}
        for name, n in counts.items():
            expected[name] = expected.get(name, 0) + n
    stored = {r["source"]: r["n"] for r in count_by_source(spark.read.parquet(staged)).collect()}  # one row per source
    if stored != expected:
        raise RuntimeError(f"staged rows per source are {stored} instead of {expected}")
    _swap_in(spark, target, Published(sum(stored.values()), {str(k): n for k, n in stored.items()}), keep_previous)
    return spark.createDataFrame([(k, n, stored.get(k, 0), n == stored.get(k, 0)) for k, n in sorted(expected.items(), key=repr)],
                                 "source string, expected bigint, found bigint, matches boolean")


def _swap_in(spark: SparkSession, target: str, published: Published, keep_previous: bool) -> None:
    _mark(spark, f"{target}__staged", published)
    (here, fs), (staged, _), (previous, _) = (_path(spark, f"{target}{x}") for x in ("", "__staged", "__previous"))
    fs.delete(previous, True)
    had_old = fs.exists(here)
    if had_old and not fs.rename(here, previous):
        raise RuntimeError(f"cannot move {target} aside")
    if not fs.rename(staged, here):
        if had_old:
            fs.rename(previous, here)
        raise RuntimeError(f"cannot move the new version to {target}")
    if had_old and not keep_previous:
        fs.delete(previous, True)


def recover(spark: SparkSession, target: str) -> str:
    """After a publication that did not end: puts a whole version at ``target``.

    Returns what it found: ``whole`` (nothing to do), ``new`` (the staged version was
    complete, as its marker says), ``old`` (the version set aside is back) or ``none``.
    """
    (here, fs), (staged, _), (previous, _) = (_path(spark, f"{target}{x}") for x in ("", "__staged", "__previous"))
    if fs.exists(here):
        return "whole"
    if marker(spark, f"{target}__staged") is not None and fs.rename(staged, here):
        return "new"
    if fs.exists(previous) and fs.rename(previous, here):
        return "old"
    return "none"
