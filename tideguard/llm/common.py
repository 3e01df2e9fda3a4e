"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1

#: Documents handled together inside a task: at most this many bytes of text,
#: or a single document if that is longer.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores behind it until no column of ``taken`` has that name."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def raw(column: str = "text") -> Column:
    """The text as UTF-8 bytes; a null text is an empty one."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id is in fold -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1))


def pieces(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose ``column`` holds at most ``limit`` bytes each."""
    sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], dtype=np.int32,
                                  count=len(batch) + 1 + batch.column(column).offset)[batch.column(column).offset:])
    start = total = 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > limit:
            yield start, row
            start, total = row, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
               schema: str, sized_by: str, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of bounded size, whatever the batch size is.

    ``sized_by`` names the binary column that decides the size of a slice.
    """
    index = df.columns.index(sized_by)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in pieces(batch, index, limit):
                result = work(batch.slice(start, end - start))
                if result is not None and len(result):
                    yield result

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, learn: Column,
                    per_class: int, max_chars: int = 200_000) -> list[tuple[int, bytes]]:
    """(label, text) of at most ``per_class`` learning documents of each class.

    The rows come in the order of a hash of the id, so that they do not depend
    on the layout. Rows with a null id or label are left out, a document with
    several labels counts with the largest, and texts over ``max_chars`` are
    not learned from (they are scored like all others): the driver holds at
    most ``2 * per_class`` documents. Only labels of a document with such a text
    are chosen, and an id with several counts once, with the text of the
    smallest hash.
    """
    usable = documents.select("doc_id", raw().alias("text")).where(F.length("text") <= max_chars)
    known = (labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
             .join(usable.select("doc_id").distinct(), "doc_id", "left_semi"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(*order).limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    rows = (usable.join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("s"))
            .orderBy(*order).select("y", "s.text").collect())
    return [(r["y"], bytes(r["text"])) for r in rows]


def class_shares(labels: DataFrame, label: str, learn: Column) -> dict[int, int]:
    """How many learning documents each class has, over all labels."""
    return {r["y"]: r["n"] for r in labels.where(learn & F.col(label).isNotNull())
            .groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
