"""Token-ID output: byte- or bit-plane shuffled blocks of ids, compressed with zstandard.

Format. A corpus is a Spark-written table of chunks, so that any file system
Spark knows can hold it and a retried task leaves no half-written file. A chunk
holds whole documents, in ascending order of their ids; its payload is

    magic "TGPL", u8 version, u8 planes, u8 bits of a plane (8 or 1), u8 0,
    u32 ids of a block, u32 blocks,
    index: for each block u32 ids in it, then u32 compressed bytes of each plane,
    the planes, block after block, each a zstandard frame.

Plane k of a block holds byte (or bit) k of every id in it, the id as little
endian. Beside the payload a chunk row stores the chunk index: shard (range of
ids), number of the chunk, ids of the shard before it, ids in it, and the id and
length of each document.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideguard.llm.common import map_slices, pieces, raw, table
from tideguard.session import fresh_path

# A task has one core; threads of the tokenizer would only hold memory of their own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MAGIC, VERSION = b"TGPL", 1
HEAD = struct.Struct("<4sBBBBII")


@dataclass(frozen=True)
class FileConfig:
    tokenizer: str = "word_bpe_49k.json"  #: a public tokenizer by name, or a path
    end: int = 2                 #: id behind each document
    block: int = 1 << 16         #: ids of a block
    chunk: int = 1 << 18         #: ids after which a chunk ends with its document
    plane_bits: int = 8          #: 8: byte planes, 1: bit planes
    level: int = 3               #: of zstandard
    words_cached: int = 300_000  #: distinct words whose ids a worker remembers


def pack(ids: np.ndarray, config: FileConfig = FileConfig()) -> bytes:
    """The payload of one chunk."""
    bits, n = config.plane_bits, len(ids)
    planes = max(1, -(-int(ids.max()).bit_length() // bits)) if n else 0
    press = zstandard.ZstdCompressor(level=config.level)
    index, body = [], []
    for a in range(0, n, config.block):
        part = ids[a: a + config.block].astype("<u4")
        frames = []
        for k in range(planes):
            plane = (part >> np.uint32(k * bits)) & np.uint32((1 << bits) - 1)
            plane = plane.astype(np.uint8) if bits == 8 else np.packbits(plane.astype(np.uint8), bitorder="little")
            frames.append(press.compress(plane.tobytes()))
        index += [len(part), *map(len, frames)]
        body += frames
    return (HEAD.pack(MAGIC, VERSION, planes, bits, 0, config.block, -(-n // config.block))
            + np.array(index, dtype="<u4").tobytes() + b"".join(body))


def unpack(payload: bytes) -> np.ndarray:
    """The ids of one chunk; ValueError if it is not one."""
    magic, version, planes, bits, _, _, blocks = HEAD.unpack_from(payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a chunk of token ids")
    index = np.frombuffer(payload, dtype="<u4", count=blocks * (1 + planes), offset=HEAD.size).reshape(blocks, 1 + planes)
    at, out, press = HEAD.size + index.nbytes, [], zstandard.ZstdDecompressor()
    for row in index.tolist():
        ids = np.zeros(row[0], dtype=np.uint32)
        for k, size in enumerate(row[1:]):
            plane = np.frombuffer(press.decompress(payload[at: at + size]), dtype=np.uint8)
            if bits == 1:
                plane = np.unpackbits(plane, count=row[0], bitorder="little")
            ids |= plane.astype(np.uint32) << np.uint32(k * bits)
            at += size
        out.append(ids)
    if at != len(payload):
        raise ValueError("a chunk of the wrong length")
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


#: A run of letters, and a run of signs that the tokenizer cuts off it.
PLAIN = re.compile(r"([^\W\d_]+)([.,!?*$#%&|;:]*)")


class Encoder:
    """Texts to little-endian u32 ids, equal to the tokenizer's on the whole text.

    This tokenizer lower-cases, drops white space and never joins across it, so
    the ids of a text are those of its words in turn; it cuts signs off letters,
    so the ids of "word," are those of "word" and ",". The first ``cached``
    distinct words are remembered. New words are encoded together: each piece
    ends with a token that has the word-end mark, which gives the cuts. A text
    that could hold one of the tokenizer's special strings is encoded whole.
    """

    def __init__(self, path: str, cached: int):
        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, parts: list[str]) -> list[bytes]:
        """Ids of strings that are one piece each to the tokenizer."""
        out = []
        for a in range(0, len(parts), 4096):
            some = parts[a: a + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # some letter falls apart in lower case
                out += self.ids(some)
                continue
            blob, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
            out += [blob[x:y] for x, y in zip(at, at[1:], strict=False)]
        return out

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words that are not known."""
        known, new, cut, rest = self.known, set(), [], []
        for w in words:
            m = PLAIN.fullmatch(w.decode())
            n = len(w) - len(m[2]) if m else 0  # the signs are one byte each
            cut.append(n)
            if not n:
                rest.append(w.decode())
            else:
                if w[:n] not in known:
                    new.add(w[:n])
                if n < len(w) and w[n:] not in known:
                    new.add(w[n:])
        parts = list(new)
        of = dict(zip(parts, self.pieces([p.decode() for p in parts]), strict=True))
        whole = iter(self.ids(rest))
        find = lambda p: of[p] if p in of else known[p]
        return [next(whole) if not n else find(w) if n == len(w) else find(w[:n]) + find(w[n:]) for w, n in zip(words, cut, strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        plain = [None if b"<|" in t else t.lower().split() for t in texts]
        seen = set()
        for words in plain:
            seen.update(words or ())
        new = [w for w in seen if w not in self.known]
        self.known.update(zip(new, self.words(new), strict=True))
        get = self.known.__getitem__
        out = [self.ids([t.decode()])[0] if words is None else b"".join(map(get, words))
               for t, words in zip(texts, plain, strict=True)]
        if len(self.known) > self.cached:
            for w in new:
                del self.known[w]
        return out


_encoders: dict[tuple[str, int], Encoder] = {}  # one per worker process


def encoder(name: str, cached: int) -> Encoder:
    path = name if "/" in name else public_tokenizers.path(name)
    if (path, cached) not in _encoders:
        _encoders[path, cached] = Encoder(str(path), cached)
    return _encoders[path, cached]


CHUNKS = ("shard int, chunk int, before long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary")


def chunks(documents: DataFrame, config: FileConfig = FileConfig(), key: str = "doc_id", text: str = "text",
           shards: int | None = None) -> DataFrame:
    """The chunk rows of all documents: ``shards`` ranges of ids (by default the session's shuffle partitions)."""
    shards = shards or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("body")
    rows = (documents.select(F.col(key).cast("long").alias("doc_id"), raw(text).alias("body"))
            .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), tie)
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie))

    def run(batches) -> Iterator[pa.RecordBatch]:
        shard, chunk, before = TaskContext.get().partitionId(), 0, 0
        encode = encoder(config.tokenizer, config.words_cached).encode
        end = np.array([config.end], dtype="<u4").tobytes()
        doc_ids, lengths, parts, held = [], [], [], 0

        def row():
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([pack(ids, config)], pa.binary())],
                names=["shard", "chunk", "before", "n_ids", "doc_ids", "lengths", "payload"])

        for batch in batches:
            for a, b in pieces(batch, 1, 1 << 21):
                for doc_id, ids in zip(batch.column(0)[a:b].to_pylist(), encode(batch.column(1)[a:b].to_pylist()), strict=True):
                    ids += end
                    doc_ids.append(doc_id), lengths.append(len(ids) // 4), parts.append(ids)
                    held += len(ids) // 4
                    if held >= config.chunk:
                        yield row()
                        chunk, before = chunk + 1, before + held
                        doc_ids, lengths, parts, held = [], [], [], 0
        if parts:
            yield row()

    return rows.mapInArrow(run, CHUNKS)


def write(documents: DataFrame, path: str, config: FileConfig = FileConfig(), key: str = "doc_id",
          text: str = "text", shards: int | None = None) -> None:
    """Writes the chunks of all documents to ``path``, a folder on any file system of Spark."""
    chunks(documents, config, key, text, shards).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document: the ids as little-endian u32, ``start`` in the corpus.

    Only the sums of the shards (as many rows as there are shards) are put in order.
    """
    stored = spark.read.schema(CHUNKS).parquet(path)
    sums = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    starts = sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("first"))
    rows = stored.join(starts, "shard").select((F.col("first") + F.col("before")).alias("start"), "n_ids", "doc_ids", "lengths", "payload")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, starts, sizes, found = [], [], [], []
        for row in batch.to_pylist():
            ids = unpack(row["payload"]).astype("<u4").tobytes()
            if len(ids) != 4 * row["n_ids"] or sum(row["lengths"]) != row["n_ids"]:
                raise ValueError("a chunk and its index differ")
            at = 0
            for doc_id, n in zip(row["doc_ids"], row["lengths"], strict=True):
                keys.append(doc_id), starts.append(row["start"] + at), sizes.append(n), found.append(ids[4 * at: 4 * (at + n)])
                at += n
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
            names=["doc_id", "start", "n_tokens", "ids"])

    return map_slices(rows, work, "doc_id long, start long, n_tokens long, ids binary", "payload", 1 << 18)


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what ``read`` returns."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(documents: DataFrame, config: FileConfig = FileConfig()) -> DataFrame:
    """Writes all documents to the shared folder, reads the files back and returns the digest.

    Defined results: null and empty texts are their end id alone; null ids come
    first; rows that repeat an id lie side by side, each with its own ids; an
    empty table gives no rows; other columns are not looked at.
    """
    spark = documents.sparkSession
    path = fresh_path(spark, "token-files")
    write(documents, path, config)
    return digest(read(spark, path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all documents, encoded, written, and read back."""
    return round_trip(table(spark, sf_dir, "documents"))


