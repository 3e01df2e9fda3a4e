"""Benchmark decontamination: BM25 with block-max WAND over an index of test items.

The inverted index is built from the benchmark items, block by block of items:
for each term its items, their BM25 impacts, and the largest impact in each
block. Items are grouped by length classes (up to 1, 2, 4, 8, ... words), each with
an index of its own. For each class every training document is cut into
overlapping passages of twice the class's length (any stretch of an item's length
lies inside one), so the passages of an item depend on its own length alone.
Every passage is a query:

1. the sum of the largest impacts of its terms bounds its score; passages whose
   bound stays under the threshold go;
2. the same with the block maxima, which leaves (passage, block) pairs;
3. inside those blocks the exact scores; all items above the threshold stay.

Impacts are divided by the score of the item for its own text, so one threshold
fits short and long items. A retrieved item is then verified: enough of the word
shingles of its question and of its answer must occur in the passage.

Items come to the tasks in shards of at most ``max_items`` items and
``max_chars`` characters, one broadcast a shard, so the size of a broadcast does
not grow with the benchmark; document frequencies are counted over all items.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import free_name, map_slices, raw, table

#: A-Z to lower case, ASCII punctuation to spaces.
FOLD = bytes(32 if chr(b) in string.punctuation else b for b in bytes(range(256)).lower())


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass(frozen=True)
class SearchConfig:
    k1: float = 1.2
    b: float = 0.75
    least_score: float = 0.5    #: of the item's score for its own text
    least_overlap: float = 0.6  #: of the shingles of question and of answer
    shingle: int = 2
    question_share: float = 2 / 3  #: of the words of an item without its own answer column
    block: int = 16             #: items of a block
    max_items: int = 4096       #: items of a shard
    max_chars: int = 1 << 24    #: characters of a shard, or one item


PIECE = 1 << 20  # blocks of postings looked at together


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The whole numbers from ``first`` on, ``size`` of them, for each pair, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def length_class(n_words: int) -> int:
    """The smallest c with at most 2**c words."""
    return (n_words - 1).bit_length()


class Index:
    """Postings with impacts and block maxima for the items of one length class of a shard."""

    def __init__(self, items: list[tuple[int, bytes, bytes | None]], frequency: dict[bytes, int],
                 n_items: int, average: float, config: SearchConfig):
        self.config = config
        self.ids, self.parts = [], []
        postings: dict[bytes, list[tuple[int, float]]] = {}
        longest = 1
        for item_id, text, answer in items:
            words = words_of(text)
            if answer is None:
                cut = max(1, int(len(words) * config.question_share))
                question, reply = words[:cut], words[cut:]
            else:
                question, reply = words, words_of(answer)
                words = question + reply
            if not words:
                continue
            number = len(self.ids)
            norm = config.k1 * (1 - config.b + config.b * len(words) / average)
            tf: dict[bytes, int] = {}
            for w in words:
                tf[w] = tf.get(w, 0) + 1
            impact = {w: np.log1p((n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * c * (config.k1 + 1) / (c + norm)
                      for w, c in tf.items()}
            own = sum(impact.values())
            for w, x in impact.items():
                postings.setdefault(w, []).append((number, x / own))
            self.ids.append(item_id)
            self.parts.append((self.shingles(question), self.shingles(reply)))
            longest = max(longest, len(words))
        self.step = 1 << length_class(longest)
        self.terms = {w: i for i, w in enumerate(postings)}
        self.bound = np.array([max(x for _, x in p) for p in postings.values()] or [0.0])
        # Postings in one piece, by term and item; the blocks of a term are ranges of them with their largest impact.
        self.item = np.array([i for p in postings.values() for i, _ in p], dtype=np.int64)
        self.impact = np.array([x for p in postings.values() for _, x in p])
        term = np.repeat(np.arange(len(postings)), [len(p) for p in postings.values()])
        block = self.item // config.block
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.low = np.flatnonzero(new)
        self.high = np.append(self.low[1:], len(term))
        self.block, self.maxima = block[self.low], np.maximum.reduceat(self.impact, self.low) if len(term) else np.zeros(0)
        self.first_block = np.searchsorted(term[self.low], np.arange(len(postings) + 1))
        self.n_blocks = -(-len(self.ids) // config.block)

    def shingles(self, words: list[bytes]) -> frozenset:
        n = min(self.config.shingle, len(words))
        return frozenset(tuple(words[i: i + n]) for i in range(len(words) - n + 1)) if words else frozenset()

    def retrieve(self, passage: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all items that score at least the threshold for their passage.

        ``terms`` has the distinct terms of each passage; passages are numbered from
        0 and come in order. Postings of blocks whose maxima do not add up to the
        threshold are not read.
        """
        least, found = self.config.least_score - 1e-9, []
        counts = self.first_block[terms + 1] - self.first_block[terms]
        begin, ends = 0, np.cumsum(counts)
        while begin < len(terms):  # as many passages as have about PIECE blocks, one at least
            stop = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PIECE, "right"))
            stop = int(np.searchsorted(passage, passage[min(stop, len(terms) - 1)], "left")) if stop < len(terms) else len(terms)
            if stop <= begin:
                stop = int(np.searchsorted(passage, passage[begin], "right"))
            at = ranges(self.first_block[terms[begin:stop]], counts[begin:stop])
            own = np.repeat(passage[begin:stop] - passage[begin], counts[begin:stop])
            key = own * self.n_blocks + self.block[at]
            bound = np.bincount(key, self.maxima[at])
            use = bound[key] >= least
            at, own = at[use], own[use]
            size = self.high[at] - self.low[at]
            post = ranges(self.low[at], size)
            pair, where = np.unique(np.repeat(own, size) * len(self.ids) + self.item[post], return_inverse=True)
            scores = np.bincount(where, self.impact[post], len(pair))
            good = scores >= least
            found.append((pair[good] // len(self.ids) + passage[begin], pair[good] % len(self.ids), scores[good]))
            begin = stop
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))

    def matches(self, words: list[list[bytes]], ids: np.ndarray) -> list[list[tuple[int, float, float, float, int]]]:
        """Per text: (item, score, question overlap, answer overlap, first word of the passage) of each passage with an item.

        ``ids`` has the terms of the words of all texts, one after the other, and -1 for words that are none.
        """
        found: list[list[tuple[int, float, float, float, int]]] = [[] for _ in words]
        step = self.step
        # Half passages: `step` words each; a passage is two of them that follow each other.
        lengths = np.array([len(w) for w in words])
        halves = np.maximum(1, -(-lengths // step))
        first = np.concatenate([[0], np.cumsum(halves)])
        ends = np.cumsum(lengths)
        hit = np.flatnonzero(ids >= 0)
        doc_of = np.searchsorted(ends, hit, "right")
        half = first[doc_of] + (hit - (ends - lengths)[doc_of]) // step
        # A term counts once in a half passage, as in the score.
        keys = distinct(half * len(self.bound) + ids[hit])
        of, terms = keys // len(self.bound), keys % len(self.bound)
        weight = np.bincount(of, self.bound[terms], int(first[-1]))
        owner = np.repeat(np.arange(len(words)), halves)
        follows = np.append(owner[1:] == owner[:-1], False)
        passage = weight + np.where(follows, np.append(weight[1:], 0), 0)
        alone = np.repeat(halves == 1, halves)
        ends = np.searchsorted(of, np.arange(int(first[-1]) + 1))
        chosen = np.flatnonzero((passage >= self.config.least_score - 1e-9) & (follows | alone))
        size = ends[np.where(follows[chosen], chosen + 2, chosen + 1)] - ends[chosen]
        pairs = distinct(np.repeat(np.arange(len(chosen)), size) * len(self.bound) + terms[ranges(ends[chosen], size)])
        number, item_of, score_of = self.retrieve(pairs // len(self.bound), pairs % len(self.bound))
        cuts = np.searchsorted(number, distinct(number))
        for c, d in zip(cuts.tolist(), [*cuts[1:].tolist(), len(number)], strict=False):
            h = int(chosen[number[c]])
            got = list(zip(item_of[c:d].tolist(), score_of[c:d].tolist(), strict=True))
            doc = int(owner[h])
            a = (h - int(first[doc])) * step
            stretch = words[doc][a: a + 2 * step]
            n = self.config.shingle
            present = {k: {tuple(stretch[i: i + k]) for i in range(len(stretch) - k + 1)} for k in range(1, n + 1)}
            for item, score in got:
                overlaps = []
                for part in self.parts[item]:
                    size = len(next(iter(part))) if part else 0
                    overlaps.append(len(part & present[size]) / len(part) if part else 1.0)
                if min(overlaps) >= self.config.least_overlap:
                    found[doc].append((item, score, overlaps[0], overlaps[1], a))
        return found


class Shard:
    """An index for each length class of the items of one shard, and the terms of all."""

    def __init__(self, items: list[tuple[int, bytes, bytes | None]], frequency: dict[bytes, int],
                 n_items: int, average: float, config: SearchConfig):
        classes: dict[int, list[tuple[int, bytes, bytes | None]]] = {}
        for item in items:
            n_words = len(words_of(item[1])) + len(words_of(item[2] or b""))
            if n_words:
                classes.setdefault(length_class(n_words), []).append(item)
        self.indexes = [Index(classes[c], frequency, n_items, average, config) for c in sorted(classes)]
        self.ids = [i for index in self.indexes for i in index.ids]
        self.terms: dict[bytes, int] = {}
        for index in self.indexes:
            for w in index.terms:
                self.terms.setdefault(w, len(self.terms))
        self.local = []  # of each index: its number for a term; the last place is for words that are no term
        for index in self.indexes:
            numbers = np.full(len(self.terms) + 1, -1, dtype=np.int32)
            numbers[[self.terms[w] for w in index.terms]] = list(index.terms.values())
            self.local.append(numbers)

    def matches(self, texts: list[bytes]) -> list[list[tuple[int, float, float, float, int]]]:
        """As ``Index.matches``, for the items of all classes."""
        found: list[list[tuple[int, float, float, float, int]]] = [[] for _ in texts]
        words, get, before = [words_of(t) for t in texts], self.terms.get, 0
        ids = np.array([get(w, -1) for ws in words for w in ws], dtype=np.int64)
        for index, numbers in zip(self.indexes, self.local, strict=True):
            for out, got in zip(found, index.matches(words, numbers[ids].astype(np.int64)), strict=True):
                out.extend((before + item, *rest) for item, *rest in got)
            before += len(index.ids)
        return found


def shards(benchmark: DataFrame, config: SearchConfig, answer: str | None = None) -> Iterator[Shard]:
    """The indexes of each shard of items; the statistics are those of the whole benchmark.

    Null ids or texts and items without words are left out. The number of items
    and of characters is counted first, and the items are dealt by a hash of
    their id to twice the shards that the bounds ask for, so that chance does not
    fill one beyond them.
    """
    columns = [F.col("item_id").cast("long").alias("item_id"), raw("text").alias("text"),
               (raw(answer) if answer else F.lit(None).cast("binary")).alias("answer")]
    rows = benchmark.where("item_id is not null and text is not null").select(*columns)
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("text") + F.coalesce(F.length("answer"), F.lit(0))).alias("c")).first()
    if not size["n"]:
        return
    deal = max(-(-2 * size["n"] // config.max_items), -(-2 * size["c"] // config.max_chars)) if (
        size["n"] > config.max_items or size["c"] > config.max_chars) else 1

    def terms(batches):
        for batch in batches:
            doc, word = [], []
            for i, text, reply in zip(range(len(batch)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for w in words_of(text) + words_of(reply or b""):
                    doc.append(batch.column(0)[i].as_py()), word.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(word, pa.binary())], names=["item_id", "word"])

    tokens = rows.mapInArrow(terms, "item_id long, word binary")
    average = (tokens.groupBy("item_id").agg(F.count("*").alias("n")).agg(F.avg("n")).first()[0]) or 1.0
    shard = F.pmod(F.xxhash64("item_id"), F.lit(deal))
    counted = tokens.distinct().groupBy("word").agg(F.count("*").alias("df"), F.collect_set(shard).alias("in_shards"))
    for k in range(deal):
        items = rows.where(shard == k).collect()
        frequency = {bytes(r["word"]): r["df"] for r in counted.where(F.array_contains("in_shards", F.lit(k).cast("long"))).select("word", "df").collect()}
        yield Shard([(r["item_id"], bytes(r["text"]), None if r["answer"] is None else bytes(r["answer"]))
                           for r in sorted(items, key=lambda r: (r["item_id"], bytes(r["text"])))],
                          frequency, size["n"], average, config)


def contaminations(documents: DataFrame, benchmark: DataFrame, config: SearchConfig = SearchConfig(),
                   key: str = "doc_id", text: str = "text", answer: str | None = None) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, first_word): a row per document and item it holds.

    Defined results: null and empty texts hold nothing; repeated documents give
    equal rows each; repeated items are found each; an empty table on either
    side gives an empty result; other columns are not looked at.
    """
    spark = documents.sparkSession
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("key"), raw(text).alias("body"))
    schema = f"key {kind}, item_id long, score double, question_overlap double, answer_overlap double, first_word long"
    result = spark.createDataFrame([], schema)
    for index in shards(benchmark, config, answer):
        model = spark.sparkContext.broadcast(index)  # within the bounds of a shard

        def work(batch: pa.RecordBatch, model=model) -> pa.RecordBatch:
            at, out = [], []
            for row, got in enumerate(model.value.matches(batch.column(1).to_pylist())):
                best: dict[int, tuple] = {}
                for item, *rest in got:
                    if item not in best or rest[0] > best[item][0]:
                        best[item] = tuple(rest)
                for item, rest in best.items():
                    at.append(row), out.append((model.value.ids[item], *rest))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["key", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        result = result.unionByName(map_slices(rows, work, schema, "body"))
    return result.withColumnRenamed("key", key)


def clean(documents: DataFrame, benchmark: DataFrame, config: SearchConfig = SearchConfig(), text: str = "text") -> DataFrame:
    """The documents, all columns as they are, that hold no benchmark item; a pass per shard, no join."""
    columns, body = documents.columns, free_name("_body_of_the_row", documents.columns)
    at, schema = len(columns), documents.schema
    for index in shards(benchmark, config):
        model = documents.sparkSession.sparkContext.broadcast(index)

        def work(batch: pa.RecordBatch, model=model) -> pa.RecordBatch:
            keep = pa.array([not got for got in model.value.matches(batch.column(at).to_pylist())], pa.bool_())
            return pa.RecordBatch.from_arrays(batch.columns[:at], schema=pa.schema(list(batch.schema)[:at])).filter(keep)

        documents = map_slices(documents.withColumn(body, raw(text)), work, schema, body).select(*columns)
    return documents


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the documents that hold an item of the benchmark, with the item."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
