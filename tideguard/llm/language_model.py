"""LM scoring: Brown class-based bigrams, every word with a class of its own.

0. All texts are cut into words once, in slices of bounded size; a slice is stored
   as numbers into the list of its own words. All steps below read the slices: their
   cost in Python goes by the distinct words of a slice and by arrays.
1. Words of all learning documents are counted (a table that grows with the
   corpus; workers add up before Spark shuffles).
2. Seeds: the most frequent words are symbols; every other word belongs to one
   of a fixed number of surface symbols, by a hash of its last bytes. Exchange
   clustering on the counts of neighbouring symbols moves symbol after symbol to
   the class that raises the likelihood of the class bigrams most. This gives
   the first class table.
3. All words: Spark counts how often each word follows and precedes each class
   (a table that grows with the vocabulary), and every word above a small count
   moves to the class with the greatest exchange gain against the class table,
   which holds still during a round. After a round the classes of the most
   frequent words take the place of the seeds' classes as contexts. Rarer words
   keep the class of their surface symbol, as unknown ones do.
4. The probability of a token is P(class | class before) * P(word | class):
   class transitions smoothed towards the class frequencies, emissions with one
   count added to each word and one for all unknown words of a class.

Counts and classes of words come to the scoring tasks in two ways: those of the
most frequent words (``broadcast_words``, a fixed number) are broadcast, all
others are joined by the hash of the word (64 bits; tasks find the words of the
broadcast by it too). So no broadcast grows with the
vocabulary, and neither a count nor a class is cut. As a context (the class
before) a word outside the broadcast stands for its surface symbol, in counting
and in scoring alike, so that no task needs to know its neighbours' hashes.

A-Z counts as lower case, words are cut at ASCII white space, and an end token
closes every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import fold, map_slices, raw, table
from tideguard.session import Stored, materialise, store


@dataclass(frozen=True)
class BrownConfig:
    symbols: int = 500            #: seed words, symbols of their own in the first exchange
    surfaces: int = 64            #: symbols of all other words
    suffix: int = 3               #: bytes of the end of a word that decide its surface symbol
    classes: int = 48
    rounds: int = 8               #: of the exchange of the seeds
    word_rounds: int = 2          #: of the exchange of all words, at least one
    least: int = 3                #: count from which a word is moved by the exchange
    back_off: float = 5.0         #: pseudo-counts of the class frequencies in the transitions
    broadcast_words: int = 200_000
    held_words: int = 400_000     #: distinct words a counting task holds at a time
    slice_bytes: int = 8 << 20    #: text encoded together; a longer one gives less to store, and larger arrays
    file_slices: int = 4          #: slices in a file, which a reader may hold at once


def surface(word: bytes, config: BrownConfig) -> int:
    return zlib.crc32(word[-config.suffix:]) % config.surfaces


def signed_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def signed_hashes(words: list[bytes]) -> np.ndarray:
    """``signed_hash`` of many words."""
    return np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64).view(np.int64)


class Numbers(dict):
    """Words by number, in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        return at


class Surfaces(dict):
    """Surface symbols by the last bytes of words that a task has met."""

    def __init__(self, config: BrownConfig):
        super().__init__()
        self.config = config

    def __missing__(self, suffix: bytes) -> int:
        if len(self) > self.config.held_words:
            self.clear()
        k = self[suffix] = surface(suffix, self.config)
        return k


class ByHash:
    """Places of words in a list, found by their hashes."""

    def __init__(self, words: list[bytes]):
        hashes = signed_hashes(words)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word, -1 if it is not in the list."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


SLICES = "docs long, learn binary, tokens binary, words binary, n binary, h binary, surface binary"


def encoded(documents: DataFrame, learn: Column, config: BrownConfig, key: str | None = None, text: str = "text") -> Stored:
    """Slices of all documents as numbers, one in a row: (keys, docs, learn, tokens, words, n, h, surface).

    Word 0 of a slice is the end token, which closes every document in ``tokens``; ``docs`` of the documents are learned from, as a
    byte for each in ``learn`` tells; ``n`` has the counts in those. Arrays are bytes, ``words`` (without word 0) are joined by line feeds.
    """
    kind = documents.schema[key].dataType.simpleString() if key else "string"
    state: dict[str, Surfaces] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        surfaces = state.setdefault("surfaces", Surfaces(config))    # one for the task
        ids, tokens = Numbers({b" ": 0}), []      # no word holds white space
        for body in batch.column(1).to_pylist():
            tokens += map(ids.__getitem__, body.lower().split())
            tokens.append(0)
        words = list(ids)
        tokens = np.array(tokens, dtype=np.min_scalar_type(len(words)))
        learned = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
        n = np.bincount(tokens[of_documents(tokens, learned)], minlength=len(words)).astype(np.int32)
        own = np.array([0, *map(surfaces.__getitem__, [w[-config.suffix:] for w in words[1:]])], dtype=np.min_scalar_type(config.surfaces))
        keys = pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(0))
        blobs = [learned.tobytes(), tokens.tobytes(), b"\n".join(words[1:]), n.tobytes(), signed_hashes(words).tobytes(), own.tobytes()]
        return pa.RecordBatch.from_arrays([keys, pa.array([int(learned.sum())]), *(pa.array([x], pa.binary()) for x in blobs)],
                                          names=["keys", "docs", "learn", "tokens", "words", "n", "h", "surface"])

    rows = documents.select((F.col(key) if key else F.lit(None).cast("string")).alias("key"), raw(text).alias("body"),
                            F.coalesce(learn, F.lit(False)).alias("learn"))
    return store(map_slices(rows, work, f"keys array<{kind}>, {SLICES}", "body", config.slice_bytes), "word-slices", config.file_slices, "zstd")


def of_documents(tokens: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which tokens are in the documents with a nonzero byte in ``chosen``."""
    return np.repeat(chosen.astype(bool), np.diff(np.flatnonzero(tokens == 0), prepend=-1))


def numbered(batch: pa.RecordBatch, config: BrownConfig) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(learn, tokens, h, surface) of each row of (learn, tokens, h, surface)."""
    for learn, tokens, h, own in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
        h = np.frombuffer(h, dtype=np.int64)
        yield (np.frombuffer(learn, dtype=np.uint8), np.frombuffer(tokens, dtype=np.min_scalar_type(len(h))), h,
               np.frombuffer(own, dtype=np.min_scalar_type(config.surfaces)))


def word_counts(slices: DataFrame, config: BrownConfig) -> DataFrame:
    """(word, n, h, surface) of all words of the learning documents."""
    def run(batches):
        for batch in batches:
            for words, n, h, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.frombuffer(n, dtype=np.int32)[1:]
                seen = np.flatnonzero(n)
                if len(seen):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words.split(b"\n"), pa.binary()).take(pa.array(seen)), pa.array(n[seen].astype(np.int64)),
                         pa.array(np.frombuffer(h, dtype=np.int64)[1:][seen]),
                         pa.array(np.frombuffer(own, dtype=np.min_scalar_type(config.surfaces))[1:][seen].astype(np.int32))],
                        names=["word", "n", "h", "surface"])

    return (slices.select("words", "n", "h", "surface").mapInArrow(run, "word binary, n long, h long, surface int")
            .groupBy("word").agg(F.sum("n").alias("n"), F.max("h").alias("h"), F.max("surface").alias("surface")))


def pair_counts(slices: DataFrame, words: list[bytes], config: BrownConfig) -> np.ndarray:
    """Counts of (symbol, next symbol) over all learning texts; before the first token of a text stands the end token.

    A word of ``words`` is a symbol of its own, any other is ``symbols + surface``; the end token comes last. The matrix
    has a fixed size, whatever the corpus.
    """
    shared = slices.sparkSession.sparkContext.broadcast(ByHash(words))
    end = config.symbols + config.surfaces
    n = end + 1

    def run(batches):
        total = np.zeros(n * n, dtype=np.int64)
        waiting, size = [], 0

        def add():
            total[:] += np.bincount(np.concatenate(waiting), minlength=n * n)

        for batch in batches:
            for learn, tokens, h, own in numbered(batch, config):
                place = shared.value.places(h)
                symbols = np.where(place >= 0, place, config.symbols + own.astype(np.int64))
                symbols[0] = end
                ids = np.append(np.int64(end), symbols[tokens[of_documents(tokens, learn)]])
                waiting.append(ids[:-1] * n + ids[1:])
                size += len(ids)
                if size > 1 << 21:    # a bin for each pair: worth its cost for many pairs at once only
                    add()
                    waiting, size = [], 0
        if waiting:
            add()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["pair", "n"])

    rows = (slices.select("learn", "tokens", "h", "surface").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(n * n, dtype=np.int64)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(n, n)


def exchange(pairs: np.ndarray, config: BrownConfig) -> np.ndarray:
    """Class of each symbol, by exchange; symbols start dealt out by frequency, the end token keeps a class of its own.

    The likelihood is sum(f(N(c, d))) - sum(f(left(c))) - sum(f(right(c))), f(x) = x * ln(x).
    """
    n, k = len(pairs), config.classes
    pairs = pairs.astype(np.float64)
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    weight = pairs.sum(axis=1)
    order = sorted(range(n - 1), key=lambda s: (-weight[s], s))
    of = np.zeros(n, dtype=np.int64)
    for rank, s in enumerate(order):
        of[s] = rank % (k - 1)
    of[n - 1] = k - 1
    member = np.zeros((n, k))
    member[np.arange(n), of] = 1
    out_, in_ = pairs @ member, pairs.T @ member   # symbol to class, class to symbol
    table_ = member.T @ out_
    for _ in range(config.rounds):
        moved = 0
        for s in order:
            if not weight[s]:
                continue
            old, own = of[s], pairs[s, s]
            row, column = out_[s].copy(), in_[s].copy()
            # Without s: its class loses the row and the column; pairs of s with itself are counted once.
            row[old] -= own
            column[old] -= own
            t = table_
            t[old, :] -= row
            t[:, old] -= column
            t[old, old] -= own
            left, right = t.sum(axis=1), t.sum(axis=0)
            w_out, w_in = row.sum() + own, column.sum() + own
            gain = (f(t + row[None, :]) - f(t)).sum(axis=1) + (f(t + column[:, None]) - f(t)).sum(axis=0)
            d = np.arange(k)
            # The diagonal cell of the new class gets the row, the column and the pairs with itself at once.
            gain += (f(t[d, d] + row + column + own) - f(t[d, d] + row) - f(t[d, d] + column) + f(t[d, d]))
            gain -= f(left + w_out) - f(left) + f(right + w_in) - f(right)
            gain[k - 1] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            t[new, :] += row
            t[:, new] += column
            t[new, new] += own
            if new != old:
                moved += 1
                of[s] = new
                out_[:, old] -= pairs[:, s]
                out_[:, new] += pairs[:, s]
                in_[:, old] -= pairs[s, :]
                in_[:, new] += pairs[s, :]
        if not moved:
            break
    return of


def frequent(counts: DataFrame, limit: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """At most ``limit`` of the most frequent words, their counts and classes; most frequent first, ties by the word.

    The least count comes from a histogram of a few hundred cells (eight to a
    doubling), so nothing is sorted but what the driver gets. Of the cell on the
    border the words with the smallest hashes are taken, so that a vocabulary of
    equally frequent words fills the list as well.
    """
    cell = F.floor(8 * F.log2("n")).cast("int")
    histogram = sorted(((r["cell"], r["v"]) for r in counts.groupBy(cell.alias("cell")).agg(F.count("*").alias("v")).collect()), reverse=True)
    wanted, held = F.lit(False), 0
    for k, v in histogram:
        if held + v > limit:
            share = (limit - held) / v
            wanted = wanted | ((cell == k) & (F.col("h") < int(share * 2.0 ** 64) - (1 << 63)))
            break
        wanted, held = cell >= k, held + v
    top = counts.where(wanted).select("word", "n", "class").toArrow()
    rows = sorted(zip(*[top.column(i).to_pylist() for i in range(3)], strict=True), key=lambda r: (-r[1], r[0]))[:limit]
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.int64)


@dataclass
class Contexts:
    """Class of a word as a neighbour: of its own for ``words``, that of its surface symbol for all others."""

    words: list[bytes]
    classes: np.ndarray
    surfaces: np.ndarray
    config: BrownConfig

    def own(self) -> dict[bytes, int]:
        return dict(zip(self.words, self.classes.tolist(), strict=True))

    def of_surface(self, word: bytes) -> int:
        return int(self.surfaces[surface(word, self.config)])


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first)


def neighbour_counts(slices: DataFrame, contexts: Contexts) -> DataFrame:
    """(h, cells): how often each word (null: the end token) follows a class and precedes one.

    A cell c below the number of classes counts class c before the word, one from
    there on class c - classes behind it: at most twice the number of classes a
    word. A task adds up and sends a word's cells in one piece, n * 2 * classes + c
    in eight bytes each, so that a word is shuffled once with its hash, whatever
    its cells; a word has a few rows for each task, also one in every text.
    """
    config = contexts.config
    k = config.classes
    shared = slices.sparkSession.sparkContext.broadcast((ByHash(contexts.words), contexts.classes, contexts.surfaces))

    def run(batches):
        known, classes, surfaces = shared.value
        # Words of all slices held, one list behind the other; cells by the place of their word there. Each list begins with the end token.
        held = {"h": [], "ends": [], "words": 0, "parts": [], "cells": 0}

        def merged():
            distinct, number = np.unique(np.concatenate(held["h"]), return_inverse=True)
            number += 1
            number[held["ends"]] = 0
            keys = np.concatenate([p[0] for p in held["parts"]])
            keys, n = summed(number[keys // (2 * k)] * (2 * k) + keys % (2 * k), np.concatenate([p[1] for p in held["parts"]]))
            held.update(h=[np.append(np.int64(0), distinct)], ends=[0], words=len(distinct) + 1, parts=[(keys, n)], cells=len(keys))

        def rows():
            merged()
            (hashes,), ((keys, n),) = held["h"], held["parts"]
            word, packed = keys // (2 * k), n * (2 * k) + keys % (2 * k)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            word, ends = word[starts], np.append(starts, len(keys))
            for a in range(0, len(word), 1 << 13):
                own = ends[a: a + (1 << 13) + 1]
                some = word[a: a + (1 << 13)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[some], pa.int64(), mask=some == 0),
                     pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((8 * (own - own[0])).astype(np.int32).tobytes()),
                                                                    pa.py_buffer(packed[own[0]: own[-1]].astype(np.int64).tobytes())])],
                    names=["h", "cells"])
            held.update(h=[], ends=[], words=0, parts=[], cells=0)

        for batch in batches:
            for learn, tokens, h, own in numbered(batch, config):
                tokens = tokens[of_documents(tokens, learn)].astype(np.int64)
                if not len(tokens):
                    continue
                place = known.places(h)
                of = np.where(place >= 0, classes[place], surfaces[own]) if len(classes) else surfaces[own]
                of[0] = k - 1
                tokens = np.append(np.int64(0), tokens)
                of = of[tokens]
                keys = np.concatenate([tokens[1:] * (2 * k) + of[:-1], tokens[:-1] * (2 * k) + k + of[1:]])
                keys.sort()
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                held["parts"].append((keys[first] + held["words"] * 2 * k, np.diff(np.append(first, len(keys)))))
                held["cells"] += len(first)
                held["h"].append(h)
                held["ends"].append(held["words"])
                held["words"] += len(h)
                if held["cells"] > 8 * config.held_words or held["words"] > 4 * config.held_words:
                    merged()
                    if held["cells"] > 5 * config.held_words or held["words"] > 2 * config.held_words:   # little is left to add up
                        yield from rows()
        if held["parts"]:
            yield from rows()

    return slices.select("learn", "tokens", "h", "surface").mapInArrow(run, "h long, cells binary")


def x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


TABLED = 16     #: counts of a cell up to here, which most cells have, take their logarithms from a table


def gain_tables(classes: np.ndarray) -> np.ndarray:
    """[n - 1, cell]: what a cell of count n adds to each class that does not hold its word."""
    sides = np.concatenate([classes, classes.T])
    return np.stack([x_log_x(sides + n) - x_log_x(sides) for n in range(1, TABLED + 1)])


def best_classes(cells: np.ndarray, n: np.ndarray, starts: np.ndarray, weight: np.ndarray, old: np.ndarray,
                 classes: np.ndarray, tables: np.ndarray | None = None) -> np.ndarray:
    """Class with the greatest exchange gain of each word, against a class table that holds still.

    ``cells`` and ``n`` are the cells of word after word, beginning at ``starts``; ``weight`` is a word's count. The
    word's own part is taken out of its old class first; the last class is the end token's and takes no word. ``tables`` are
    ``gain_tables(classes)``.
    """
    tables = gain_tables(classes) if tables is None else tables
    sides = np.concatenate([classes, classes.T])        # [g]: classes after g; [k + g]: classes before g
    sizes = np.diff(np.append(starts, len(cells)))
    part = tables[np.minimum(n, TABLED) - 1, cells]     # what a cell adds to each class
    more = np.flatnonzero(n > TABLED)
    some = sides[cells[more]]
    part[more] = x_log_x(some + n[more, None]) - x_log_x(some)
    was = np.repeat(old, sizes)
    base = np.maximum(sides[cells, was] - n, 0)
    part[np.arange(len(cells)), was] = x_log_x(base + n) - x_log_x(base)
    gain = np.add.reduceat(part, starts, axis=0)
    mine = np.arange(len(old)), old
    for totals in (classes.sum(axis=1), classes.sum(axis=0)):
        totals = np.repeat(totals[None, :], len(old), axis=0)
        totals[mine] = np.maximum(totals[mine] - weight, 0)
        gain -= x_log_x(totals + weight[:, None]) - x_log_x(totals)
    gain[:, -1] = -np.inf
    new = gain.argmax(axis=1)
    return np.where(gain[np.arange(len(old)), new] > gain[mine] + 1e-9, new, old)


def whole_words(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches in which all rows of a word are together, and the first row of each word; rows come in the order of ``column``."""
    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        first = first_rows(held.column(column))
        if len(first) > 1:      # the last word may go on
            yield held.slice(0, int(first[-1])), first[:-1]
            held = held.slice(int(first[-1]))
    if held is not None and len(held):
        yield held, first_rows(held.column(column))


def first_rows(values: pa.Array) -> np.ndarray:
    """The first row of each run of equal values; nulls are equal."""
    named, x = values.is_valid().to_numpy(zero_copy_only=False), values.fill_null(0).to_numpy()
    return np.flatnonzero(np.append(len(x) > 0, (x[1:] != x[:-1]) | (named[1:] != named[:-1]))[: len(x)])


def moved(counts: DataFrame, cells: DataFrame, classes: np.ndarray, config: BrownConfig) -> DataFrame:
    """One round for all words: the rows of ``counts`` with their new classes, and the class table by the new classes.

    Rows of the table have a null word: (before, class, n) says how often a token of the class follows the class ``before``.
    """
    k = config.classes
    shared = counts.sparkSession.sparkContext.broadcast(classes.astype(np.float64))

    def run(batches):
        total = np.zeros(k * k, dtype=np.int64)
        tables = gain_tables(shared.value)
        for all_rows, first in whole_words(batches, 2):
            batch = all_rows.take(pa.array(first))     # a row for each word
            named = batch.column(2).is_valid()         # all but the end token
            numbers = batch.column(1).fill_null(0).to_numpy()
            # Cells of a word, added up over its rows.
            blobs = all_rows.column(5)
            offsets = np.frombuffer(blobs.buffers()[1], dtype=np.int32)[blobs.offset: blobs.offset + len(blobs) + 1]
            packed = np.frombuffer(blobs.buffers()[2], dtype=np.uint8)[offsets[0]: offsets[-1]].view(np.int64)
            at = (np.append(offsets[first], offsets[-1]) - offsets[0]) // 8
            keys, n = summed(np.repeat(np.arange(len(batch)), np.diff(at)) * (2 * k) + packed % (2 * k), packed // (2 * k))
            cell, sizes = keys % (2 * k), np.bincount(keys // (2 * k), minlength=len(batch))
            starts = np.cumsum(sizes) - sizes
            new = batch.column(4).fill_null(k - 1).to_numpy().astype(np.int64)
            asked = (numbers >= config.least) & (new != k - 1)
            a = 0
            while a < len(new):   # words with 16,384 cells at a time
                b = max(a + 1, int(np.searchsorted(starts, starts[a] + (1 << 14))))
                some = np.flatnonzero(asked[a:b]) + a
                if len(some):
                    mine = np.repeat(asked[a:b], sizes[a:b])
                    part = slice(starts[a], starts[b - 1] + sizes[b - 1])
                    new[some] = best_classes(cell[part][mine], n[part][mine], np.cumsum(sizes[some]) - sizes[some], numbers[some].astype(np.float64),
                                             new[some], shared.value, tables)
                a = b
            before = cell < k
            total += np.bincount(cell[before] * k + np.repeat(new, sizes)[before], n[before], minlength=k * k).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(new.astype(np.int32)), pa.nulls(len(new), pa.int32())],
                names=["word", "n", "h", "surface", "class", "before"]).filter(named)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(at), pa.binary()), pa.array(total[at]), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int32()),
             pa.array((at % k).astype(np.int32)), pa.array((at // k).astype(np.int32))],
            names=["word", "n", "h", "surface", "class", "before"])

    # Dealt out by the word and in its order, however the join is done.
    return (cells.repartition("h").join(counts, "h", "left").select("word", "n", "h", "surface", "class", "cells").sortWithinPartitions("h")
            .mapInArrow(run, "word binary, n long, h long, surface int, class int, before int"))


@dataclass
class Brown:
    """What the scoring tasks need besides the counts and classes of rare words; its size is fixed by the configuration."""

    words: list[bytes]        # of the broadcast, most frequent first
    counts: np.ndarray
    classes: np.ndarray       # class of each of them
    contexts: Contexts
    move: np.ndarray          # log10 P(class | class before)
    mass: np.ndarray          # log10 of the denominator of the emissions, per class
    total: int                # training tokens, with the end tokens
    distinct: int             # distinct training tokens, with the end token
    config: BrownConfig


def class_table(pairs: np.ndarray, of: np.ndarray, config: BrownConfig) -> np.ndarray:
    member = np.zeros((len(pairs), config.classes))
    member[np.arange(len(pairs)), of] = 1
    return member.T @ pairs @ member


def train(documents: DataFrame, learn: Column, config: BrownConfig = BrownConfig(), text: str = "text") -> tuple[Brown, DataFrame]:
    """The model, and the table of the counts and classes of all words: (word, n, h, surface, class)."""
    slices = encoded(documents.where(learn), F.lit(True), config, text=text)
    model, counts, _ = train_slices(slices.df, config)
    slices.discard()
    return model, counts


def train_slices(slices: DataFrame, config: BrownConfig) -> tuple[Brown, DataFrame, int]:
    """``train`` from the learning documents of ``encoded`` ones, and how many these are."""
    spark = slices.sparkSession
    counts = materialise(word_counts(slices, config).withColumn("class", F.lit(0)), "word-counts")
    n_docs = slices.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    seeds = frequent(counts, config.symbols)[0]
    pairs = pair_counts(slices, seeds, config)
    of = exchange(pairs, config)
    classes = class_table(pairs, of, config)
    surfaces = of[config.symbols: config.symbols + config.surfaces]
    contexts = Contexts(seeds, of[: len(seeds)], surfaces, config)
    first = spark.createDataFrame(pa.table({"word": pa.array(seeds, pa.binary()), "seed": pa.array(of[: len(seeds)].astype(np.int32))}))
    counts = (counts.join(F.broadcast(first), "word", "left")
              .withColumn("class", F.coalesce("seed", F.get(F.array(*[F.lit(int(c)) for c in surfaces]), F.col("surface")))).drop("seed"))
    for i in range(config.word_rounds):
        if i:
            words, _, own = frequent(counts, config.broadcast_words)
            contexts = Contexts(words, own, surfaces, config)
        stored = materialise(moved(counts, neighbour_counts(slices, contexts), classes, config), "word-classes")
        counts = stored.where("before is null").drop("before")
        classes = np.zeros((config.classes, config.classes))
        for r in stored.where("before is not null").groupBy("before", "class").agg(F.sum("n").alias("n")).collect():
            classes[r["before"], r["class"]] = r["n"]
    seen = classes.sum(axis=0)
    usual = (seen + 1) / (seen.sum() + config.classes)
    move = np.log10((classes + config.back_off * usual[None, :]) / (classes.sum(axis=1, keepdims=True) + config.back_off))
    # Tokens and distinct words of each class; the end token is alone in the last one.
    mass = np.ones(config.classes)
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        mass[r["class"]] += r["n"] + r["v"]
    mass[-1] += n_docs + int(n_docs > 0)
    words, numbers, own = frequent(counts, config.broadcast_words)
    model = Brown(words, numbers, own, contexts, move, np.log10(mass), n_words + n_docs, n_distinct + int(n_docs > 0), config)
    return model, counts, n_docs


def score(documents: DataFrame, model: Brown, counts: DataFrame, n_ends: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of every row, log10; ``n_ends``: training documents.

    Defined results: null and empty texts are their end token alone; repeated
    rows score alike; with nothing to learn from every word is unknown; an empty
    table gives an empty result; other columns are not looked at.
    """
    slices = encoded(documents, F.lit(False), model.config, key, text)
    scored = score_slices(slices.df, model, counts, n_ends, key)
    slices.discard()
    return scored


def score_slices(slices: DataFrame, model: Brown, counts: DataFrame, n_ends: int, key: str) -> DataFrame:
    """``score`` of all ``encoded`` documents, which the result does not read any more."""
    spark = slices.sparkSession
    # Without the words: tasks find them by their hashes.
    shared = spark.sparkContext.broadcast((ByHash(model.words), model.counts, model.classes, ByHash(model.contexts.words), model.contexts.classes))
    kind = slices.schema["keys"].dataType.elementType.simpleString()
    item = pa.struct([("h", pa.int64()), ("before", pa.int32()), ("k", pa.int32()), ("d", pa.float64())])
    config, surfaces = model.config, model.contexts.surfaces
    end, k = config.classes - 1, config.classes
    gain = model.move - model.mass[None, :]   # log10 of a transition, less that of the denominator of its emission
    end_log = float(np.log10(n_ends + 1.0))

    def run(batches):
        known, numbers_of, classes_of, neighbours, contexts_of = shared.value
        # The last place is that of words which are not in the broadcast.
        logs_of, classes_of, contexts_of = np.append(np.log10(numbers_of + 1.0), np.nan), np.append(classes_of, 0), np.append(contexts_of, 0)
        for batch in batches:
            for i, (_, tokens, h, own) in enumerate(numbered(batch, config)):
                place, near = known.places(h), neighbours.places(h)
                yield work(batch.column(4)[i].values, tokens, h, logs_of[place], np.where(place >= 0, classes_of[place], surfaces[own]),
                           np.where(near >= 0, contexts_of[near], surfaces[own]))

    def work(keys_: pa.Array, tokens: np.ndarray, h: np.ndarray, logs: np.ndarray, classes: np.ndarray, contexts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.flatnonzero(tokens == 0), prepend=-1) - 1
        numbers = tokens[tokens != 0].astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        start = np.cumsum(sizes) - sizes
        before = np.append(np.int64(end), contexts[numbers])[:-1] if len(numbers) else numbers
        before[start[sizes > 0]] = end
        last = np.full(len(sizes), end, dtype=np.int64)
        last[sizes > 0] = contexts[numbers[(start + sizes - 1)[sizes > 0]]]
        step = gain[before, classes[numbers]]
        width, logs = len(h), logs[numbers]
        rare = np.isnan(logs)
        sums = lambda x: np.bincount(doc, x, minlength=len(sizes))
        base = sums(np.where(rare, 0.0, logs)) + end_log
        own = sums(step) + gain[last, end]
        seen = sums(~rare).astype(np.int64) + int(n_ends > 0)
        # A rare word comes with its surface's class in ``own``; the join puts its class right. One item a document, word and class before.
        packed, place, times = np.unique((doc[rare] * width + numbers[rare]) * k + before[rare], return_index=True, return_counts=True)
        keys = packed // (width * k), packed // k % width, packed % k
        items = pa.StructArray.from_arrays(
            [pa.array(h[keys[1]]), pa.array(keys[2].astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(step[rare][place])],
            fields=list(item))
        offsets = np.searchsorted(keys[0], np.arange(len(sizes) + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [keys_, pa.array(sizes + 1), pa.array(seen), pa.array(base), pa.array(own), pa.ListArray.from_arrays(pa.array(offsets), items)],
            names=["key", "n_tokens", "known", "logs", "own", "rare"])

    # Stored: the row numbers must not change between the two uses below.
    first = materialise(slices.select("learn", "tokens", "h", "surface", "keys").mapInArrow(
        run, f"key {kind}, n_tokens long, known long, logs double, own double, "
        "rare array<struct<h:long,before:int,k:int,d:double>>").withColumn("row", F.monotonically_increasing_id()), "scored-rows")
    steps = spark.createDataFrame(pa.table({"before": np.repeat(np.arange(k, dtype=np.int32), k), "class": np.tile(np.arange(k, dtype=np.int32), k),
                                            "step": gain.ravel()}))
    found = (first.select("row", F.explode("rare").alias("r")).select("row", "r.*")
             .join(counts.select("h", "n", "class"), "h").join(F.broadcast(steps), ["before", "class"])
             .groupBy("row").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + F.lit(1.0))).alias("more_logs"),
                                 F.sum(F.col("k") * (F.col("step") - F.col("d"))).alias("more_own")))
    scale = float(np.log10(model.total + model.distinct + 1))
    every = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return (first.drop("rare").join(found, "row", "left")
            .select(F.col("key").alias(key), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    (every - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
                    (every + F.col("own") + F.coalesce("more_own", F.lit(0.0))).alias("score")))


def perplexity(score_: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score_ / n_tokens)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all documents; learned from the folds other than 2 of 7."""
    documents, config = table(spark, sf_dir, "documents"), BrownConfig()
    slices = encoded(documents, fold("doc_id", 7) != 2, config, "doc_id")
    model, counts, n_docs = train_slices(slices.df, config)
    scored = score_slices(slices.df, model, counts, n_docs, "doc_id")
    slices.discard()
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score", perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"))
