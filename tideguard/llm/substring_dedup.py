"""Substring dedup by recompression.

A window is ``window`` consecutive words of one document; each word in a window
whose word sequence also starts anywhere else goes. Comparing all windows would
move the corpus ``window`` times over; recompression moves little of it:

1. Words are symbols. A round replaces each maximal run of a symbol by one
   symbol, then each pair of a left and a right symbol (a coin from the symbol's
   hash) by one symbol. The name of a run or pair is a hash of what it is made
   of, so it is the same in all documents without a dictionary. Every symbol
   carries its context: the words that decide its borders. Equal words there
   give the equal symbol at the equal place, so equal windows hold equal
   interior symbols.
2. Of the symbols of the highest round whose context lies inside a window, the
   one with the smallest hash is the window's anchor. Consecutive windows with
   one anchor make one row (anchor, span), a row for about 13 words.
3. Rows are grouped by anchor. A window whose anchor is alone repeats nowhere.
   Where all rows of an anchor have equal spans, all their windows repeat.
   Otherwise equal spans are brought together, and one row of each distinct span
   gives the hashes of its single windows, which are counted.

Anchors and windows are compared by two 64-bit hashes together. The verdict is
on the input: what goes does not change what else is a repeat.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import map_slices, mix, raw, table
from tideguard.session import materialise

GOLD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


@dataclass(frozen=True)
class RepeatConfig:
    window: int = 50
    rounds: int = 2


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(1, n), dtype=np.uint64)
    done = 1
    while done < n:
        size = min(done, n - done)
        out[done: done + size] = out[:size] * np.uint64(pow(base, done, 1 << 64))
        done += size
    return out


class Texts:
    """The words of several texts in one row: hashes, bounds, and range hashes."""

    def __init__(self, texts: list[bytes]):
        self.words = [t.split() for t in texts]
        digest = xxhash.xxh64_intdigest
        flat = [w for ws in self.words for w in ws]
        known = {w: digest(w) for w in set(flat)}
        self.hash = np.array([known[w] for w in flat], dtype=np.uint64)
        lengths = np.array([len(ws) for ws in self.words], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        self.doc = np.repeat(np.arange(len(texts)), lengths)
        n = len(flat)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.hash) * powers(BASE, n)[:n], dtype=np.uint64)])
        self.down = powers(INVERSE, n + 1)

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the words from start to end (exclusive), the same wherever they stand."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * GOLD)


@dataclass
class Level:
    name: np.ndarray   # symbol
    doc: np.ndarray
    low: np.ndarray    # context: words from low to high (exclusive); beyond the text if its end decided
    high: np.ndarray


def words_level(texts: Texts) -> Level:
    at = np.arange(len(texts.hash))
    return Level(mix(texts.hash + GOLD), texts.doc, at, at + 1)


def recompress(level: Level, texts: Texts) -> Level:
    """One round: runs, then pairs."""
    n = len(level.name)
    if not n:
        return level
    # Runs. That a run ends is decided by the symbols before and behind it.
    starts = np.ones(n, dtype=bool)
    starts[1:] = (level.name[1:] != level.name[:-1]) | (level.doc[1:] != level.doc[:-1])
    first = np.flatnonzero(starts)
    last = np.append(first[1:], n) - 1
    length = (last - first + 1).astype(np.uint64)
    name, doc = level.name[first], level.doc[first]
    name = np.where(length > 1, mix(name * GOLD + length), name)
    before, behind = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
    low = np.where((first > 0) & (level.doc[before] == doc), level.low[before], texts.first[doc] - 1)
    high = np.where((last < n - 1) & (level.doc[behind] == doc), level.high[behind], texts.first[doc + 1] + 1)
    # Pairs: a left symbol and the right symbol behind it.
    n = len(name)
    right = (mix(name + GOLD) >> np.uint64(40)) & np.uint64(1) == 1
    same = doc[1:] == doc[:-1]
    joins = np.zeros(n, dtype=bool)
    joins[:-1] = ~right[:-1] & right[1:] & same
    joined = np.zeros(n, dtype=bool)
    joined[1:] = joins[:-1]
    next_, before = np.minimum(np.arange(n) + 1, n - 1), np.maximum(np.arange(n) - 1, 0)
    has_next, has_before = np.append(same, False), np.append(False, same)
    # A symbol that stays single shows that its one possible partner is none.
    low_ = np.where(right, np.where(has_before, low[before], texts.first[doc] - 1), low)
    high_ = np.where(joins, high[next_], np.where(right, high, np.where(has_next, high[next_], texts.first[doc + 1] + 1)))
    name_ = np.where(joins, mix(name * GOLD + mix(name[next_])), name)
    keep = ~joined
    return Level(name_[keep], doc[keep], np.minimum(low_, low)[keep], np.maximum(high_, high)[keep])


def least_in(rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the smallest rank, the leftmost of equal ones, in each non-empty range from low to high (exclusive)."""
    size = high - low
    steps = int(size.max()).bit_length()
    place = np.arange(len(rank))
    out = np.empty(len(low), dtype=np.int64)
    power = np.frexp(size.astype(np.float64))[1] - 1
    for k in range(steps):
        use = power == k
        a, b = place[low[use]], place[high[use] - (1 << k)]
        out[use] = np.where(rank[a] <= rank[b], a, b)
        other = place[np.minimum(np.arange(len(rank)) + (1 << k), len(rank) - 1)]
        place = np.where(rank[place] <= rank[other], place, other)
    return out


def spans(texts: Texts, config: RepeatConfig) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, anchor, span) of each stretch of windows with one anchor; places within the document."""
    size = config.window
    lengths = np.diff(texts.first)
    n_windows = np.maximum(lengths - size + 1, 0)
    total = int(n_windows.sum())
    if not total:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    doc = np.repeat(np.arange(len(lengths)), n_windows)
    start = texts.first[doc] + np.arange(total) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    levels = [words_level(texts)]
    for _ in range(config.rounds):
        levels.append(recompress(levels[-1], texts))
    low_of, high_of = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64)
    height = np.zeros(total, dtype=np.int64)
    open_ = np.ones(total, dtype=bool)
    for k in range(config.rounds, -1, -1):
        level = levels[k]
        low = np.searchsorted(level.low, start)
        high = np.searchsorted(level.high, start + size, side="right")
        use = np.flatnonzero(open_ & (high > low))
        if len(use):
            at = least_in(mix(level.name), low[use], high[use])
            low_of[use], high_of[use], height[use] = level.low[at], level.high[at], k
            open_[use] = False
    new = np.ones(total, dtype=bool)
    new[1:] = ((low_of[1:] != low_of[:-1]) | (high_of[1:] != high_of[:-1]) | (height[1:] != height[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, total))
    anchor = mix(texts.range_hash(low_of[first], high_of[first]) + height[first].astype(np.uint64))
    span = texts.range_hash(start[first], start[first] + count - 1 + size)
    return doc[first], start[first] - texts.first[doc[first]], count, anchor, span


def remove(words: list[bytes], starts: np.ndarray, size: int) -> tuple[int, str]:
    """Words that windows at ``starts`` cover, and the SHA-256 of the others, joined by single spaces."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    gone = np.cumsum(change[:-1]) > 0
    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if len(starts) else b" ".join(words)
    return int(gone.sum()), hashlib.sha256(kept).hexdigest()


def expand(ranges: list[tuple[int, int]]) -> np.ndarray:
    return np.concatenate([np.arange(a, a + n) for a, n in ranges]) if ranges else np.zeros(0, dtype=np.int64)


ROW = "id long, digest long"  # an id that repeats with another text is another document


def repeats(documents: DataFrame, config: RepeatConfig = RepeatConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row.

    Defined results: null and empty texts have no words; a text shorter than a
    window keeps all; rows that repeat a text repeat all its windows, so all of
    them lose them; an empty table gives an empty result; other columns are not
    looked at.
    """
    size = config.window
    rows = documents.select(F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(raw(text)).alias("digest"),
                            F.col(key).cast("long").alias("doc_id"), raw(text).alias("body"))

    def anchors(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, first, count, anchor, span = spans(Texts(batch.column(2).to_pylist()), config)
        take = pa.array(doc)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(np.int64)), pa.array(span.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take),
             pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
            names=["anchor", "span", "id", "digest", "start", "n"])

    found = materialise(map_slices(rows.select("id", "digest", "body"), anchors,
                                   f"anchor long, span long, {ROW}, start int, n int", "body"), "anchors")
    shared = (found.groupBy("anchor").agg(F.count("*").alias("c"), F.min("span").alias("lo"), F.max("span").alias("hi"))
              .where("c > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")))
    hits = materialise(found.join(shared, "anchor"), "shared-anchors")
    whole = hits.where("not mixed").select("id", "digest", "start", "n", F.lit(True).alias("sure"), F.lit(False).alias("gives"),
                                           F.lit(0).cast("long").alias("anchor"))
    mixed = hits.where("mixed").drop("mixed")
    place = F.struct("id", "digest", "start")
    equal = mixed.groupBy("anchor", "span").agg(F.count("*").alias("c"), F.min(place).alias("one"))
    parted = mixed.join(equal, ["anchor", "span"]).select(
        "id", "digest", "start", "n", (F.col("c") > 1).alias("sure"), (F.col("one") == place).alias("gives"), "anchor")
    by_doc = (whole.unionByName(parted.where("sure or gives")).groupBy("id", "digest")
              .agg(F.collect_set(F.struct("start", "n", "sure", "gives", "anchor")).alias("ranges")))
    with_ranges = rows.join(by_doc, ["id", "digest"], "left").select("id", "digest", "doc_id", "ranges", "body")

    item = pa.struct([("start", pa.int32()), ("n", pa.int32())])
    window = pa.struct([("anchor", pa.int64()), ("hash", pa.int64()), ("start", pa.int32()), ("open", pa.bool_())])

    def first_verdict(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, shas, bodies, sure_, windows = [], [], [], [], [], []
        for body, ranges in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words, ranges = body.split(), ranges or []
            sure = sorted((r["start"], r["n"]) for r in ranges if r["sure"])
            asked = sorted((r["start"], r["n"], r["anchor"], r["sure"]) for r in ranges if r["gives"])
            given, own = [], Texts([body]) if asked else None
            for a, n, anchor, known in asked:
                at = np.arange(a, a + n)
                given += [{"anchor": anchor, "hash": h, "start": s, "open": not known}
                          for h, s in zip(own.range_hash(at, at + size).view(np.int64).tolist(), range(a, a + n), strict=True)]
            windows.append(given)
            sizes.append(len(words))
            if all(known for *_, known in asked):
                gone, sha = remove(words, expand(sure), size)
                removed.append(gone), shas.append(sha), bodies.append(None), sure_.append(None)
            else:
                removed.append(None), shas.append(None), bodies.append(body)
                sure_.append([{"start": a, "n": n} for a, n in sure])
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
             pa.array(bodies, pa.binary()), pa.array(sure_, pa.list_(item)), pa.array(windows, pa.list_(window))],
            names=["id", "digest", "doc_id", "n_words", "n_removed", "kept_sha256", "body", "sure", "windows"])

    verdicts = materialise(map_slices(
        with_ranges, first_verdict,
        f"{ROW}, doc_id long, n_words long, n_removed long, kept_sha256 string, body binary, "
        "sure array<struct<start:int,n:int>>, windows array<struct<anchor:long,hash:long,start:int,open:boolean>>",
        "body"), "first-verdicts")
    # Rows that repeat an id and its text ask about the same windows once.
    single = verdicts.select("id", "digest", F.explode("windows").alias("w")).select("id", "digest", "w.*").distinct()
    twice = single.groupBy("anchor", "hash").agg(F.count("*").alias("c")).where("c > 1").select("anchor", "hash")
    late = (single.where("open").join(twice, ["anchor", "hash"]).groupBy("id", "digest")
            .agg(F.collect_set("start").alias("late")))
    waiting = (verdicts.where("body is not null").select("id", "digest", "doc_id", "n_words", "sure", "body")
               .join(late, ["id", "digest"], "left").select("doc_id", "n_words", "sure", "late", "body"))

    def last_verdict(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, shas = [], []
        for sure, more, body in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)], strict=True):
            starts = np.concatenate([expand([(r["start"], r["n"]) for r in sure]), np.array(more or [], dtype=np.int64)])
            gone, sha = remove(body.split(), starts, size)
            removed.append(gone), shas.append(sha)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                                          names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    done = verdicts.where("body is null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.unionByName(map_slices(waiting, last_verdict, schema, "body"))


QUERY_CONFIG = RepeatConfig(window=35)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all documents without the words of repeated windows of 35 words."""
    return repeats(table(spark, sf_dir, "documents"), QUERY_CONFIG)


#: Sorting out by windows of hashes of whole windows; one row per document.
ORACLE = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
    SELECT doc_id, p, md5(array_to_string(ws[p : p + 34], ' ')) AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM d WHERE len(ws) >= 35)),
r AS (
    SELECT doc_id, list(DISTINCT p + k) AS gone
    FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY gram) AS c FROM g), range(35) AS t(k)
    WHERE c > 1 GROUP BY doc_id),
k AS (
    SELECT x.doc_id, array_to_string(list(w ORDER BY p), ' ') AS kept
    FROM (SELECT d.doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d) AS x
    LEFT JOIN (SELECT doc_id, unnest(gone) AS q FROM r) AS y ON x.doc_id = y.doc_id AND x.p = y.q
    WHERE y.q IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""
