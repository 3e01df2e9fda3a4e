"""Periodic runs in texts, found on a grammar of their words.

A run is a stretch of consecutive words with smallest period q that is at least
``ratio`` periods and at least ``least`` words long and that no neighbouring word
extends with period q. Texts are handled in slices inside tasks, each text whole.

1. In a run each short stretch of words comes again a period further on or back, so
   words between stretches that do not recur near by are in no run and end a
   segment. Only segments go on (mostly few words; a periodic text as a whole).
2. Re-Pair: in each round every pair of neighbouring symbols that recurs, and is more
   frequent than the pairs it overlaps, becomes a nonterminal. What is left when no
   pair recurs is joined pairwise, so a segment is one tree.
3. Each nonterminal is looked at once, at one of its occurrences: which runs within
   it cross the boundary between its two parts? A run reaches far to the left or to
   the right of the boundary, so the short stretch of words at the boundary comes
   again a period away: those places give the periods to try, and the longest common
   extensions of the two places, by prefix hashes, give the run.
4. The tree translates these runs to all positions of the nonterminal. Intervals of a
   period that overlap by a period are one run. Of equal intervals the smallest
   period stays. Every run found is checked word by word.

A run lies whole in the lowest node that holds it and crosses its boundary, so all
are found, and what a node cuts off is part of a longer interval found above it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import map_slices, mix, raw, table


@dataclass(frozen=True)
class RunConfig:
    least: int = 24   #: words of a run, at least
    ratio: int = 3    #: periods of a run, at least; below 3 a run need not show at a boundary as described above
    chunk: int = 1 << 20  #: candidates handled together

    def __post_init__(self) -> None:
        if self.ratio < 3 or self.least < 2 * self.ratio:
            raise ValueError("ratio from 3 and least from 2 * ratio")


#: Primes and bases of the prefix hashes.
_PRIMES = (2_147_483_647, 2_147_483_629)
_BASES = (1_103_515_245, 1_289_706_101)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def grams(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the stretches of ``size`` words within one owner, and 64-bit keys of (stretch, owner)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    mixed, key = mix(words.astype(np.uint64) + np.uint64(1)), owner[:n].astype(np.uint64)
    for j in range(size):
        key = key * _MULTIPLY + mixed[j: j + n]
    starts = np.flatnonzero(owner[:n] == owner[size - 1:])
    return starts, mix(key[starts])


def recurring(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    low = keys[order]
    same = low[1:] == low[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def segments(words: np.ndarray, owner: np.ndarray, config: RunConfig) -> list[tuple[int, int]]:
    """(start, end) of the stretches that can hold runs; every run lies in one of them."""
    size = config.least // config.ratio
    where = np.arange(len(words))
    while True:
        starts, keys = grams(words, owner, size)
        again = recurring(keys)
        starts = starts[again]
        if not len(starts):
            return []
        first = np.ones(len(starts), bool)
        first[1:] = (np.diff(where[starts]) != 1) | (np.diff(owner[starts]) != 0)
        begin = np.flatnonzero(first)
        a = starts[begin]
        b = starts[np.append(begin[1:], len(starts)) - 1] + size
        long = b - a >= config.least
        a, b = a[long], b[long]
        if not len(a):
            return []
        total = int((b - a).sum())
        if total == len(words):
            return list(zip(where[a].tolist(), (where[b - 1] + 1).tolist(), strict=True))
        keep = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)])
        words, where = words[keep], where[keep]
        owner = np.repeat(np.arange(len(a)), b - a)


@dataclass
class Grammar:
    """Nonterminal ``base + i`` is ``left[i] right[i]``, made in round ``made[i]``; ``at`` is one of its occurrences."""

    base: int
    left: np.ndarray
    right: np.ndarray
    made: np.ndarray
    size: np.ndarray   #: words of each symbol, terminals first
    at: np.ndarray     #: of the nonterminals
    roots: np.ndarray  #: the symbol of each segment
    starts: np.ndarray  #: and its place


def _chosen(pair: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Places whose pair recurs and outranks the pairs it overlaps; of overlapping equal pairs every other one."""
    _, inverse, count = np.unique(pair[joined], return_inverse=True, return_counts=True)
    rank = np.zeros(len(pair), np.uint64)
    # The more frequent first, by powers of two; among those by a hash, so that rounds are few.
    worth = (np.floor(np.log2(count)).astype(np.uint64) << np.uint64(57)) | (mix(np.unique(pair[joined]).astype(np.uint64)) >> np.uint64(7))
    worth[count < 2] = 0
    rank[joined] = worth[inverse]
    new = np.ones(len(pair), bool)
    new[1:] = (rank[1:] != rank[:-1]) | (rank[1:] == 0)
    begin = np.flatnonzero(new)
    high = rank[begin]
    edge = np.zeros(1, np.uint64)
    best = (high > np.concatenate([edge, high[:-1]])) & (high > np.concatenate([high[1:], edge]))
    of = np.cumsum(new) - 1
    return best[of] & ((np.arange(len(pair)) - begin[of]) % 2 == 0)


def repair(words: np.ndarray, owner: np.ndarray) -> Grammar:
    """The grammar of the segments in ``words`` (ids from 0), each with an ``owner`` of its own."""
    base = int(words.max()) + 1
    symbol, place, own = words.astype(np.int64), np.arange(len(words)), owner
    size, left, right, made, at = [np.ones(base, np.int64)], [], [], [], []
    total, turn, recur = base, 0, True
    while len(symbol) > 1:
        joined = own[1:] == own[:-1]
        if not joined.any():
            break
        turn += 1
        if recur:
            pair = symbol[:-1] * total + symbol[1:]
            take = _chosen(pair, joined)
            recur = bool(take.any())
            names, first, which = np.unique(pair[take], return_index=True, return_inverse=True)
        if not recur:  # nothing recurs any more: neighbours are joined two by two
            nth = np.arange(len(symbol)) - np.searchsorted(own, own)
            take = joined & (nth[:-1] % 2 == 0)
            first = which = np.arange(int(take.sum()))
        spots = np.flatnonzero(take)
        one, other = symbol[spots[first]], symbol[spots[first] + 1]
        sizes = np.concatenate(size)
        size = [sizes, sizes[one] + sizes[other]]
        left.append(one), right.append(other), made.append(np.full(len(one), turn)), at.append(place[spots[first]])
        symbol = symbol.copy()
        symbol[spots] = total + which
        total += len(one)
        keep = np.ones(len(symbol), bool)
        keep[spots + 1] = False
        symbol, place, own = symbol[keep], place[keep], own[keep]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Grammar(base, join(left), join(right), join(made), np.concatenate(size), join(at), symbol, place)


class Extensions:
    """Longest common extensions in ``words``, many at a time, by prefix hashes of two primes."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.powers, self.sums = [], []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            power = np.ones(n + 1, np.uint64)
            done, step = 1, base % prime
            while done <= n:  # powers[done + i] = powers[i] * base ** done
                more = min(done, n + 1 - done)
                power[done: done + more] = power[:more] * np.uint64(step) % np.uint64(prime)
                step = step * step % prime
                done += more
            value = (words.astype(np.uint64) + np.uint64(1)) * power[:n] % np.uint64(prime)
            self.powers.append(power)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)]))

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Do the stretches of ``length`` words at a and at b >= a agree?"""
        out = np.ones(len(a), bool)
        for prime, power, sums in zip(_PRIMES, self.powers, self.sums, strict=True):
            p = np.uint64(prime)
            one, other = (sums[a + length] - sums[a]) % p, (sums[b + length] - sums[b]) % p
            out &= one * power[b - a] % p == other
        return out

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words, up to ``most``, that agree from a and b onwards."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            good = self.same(a, b, mid)
            low, high = np.where(good, mid, low), np.where(good, high, mid - 1)
        return low

    def back(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words, up to ``most``, that agree before a and b."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            good = self.same(a - mid, b - mid, mid)
            low, high = np.where(good, mid, low), np.where(good, high, mid - 1)
        return low


def crossing(words: np.ndarray, owner: np.ndarray, grammar: Grammar, config: RunConfig) -> tuple[np.ndarray, ...]:
    """(nonterminal, start, end, period): runs within a nonterminal that cross its boundary, from its start."""
    n, size = len(words), config.least // (2 * config.ratio)
    whole = grammar.size[grammar.base:]
    wide = np.flatnonzero(whole >= config.least)
    lo = grammar.at[wide]
    middle, hi = lo + grammar.size[grammar.left[wide]], lo + whole[wide]
    starts, keys = grams(words, owner, size)
    name = np.full(n + 1, -1, np.int64)
    name[starts] = np.unique(keys, return_inverse=True)[1]
    listed = np.sort(name[starts] * (n + 1) + starts)   # all places of a stretch, in order
    extend = Extensions(words)
    found = [np.zeros((4, 0), np.int64)]
    for forward in (True, False):
        # A run with ratio * q words in all has, on one side, half of them: 1.5 q with a ratio of 3.
        here = middle if forward else np.maximum(middle - size, 0)
        room = hi - middle if forward else middle - lo
        at = np.flatnonzero((room >= size) & (name[here] >= 0))
        far = 2 * room[at] // config.ratio
        key = name[here[at]] * (n + 1)
        if forward:
            first = np.searchsorted(listed, key + here[at], side="right")
            last = np.searchsorted(listed, key + here[at] + far, side="right")
        else:
            first = np.searchsorted(listed, key + np.maximum(here[at] - far, 0), side="left")
            last = np.searchsorted(listed, key + here[at], side="left")
        count = np.maximum(last - first, 0)
        ends = np.cumsum(count)
        begin = 0
        while begin < len(at):  # as many boundaries as have config.chunk candidates, one at least
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + config.chunk, side="right")))
            c = count[begin:stop]
            x = np.repeat(at[begin:stop], c)
            nth = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            other = listed[np.repeat(first[begin:stop], c) + nth] - np.repeat(key[begin:stop], c)
            period = np.abs(other - here[x])
            a = middle[x] if forward else middle[x] - period
            good = (period > 0) & (a >= lo[x]) & (a + period <= hi[x]) & (hi[x] - lo[x] >= config.ratio * period)
            x, a, period = x[good], a[good], period[good]
            s = a - extend.back(a, a + period, a - lo[x])
            e = a + period + extend.ahead(a, a + period, hi[x] - a - period)
            good = e - s >= np.maximum(config.least, config.ratio * period)
            found.append(np.stack([wide[x[good]], s[good] - lo[x[good]], e[good] - lo[x[good]], period[good]]))
            begin = stop
    rows = np.concatenate(found, axis=1)
    node, s, e, period = rows[:, np.lexsort(rows[::-1])]
    first = np.ones(len(node), bool)  # of equal intervals the smallest period
    first[1:] = (node[1:] != node[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return node[first], s[first], e[first], period[first]


def translated(grammar: Grammar, node: np.ndarray, s: np.ndarray, e: np.ndarray, period: np.ndarray, config: RunConfig) -> np.ndarray:
    """Rows (start, end, period) of the runs of all occurrences of the nonterminals."""
    found = [np.zeros((3, 0), np.int64)]
    if not len(node):
        return found[0]
    rounds = int(grammar.made.max(initial=0))
    waiting: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(rounds + 1)]

    def wait(symbol: np.ndarray, place: np.ndarray) -> None:
        wide = (symbol >= grammar.base) & (grammar.size[symbol] >= config.least)
        symbol, place = symbol[wide], place[wide]
        made = grammar.made[symbol - grammar.base]
        order = np.argsort(made, kind="stable")
        cuts = np.flatnonzero(np.diff(made[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            waiting[made[part[0]]].append((symbol[part], place[part]))

    wait(grammar.roots, grammar.starts)
    for turn in range(rounds, 0, -1):
        if not waiting[turn]:
            continue
        symbol, place = (np.concatenate(x) for x in zip(*waiting[turn], strict=True))
        waiting[turn] = []
        i = symbol - grammar.base
        first, last = np.searchsorted(node, i), np.searchsorted(node, i, side="right")
        c = last - first
        own = np.repeat(first, c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        shift = np.repeat(place, c)
        found.append(np.stack([s[own] + shift, e[own] + shift, period[own]]))
        wait(grammar.left[i], place)
        wait(grammar.right[i], place + grammar.size[grammar.left[i]])
    return np.concatenate(found, axis=1)


def merged(words: np.ndarray, owner: np.ndarray, intervals: np.ndarray, config: RunConfig) -> list[tuple[int, int, int]]:
    """(start, end, period) of the maximal runs, each checked word by word."""
    if not intervals.shape[1]:
        return []
    start, end, period = intervals[:, np.lexsort((intervals[1], intervals[0], intervals[2]))]
    shift = np.unique(period, return_inverse=True)[1] * (len(words) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] + shift[1:] > reach[:-1] - period[1:])
    begin = np.flatnonzero(new)
    close = reach[np.append(begin[1:], len(start)) - 1] - shift[begin]
    least: dict[tuple[int, int], int] = {}
    for a, b, q in zip(start[begin].tolist(), close.tolist(), period[begin].tolist(), strict=True):
        for x, y in exact(words, owner, a, b, q, config):
            least[x, y] = min(q, least.get((x, y), q))
    return sorted((x, y, q) for (x, y), q in least.items())


def exact(words: np.ndarray, owner: np.ndarray, a: int, b: int, q: int, config: RunConfig) -> list[tuple[int, int]]:
    """The interval itself, if its words have the period; else (two hashes collided) the runs of the period in its segment."""
    if np.array_equal(words[a: b - q], words[a + q: b]):
        return [(a, b)]
    lo, hi = np.searchsorted(owner, owner[a]), np.searchsorted(owner, owner[a], side="right")
    same = np.concatenate([[False], words[lo: hi - q] == words[lo + q: hi], [False]])
    ends = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
    return [(int(lo + x), int(lo + y + q)) for x, y in ends if y - x + q >= max(config.least, config.ratio * q)]


def runs_of(texts: list[list[bytes]], config: RunConfig = RunConfig()) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text (its words), by start, then period."""
    ids: dict[bytes, int] = {}
    name = ids.setdefault
    flat = np.array([name(w, len(ids)) for words in texts for w in words], dtype=np.int64)
    lengths = np.array([len(words) for words in texts], dtype=np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    parts = segments(flat, np.repeat(np.arange(len(texts)), lengths), config)
    if not parts:
        return out
    words = np.concatenate([flat[a:b] for a, b in parts])
    words = np.unique(words, return_inverse=True)[1]
    sizes = np.array([b - a for a, b in parts])
    owner, offset = np.repeat(np.arange(len(parts)), sizes), np.cumsum(sizes) - sizes
    grammar = repair(words, owner)
    places = translated(grammar, *crossing(words, owner, grammar, config), config)
    bounds = np.cumsum(lengths)
    for start, end, period in merged(words, owner, places, config):
        part = owner[start]
        at = parts[part][0] + start - int(offset[part])
        text = int(np.searchsorted(bounds, at, side="right"))
        out[text].append((at - int(bounds[text] - lengths[text]), end - start, period))
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those behind the first period of a run that holds them."""
    if not found:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)


SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def periodic_runs(documents: DataFrame, config: RunConfig = RunConfig(), key: str = "doc_id", text: str = "text",
                  prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row per document, with its runs and its text without repetitions.

    Words are cut at ASCII white space. ``prepare`` may change the words of a text first.

    Defined results: null and empty texts have no words, no runs and an empty
    ``collapsed``; a null id is a document like others; rows that repeat are each
    judged alone, and equal rows get equal results; other columns are not looked at.
    """
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [body.split() for body in batch.column(1).to_pylist()]
        if prepare is not None:
            texts = [prepare(i, words) for i, words in zip(batch.column(0).to_pylist(), texts, strict=True)]
        found = runs_of(texts, config)
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in found]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(runs, pairs),
             pa.array([collapse(w, own) for w, own in zip(texts, found, strict=True)], pa.binary())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    return map_slices(documents.select(F.col(key).cast("long").alias("doc_id"), raw(text).alias("body")), work, SCHEMA, "body")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's texts: a tenth of the ids become periodic from some word on."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head, unit = words[:a], words[a: a + p]
    return head + (unit * ((n - a) // len(unit) + 1))[: n - a]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the runs of all documents as the contract plants them, and digests of runs and collapsed texts."""
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=planted)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))

    # The greater quotient of two whole numbers without rounding: products of word counts stay far below 2**63.
    def better(best, r):
        one, other = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (one > other), r).otherwise(best)  # runs come by start, then period

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), better)
    return (found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
            .select("doc_id", "n_words", "n_runs", "b.start", "b.length", "b.period",
                    F.expr("1000 * b.length div b.period").alias("exponent_milli"),
                    F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
