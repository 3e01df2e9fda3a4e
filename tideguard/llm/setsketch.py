"""MinHash near-duplicate detection with SetSketch registers.

A document's set (its distinct word shingles, as 64-bit hashes) is sketched by
``m`` registers. Register j is the truncated exponent, to base ``base``, of the
smallest exponentially distributed hash of the set: exponentially spaced
truncated minima. Sketches of two sets merge by a maximum. The steps:

1. Sketch every document in one pass. Documents with the same set share a
   128-bit fingerprint; one of them (the smallest id) stands for all.
2. Band the registers. Of the documents that share a band, all are paired with
   one of them (the centre, at first the smallest id): pairs grow with the number
   of documents, not with the square of a group.
3. A pair stays if its sizes allow the similarity and the joint likelihood
   estimate from both sketches does not rule it out (six standard errors away).
4. Pairs are verified on the full sets: the text of the documents that can be in
   pairs is set aside once, then brought together pair by pair in a stream.
5. Verified links are contracted to components. Where a band still holds several
   components, the next round takes another centre in each band, by a hash of id
   and band, and pairs it with the members of other components (3. and 4. apply).
   A round that finds no link is the last one.

6. Members of bands that hold several components after the last round go to an
   exact join: sets that reach the threshold share a shingle of their prefixes in
   any common order (here the rarest first), at places that the sizes bound. Its
   pairs of different components pass 3. and 4. and complete the components.

Chance that two documents at exactly the threshold 0.8 share none of 48 bands of
7: (1 - 0.8**7)**48 = 1e-5; they share ten on average.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import map_slices, mix, raw, table
from tideguard.session import materialise, store

#: Bytes that a file of a stored table holds about.
FILE_BYTES = 1 << 22


@dataclass(frozen=True)
class SketchConfig:
    shingle: int = 5       #: words of a shingle
    percent: int = 80      #: link if 100 * intersection >= percent * union
    bands: int = 48
    rows: int = 7          #: registers of a band
    rounds: int = 4        #: centres that each band gets in turn, at most
    base: float = 1.001    #: of the exponents
    rate: float = 20.0     #: of the exponential distribution
    limit: int = 65_534    #: largest exponent
    seed: int = 11
    salt: int = 512        #: rows of a side of the exact join that come together under a shingle

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def files(rows: int, width: int) -> int:
    """How many files ``rows`` rows of ``width`` bytes fill.

    A stored table of few rows gets few files, whatever the number of shuffle
    partitions is: making a file takes longer than its rows do.
    """
    return max(1, -(-rows * width // FILE_BYTES))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z in lower case; words are cut at ASCII white space."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in text.lower().split()], dtype=np.uint64)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, one without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < size:
        total = np.array([len(words)], dtype=np.uint64)
        for h in words:
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + h)
        return total
    total = words[: len(words) - size + 1].copy()
    for j in range(1, size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[j: len(words) - size + 1 + j])
    return np.unique(total)


def multipliers(config: SketchConfig) -> np.ndarray:
    return np.random.default_rng(config.seed).integers(0, 1 << 31, config.registers, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def exponents(smallest: np.ndarray, config: SketchConfig) -> np.ndarray:
    """Registers from the smallest 32-bit hash: clamp(floor(1 - log_base(exponential)), 0, limit)."""
    uniform = (smallest.astype(np.float64) + 0.5) / 4294967296.0
    exponential = -np.log1p(-uniform) / config.rate
    k = np.floor(1 - np.log(exponential) / math.log(config.base))
    return np.clip(k, 0, config.limit).astype(np.uint16)


def registers_of(members: np.ndarray, factors: np.ndarray, config: SketchConfig) -> np.ndarray:
    """Sketch of one set of 64-bit hashes; 0 everywhere for an empty set."""
    if not len(members):
        return np.zeros(config.registers, dtype=np.uint16)
    low = (mix(members) >> np.uint64(32)).astype(np.uint32)
    smallest = None
    for a in range(0, len(low), 512):  # stays in the cache
        part = low[a: a + 512, None] * factors[None, :]
        part ^= part >> np.uint32(16)
        part *= np.uint32(0x85EBCA6B)
        part = part.min(axis=0)
        smallest = part if smallest is None else np.minimum(smallest, part)
    return exponents(smallest, config)


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(one, other)


def estimate(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray,
             config: SketchConfig, steps: int = 101) -> np.ndarray:
    """Joint maximum likelihood of the Jaccard similarity of pairs of sketches, sizes known.

    With u and v the shares of the sizes in their sum, a register of the first
    set is larger with probability p(u - v*J), smaller with p(v - u*J), where
    p(x) = -log_base(1 - x * (base - 1) / base); the likelihood of the three
    counts is maximised over J.
    """
    more, less = (one > other).sum(axis=1), (one < other).sum(axis=1)
    same = one.shape[1] - more - less
    u = (n_one / (n_one + n_other))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    j = top * np.linspace(0, 1, steps)[None, :]
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (config.base - 1) / config.base) / math.log(config.base)
    a, b = np.clip(p(u - v * j), 1e-12, 1), np.clip(p(v - u * j), 1e-12, 1)
    c = np.clip(1 - a - b, 1e-12, 1)
    fit = more[:, None] * np.log(a) + less[:, None] * np.log(b) + same[:, None] * np.log(c)
    return np.take_along_axis(j, fit.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketches(documents: DataFrame, config: SketchConfig, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, f1, f2, registers): set size, 128-bit fingerprint of the set and its sketch."""
    factors = multipliers(config)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, f1, f2, found = [], [], [], []
        for body in batch.column(1).to_pylist():
            members = shingle_set(body, config.shingle)
            sizes.append(len(members))
            f1.append(int(np.add.reduce(mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5)))) - (1 << 63))
            f2.append(int(np.add.reduce(mix(members + np.uint64(0x9E3779B97F4A7C15)))) - (1 << 63))
            found.append(registers_of(members, factors, config).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
             pa.array(found, pa.binary())], names=["doc_id", "n_shingles", "f1", "f2", "registers"])

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), raw(text).alias("body"))
    return map_slices(rows, work, "doc_id long, n_shingles long, f1 long, f2 long, registers binary", "body")


def banded(classes: DataFrame, config: SketchConfig) -> DataFrame:
    """(band, code, rep, n): a row for each class of equal sets and each band of its sketch."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(batch)
        flat = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint16).reshape(n, config.bands, config.rows)
        code = np.zeros((n, config.bands), dtype=np.uint64)
        for j in range(config.rows):
            code = mix(code * np.uint64(0x9E3779B97F4A7C15) + flat[:, :, j].astype(np.uint64) + np.uint64(1))
        band = np.tile(np.arange(config.bands, dtype=np.int32), n)
        return pa.RecordBatch.from_arrays(
            [pa.array(band), pa.array(code.reshape(-1).view(np.int64)),
             pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), config.bands)),
             pa.array(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), config.bands))],
            names=["band", "code", "rep", "n"])

    return map_slices(classes.select("rep", "n", "registers"), work,
                      "band int, code long, rep long, n long", "registers")


def likely(pairs: DataFrame, classes: DataFrame, config: SketchConfig) -> DataFrame:
    """Of the pairs (a, b) those that the sketches do not rule out."""
    share = config.percent / 100
    least = share - 6 * math.sqrt(max(share * (1 - share), 0.01) / config.registers)
    of = classes.select("rep", "n", "registers")
    both = (pairs.join(of.toDF("a", "n_a", "s_a"), "a").join(of.toDF("b", "n_b", "s_b"), "b")
            .select("a", "b", "n_a", "n_b", "s_a", "s_b"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        one, other = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint16).reshape(len(batch), -1) for i in (4, 5))
        n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (2, 3))
        keep = pa.array(estimate(one, other, n_a, n_b, config) >= least)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return map_slices(both, work, "a long, b long", "s_a")


def verified(pairs: DataFrame, texts: DataFrame, config: SketchConfig) -> DataFrame:
    """(a, b, common, total) of the pairs whose full sets reach the threshold.

    Rows stream through tasks sorted by (a, salt): first the text of ``a``, then
    its partners. A task holds one set and one slice of texts, and an ``a`` with
    many partners is salted by their number, 256 partners to a salt.
    """
    degree = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    salted = (pairs.join(degree, "a")
              .withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / 256))))
    needs = (salted.select(F.col("b").alias("rep"), "a", "salt", F.lit(1).alias("role"))
             .unionByName(salted.select(F.col("a").alias("rep"), "a", "salt", F.lit(0).alias("role")).distinct()))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (needs.join(texts, "rep").select("a", "salt", "role", "rep", "body")
            .repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "role", "rep"))

    def run(batches):
        centre, members = None, []
        for batch in batches:
            a, b, common, total = [], [], [], []
            for first, role, rep, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                              batch.column(3).to_pylist(), batch.column(4), strict=True):
                own = shingle_set(body.as_py(), config.shingle)
                if role == 0:
                    if centre != first:
                        centre, members = first, []
                    if not any(np.array_equal(own, x) for x in members):  # an id may repeat with other texts
                        members.append(own)
                    continue
                for other in members:
                    both = len(np.intersect1d(other, own, assume_unique=True))
                    union = len(other) + len(own) - both
                    if 100 * both >= config.percent * union:
                        a.append(first), b.append(rep), common.append(both), total.append(union)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, common, total)],
                                             names=["a", "b", "common", "total"])

    return (rows.mapInArrow(run, "a long, b long, common long, total long")
            .groupBy("a", "b").agg(F.max(F.struct("common", "total")).alias("s")).select("a", "b", "s.*"))


def components(links: DataFrame) -> DataFrame:
    """(rep, component): the smallest id that links reach, for every id in ``links`` (columns a, b; a stored table).

    Alternates large-star and small-star steps over stored tables until the
    links are stars; the steps grow with the logarithm of the longest chain.
    Components found before can be among the links, as stars.
    """
    edges = links.select(F.col("a").alias("v"), F.col("b").alias("u"))
    into, stored = files(edges.count(), 16), None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select("v", F.col("m").alias("u")).where("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = (small.select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v")
                 .unionByName(least.select("v", F.col("m").alias("u"))).distinct())
        after = store(small.coalesce(into), "links")
        if stored is not None:
            stored.discard()
        stored, edges = after, after.df
        # Stars: an id is linked to one smaller id, and then no larger id to it.
        ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
            edges.select(F.col("u").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        ends = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        if not ends.where("below > 1 or below = 1 and above = 1").agg(F.count("*")).first()[0]:
            break
    return edges.select(F.col("v").alias("rep"), F.col("u").alias("component"))


def extended(components_of: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components (rep, component) after further links; found links need not be looked at again."""
    if components_of is None:
        return components(links)
    if links.isEmpty():
        return components_of
    return components(links.select("a", "b").unionByName(components_of.toDF("a", "b")))


def prefixes(members: DataFrame, texts: DataFrame, config: SketchConfig) -> DataFrame:
    """(token, rep, component, n, place, short): the shingles by which sets that reach the threshold must meet.

    Sets are ordered by how often a shingle's bucket (of 65,536) occurs, then by
    the shingle, so hot shingles come last; any common order is exact. A partner
    at least as large is met within the ``short`` prefix, any other one within
    the whole.
    """
    rows = texts.join(members, "rep").select("rep", "component", "body")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(body, config.shingle) for body in batch.column(2).to_pylist()]
        bucket, n = np.unique(np.concatenate(sets) >> np.uint64(48), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(n.astype(np.int64))], names=["bucket", "n"])

    often = np.zeros(1 << 16, dtype=np.int64)
    for r in map_slices(rows, count, "bucket int, n long", "body").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        often[r["bucket"]] = r["n"]
    shared = texts.sparkSession.sparkContext.broadcast(often)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], [], [], [], []]
        for rep, component, body in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            own = shingle_set(body, config.shingle)
            n = len(own)
            if not n:
                continue
            whole = n + (-config.percent * n) // 100 + 1
            short = n + (-2 * config.percent * n) // (100 + config.percent) + 1
            first = own[np.lexsort((own, shared.value[own >> np.uint64(48)]))[:whole]]
            place = np.arange(whole, dtype=np.int32)
            for column, x in zip(out, (first.view(np.int64), np.full(whole, rep), np.full(whole, component), np.full(whole, n),
                                       place, place < short), strict=True):
                column.append(x)
        names = ["token", "rep", "component", "n", "place", "short"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], k) for c, k in zip(out, kinds, strict=True)], names=names)

    return map_slices(rows, work, "token long, rep long, component long, n long, place int, short boolean", "body")


def exact_pairs(members: DataFrame, texts: DataFrame, config: SketchConfig) -> DataFrame:
    """(a, b): all pairs of ``members`` (rep, component) in different components whose sets can reach the threshold.

    Both sides of a hot shingle are salted, so that no task reads them whole.
    """
    rows = materialise(prefixes(members, texts, config), "prefixes")
    met = (rows.groupBy("token").agg(F.count("*").alias("of_all"), F.count_if("short").alias("of_short"),
                                     F.min("component").alias("lo"), F.max("component").alias("hi"))
           .where("of_short > 0 and lo < hi")
           .select("token", F.ceil(F.col("of_all") / config.salt).cast("int").alias("all_salts"),
                   F.ceil(F.col("of_short") / config.salt).cast("int").alias("short_salts")))
    rows = rows.join(met, "token")
    mine = lambda salts: F.pmod(F.xxhash64("rep"), F.col(salts)).cast("int")
    every = lambda salts: F.explode(F.sequence(F.lit(0), F.col(salts) - 1))
    large = rows.select("token", mine("all_salts").alias("i"), every("short_salts").alias("j"), F.struct("n", "rep").alias("x"), "component", "place")
    small = rows.where("short").select(
        F.col("token").alias("t"), every("all_salts").alias("k"), mine("short_salts").alias("l"),
        F.struct("n", "rep").alias("y"), F.col("component").alias("c"), F.col("place").alias("at"))
    both = F.ceil(config.percent * (F.col("x.n") + F.col("y.n")) / (100 + config.percent) - 1e-6)  # least intersection
    near = ((F.col("token") == F.col("t")) & (F.col("i") == F.col("k")) & (F.col("j") == F.col("l"))
            & (F.col("component") != F.col("c")) & (F.col("y") < F.col("x")) & (F.col("x.n") * config.percent <= F.col("y.n") * 100)
            & (F.col("place") + both <= F.col("x.n")) & (F.col("at") + both <= F.col("y.n")))
    return large.join(small, near).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def near_duplicates(documents: DataFrame, config: SketchConfig = SketchConfig(),
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, links): one row per document.

    ``links`` counts the verified links of the document's class of equal sets to
    others: not all it has, as members of one component are not all compared. ``kept`` is true for the smallest id of a component.

    Defined results: null and empty texts and texts without words have size 0,
    no links and are kept; a null id is never linked and is kept, with a null
    component; rows that repeat an id are judged row by row, and equal rows get
    equal results; other columns are not looked at.
    """
    found = materialise(sketches(documents, config, key, text), "sketches")
    rows, shingles = found.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    usable = found.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialise(usable.groupBy("f1", "f2", F.col("n_shingles").alias("n"))
                          .agg(F.min("doc_id").alias("rep"), F.min("registers").alias("registers"))
                          .coalesce(files(rows, 2 * config.registers + 32)), "classes")
    bands = banded(classes, config)
    size = bands.groupBy("band", "code").agg(F.count("*").alias("size")).where("size > 1")
    # Members of bands with more than one class; stored, as every round reads them.
    shared = materialise(bands.join(size, ["band", "code"]).coalesce(files(classes.count() * config.bands, 36)), "shared")
    into = files(shared.count(), 16)
    links = components_of = texts = tried = None
    for k in range(config.rounds):
        members = shared
        if k == 0:
            members = members.withColumn("component", F.col("rep"))
        else:
            members = (members.where("size > 2").join(components_of, "rep", "left")
                       .withColumn("component", F.coalesce("component", "rep")))
        turn = F.col("rep") if k == 0 else F.xxhash64("rep", "band", F.lit(k))
        centres = (members.groupBy("band", "code")
                   .agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                        F.min(F.struct(turn.alias("turn"), F.col("rep"), F.col("n"), F.col("component"))).alias("c"))
                   .where("lo < hi").select("band", "code", "c"))
        near = ((F.col("n") * config.percent <= F.col("c.n") * 100) & (F.col("c.n") * config.percent <= F.col("n") * 100)
                & (F.col("component") != F.col("c.component")))
        pairs = (members.join(centres, ["band", "code"]).where(near)
                 .select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs.coalesce(into), "tried")
        tried = pairs if tried is None else tried.unionByName(pairs)
        pairs = materialise(likely(pairs, classes, config).repartition(files(pairs.count(), 16)), "pairs")
        if texts is None:
            wanted = (pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
                      .unionByName(shared.where("size > 2").select("rep")).distinct())
            texts = materialise(documents.select(F.col(key).cast("long").alias("rep"), raw(text).alias("body"))
                                .join(wanted, "rep", "left_semi").coalesce(files(shingles, 8)), "texts")
        good = materialise(verified(pairs, texts, config).coalesce(files(pairs.count(), 32)), "links")
        links = good if links is None else links.unionByName(good)
        components_of = extended(components_of, good)
        if good.isEmpty():  # the exact join does the rest
            break
    members = (shared.where("size > 2").join(components_of, "rep", "left")
               .withColumn("component", F.coalesce("component", "rep")))
    mixed = members.groupBy("band", "code").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    left = materialise(members.join(mixed, ["band", "code"], "left_semi").select("rep", "component").distinct().coalesce(into), "left")
    if not left.isEmpty():
        pairs = materialise(exact_pairs(left, texts, config).join(tried, ["a", "b"], "left_anti"), "tried")
        pairs = materialise(likely(pairs, classes, config).repartition(files(pairs.count(), 16)), "pairs")
        good = materialise(verified(pairs, texts, config).coalesce(files(pairs.count(), 32)), "links")
        links = links.unionByName(good)
        components_of = extended(components_of, good)
    degree = (links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep")))
              .groupBy("rep").agg(F.count("*").alias("links")))
    of_class = (classes.select("f1", "f2", F.col("n").alias("n_shingles"), "rep")
                .join(components_of, "rep", "left").join(degree, "rep", "left"))
    return (found.drop("registers").join(of_class, ["f1", "f2", "n_shingles"], "left").coalesce(files(rows, 48))
            .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"),
                    F.coalesce("links", F.lit(0)).alias("links"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


QUERY_CONFIG = SketchConfig(shingle=2)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: near-duplicates of all documents by two-word shingles."""
    return (near_duplicates(table(spark, sf_dir, "documents"), QUERY_CONFIG)
            .select("doc_id", "n_shingles", "component_id", "kept", "links"))
