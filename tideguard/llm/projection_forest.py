"""Near-duplicate vectors by a forest of random projection trees with overlapping splits.

1. Rows with the same vector are one class; what follows works on classes.
2. Each tree splits its nodes by a random direction (one a level and tree) about the
   median; a share of a node on both sides of the median goes both ways (spill). The
   upper splits are fitted on a bounded sample. Every class is placed in all trees in
   one pass. Leaves that are still too large are split further in rounds, by quantiles
   that Spark aggregates, until no leaf holds more than ``leaf`` classes.
3. Dense groups: classes within half the angle of the threshold from a centre are
   linked with each other for certain, however many they are. Such balls need no pairs.
   Their centres are looked for in the sample.
4. A task compares all classes of a leaf, counts the links of each and joins the linked
   ones to their smallest: no pair leaves the task. A pair that shares several leaves
   (or a ball) counts in the first of them only, as each class brings the list of its
   earlier leaves along.
5. Links join to components.

A link is missed if no tree has a leaf with both ends. Two vectors at exactly cosine
0.9 stay together on a level with chance .93 (64 dimensions, spill .05); over eight
trees of eight levels all but a thousandth of such links are found, with twenty levels
(10**8 vectors) nine of ten; nearer ones more. ``trees`` and ``spill`` set the price.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import mix, table
from tideguard.llm.setsketch import components
from tideguard.session import materialise


@dataclass(frozen=True)
class ForestConfig:
    least: float = 0.9     #: cosine of a link
    trees: int = 8
    leaf: int = 512        #: classes of a leaf, at most
    spill: float = 0.05    #: share of a node on each side of its median that goes both ways
    sample: int = 16_384   #: classes that the upper splits are fitted on, at most ...
    sample_bytes: int = 16 << 20  #: ... and of so many bytes
    fewest: int = 64       #: classes of the sample in a node that it still splits
    dense: int = 4_096     #: classes of the sample among which dense groups are looked for
    crowd: int = 8         #: of those in a dense group, at least
    lengths: int = 64      #: lengths of vectors that get upper splits; others are split in rounds only
    levels: int = 4        #: levels that a round adds
    seed: int = 29


def directions(tree: int, first: int, levels: int, size: int, config: ForestConfig) -> np.ndarray:
    """Unit vectors, one a level."""
    made = [np.random.default_rng([config.seed, tree, first + k]).standard_normal(size) for k in range(levels)]
    return np.array([d / np.linalg.norm(d) for d in made]).reshape(levels, size)


def units(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def projected(x: np.ndarray, names: np.ndarray, tree: int, first: int, levels: int, config: ForestConfig) -> np.ndarray:
    """Projections (rows x levels), with a little noise by name, so that equal ones can be split."""
    salt = np.uint64(1) + np.arange(first, first + levels, dtype=np.uint64) + np.uint64(tree << 20)
    noise = (mix(names[:, None] ^ mix(salt)[None, :]) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    return x @ directions(tree, first, levels, x.shape[1], config).T + 1e-3 * noise / math.sqrt(x.shape[1])


@dataclass
class Tree:
    """Node i goes left up to ``high[i]`` and right from ``low[i]`` on; ``left[i]`` < 0 is a leaf."""

    low: np.ndarray
    high: np.ndarray
    left: np.ndarray   #: the right child comes behind the left one
    depth: int


def grow(x: np.ndarray, names: np.ndarray, tree: int, scale: float, config: ForestConfig) -> Tree:
    """The tree of a sample, of which each row stands for ``scale`` rows of the table."""
    low, high, left, level = [0.0], [0.0], [-1], 0
    here = [(0, np.arange(len(x)))]
    while True:
        split = [(i, own) for i, own in here if len(own) * scale > config.leaf and len(own) >= config.fewest]
        if not split:
            return Tree(np.array(low), np.array(high), np.array(left), level)
        p = projected(x, names, tree, level, 1, config)[:, 0]
        here, level = [], level + 1
        for i, own in split:
            low[i], high[i] = np.quantile(p[own], [0.5 - config.spill, 0.5 + config.spill])
            left[i] = len(low)
            for part in (own[p[own] <= high[i]], own[p[own] >= low[i]]):
                here.append((len(low), part))
                low.append(0.0), high.append(0.0), left.append(-1)


def leaves(tree: Tree, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, node, level) of all leaves that rows with the projections ``p`` are in."""
    row, node, found = np.arange(len(p)), np.zeros(len(p), np.int64), []
    for level in range(tree.depth + 1):
        ends = tree.left[node] < 0
        found.append((row[ends], node[ends], np.full(int(ends.sum()), level)))
        row, node = row[~ends], node[~ends]
        if not len(row):
            break
        at = p[row, level]
        goes = [at <= tree.high[node], at >= tree.low[node]]
        row, node = (np.concatenate([row[g] for g in goes]),
                     np.concatenate([tree.left[node[g]] + side for side, g in enumerate(goes)]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


@dataclass
class Fit:
    """Upper splits and the centres of dense groups, for vectors of one length."""

    trees: list[Tree]
    centres: np.ndarray


def certain(config: ForestConfig) -> float:
    """Vectors that are this near to a centre are linked with each other."""
    return math.cos(math.acos(config.least) / 2) + 1e-9


def centres_of(x: np.ndarray, config: ForestConfig) -> np.ndarray:
    """Rows of the sample that have ``crowd`` others in their ball, the fullest first, none in the ball of another."""
    x = x[: config.dense]
    near = np.concatenate([x[a: a + 1024] @ x.T >= certain(config) for a in range(0, len(x), 1024)]) if len(x) else np.zeros((0, 0), bool)
    found, free = [], np.ones(len(x), bool)
    for i in np.argsort(-near.sum(axis=1), kind="stable"):
        if free[i] and (near[i] & free).sum() >= config.crowd:
            found.append(i)
            free &= ~near[i]
    return x[found]


def fit(classes: DataFrame, config: ForestConfig) -> dict[int, Fit]:
    """By length of vector. The driver holds ``sample`` vectors, and not more than ``sample_bytes``, of each of the most frequent lengths."""
    sizes = {r["size"]: r["count"] for r in classes.groupBy("size").count().orderBy(F.desc("count"), "size").limit(config.lengths).collect()}
    out = {}
    for size, n in sizes.items():
        most = max(1, min(config.sample, config.sample_bytes // (8 * size) // len(sizes)))
        rows = classes.where(F.col("size") == size).orderBy("name", "cls").limit(most).select("name", "vector").collect()
        x, names = units(np.array([r["vector"] for r in rows], dtype=np.float64)), np.array([r["name"] for r in rows], np.int64).view(np.uint64)
        out[size] = Fit([grow(x, names, t, n / len(x), config) for t in range(config.trees)], centres_of(x, config))
    return out


def classes_of(rows: DataFrame) -> DataFrame:
    """(cls, size, name, other, rep, copies, vector): one row for each distinct vector; two 64-bit hashes tell them apart."""
    found = (rows.where("name is not null").groupBy("size", "name", "other")
             .agg(F.min("key").alias("rep"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")))
    return materialise(found.withColumn("cls", F.monotonically_increasing_id()), "forest-classes")


def vectors(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(key, size, name, other, vector); ``name`` is null for rows that link with nothing."""
    v = F.col(column)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.coalesce(F.col(key).isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))
    return rows.select(F.col(key).cast("long").alias("key"), F.size(v).alias("size"), F.when(good, F.xxhash64(v)).alias("name"),
                       F.when(good, F.xxhash64(F.lit(1), v)).alias("other"), v.alias("vector"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows."""
    return units(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))


def by_length(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column(at).to_numpy()
    for size in np.unique(sizes).tolist():
        yield size, batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


PLACE = "struct<grp: long, tree: int, level: int>"


def placed(classes: DataFrame, fits: dict[int, Fit], config: ForestConfig) -> DataFrame:
    """(cls, size, name, copies, vector, ball, places): the leaves of every class, and its dense group (null: none)."""
    shared = classes.sparkSession.sparkContext.broadcast(fits)
    kind = classes.schema["vector"].dataType.simpleString()
    place = pa.list_(pa.struct([("grp", pa.int64()), ("tree", pa.int32()), ("level", pa.int32())]))

    def work(batches):
        for whole in batches:
            for size, batch in by_length(whole, 1):
                x, names, own = matrix(batch["vector"]), batch["name"].to_numpy().view(np.uint64), shared.value.get(size)
                found = []
                for t in range(config.trees):
                    tree = own.trees[t] if own else Tree(np.zeros(1), np.zeros(1), np.array([-1]), 0)
                    row, node, level = leaves(tree, projected(x, names, t, 0, tree.depth, config))
                    found.append((row, (np.int64(t) << 40) + node, np.full(len(row), t), level))
                row, grp, tree, level = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.argsort(row, kind="stable")
                inner = pa.StructArray.from_arrays([pa.array(grp[order]), pa.array(tree[order].astype(np.int32)), pa.array(level[order].astype(np.int32))],
                                                   names=["grp", "tree", "level"])
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))])
                ball = np.full(len(x), -1)
                if own and len(own.centres):
                    near = x @ own.centres.T
                    ball = np.where(near.max(axis=1) >= certain(config), near.argmax(axis=1), -1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(ball, pa.int64(), mask=ball < 0),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner).cast(place)],
                    names=["cls", "size", "name", "copies", "vector", "ball", "places"])

    return (classes.select("cls", "size", "name", "copies", "vector")
            .mapInArrow(work, f"cls long, size int, name long, copies long, vector {kind}, ball long, places array<{PLACE}>"))


def both_ways(codes: Column, sides: Column) -> Column:
    """Every code with every side behind it."""
    return F.flatten(F.transform(codes, lambda x: F.transform(sides, lambda y: x * 2 + y)))


def split_further(rows: DataFrame, large: DataFrame, config: ForestConfig) -> DataFrame:
    """``rows`` with the leaves in ``large`` (size, grp, turns) split on as many more levels.

    Quantiles are aggregated and combined map-side; the joins are by leaf, and
    Spark splits a leaf that holds many rows.
    """
    def project(batches):
        for whole in batches:
            for _, batch in by_length(whole, 1):
                x, names = matrix(batch["vector"]), batch["name"].to_numpy().view(np.uint64)
                tree, level = batch["tree"].to_numpy(), batch["level"].to_numpy()
                p = np.zeros((len(x), config.levels))
                for t, k in set(zip(tree.tolist(), level.tolist(), strict=True)):
                    own = (tree == t) & (level == k)
                    p[own] = projected(x[own], names[own], t, k, config.levels, config)
                yield pa.RecordBatch.from_arrays([batch["cls"], batch["size"], batch["grp"], batch["turns"], pa.array(list(p), pa.list_(pa.float64()))],
                                                 names=["cls", "size", "grp", "turns", "p"])

    flat = rows.select("cls", "size", "name", "vector", F.inline("places"))
    over = materialise(flat.join(large, ["size", "grp"]).select("cls", "size", "name", "vector", "grp", "tree", "level", "turns")
                       .mapInArrow(project, "cls long, size int, grp long, turns int, p array<double>"), "forest-over")
    cut = lambda k: F.percentile_approx(F.col("p")[k], [0.5 - config.spill, 0.5 + config.spill], 2_000)
    cuts = over.groupBy("size", "grp").agg(F.array(*[cut(k) for k in range(config.levels)]).alias("cuts"))
    codes = F.array(F.lit(1).cast("long"))
    for k in range(config.levels):
        at, c = F.col("p")[k], F.col("cuts")[k]
        sides = F.when(at < c[0], F.array(F.lit(0))).when(at > c[1], F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))
        codes = F.when(F.col("turns") > k, both_ways(codes, sides)).otherwise(codes)
    halves = (over.join(cuts, ["size", "grp"]).select("cls", "grp", "turns", F.explode(codes).alias("code"))
              .select("cls", "grp", F.struct(F.xxhash64("grp", "code").alias("grp"), F.col("turns")).alias("part"))
              .groupBy("cls", "grp").agg(F.collect_list("part").alias("parts")))
    fresh = (rows.select("cls", F.inline("places")).join(halves, ["cls", "grp"], "left")
             .select("cls", "tree", "level", F.explode(F.coalesce("parts", F.array(F.struct(F.col("grp"), F.lit(0).alias("turns"))))).alias("part"))
             .groupBy("cls").agg(F.collect_list(F.expr("struct(part.grp as grp, tree, level + part.turns as level)")).alias("places")))
    return rows.drop("places").join(fresh, "cls").select(*rows.columns)


def settled(rows: DataFrame, config: ForestConfig) -> DataFrame:
    """Rounds of further splits, until no leaf holds more than ``leaf`` classes."""
    shrink = math.log(1 / (0.5 + config.spill))
    while True:
        rows = materialise(rows, "forest-places")
        turns = F.least(F.lit(config.levels), F.ceil(F.log(F.col("n") / config.leaf) / shrink)).cast("int")
        large = (rows.select("size", F.inline("places")).groupBy("size", "grp").agg(F.count("*").alias("n"))
                 .where(F.col("n") > config.leaf).select("size", "grp", F.greatest(F.lit(1), turns).alias("turns")))
        large = materialise(large, "forest-large")
        if large.isEmpty():
            return rows
        rows = split_further(rows, large, config)


def compared(rows: DataFrame, config: ForestConfig) -> DataFrame:
    """(a, b, gained): for a class linked in a leaf, the smallest class there that its links reach, and the rows its links there lead to."""
    flat = (rows.select("cls", "size", "copies", "ball", "vector", F.expr("array_sort(transform(places, x -> x.grp))").alias("all"))
            .select("*", F.explode("all").alias("grp"))
            .select("size", "grp", "cls", "copies", "ball", "vector", F.expr("filter(all, x -> x < grp)").alias("earlier"))
            .repartition("size", "grp").sortWithinPartitions("size", "grp", "cls"))

    def pairs(group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs that this leaf is the first to hold."""
        x, ball = matrix(group["vector"]), group["ball"].fill_null(-1).to_numpy()
        link = np.triu(x @ x.T >= config.least, 1)
        link &= (ball[:, None] != ball[None, :]) | (ball < 0)[:, None]
        i, j = np.nonzero(link)
        ends = group["earlier"].offsets.to_numpy()
        count = np.diff(ends)
        listed = np.full((len(x), max(1, count.max(initial=0))), -1, np.int64)
        own = np.repeat(np.arange(len(x)), count)
        listed[own, np.arange(count.sum()) - np.repeat(ends[:-1] - ends[0], count)] = group["earlier"].flatten().to_numpy()
        other = np.where(listed == -1, -2, listed)
        first = np.ones(len(i), bool)
        for a in range(0, len(i), 4096):
            first[a: a + 4096] = ~(listed[i[a: a + 4096], :, None] == other[j[a: a + 4096], None, :]).any(axis=(1, 2))
        return i[first], j[first]

    def compare(group: pa.RecordBatch) -> pa.RecordBatch:
        i, j = pairs(group)
        copies, cls = group["copies"].to_numpy(), group["cls"].to_numpy()
        gained = np.zeros(len(cls), np.int64)
        np.add.at(gained, i, copies[j])
        np.add.at(gained, j, copies[i])
        low = np.arange(len(cls))
        while True:  # the rows come in the order of cls
            before = low.copy()
            np.minimum.at(low, i, low[j])
            np.minimum.at(low, j, low[i])
            low = low[low]
            if (low == before).all():
                break
        has = np.flatnonzero(gained)
        return pa.RecordBatch.from_arrays([pa.array(cls[has]), pa.array(cls[low[has]]), pa.array(gained[has])], names=["a", "b", "gained"])

    def work(batches):
        kept = None  # the rows of a leaf that may go on in the next batch
        for batch in batches:
            if kept is not None:
                batch = pa.concat_batches([kept, batch])
            size, grp = batch["size"].to_numpy(), batch["grp"].to_numpy()
            ends = np.flatnonzero((np.diff(size) != 0) | (np.diff(grp) != 0)) + 1
            cuts = [0, *ends.tolist()]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield compare(batch.slice(a, b - a))
            kept = batch.slice(cuts[-1])
        if kept is not None and len(kept):
            yield compare(kept)

    return flat.mapInArrow(work, "a long, b long, gained long")


def near_vectors(rows: DataFrame, config: ForestConfig = ForestConfig(), key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row.

    ``n_links`` counts the other rows that a row is linked with, copies included;
    ``component_id`` is the smallest id that links reach; ``kept`` is true for that id.

    Defined results: a vector that is null, empty or zero, or holds a null or a
    component that is not finite, links with nothing and is kept; so is a row with a
    null id, with a null component; vectors of different lengths link with nothing of
    each other; rows that repeat an id are judged each alone; other columns are not
    looked at.
    """
    known = materialise(vectors(rows, key, column).drop("vector"), "forest-rows")
    classes = classes_of(vectors(rows, key, column))
    places = settled(placed(classes, fit(classes, config), config), config)
    found = materialise(compared(places, config), "forest-links")
    # A ball's number is that of a centre, of which there are at most dense / crowd a length.
    balls = places.where("ball is not null").groupBy("size", "ball").agg(F.min("cls").alias("low"), F.sum("copies").alias("in_ball"))
    inside = materialise(places.select("cls", "size", "ball").join(F.broadcast(balls), ["size", "ball"]).select("cls", "low", "in_ball"), "forest-balls")
    links = (found.select("a", "b").unionByName(inside.select(F.col("cls").alias("a"), F.col("low").alias("b"))).where("a <> b"))
    of = components(links).select(F.col("rep").alias("cls"), "component")
    gained = found.groupBy(F.col("a").alias("cls")).agg(F.sum("gained").alias("gained"))
    joined = materialise(classes.select("cls", "size", "name", "other", "rep", "copies").join(of, "cls", "left").join(gained, "cls", "left")
                         .join(inside.select("cls", "in_ball"), "cls", "left").withColumn("component", F.coalesce("component", "cls")), "forest-classes")
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    verdict = joined.join(least, "component").select(
        "size", "name", "other", "component_id",
        (F.coalesce("in_ball", "copies") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"))
    return (known.join(verdict, ["size", "name", "other"], "left")
            .select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "key").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: near duplicates of all embeddings at cosine 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
