"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

The token share p of each source is raised to an exponent a and normalised:
w = p**a / sum(p**a). At a = 1 the mix is the corpus, at a = 0 it is flat. The
exponent is bisected: the largest one whose weights reach the target entropy,
but no smaller than the least one at which no source is repeated more often than
allowed. Each source then gets w * budget tokens: whole epochs of all its
documents, and for the rest the first blocks of a permutation of its documents
into blocks (and, of the block on the border, its first sub-blocks), so the
budget is met to within one sub-block of each source, about a 260,000th of it,
or one document. No ranking of a source's documents is needed: a hash of the
id, the text and the row's number deals them to blocks, so rows that repeat an id,
or have none, spread like others; only the sums of blocks are ordered.

Token counts are words cut at ASCII white space.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideguard.llm.common import table
from tideguard.session import materialise


@dataclass(frozen=True)
class MixConfig:
    entropy: float = 0.95       #: target, as a share of the entropy of equal weights
    max_repeats: float = 3.0    #: epochs of any source at most
    budget: float = 1.0         #: tokens of the mix, as a multiple of the tokens given
    blocks: int = 512           #: blocks of a source, and sub-blocks of a block
    seed: int = 17


def n_tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sources_of(slim: DataFrame) -> DataFrame:
    """(source, total): tokens of each source that has any."""
    return slim.groupBy("source").agg(F.sum("tokens").alias("total")).where("total > 0")


def exponent(sources: DataFrame, config: MixConfig, steps: int = 16, rounds: int = 6) -> tuple[float, float]:
    """(exponent, its normaliser sum(p**a)), by bisection into ``steps`` parts a round.

    Each round is one aggregate over the sources, whose number is not bounded.
    """
    total, n = sources.agg(F.sum("total"), F.count("*")).first()
    if not n:
        return 1.0, 1.0
    p = F.col("total") / F.lit(float(total))
    sums = sources.select(F.log(p).alias("l"))

    def at(grid: list[float]) -> list[tuple[float, float, float]]:
        """(normaliser, entropy, most repeats) for each exponent."""
        row = sums.agg(*[x for i, a in enumerate(grid) for x in (
            F.sum(F.exp(a * F.col("l"))).alias(f"z{i}"), F.sum(F.exp(a * F.col("l")) * F.col("l")).alias(f"s{i}"),
            F.max((a - 1) * F.col("l")).alias(f"m{i}"))]).first()
        out = []
        for i, a in enumerate(grid):
            z, s, m = row[f"z{i}"], row[f"s{i}"], row[f"m{i}"]
            out.append((z, float(math.log(z) - a * s / z), config.budget * math.exp(m) / z))
        return out

    def border(good_below: bool, good) -> float:
        """Where a monotone test changes; good_below: it holds for small exponents."""
        lo, hi = 0.0, 1.0
        for _ in range(rounds):
            grid = [lo + (hi - lo) * i / steps for i in range(steps + 1)]
            holds = [good(x) for x in at(grid)]
            if good_below:
                k = max((i for i, h in enumerate(holds) if h), default=-1)
                if k < 0:
                    return 0.0
                if k == steps:
                    return grid[k]
                lo, hi = grid[k], grid[k + 1]
            else:
                k = min((i for i, h in enumerate(holds) if h), default=steps + 1)
                if k > steps:
                    return 1.0
                if k == 0:
                    return grid[0]
                lo, hi = grid[k - 1], grid[k]
        return lo if good_below else hi

    target = config.entropy * math.log(n)
    flat_enough = border(True, lambda x: x[1] >= target - 1e-12)
    rare_enough = border(False, lambda x: x[2] <= config.max_repeats + 1e-12)
    a = max(flat_enough, rare_enough)
    return a, at([a])[0][0]


def plan(documents: DataFrame, config: MixConfig = MixConfig(), key: str = "doc_id",
         text: str = "text", source: str = "source") -> DataFrame:
    """(source, total, weight, quota, epochs, cut_block, cut_sub): what each source gives.

    A document is drawn ``epochs`` times, and once more if its (block, sub-block)
    comes before (cut_block, cut_sub).
    """
    slim = materialise(documents.select(F.col(source).alias("source"), n_tokens(text).alias("tokens"),
                                        *places(key, text, config)), "mix-tokens")
    sources = materialise(sources_of(slim), "mix-sources")
    a, z = exponent(sources, config)
    every = sources.agg(F.sum("total").alias("every"))
    total = every.first()[0] or 0
    share = F.pow(F.col("total") / F.lit(float(total or 1)), F.lit(a)) / F.lit(z)
    wanted = (sources.withColumn("weight", share)
              .withColumn("quota", F.floor(F.col("weight") * F.lit(config.budget * total)))
              .withColumn("epochs", F.floor(F.col("quota") / F.col("total")).cast("int"))
              .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("total")))

    def cut(sums: DataFrame, name: str) -> DataFrame:
        """Per source the first cell that does not fit into the rest, and what is left for it.

        At most ``blocks`` rows of a source come together.
        """
        order = Window.partitionBy("source").orderBy(name)
        run = sums.withColumn("upto", F.sum("t").over(order))
        return (run.where(F.col("upto") > F.col("rest")).groupBy("source")
                .agg(F.min(F.struct(F.col(name), (F.col("rest") - F.col("upto") + F.col("t")).alias("left"))).alias("c"))
                .select("source", F.col(f"c.{name}").alias(f"cut_{name}"), F.col("c.left").alias("left")))

    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))  # noqa: E731  a null source is a source
    rest = wanted.select(F.col("source").alias("s"), "rest")
    blocks = slim.groupBy("source", "block").agg(F.sum("tokens").alias("t")).join(rest, same("source", "s")).drop("s")
    first = materialise(cut(blocks, "block"), "mix-cut")
    border = first.select(F.col("source").alias("s"), F.col("cut_block").alias("b"), F.col("left").alias("rest"))
    subs = (slim.join(border, same("source", "s") & (F.col("block") == F.col("b")))
            .groupBy("source", "sub", "rest").agg(F.sum("tokens").alias("t")))
    second = cut(subs, "sub").drop("left")
    out = wanted.drop("rest")
    for part, name in ((first.drop("left"), "cut_block"), (second, "cut_sub")):
        part = part.withColumnRenamed("source", "s")
        out = out.join(part, same("source", "s"), "left").drop("s").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("int"))
    return materialise(out, "mix-plan")


def places(key: str, text: str, config: MixConfig) -> list[Column]:
    """Block and sub-block of a row in the permutation of the part epoch.

    The number of the row tells apart rows that are equal. ``documents`` is read twice,
    for the plan and for the mix, so give a stored table: rows that come in another
    order the second time are drawn by other numbers, and quotas are met only nearly.
    """
    h = F.xxhash64(F.col(key), F.col(text), F.monotonically_increasing_id(), F.lit(config.seed))
    return [F.pmod(h, F.lit(config.blocks)).cast("int").alias("block"),
            F.pmod(F.shiftright(h, 20), F.lit(config.blocks)).cast("int").alias("sub")]


def mix(documents: DataFrame, config: MixConfig = MixConfig(), key: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``documents``, each as often as the mix draws it, with mix_epoch and mix_block.

    ``mix_block`` permutes each epoch anew: writing the mix sorted by
    (mix_epoch, mix_block) gives the order of training.

    Defined results: a null source is a source of its own; documents without
    words (null and empty texts) have no tokens and are never drawn; rows that
    repeat an id, or have none, are drawn each on its own; an empty table gives an
    empty mix; other columns pass unchanged.
    """
    if not set(documents.columns).isdisjoint({"mix_epoch", "mix_block"}):
        documents = documents.drop("mix_epoch", "mix_block")
    chosen = plan(documents, config, key, text, source).select(
        F.struct(F.col("source").alias("of"), "epochs", "cut_block", "cut_sub").alias("_mix_plan"))
    # Before all else, so that rows are numbered as in the plan.
    documents = documents.select("*", F.struct(*places(key, text, config)).alias("_mix_place"))
    block, sub = F.col("_mix_place.block"), F.col("_mix_place.sub")
    more = (block < F.col("_mix_plan.cut_block")) | ((block == F.col("_mix_plan.cut_block")) & (sub < F.col("_mix_plan.cut_sub")))
    draws = F.col("_mix_plan.epochs") + more.cast("int")
    drawn = (documents.join(chosen, F.col(source).eqNullSafe(F.col("_mix_plan.of")))
             .where(F.col(text).rlike(r"[^\x20\x09-\x0D]"))
             .where(draws > 0)
             .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), draws - 1))))
    return (drawn.withColumn("mix_block", F.pmod(F.xxhash64(F.col(key), F.col("mix_epoch"), F.lit(config.seed)),
                                                 F.lit(config.blocks)).cast("int"))
            .drop("_mix_plan", "_mix_place"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the mix of all documents; a row for each time a document is drawn."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", n_tokens("text").alias("n_tokens"), "mix_epoch", "mix_block")
