"""Merkle manifest of a corpus: a persistent tree whose versions copy only paths.

The leaves of a group (a source) stand in order; every ``fan`` consecutive nodes
of a level become one node of the next, until one is left: the group's subroot.
The subroots, in order of their groups, form a tree of their own up to the root.

1. Leaves are hashed in one pass and stored without their texts.
2. They get their places by a range partitioning (group, order) and one offset a
   partition: no group is sorted or counted in one task.
3. Aligned blocks of ``fan ** levels`` leaves are hashed, a task a block; their
   tops are the members of the next tier, and so on. All nodes are stored once.
4. What a node's path needs from above, the siblings left and right of it on every
   level, comes down tier by tier, to blocks and not to leaves.
5. A tampered leaf makes a version: in its block only its ancestors are copied, all
   other nodes are those of the stored tree, and the copies go on up to a root of
   their own by the siblings from above. As these come down to the blocks, no upper
   node gathers the versions of all leaves below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideguard.llm.common import table
from tideguard.session import materialise


@dataclass(frozen=True)
class ManifestConfig:
    fan: int = 16       #: nodes of a run
    levels: int = 3     #: levels of an aligned block, which one task hashes
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")  #: of a leaf, in this order
    group: str = "source"
    key: str = "doc_id"

    @property
    def block(self) -> int:
        return self.fan ** self.levels


def sha(*parts: str) -> str:
    """Lower-case hex sha256 of the parts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value: Column) -> Column:
    """A field of a leaf: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]).cast("binary"), 256)


def leaves(documents: DataFrame, changes: dict[str, Column], tampered: Column, config: ManifestConfig) -> DataFrame:
    """(key, grp, row, digest, changed): a leaf for each row, and the leaf that tampering makes of it (null: none).

    ``grp`` sorts null groups first and others by their UTF-8 bytes.
    """
    whole = isinstance(documents.schema[config.key].dataType, T.IntegralType)
    return documents.select(
        F.col(config.key).cast("long" if whole else "string").alias("key"),
        F.coalesce(F.concat(F.lit("+"), F.col(config.group).cast("string")), F.lit("")).alias("grp"),
        F.monotonically_increasing_id().alias("row"),
        leaf([F.col(c) for c in config.fields]).alias("digest"),
        F.when(tampered, leaf([changes.get(c, F.col(c)) for c in config.fields])).alias("changed"))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``place``: the row's number in its ``grp``, by ``order``.

    Rows are dealt out by ranges and numbered where they lie; a group that goes on
    from one range to the next needs one offset there. These offsets, at most one
    a partition, are broadcast.
    """
    dealt = (rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
             .withColumn("part", F.spark_partition_id()))
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in dealt.schema)}, nth long"

    def number(batches):
        last, n = None, 0
        for batch in batches:
            groups, nth = batch["grp"], []
            starts = [0, *[i + 1 for i in pc.indices_nonzero(pc.not_equal(groups[1:], groups[:-1])).to_pylist()], len(batch)]
            for a, b in zip(starts, starts[1:], strict=False):
                first = n if groups[a].as_py() == last else 0
                nth.extend(range(first, first + b - a))
                last, n = groups[a].as_py(), first + b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth, pa.int64())], names=[*batch.schema.names, "nth"])

    counted = materialise(dealt.mapInArrow(number, schema), "manifest-places")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counted.groupBy("grp", "part").agg(F.count("*").alias("n")).withColumn("offset", F.sum("n").over(before))
               .where("offset > 0").drop("n"))
    return (counted.join(F.broadcast(offsets), ["grp", "part"], "left")
            .withColumn("place", F.col("nth") + F.coalesce("offset", F.lit(0))).drop("part", "nth", "offset"))


def levels_of(digests: list[str], block: int, config: ManifestConfig) -> list[list[str]]:
    """The nodes of a block, level by level; a block that is not its group's only one has all its levels."""
    found = [digests]
    while len(found[-1]) > 1 or (block > 0 and len(found) <= config.levels):
        low = found[-1]
        found.append([sha(*low[i: i + config.fan]) for i in range(0, len(low), config.fan)])
    return found


def steps(found: list[list[str]], config: ManifestConfig) -> list[list[tuple[str, str]]]:
    """For each node below the top, level by level: the digests to its left in its run, and to its right."""
    out = []
    for level in found[:-1]:
        here = []
        for a in range(0, len(level), config.fan):
            run = level[a: a + config.fan]
            here += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
        out.append(here)
    return out


BLOCKS = "grp string, block long, members array<struct<place long, digest string, key {kind}, changed string>>, top string, whole boolean"


def blocks(members: DataFrame, config: ManifestConfig) -> DataFrame:
    """A row for each aligned block of (grp, place, digest, key, changed), with its top; ``whole`` if it is all of a group."""
    kind = members.schema["key"].dataType.simpleString()
    gathered = (members.groupBy("grp", F.floor(F.col("place") / config.block).alias("block"))
                .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "key", "changed"))).alias("members")))

    def work(batches):
        for batch in batches:
            numbers, sets = batch["block"].to_pylist(), batch["members"]
            tops, whole = [], []
            for b, own in zip(numbers, sets, strict=True):
                digests = [m["digest"] for m in own.as_py()]
                tops.append(levels_of(digests, b, config)[-1][0])
                whole.append(b == 0 and len(digests) < config.block)
            yield pa.RecordBatch.from_arrays([batch["grp"], batch["block"], sets, pa.array(tops), pa.array(whole)],
                                             names=["grp", "block", "members", "top", "whole"])

    return gathered.mapInArrow(work, BLOCKS.format(kind=kind))


def tiers(members: DataFrame, config: ManifestConfig) -> list[DataFrame]:
    """Stored blocks of every tier: tops of blocks that are not whole groups are the members of the next."""
    found = []
    while True:
        found.append(materialise(blocks(members, config), "manifest-tier"))
        open_ = found[-1].where("not whole")
        if open_.isEmpty():
            return found
        members = open_.select("grp", F.col("block").alias("place"), F.col("top").alias("digest"),
                               F.lit(None).cast("long").alias("key"), F.lit(None).cast("string").alias("changed"))


def tops(found: list[DataFrame]) -> DataFrame:
    """(grp, digest): the one node that is left of each group."""
    ends = [t.where("whole").select("grp", F.col("top").alias("digest")) for t in found]
    out = ends[0]
    for other in ends[1:]:
        out = out.unionByName(other)
    return out


def down(tier: DataFrame, above: DataFrame, config: ManifestConfig) -> DataFrame:
    """(grp, place, key, lefts, rights, subroot) of every member of a tier: its siblings level by level up to the root."""
    kind = tier.schema["members"].dataType.elementType["key"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            out = {c: [] for c in ("grp", "place", "key", "lefts", "rights", "subroot")}
            for row in batch.to_pylist():
                own = steps(levels_of([m["digest"] for m in row["members"]], row["block"], config), config)
                for i, m in enumerate(row["members"]):
                    path = [level[i // config.fan ** k] for k, level in enumerate(own)]
                    for c, x in (("grp", row["grp"]), ("place", m["place"]), ("key", m["key"]), ("subroot", row["subroot"]),
                                 ("lefts", [x[0] for x in path] + row["lefts"]), ("rights", [x[1] for x in path] + row["rights"])):
                        out[c].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("grp", pa.string()), ("place", pa.int64()), ("key", pa.string() if kind == "string" else pa.int64()),
                        ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())), ("subroot", pa.string())])
    return (tier.join(above, ["grp", "block"]).select("grp", "block", "members", "lefts", "rights", "subroot")
            .mapInArrow(work, f"grp string, place long, key {kind}, lefts array<string>, rights array<string>, subroot string"))


def above_leaves(found: list[DataFrame], entry: DataFrame | None, config: ManifestConfig) -> DataFrame:
    """(grp, block, lefts, rights, subroot) for the blocks of the lowest tier.

    ``entry`` (grp, lefts, rights, subroot) is above the groups; without it nothing is.
    """
    def whole(tier: DataFrame) -> DataFrame:
        ends = tier.where("whole").select("grp", "block")
        if entry is not None:
            return ends.join(entry, "grp")
        none = F.array().cast("array<string>")
        return ends.select("grp", "block", none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"))

    above = whole(found[-1])
    for upper, lower in zip(found[:0:-1], found[-2::-1], strict=True):
        come = down(upper, above, config).select("grp", F.col("place").alias("block"), "lefts", "rights", "subroot")
        above = materialise(come.unionByName(whole(lower).select(*come.columns)), "manifest-above")
    return above


@dataclass
class Manifest:
    """The stored tree: blocks of all tiers of the groups and of the tree over them."""

    groups: list[DataFrame]
    over: list[DataFrame]
    root: str | None          #: null for an empty table
    config: ManifestConfig

    def above(self) -> DataFrame:
        """What the paths of the leaves' blocks need from above, see ``above_leaves``."""
        entry = down(self.over[0], above_leaves(self.over, None, self.config), self.config)
        # The key of a member of the upper tree is its group.
        entry = entry.select(F.col("key").alias("grp"), "lefts", "rights").join(tops(self.groups), "grp")
        return above_leaves(self.groups, materialise(entry.withColumnRenamed("digest", "subroot"), "manifest-entry"), self.config)


def build(documents: DataFrame, changes: dict[str, Column], tampered: Column, config: ManifestConfig = ManifestConfig()) -> Manifest:
    """The tree over all rows; see ``versions`` for what tampering makes of it."""
    rows = materialise(leaves(documents, changes, tampered, config), "manifest-leaves")
    groups = tiers(placed(rows, ["key", "digest", "row"]), config)
    members = tops(groups).select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest", F.lit(None).cast("string").alias("changed"))
    over = tiers(placed(members, ["key"]), config)
    end = tops(over).first()
    return Manifest(groups, over, end["digest"] if end else None, config)


def versions(manifest: Manifest) -> DataFrame:
    """(key, leaf, subroot, proof, copied): every leaf with its proof and its version of the tree.

    ``proof`` are the siblings from the leaf's run up to the root, left to right;
    ``copied`` are the nodes of the version that the leaf makes, from the leaf (the
    tampered one, where there is one) to the version's root. All other nodes of the
    version are those of the stored tree.

    Defined results: null fields are ``-``; null keys come first, equal keys in the
    order of their leaves; a null group is a group of its own, before all others;
    empty tables give no rows; columns that are not fields are not looked at.
    """
    config, lowest = manifest.config, manifest.groups[0]
    kind = lowest.schema["members"].dataType.elementType["key"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            out = {c: [] for c in schema.names}
            for row in batch.to_pylist():
                own = steps(levels_of([m["digest"] for m in row["members"]], row["block"], config), config)
                high = list(zip(row["lefts"], row["rights"], strict=True))
                for i, m in enumerate(row["members"]):
                    path = [level[i // config.fan ** k] for k, level in enumerate(own)] + high
                    copied = [m["changed"] or m["digest"]]
                    for left, right in path:
                        copied.append(sha(left, copied[-1], right))
                    for c, x in zip(schema.names, (m["key"], m["digest"], row["subroot"], "".join(a + b for a, b in path), copied), strict=True):
                        out[c].append(x)
                    if len(out["key"]) == 1024:
                        yield pa.RecordBatch.from_pydict(out, schema=schema)
                        out = {c: [] for c in schema.names}
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("key", pa.string() if kind == "string" else pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                        ("proof", pa.string()), ("copied", pa.list_(pa.string()))])
    return (lowest.join(manifest.above(), ["grp", "block"]).select("block", "members", "lefts", "rights", "subroot")
            .mapInArrow(work, f"key {kind}, leaf string, subroot string, proof string, copied array<string>"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the manifest of all documents, and the check of each against a fifth of tampered ones."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    manifest = build(docs, {"text": lower_ascii(F.col("text"))}, tampered)
    root = F.lit(manifest.root).cast("string")
    folded = F.element_at("copied", -1)
    return versions(manifest).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"), F.sha2("proof", 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == root).alias("verified"))


def _framed(name: str, value: str | None = None) -> str:
    return f"coalesce(octet_length(encode(CAST({value or name} AS VARCHAR))) || ':' || CAST({value or name} AS VARCHAR), '-')"


def _leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_framed(c, text if c == "text" else None) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"


#: crc32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
  lambda v, b: list_reduce(list_concat([xor(v, b)], range(8)::UBIGINT[]),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT)"""


def _forest(name: str, levels: int) -> str:
    """Nodes and runs of the trees over ``{name}0`` (grp, i, d), a few levels each; up to 16 ** levels leaves a group."""
    out = []
    for k in range(levels):
        a, b = f"{name}{k}", f"{name}{k + 1}"
        out.append(f"{name}r{k} AS (SELECT grp, i // 16 AS run, list(d ORDER BY i) AS ds, max(n) AS n FROM "
                   f"(SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {a}) GROUP BY grp, i // 16)")
        out.append(f"{b} AS (SELECT grp, run AS i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {name}r{k})")
    return ",\n".join(out)


def _climb(name: str, start: str, levels: int, grp: str, at: str) -> str:
    """Proof text and folded digest of every row of ``start`` up the trees of ``name``."""
    out = []
    for k in range(levels):
        before = start if k == 0 else f"{name}c{k - 1}"
        place = f"(({at} >> {4 * k}) % 16)"
        left, right = f"array_to_string(r.ds[1:{place}], '')", f"array_to_string(r.ds[{place} + 2:], '')"
        out.append(f"{name}c{k} AS (SELECT x.* EXCLUDE (proof, folded), x.proof || CASE WHEN r.n > 1 THEN {left} || {right} ELSE '' END AS proof, "
                   f"CASE WHEN r.n > 1 THEN sha256({left} || x.folded || {right}) ELSE x.folded END AS folded "
                   f"FROM {before} x JOIN {name}r{k} r ON r.grp = x.{grp} AND r.run = x.{at} >> {4 * k + 4})")
    return ",\n".join(out)


#: Up to 16 ** 5 documents a source and 16 ** 3 sources.
ORACLE = f"""WITH leaves AS (SELECT doc_id, coalesce('+' || source, '') AS grp, {_leaf()} AS d,
  CASE WHEN {_CRC} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS c FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM leaves),
s0 AS (SELECT grp, i, d FROM p),
{_forest("s", 5)},
t0 AS (SELECT 0 AS grp, row_number() OVER (ORDER BY encode(s5.grp)) - 1 AS i, s5.d, s5.grp AS name FROM s5),
{_forest("t", 3)},
start AS (SELECT p.doc_id, p.grp, p.i, p.d AS leaf, s5.d AS subroot, '' AS proof, coalesce(c, p.d) AS folded, t0.i AS j, 0 AS zero
  FROM p JOIN s5 ON s5.grp = p.grp JOIN t0 ON t0.name = p.grp),
{_climb("s", "start", 5, "grp", "i")},
{_climb("t", "sc4", 3, "zero", "j")}
SELECT doc_id, leaf, subroot, (SELECT d FROM t3) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = (SELECT d FROM t3) AS verified FROM tc2"""
