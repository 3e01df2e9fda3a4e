"""The Merkle manifest against a plain tree in memory."""

import hashlib

import pytest

from pyspark.sql import functions as F

from tideguard.llm import merkle_manifest
from tideguard.llm.merkle_manifest import ManifestConfig


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests, fan):
    """The top of a tree, and for each leaf the siblings (left, right) level by level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for i, here in enumerate(at):
            run = here // fan * fan
            paths[i].append((level[run:here], level[here + 1: run + fan]))
        at = [i // fan for i in at]
        level = [digest("".join(level[a: a + fan])) for a in range(0, len(level), fan)]
    return level[0], paths


def plain(rows, fan, tampered):
    """Sorted (doc_id, leaf, subroot, proof, version's root, root) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        own[name] = members, *climb([leaf_of(r) for r in members], fan)
    root, above = climb([own[n][1] for n in names], fan)
    out = []
    for name, over in zip(names, above, strict=True):
        members, top, paths = own[name]
        for r, path in zip(members, paths, strict=True):
            here = leaf_of((*r[:4], r[4].encode().lower().decode() if r[4] else r[4])) if tampered(r) else leaf_of(r)
            proof = ""
            for left, right in path + over:
                proof += "".join(left + right)
                here = digest("".join([*left, here, *right]))
            out.append((r[0], leaf_of(r), top, proof, here, root))
    return sorted(out, key=repr)


ROWS = ([(i, "big", "en", i, f"Text {i}") for i in range(150)] + [(i, "even", None, None, f"T {i}") for i in range(16)]
        + [(i, "part", "en", 1, f"P {i}") for i in range(17)] + [(None, None, None, None, None), (5, None, "en", 2, ""), (6, "lone", "de", 3, "Ä")]
        + [(7, "same", "en", 1, "X"), (7, "same", "en", 1, "X"), (7, "same", "en", 1, "W"), (None, "same", "en", 1, "n"), (-3, "same", "en", 0, "A" * 100_000)])
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize(("fan", "levels"), [(2, 3), (5, 1), (16, 3)])
def test_manifest_equals_a_plain_tree(spark, fan, levels):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(1) for c in ("grp", "key", "place", "members", "block", "digest", "top")})
    manifest = merkle_manifest.build(docs, {"text": merkle_manifest.lower_ascii(F.col("text"))}, F.col("doc_id") % 3 == 0,
                                     ManifestConfig(fan=fan, levels=levels))
    got = [(r["key"], r["leaf"], r["subroot"], r["proof"], r["copied"][-1], manifest.root) for r in merkle_manifest.versions(manifest).collect()]
    want = plain(ROWS, fan, lambda r: r[0] is not None and r[0] % 3 == 0)
    assert sorted(got, key=repr) == want


def test_versions_share_all_but_a_path(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"Text {i}") for i in range(40)], SCHEMA)
    manifest = merkle_manifest.build(docs, {"text": F.lit("other")}, F.col("doc_id") == 21, ManifestConfig(fan=4, levels=2))
    rows = {r["key"]: r["copied"] for r in merkle_manifest.versions(manifest).collect()}
    assert all(path[-1] == manifest.root for key, path in rows.items() if key != 21)
    assert len(rows[21]) == 4 and rows[21][-1] != manifest.root and not set(rows[21]) & set(rows[20])


def test_manifest_of_other_columns_and_of_nothing(spark):
    docs = spark.createDataFrame([("b", "x", 1), ("a", "x", 2), (None, "y", 3)], "name string, site string, size int")
    config = ManifestConfig(fields=("size", "name"), group="site", key="name")
    rows = {r["key"]: r["leaf"] for r in merkle_manifest.versions(merkle_manifest.build(docs, {}, F.lit(False), config)).collect()}
    assert rows == {"a": digest("1:21:a"), "b": digest("1:11:b"), None: digest("1:3-")}
    empty = merkle_manifest.build(docs.where("false"), {}, F.lit(True), config)
    assert empty.root is None and merkle_manifest.versions(empty).count() == 0
