"""The projection forest against all pairs."""

import math

import numpy as np

from pyspark.sql import functions as F

from tideguard.llm import projection_forest
from tideguard.llm.projection_forest import ForestConfig, near_vectors

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, least=0.9):
    """(vec_id, n_links, component_id, kept) by all pairs; rows have ids of their own."""
    good = [i for i, (key, v) in enumerate(rows) if key is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    links = {i: set() for i in good}
    for size in {len(rows[i][1]) for i in good}:
        own = [i for i in good if len(rows[i][1]) == size]
        x = np.array([rows[i][1] for i in own])
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in np.argwhere(x @ x.T >= least).tolist():
            if a != b:
                links[own[a]].add(own[b])
    part = {}
    for i in sorted(good, key=lambda i: rows[i][0]):
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in part:
                part[j] = rows[i][0]
                stack += links[j]
    return sorted(((key, len(links.get(i, ())), part.get(i, key), part.get(i, key) == key) for i, (key, _) in enumerate(rows)), key=repr)


def at_cosine(rng, v, cosine):
    w = rng.standard_normal(len(v))
    w -= w @ v / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(40):
        centre = rng.standard_normal(32)
        rows += [at_cosine(rng, centre, rng.uniform(0.9, 0.999)) * rng.uniform(0.1, 9) for _ in range(k % 12 + 1)]
    rows += [rows[0]] * 50 + [rows[5] * 3.0] * 3 + [rng.standard_normal(32) for _ in range(300)]
    table = list(enumerate(v.tolist() for v in rows))
    rng.shuffle(table)
    docs = spark.createDataFrame(table, SCHEMA).withColumns({c: F.lit(1) for c in ("key", "vector", "name", "size", "cls", "ball", "label")})
    assert collected(near_vectors(docs)) == plain(table)


def test_dense_groups_beyond_a_leaf_and_recall_over_rounds(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(48)
    rows = [at_cosine(rng, centre, rng.uniform(0.985, 0.9999)).tolist() for _ in range(1500)]      # all linked with each other
    singles = rng.standard_normal((1200, 48))
    rows += singles.tolist() + [at_cosine(rng, v, rng.uniform(0.9, 0.95)).tolist() for v in singles]  # pairs just above the threshold
    table = list(enumerate(rows))
    config = ForestConfig(leaf=128, sample=300, dense=300, fewest=64)                               # most splits are made in rounds
    got, want = collected(near_vectors(spark.createDataFrame(table, SCHEMA), config)), plain(table)
    dense = [(g[1], w[1]) for g, w in zip(got, want, strict=True) if g[0] < 1500]
    assert all(a == b >= 1499 for a, b in dense)
    found = [(g[1], w[1]) for g, w in zip(got, want, strict=True) if g[0] >= 1500]
    assert all(a <= b for a, b in found) and sum(a for a, _ in found) >= 0.95 * sum(b for _, b in found)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, float("nan"), 3.0]),
            (8, [1.0, float("inf"), 1.0]), (None, v), (9, v), (9, v), (9, [-1.0, -2.0, -3.0]), (10, [1.0, 2.0, 3.0, 0.0]), (-4, [1.0, 2.0, 3.0, 0.0]),
            (11, [1e200, 2e200, 3e200]), (12, [1e-200, 2e-200, 3e-200])]
    got = collected(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    linked = [(1, 5, 1, True), (2, 5, 1, False), (9, 5, 1, False), (9, 5, 1, False), (11, 5, 1, False), (12, 5, 1, False)]
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9)]
    other = [(10, 1, -4, False), (-4, 1, -4, True), (None, 0, None, True)]
    assert got == sorted(linked + alone + other, key=repr)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    floats = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert collected(near_vectors(floats)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_equal_projections_are_split(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal(8)
    rows = [(i, (v * (1 + i / 1000)).tolist()) for i in range(700)]  # one direction, 700 vectors
    got = collected(near_vectors(spark.createDataFrame(rows, SCHEMA), ForestConfig(leaf=64, sample=16)))
    assert {r[1:3] for r in got} == {(699, 0)}


def test_query_equals_brute_force(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert collected(projection_forest.query(spark, sf)) == plain(rows)
