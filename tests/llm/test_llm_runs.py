"""Periodic runs against a plain search of all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from tideguard.llm import periodic_runs
from tideguard.llm.periodic_runs import RunConfig, repair, runs_of

SF = "/root/testdata/sf0.01"


def plain(words, least=24, ratio=3):
    """(start, length, smallest period) of all runs, by start, then period."""
    found, n = {}, len(words)
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], dtype=np.int64)
    for q in range(1, n // ratio + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        for a, b in np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).tolist():
            if b - a + q >= max(least, ratio * q):
                found.setdefault((a, b + q), q)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def random_text(rng):
    words, alphabet, most = [], rng.choice([1, 2, 2, 3, 5, 50]), rng.randint(0, 300)
    while len(words) < most:
        unit = [b"w%d" % rng.randrange(alphabet) for _ in range(rng.randint(1, 40))]
        words += unit if rng.random() < 0.4 else (unit * 8)[: rng.randint(1, 8 * len(unit))]
    return words * 3 if rng.random() < 0.2 else words


@pytest.mark.parametrize(("least", "ratio", "chunk"), [(24, 3, 1 << 20), (24, 3, 50), (12, 3, 1 << 20), (24, 4, 1 << 20), (10, 5, 7)])
def test_runs_equal_brute_force(least, ratio, chunk):
    rng = random.Random(least + ratio + chunk)
    total = 0
    for _ in range(60):
        texts = [random_text(rng) for _ in range(rng.randint(1, 6))]
        got = runs_of(texts, RunConfig(least, ratio, chunk))
        assert got == [plain(w, least, ratio) for w in texts]
        total += sum(map(len, got))
    assert total > 100


def test_words_of_all_orders():
    thue_morse = [b"ab"[bin(i).count("1") % 2:][:1] for i in range(4096)]   # has no cube, and breaks hashes mod 2 ** 64
    fibonacci = [b"a", b"ab"]
    while len(fibonacci[-1]) < 3000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    letters = [bytes([c]) for c in fibonacci[-1]]
    assert runs_of([thue_morse]) == [[]] and runs_of([letters]) == [plain(letters)] != [[]]
    long = [b"a"] * 30_000 + [b"b"] + [b"c", b"d"] * 20_000
    assert runs_of([long]) == [[(0, 30_000, 1), (30_001, 40_000, 2)]]


def test_grammar_spells_its_text():
    rng = random.Random(5)
    words = np.array([rng.randrange(3) for _ in range(500)] + [0, 1, 2, 2] * 100)
    owner = np.repeat([0, 1, 2], [300, 200, 400])
    g = repair(words, owner)

    def spell(symbol):
        return [symbol] if symbol < g.base else spell(g.left[symbol - g.base]) + spell(g.right[symbol - g.base])

    assert [spell(r) for r in g.roots] == [words[owner == k].tolist() for k in range(3)]
    for i, at in enumerate(g.at):
        own = spell(g.base + i)
        assert len(own) == g.size[g.base + i] and own == words[at: at + len(own)].tolist()
    assert len(g.left) < 450  # the recurring pairs are shared


def row_of(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = sorted(tuple(r) for r in periodic_runs.query(spark, SF).select(*COLUMNS).collect())
    assert got == sorted(row_of(i, t) for i, t in docs)


def test_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x " * 24), (5, "x " * 23), (None, "y z " * 30), (7, "x y " * 30), (7, "x y " * 30),
            (10, "a b c " * 40), (-17, " ".join(map(str, range(9))) * 9), (None, None), (11, " ".join(f"w{i % 9001}" for i in range(60_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("body", "runs", "collapsed", "n_words", "start")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in periodic_runs.query(spark, str(tmp_path)).select(*COLUMNS).collect()), key=repr)
    assert got == sorted((row_of(i, t) for i, t in rows), key=repr)
    assert periodic_runs.periodic_runs(docs.where("false")).count() == 0
    shown = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in shown[4]["runs"]] == [(0, 24, 1)] and bytes(shown[4]["collapsed"]) == b"x" and shown[5]["runs"] == []
