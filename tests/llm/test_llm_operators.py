"""Every operator against brute force, plain formulas, exact round trips or held-out labels."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideguard.llm import catalogue, decontamination, language_model, mixing, personal_data, quality_classifier
from tideguard.llm import quality_rules, setsketch, substring_dedup, token_files, toxicity
from tideguard.llm.common import fold, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracles(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    want = con.sql(catalogue.ORACLES[name]).df()
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(want.columns)
    assert sorted(map(tuple, got[order].values.tolist())) == sorted(map(tuple, want[order].values.tolist()))


# -- op1 -------------------------------------------------------------------
def test_rules_keep_the_same_rows_in_any_order(spark):
    docs = table(spark, SF, "documents")
    rules = quality_rules.text_rules()
    one = {r[0] for r in docs.where(quality_rules.verdict(rules).isNull()).select("doc_id").collect()}
    other = {r[0] for r in docs.where(quality_rules.verdict(rules[::-1]).isNull()).select("doc_id").collect()}
    ranked = quality_rules.cascade(docs).where("rejected_by is null").select("doc_id")
    assert one == other == {r[0] for r in ranked.collect()}


def test_rules_are_ordered_by_rejections_per_second(spark):
    found = quality_rules.order(table(spark, SF, "documents").select("doc_id", "text"), quality_rules.text_rules(), rows=200)
    worth = [share / seconds for _, seconds, share in found]
    assert worth == sorted(worth, reverse=True) and all(0 <= share <= 1 for *_, share in found)


def test_native_plans_have_no_python(spark):
    for df in (quality_rules.measured(table(spark, SF, "documents")), personal_data.spans(table(spark, SF, "documents"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# -- op2 -------------------------------------------------------------------
def removed(docs, size):
    seen, split = collections.Counter(), [(i, (t or "").encode().split()) for i, t in docs]
    for _, w in split:
        seen.update(tuple(w[p: p + size]) for p in range(len(w) - size + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if seen[tuple(w[p: p + size])] > 1:
                gone[p: p + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [4, 35])
def test_repeats_equal_brute_force(spark, size):
    rng = random.Random(size)
    docs = []
    for i in range(200):
        words = [f"w{rng.randint(0, rng.choice([0, 1, 2, 40]))}" for _ in range(rng.randint(0, 110))]
        if docs and rng.random() < 0.5:
            other = (rng.choice(docs)[1] or "").split()
            words[len(words) // 2: len(words) // 2] = other[rng.randint(0, len(other)):][:60]
        docs.append((i, " ".join(words)))
    docs += [(900, "x " * 80), (900, "x " * 81), (3, docs[3][1]), (901, None), (902, "")]
    got = substring_dedup.repeats(spark.createDataFrame(docs, "doc_id long, text string"), substring_dedup.RepeatConfig(size))
    assert sorted(map(tuple, got.collect()), key=repr) == removed(docs, size)


def test_equal_words_have_equal_interior_symbols():
    rng = random.Random(5)
    shared = [b"s%d" % rng.randint(0, 9) for _ in range(60)]
    texts = [b" ".join([b"l%d" % rng.randint(0, 9) for _ in range(n)] + shared + [b"r%d" % rng.randint(0, 9) for _ in range(m)])
             for n, m in ((7, 30), (23, 2))]
    places = []
    for t, lead in zip(texts, (7, 23), strict=True):
        words = substring_dedup.Texts([t])
        level = substring_dedup.words_level(words)
        for _ in range(2):
            level = substring_dedup.recompress(level, words)
        inside = (level.low >= lead) & (level.high <= lead + 60)
        places.append([(int(a) - lead, int(b) - lead, int(c)) for a, b, c in zip(level.low[inside], level.high[inside], level.name[inside], strict=True)])
    assert places[0] == places[1] and len(places[0]) > 15


# -- op3 -------------------------------------------------------------------
def small_field():
    words = {(0, b"bad"): 1, (0, b"awful"): 2, (4, b"nast"): 3}
    return toxicity.Field(words, np.array([-3.0, 2.5, 0.7, 1.5]), np.array([[0.4, -1.2], [-0.6, 0.3]]), -1.1)


def test_marginals_equal_plain_forward_backward():
    model, rng = small_field(), np.random.default_rng(0)
    for _ in range(50):
        ids = [int(rng.integers(1, 4)) if rng.random() < 0.3 else 0 for _ in range(int(rng.integers(1, 60)))]
        places = [i for i, k in enumerate(ids) if k]
        if not places:
            continue
        emit = [np.array([1, math.exp(model.emit[k])]) for k in ids]
        step, n = np.exp(model.step), len(ids)
        forward, backward = np.zeros((n, 2)), np.ones((n, 2))
        forward[0] = np.array([1, math.exp(model.start)]) * emit[0]
        for i in range(1, n):
            forward[i] = (forward[i - 1] @ step) * emit[i]
            forward[i] /= forward[i].sum()
        for i in range(n - 2, -1, -1):
            backward[i] = step @ (emit[i + 1] * backward[i + 1])
            backward[i] /= backward[i].sum()
        p = forward * backward
        p = (p / p.sum(axis=1, keepdims=True))[:, 1]
        assert np.allclose(model.marginals(places, [ids[i] for i in places], n), p[places], atol=1e-12)


def test_toxic_offsets_are_code_points(spark):
    model = small_field()
    model.emit[1] = 9.0
    model = toxicity.Field(model.words, model.emit, model.step, model.start)
    text = "é ü, BAD! x"
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[s["start"]: s["end"]] for s in row["offsets"]] == ["BAD"]


def auc(scores, labels):
    order = sorted(zip(scores, labels, strict=True))
    ranks, i = 0.0, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks += sum(y for _, y in order[i:j]) * (i + 1 + j) / 2
        i = j
    ones = sum(labels)
    return (ranks - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    found = catalogue.QUERIES["op3_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert auc(found.score.tolist(), found.toxic.tolist()) > 0.93
    assert (found.toxic[found.predicted == 1] == 1).mean() > 0.9


# -- op4 -------------------------------------------------------------------
def test_base_scores_and_gain(spark, documents):
    got = {r["doc_id"]: r for r in catalogue.QUERIES["op4_lm_scoring"](spark, SF).collect()}
    counts = collections.Counter()
    for i, t in documents:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*t.encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    for i, t in documents:
        tokens = [*t.encode().lower().split(), None]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(w in counts for w in tokens), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens), rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_come_by_the_join(spark, documents):
    """With a small broadcast list almost all counts are joined; the scores are the same."""
    docs = table(spark, SF, "documents").limit(150).cache()
    learn = fold("doc_id", 7) != 2
    results = []
    for n in (20, 200_000):
        config = language_model.BrownConfig(symbols=10, classes=6, surfaces=8, broadcast_words=n)
        model, counts = language_model.train(docs, learn, config)
        rows = language_model.score(docs, model, counts, docs.where(learn).count()).collect()
        results.append({r["doc_id"]: (r["n_known"], round(r["base_score"], 6), len(model.words)) for r in rows})
    assert max(x[2] for x in results[0].values()) <= 20
    assert {k: v[:2] for k, v in results[0].items()} == {k: v[:2] for k, v in results[1].items()}


def test_emissions_and_transitions_are_probabilities(spark):
    docs = table(spark, SF, "documents").limit(100).cache()
    model, counts = language_model.train(docs, fold("doc_id", 7) != 2, language_model.BrownConfig(symbols=20, classes=6, surfaces=8))
    assert np.allclose((10 ** model.move).sum(axis=1), 1)
    mass = np.ones(6)
    for r in counts.collect():
        mass[r["class"]] += r["n"] + 1
    mass[5] += docs.where(fold("doc_id", 7) != 2).count() + 1
    assert np.allclose(10 ** model.mass, mass)


@pytest.mark.parametrize("n", [20, 200_000])
def test_scores_are_those_of_a_plain_class_bigram(spark, documents, n):
    """Counts, classes and transitions retold token by token; with 20 words in the broadcast nearly all come by the join."""
    docs = table(spark, SF, "documents").limit(120).cache()
    learn = fold("doc_id", 7) != 2
    config = language_model.BrownConfig(symbols=30, classes=8, surfaces=8, broadcast_words=n, least=2)
    model, counts = language_model.train(docs, learn, config)
    rows = {bytes(r["word"]): (r["n"], r["class"]) for r in counts.collect()}
    own = model.contexts.own()
    end = config.classes - 1
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in docs.collect()}
    learned = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    assert {w: x[0] for w, x in rows.items()} == collections.Counter(w for t in learned for w in t)
    before = lambda w: own.get(w, model.contexts.of_surface(w))
    of = lambda w: rows[w][1] if w in rows else model.contexts.of_surface(w)
    moves = np.zeros((config.classes, config.classes))
    for t in learned:
        for g, c in zip([end, *map(before, t)], [*map(of, t), end], strict=True):
            moves[g, c] += 1
    usual = (moves.sum(axis=0) + 1) / (moves.sum() + config.classes)
    assert np.allclose(10 ** model.move, (moves + config.back_off * usual) / (moves.sum(axis=1, keepdims=True) + config.back_off))
    got = {r["doc_id"]: r["score"] for r in language_model.score(docs, model, counts, len(learned)).collect()}
    for i, t in texts.items():
        plain = math.log10(len(learned) + 1) - model.mass[end] + model.move[before(t[-1]) if t else end, end]
        for g, w in zip([end, *map(before, t)], t, strict=False):
            plain += model.move[g, of(w)] + math.log10(rows.get(w, (0,))[0] + 1) - model.mass[of(w)]
        assert got[i] == pytest.approx(plain, rel=1e-9)


def test_best_classes_are_those_of_trying_all():
    rng = np.random.default_rng(4)
    k, words = 5, 40
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    left, right = rng.integers(0, 6, (words, k)) * (rng.random((words, k)) < 0.5), rng.integers(0, 6, (words, k)) * (rng.random((words, k)) < 0.5)
    left[:, 0] += 1
    weight, old = left.sum(axis=1), rng.integers(0, k - 1, words)
    table_ = rng.integers(30, 90, (k, k)).astype(float) * 50
    both = np.concatenate([left, right], axis=1)
    cells = [np.flatnonzero(row) for row in both]
    starts = np.cumsum([0] + [len(c) for c in cells])[:-1]
    got = language_model.best_classes(np.concatenate(cells), np.concatenate([row[c] for row, c in zip(both, cells, strict=True)]), starts,
                                      weight.astype(float), old, table_)
    for i in range(words):
        gains = []
        for c in range(k - 1):
            without = lambda x, own: np.maximum(x - own, 0) if c == old[i] else x  # noqa: E731, B023
            after, behind = without(table_[:, c], left[i]), without(table_[c], right[i])
            out, in_ = without(table_.sum(axis=1)[c], weight[i]), without(table_.sum(axis=0)[c], weight[i])
            gains.append(f(after + left[i]) - f(after) + f(behind + right[i]) - f(behind) - f(out + weight[i]) + f(out) - f(in_ + weight[i]) + f(in_))
        assert gains[got[i]] == pytest.approx(max(gains))


def test_classes_grow_with_the_vocabulary_and_a_flat_one_keeps_its_seeds(spark):
    config = language_model.BrownConfig(symbols=50, classes=6, surfaces=4, broadcast_words=50)
    rng = np.random.default_rng(6)
    for size in (200, 800):   # equally frequent words, in texts of one of two halves
        texts = []
        for half in "ab" * 40:
            order = rng.permutation(size // 2).reshape(-1, 20)
            texts += [" ".join(f"{half}{j}x" for j in row) for row in order.tolist()]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        model, counts = language_model.train(docs, fold("doc_id", 7) >= 0, config)
        assert 40 <= len(model.words) <= 50
        rows = [(bytes(r["word"]), r["class"]) for r in counts.collect()]
        assert len(rows) == size
        if size > 200:
            continue
        # Words of the two halves never meet: where a quarter of them are seeds, the exchange tells all apart, whatever their surfaces are.
        a, b = ({c: sum(x == c for w, x in rows if w.startswith(h)) for c in range(5)} for h in (b"a", b"b"))
        assert sum(max(a[c], b[c]) for c in range(5)) > 0.8 * size


def test_texts_are_cut_into_words_once(spark, documents):
    """Training and scoring read the stored slices, not the texts again."""
    learned = [(i, t) for i, t in documents[:60] if zlib.crc32(str(i).encode()) % 7 != 2]
    seen = spark.sparkContext.accumulator(0)

    def met(text):
        seen.add(1)
        return text

    docs = spark.createDataFrame(learned, "doc_id long, text string").withColumn("text", F.udf(met, "string").asNondeterministic()("text"))
    model, counts = language_model.train(docs, F.lit(True), language_model.BrownConfig(symbols=20, classes=6, surfaces=8))
    assert seen.value == len(learned)
    language_model.score(docs, model, counts, len(learned)).collect()
    assert seen.value == 2 * len(learned)


@pytest.mark.parametrize("limits", [{"slice_bytes": 400}, {"slice_bytes": 3000, "held_words": 40, "file_slices": 1}])
def test_small_slices_and_little_room_change_no_score(spark, documents, limits):
    docs = spark.createDataFrame([*documents[:80], (None, "A word of\x0bits own"), (-1, None), (-2, " ")], "doc_id long, text string").cache()
    results = []
    for more in ({}, limits):
        config = language_model.BrownConfig(symbols=20, classes=6, surfaces=8, broadcast_words=50, least=2, **more)
        slices = language_model.encoded(docs, fold("doc_id", 7) != 2, config, "doc_id")
        model, counts, n = language_model.train_slices(slices.df, config)
        assert n == docs.where(fold("doc_id", 7) != 2).count()
        scored = language_model.score_slices(slices.df, model, counts, n, "doc_id")
        results.append(({bytes(r["word"]): (r["n"], r["class"]) for r in counts.collect()}, model.move,
                        {r["doc_id"]: (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in scored.collect()}))
    assert results[0][0] == results[1][0] and np.array_equal(results[0][1], results[1][1])
    assert results[0][2].keys() == results[1][2].keys()
    for i, r in results[0][2].items():
        assert results[1][2][i] == pytest.approx(r, rel=1e-9)


def test_rows_of_a_word_come_together():
    hashes = [None, None, 0, 0, 0, 0, 0, 3, 4, 4]
    for cuts in ([2, 5], [1, 3, 4], [7], [0, 9]):
        batches = [pa.RecordBatch.from_arrays([pa.array(hashes[a:b], pa.int64()), pa.array(range(a, b), pa.int64())], names=["h", "row"])
                   for a, b in zip([0, *cuts], [*cuts, 10], strict=True)]
        words = []
        for batch, first in language_model.whole_words(batches, 0):
            rows = batch.column(1).to_pylist()
            words += [rows[a:b] for a, b in zip(first, [*first[1:], len(rows)], strict=True)]
        assert words == [[0, 1], [2, 3, 4, 5, 6], [7], [8, 9]]


def test_logarithms_from_the_table_choose_the_same_classes(monkeypatch):
    rng = np.random.default_rng(5)
    k, words = 6, 50
    n = rng.integers(1, 60, words * 4)
    cells = np.concatenate([np.sort(rng.choice(2 * k, 4, replace=False)) for _ in range(words)])
    rest = (np.arange(words) * 4, n.reshape(words, 4).sum(axis=1).astype(float), rng.integers(0, k - 1, words), rng.integers(100, 999, (k, k)).astype(float))
    some = language_model.best_classes(cells, n, *rest)
    monkeypatch.setattr(language_model, "TABLED", 60)
    assert some.tolist() == language_model.best_classes(cells, n, *rest).tolist()


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    config = language_model.BrownConfig(classes=4, rounds=5)
    kind = np.array([0, 1, 2] * 4 + [3])
    pairs = rng.integers(0, 3, (13, 13)) + 60 * (kind[:, None] == (kind[None, :] + 1) % 3)

    def likelihood(of):
        member = np.eye(4)[of]
        t = member.T @ pairs @ member
        f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return f(t) - f(t.sum(axis=0)) - f(t.sum(axis=1))

    of = language_model.exchange(pairs, config)
    assert likelihood(of) > likelihood(np.array([i % 3 for i in rng.permutation(12)] + [3]))
    for s in range(12):  # no single move is better
        for c in range(3):
            other = of.copy()
            other[s] = c
            assert likelihood(other) <= likelihood(of) + 1e-6


# -- op5 -------------------------------------------------------------------
def test_mix_meets_its_quotas(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text", "source").limit(6000).cache()
    config = mixing.MixConfig(entropy=0.97, max_repeats=2.0, blocks=64)
    plan = {r["source"]: r for r in mixing.plan(docs, config).collect()}
    drawn = mixing.mix(docs, config).select("source", mixing.n_tokens("text").alias("n")).groupBy("source").sum("n").collect()
    longest = docs.select(mixing.n_tokens("text").alias("n")).agg({"n": "max"}).first()[0]
    weights = np.array([r["weight"] for r in plan.values()])
    assert weights.sum() == pytest.approx(1)
    assert -(weights * np.log(weights)).sum() >= 0.97 * math.log(len(weights)) - 1e-6 or max(
        r["quota"] / r["total"] for r in plan.values()) > 1.99
    for r in drawn:
        quota = plan[r["source"]]["quota"]
        assert quota - longest - plan[r["source"]]["total"] / 500 <= r["sum(n)"] <= quota
    assert all(r["quota"] <= 2.0 * r["total"] + 1 for r in plan.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_quotas_are_met_where_rows_share_an_id_or_have_none(spark, seed):
    """Source a: a third of the rows are one row; b: half have no id; c is large, so that a and b are drawn in part epochs."""
    rows = [(7, "the same five words here", "a")] * 800 + [(100 + i, f"a {i} some words", "a") for i in range(1600)]
    rows += [(None, f"b {i} of many words", "b") for i in range(1200)] + [(5000 + i, f"b {i} words", "b") for i in range(1200)]
    rows += [(10_000 + i, " ".join(["c"] * 10), "c") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).cache()
    config = mixing.MixConfig(entropy=0.9, max_repeats=4.0, budget=0.4, blocks=64, seed=seed)
    plan = {r["source"]: r for r in mixing.plan(docs, config).collect()}
    drawn = {r["source"]: r["n"] for r in mixing.mix(docs, config).groupBy("source").agg(F.sum(mixing.n_tokens("text")).alias("n")).collect()}
    assert 0.05 < plan["a"]["quota"] / plan["a"]["total"] % 1 < 0.98
    for source, r in plan.items():
        assert r["quota"] - 10 - r["total"] / 500 <= drawn[source] <= r["quota"]


# -- op6 -------------------------------------------------------------------
def test_token_files_equal_whole_text_encoding(spark, documents):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    got = {r["doc_id"]: tuple(r)[1:] for r in catalogue.QUERIES["op6_token_files"](spark, SF).collect()}
    start = 0
    for i, t in documents:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_words_in_turn_are_the_whole_text():
    encode = token_files.encoder("word_bpe_49k.json", 50)
    odd = ["İstanbul ﬁ Straße é a ́b  x <|endoftext|> 's don't 12a # ß ẞ ½a aª² _a_ K ŉ. ΑΣ Σ, \x1c \x85 ‍a a.b, ,a <|EndOfText|>",
           "", " ", "a, a. a! A, b", "ea*** ea%%% ea### ea"]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in encode.tokenizer.encode_batch(odd, add_special_tokens=False)]
    assert encode.encode([t.encode() for t in odd]) == want == encode.encode([t.encode() for t in odd])
    assert len(encode.known) <= 50


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(bits)
    config = token_files.FileConfig(plane_bits=bits, block=1000)
    for ids in (np.zeros(0, np.uint32), np.array([0], np.uint32), np.array([2**32 - 1, 5], np.uint32),
                rng.integers(0, 50_000, 4321).astype(np.uint32)):
        assert (token_files.unpack(token_files.pack(ids, config)) == ids).all()
    with pytest.raises(ValueError):
        token_files.unpack(b"x" * 16)


# -- op7 -------------------------------------------------------------------
def test_contaminations_are_those_of_brute_force(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    norm = lambda t: b" " + b" ".join(decontamination.words_of(t.encode())) + b" "
    whole = {(i, k) for i, t in documents for k, q in items if norm(q) in norm(t)}
    for config in (decontamination.SearchConfig(), decontamination.SearchConfig(max_items=9)):  # one shard, and several
        got = decontamination.contaminations(table(spark, SF, "documents"), table(spark, SF, "benchmark"), config)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == whole


def test_retrieval_is_that_of_plain_bm25():
    rng = random.Random(1)
    items = [(i, b" ".join(b"t%d" % min(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(3, 30))), None) for i in range(90)]
    frequency = collections.Counter(w for _, t, _ in items for w in set(t.split()))
    average = sum(len(t.split()) for _, t, _ in items) / 90
    config = decontamination.SearchConfig(block=7, least_score=0.35)
    index = decontamination.Index(items, frequency, 90, average, config)

    def bm25(query, text):
        tf, out = collections.Counter(text), 0.0
        for w in set(query) & set(text):
            idf = math.log1p((90 - frequency[w] + 0.5) / (frequency[w] + 0.5))
            out += idf * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(text) / average))
        return out

    for _ in range(40):
        query = [b"t%d" % rng.randint(0, 60) for _ in range(25)]
        terms = np.unique([index.terms[w] for w in query if w in index.terms])
        want = {i for i, (_, t, _) in enumerate(items) if bm25(query, t.split()) >= 0.35 * bm25(t.split(), t.split())}
        assert set(index.retrieve(np.zeros(len(terms), int), terms)[1].tolist()) == want


def test_short_items_beside_a_very_long_one(spark):
    short = [f"w{i}" for i in range(10)]
    filler = lambda k, n: [f"f{k}_{i}" for i in range(n)]
    scattered = [w for i in range(9) for w in short[i: i + 2] + filler(i, 60)]
    long = filler(99, 3000)
    docs = spark.createDataFrame([(1, " ".join(scattered)), (2, " ".join(filler(5, 700) + short + filler(6, 700))), (3, " ".join(filler(7, 50) + long))],
                                 "doc_id long, text string")
    items = [(1, " ".join(short)), (2, " ".join(long)), (3, "one two three four")]
    for some in (items, items[::2]):
        for config in (decontamination.SearchConfig(), decontamination.SearchConfig(max_items=1)):
            got = decontamination.contaminations(docs, spark.createDataFrame(some, "item_id long, text string"), config).collect()
            assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(2, 1)] + [(3, 2)] * (some is items)


# -- op8 -------------------------------------------------------------------
def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    found = catalogue.QUERIES["op8_quality_classifier"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert auc(found.score.tolist(), found.quality.tolist()) > 0.97
    assert (found.predicted[found.quality == 1] == 1).mean() > 0.95


def test_network_looks_at_the_end_of_a_long_text():
    sample = [(0, b"plain words here " * 20 + b"@@@@@"), (1, b"plain words here " * 20)] * 60
    net = quality_classifier.fit(sample, {0: 60, 1: 60}, quality_classifier.NetConfig(epochs=8))
    clean, spoilt = b"plain words here " * 20_000, b"plain words here " * 20_000 + b"@@@@@"
    a, b = net.probability([clean, spoilt])
    assert net.probability([sample[0][1]])[0] < 0.3 < 0.7 < net.probability([sample[1][1]])[0]
    assert b < a
    together = net.probability([b"", clean, b"x", spoilt])
    assert together[1] == pytest.approx(a) and together[3] == pytest.approx(b)  # neighbours do not matter


# -- op9 -------------------------------------------------------------------
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(kind, m[0]))


EVIL = ["1 2 3 4 5 6 7 8 9 " * 2000, "a@b.c_d@e.f x@y@z.w " * 300, "1.2.3.4.5.6.7.8 +1 (2", "4111 1111 1111 1111 " * 300,
        "é+12 345 678 9012\U0001F600 a.b@c-d.e.", "", None, "9" * 40000, "a" * 50000 + "@b.c", "+" + "1 " * 20000,
        "4111-1111-1111-1111-5 4111111111111111 256.1.1.1 001.02.3.255", "x@y.z" * 2000]


def test_base_spans_equal_plain_patterns(spark, documents):
    docs = documents + [(10_000 + i, t) for i, t in enumerate(EVIL)]
    found = personal_data.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    for r in found:
        assert [tuple(s) for s in r["base"]] == base_spans(texts[r["doc_id"]])
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
    assert any(len(r["spans"]) > len(r["base"]) for r in found)


def test_base_spans_without_runs_of_digits(spark):
    texts = ["call +33 1 23 45 67 89 now", "paid 41 11 11 11 11 11 11 11 today", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "+3(3)1-2.3 4-5 6-7 8-9"]
    found = personal_data.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: [tuple(s) for s in r["base"]] for r in found} == {i: base_spans(t) for i, t in enumerate(texts)}
    assert all(r["base"] for r in found)


def test_spaced_forms_without_context_are_no_addresses(spark):
    rows = [f"please mail ann{i} [at] host{i}.org today" for i in range(40)] + [f"we look @ home{i}.now and then" for i in range(40)]
    rows += [f"see x{i}@site{i}.net" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: r["s"] for r in personal_data.personal_data(docs).select("doc_id", personal_data.joined("spans").alias("s")).collect()}
    assert all(found[i].startswith("email:12:") for i in range(40))
    assert all(found[i] == "" for i in range(40, 80))
    assert all(found[i].startswith("email:4:") for i in range(80, 120))


def test_candidates_inside_base_spans_of_a_crowded_text(spark):
    """Blocks of 256 spans: against a plain search over all base spans."""
    body = " ".join(f"call +1 415 555 {i:04d} or 415 555 {i:04d}, card 4111 1111 1111 1111, 10.0.{i % 256}.7" for i in range(900))
    docs = spark.createDataFrame([(1, body), (2, "call 415 555 0000"), (3, None)], "doc_id long, text string")
    found = personal_data.spans(docs)
    everything = sorted({c["pattern"] for r in found.collect() for c in r["more"]})
    original = personal_data.accepted
    try:
        personal_data.accepted = lambda *_: everything
        got = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in personal_data.personal_data(docs).collect()}
    finally:
        personal_data.accepted = original
    for r in found.collect():
        base = {tuple(b) for b in r["base"]}
        plain = base | {(c["start"], c["kind"], c["end"]) for c in r["more"] if not any(a <= c["start"] and c["end"] <= e for a, _, e in base)}
        assert got[r["doc_id"]] == sorted(plain)
    assert len(got[1]) > 3000 and got[3] == []


def test_redaction_keeps_a_column_of_its_own_name(spark):
    docs = spark.createDataFrame([(1, "a@b.cd here", 7), (2, None, 8)], "doc_id long, text string, spans int")
    got = [tuple(r) for r in personal_data.redact(docs, personal_data.personal_data(docs)).orderBy("doc_id").collect()]
    assert got == [(1, "a@b.cd here", 7, "[email] here"), (2, None, 8, None)]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é a.b@c.d x 1.2.3.4"), (2, "none"), (3, None)], "doc_id long, text string")
    found = personal_data.personal_data(docs)
    got = {r["doc_id"]: r["redacted"] for r in personal_data.redact(docs, found).collect()}
    assert got == {1: "é [email] x [ip]", 2: "none", 3: None}


# -- op10 ------------------------------------------------------------------
def components(docs, size, percent=80):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[p: p + size]) for p in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(sets, key=lambda i: len(sets[i]))
    for k, a in enumerate(order):
        for b in order[k + 1:]:
            if not sets[a] or 100 * len(sets[a]) < percent * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, documents):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    docs = list(documents)
    for f in range(6):  # families around the threshold
        base = [rng.choice(words) for _ in range(120)]
        for k in range(12):
            copy = [w if rng.random() > 0.015 * (k % 5) else rng.choice(words) for w in base]
            docs.append((20_000 + 100 * f + k, " ".join(copy)))
    docs += [(30_000, "One"), (30_001, "one"), (30_002, None), (30_003, " \n"), (30_004, "")]
    got = setsketch.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), setsketch.QUERY_CONFIG).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(docs, 2)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_partners_in_a_hot_band_are_found(spark):
    docs = []
    for k in range(60):  # pairs on one template: the two are linked (200 of 248), the pairs are not (199 of 249)
        for side in range(2):
            words = [f"t{i}" for i in range(200)] + [f"p{k}"] + [f"d{k}_{side}_{i}" for i in range(24)]
            docs.append((2 * k + side, " ".join(words)))
    got = setsketch.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), setsketch.SketchConfig(shingle=2, rounds=1, salt=7)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(docs, 2)
    assert sum(r["kept"] for r in got) == 60


def test_sketches_merge_and_estimate():
    config, rng = setsketch.SketchConfig(), np.random.default_rng(0)
    factors = setsketch.multipliers(config)
    members = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = members[:2000], members[500:]
    one, other = (setsketch.registers_of(x, factors, config) for x in (a, b))
    assert (setsketch.merge(one, other) == setsketch.registers_of(members, factors, config)).all()
    got = setsketch.estimate(one[None], other[None], np.array([2000.0]), np.array([2500.0]), config)[0]
    assert abs(got - 0.5) < 0.1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 300)], "a long, b long")
    found = {r["rep"]: r["component"] for r in setsketch.components(links).collect()}
    assert all(found[i] == 0 for i in range(1, 201)) and found[500] == 300


def test_small_tables_get_few_files_and_few_steps(spark, documents, monkeypatch):
    stored, store = [], setsketch.store

    def counting(df, name, *args):
        out = store(df, name, *args)
        stored.append((name, len(out.df.inputFiles()), out.df.count()))
        return out

    monkeypatch.setattr(setsketch, "store", counting)
    monkeypatch.setattr(setsketch, "materialise", lambda df, name: counting(df, name).df)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = [(i, t) for i, t in list(documents)[:150]] + [(50_000 + i, " ".join(f"w{j}" for j in range(60 + i))) for i in range(8)]
    try:
        got = setsketch.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), setsketch.QUERY_CONFIG).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(docs, 2)
    assert all(n == 1 for name, n, _ in stored if name in ("classes", "shared", "pairs", "texts", "links", "left"))
    rounds = [i for i, (name, _, _) in enumerate(stored) if name == "tried"]
    assert len(rounds) <= 3  # one that finds all links, one that finds none, and the exact join


def test_components_take_stars_found_before(spark, monkeypatch):
    steps, store = [], setsketch.store
    monkeypatch.setattr(setsketch, "store", lambda df, name: steps.append(name) or store(df, name))
    stars = spark.createDataFrame([(i, i // 10 * 10) for i in range(100) if i % 10], "a long, b long")
    assert {r["rep"]: r["component"] for r in setsketch.components(stars).collect()} == {i: i // 10 * 10 for i in range(100) if i % 10}
    assert len(steps) == 1  # no step only to see that nothing changes
    known = setsketch.components(stars)
    assert setsketch.extended(known, stars.limit(0)) is known
    links = spark.createDataFrame([(57, 13, 1, 1), (99, 57, 1, 1), (200, 201, 1, 1)], "a long, b long, common long, total long")
    found = {r["rep"]: r["component"] for r in setsketch.extended(known, links).collect()}
    joined = {r["rep"]: r["component"] for r in setsketch.components(links.select("a", "b").unionByName(stars)).collect()}
    assert found == joined and found[50] == found[99] == found[90] == 10 and found[201] == 200 and found[45] == 40
