"""Toxicity: a linear-chain conditional random field over tokens.

Documents are labelled as a whole. Tokens get their labels from that: words, and
beginnings of words, that stand significantly more often in toxic documents than
in others are the field's vocabulary, their occurrences in toxic documents are
labelled toxic, all other tokens clean. (Near copies count once there, or every
word of a copied document would look significant.) The field (two states, a
weight per entry of the vocabulary, one for all other words, transitions) is
fitted by gradient ascent on the likelihood of these labels. Scoring runs forward-backward over the whole document: between
two vocabulary words all tokens look alike to the field, so that stretch is a
power of one matrix, exactly, whatever its length. The marginals give the
offending offsets; their sum, maximum and share give the document score by a
logistic unit calibrated on the documents' own labels.

Defined results: null and empty texts hold no tokens and get the score of a
document without findings; repeated rows score alike; an empty table gives an
empty result; without toxic documents to learn from nothing is a finding.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import class_shares, fold, labelled_sample, map_slices, raw, table

#: A-Z to lower case, ASCII punctuation to spaces; offsets stay.
FOLD = bytes(32 if chr(b) in string.punctuation else b for b in bytes(range(256)).lower())
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class FieldConfig:
    per_class: int = 3000   #: bound on the labelled documents that are learned from, per class
    max_chars: int = 20_000  #: of a document that is learned from; longer ones are scored like all others
    least_docs: int = 3     #: toxic documents a vocabulary entry is in
    least_gain: float = 15.0  #: likelihood ratio (2 ln) against equal frequency in both classes
    least_ratio: float = 5.0  #: of its frequency in toxic and other documents
    beginnings: tuple[int, ...] = (4, 5)  #: bytes of the beginnings of words that are tried
    vocabulary: int = 5000
    stretch: int = 32       #: tokens of a training sequence
    clean_stretches: int = 4000
    steps: int = 80
    rate: float = 0.15
    l2: float = 1e-3
    least: float = 0.5      #: marginal of a reported offset


@dataclass
class Field:
    """emit[w]: log weight of state toxic (against clean) for word w, 0 is any other word; step[i, j]: transitions."""

    words: dict[tuple[int, bytes], int]  # (0, word) or (n, the first n bytes of longer words)
    emit: np.ndarray
    step: np.ndarray
    start: float
    unit: np.ndarray = field(default_factory=lambda: np.zeros(4))
    config: FieldConfig = field(default_factory=FieldConfig)

    def __post_init__(self):
        # One token of no vocabulary word: a 2x2 matrix, and its powers in closed form.
        m = np.exp(self.step) * np.array([1.0, math.exp(self.emit[0])])[None, :]
        values, vectors = np.linalg.eig(m)
        order = np.argsort(-np.abs(values))
        values, vectors = values[order].real, vectors[:, order].real
        inverse = np.linalg.inv(vectors)
        self.main = np.outer(vectors[:, 0], inverse[0]).tolist()
        self.rest = np.outer(vectors[:, 1], inverse[1]).tolist()
        self.ratio = float(values[1] / values[0])
        self.moves = np.exp(self.step).tolist()
        self.odds = np.exp(self.emit).tolist()
        self.first = [1.0, math.exp(self.start)]
        self.heads = heads_of(self.words)

    def gap(self, n: int) -> list[list[float]]:
        """The matrix of ``n`` other tokens, up to a factor."""
        r = self.ratio ** n
        (a, b), (c, d) = self.main
        (e, f), (g, h) = self.rest
        return [[a + r * e, b + r * f], [c + r * g, d + r * h]]

    def marginals(self, places: list[int], ids: list[int], n: int) -> list[float]:
        """Probability of the toxic state at each vocabulary word of a document of ``n`` tokens."""
        moves, odds = self.moves, self.odds
        forward, before = [], -1
        x, y = self.first
        for k, (at, w) in enumerate(zip(places, ids, strict=True)):
            skipped = at - before - 1
            if k == 0:
                if skipped:  # the first token is another word
                    y *= odds[0]
                    m = self.gap(skipped - 1)
                    x, y = x * m[0][0] + y * m[1][0], x * m[0][1] + y * m[1][1]
                    x, y = x * moves[0][0] + y * moves[1][0], x * moves[0][1] + y * moves[1][1]
            else:
                m = self.gap(skipped)
                x, y = x * m[0][0] + y * m[1][0], x * m[0][1] + y * m[1][1]
                x, y = x * moves[0][0] + y * moves[1][0], x * moves[0][1] + y * moves[1][1]
            y *= odds[w]
            total = x + y
            x, y = x / total, y / total
            forward.append((x, y))
            before = at
        out = [0.0] * len(places)
        m = self.gap(n - 1 - before)
        u, v = m[0][0] + m[0][1], m[1][0] + m[1][1]
        for k in range(len(places) - 1, -1, -1):
            x, y = forward[k]
            out[k] = y * v / (x * u + y * v)
            if k:
                v *= odds[ids[k]]
                u, v = moves[0][0] * u + moves[0][1] * v, moves[1][0] * u + moves[1][1] * v
                m = self.gap(places[k] - places[k - 1] - 1)
                u, v = m[0][0] * u + m[0][1] * v, m[1][0] * u + m[1][1] * v
                total = u + v
                u, v = u / total, v / total
        return out

    def findings(self, text: bytes) -> tuple[int, list[int], list[float]]:
        """Tokens of a text, places of its vocabulary words, and their marginals."""
        words = text.translate(FOLD).split()
        heads, cut = self.heads, HEAD
        hits = [(i, number_of(w, self.words, self.config)) for i, w in enumerate(words) if w[:cut] in heads]
        hits = [(i, k) for i, k in hits if k]
        if not hits:
            return len(words), [], []
        places, ids = zip(*hits, strict=True)
        return len(words), list(places), self.marginals(places, ids, len(words))

    def features(self, n: int, marginals: list[float]) -> list[float]:
        if not marginals:
            return [1.0, 0.0, 0.0, 0.0]
        total = sum(marginals)
        return [1.0, math.log1p(total), max(marginals), total / n * 10]

    def score(self, n: int, marginals: list[float]) -> float:
        z = float(np.dot(self.unit, self.features(n, marginals)))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


HEAD = 4  # bytes by which a token is first looked up


def heads_of(words: dict[tuple[int, bytes], int]) -> set[bytes]:
    return {w[:HEAD] for _, w in words}


def number_of(word: bytes, words: dict[tuple[int, bytes], int], config: FieldConfig) -> int:
    """The vocabulary entry of a token, the most general one first; 0 if there is none."""
    for n in config.beginnings:
        if len(word) > n and (n, word[:n]) in words:
            return words[n, word[:n]]
    return words.get((0, word), 0)


def entries_of(text: bytes, config: FieldConfig) -> set[tuple[int, bytes]]:
    """The words of a text and the beginnings of its longer words."""
    words = set(text.translate(FOLD).split())
    return {(0, w) for w in words}.union(*({(n, w[:n]) for w in words if len(w) > n} for n in config.beginnings))


def vocabulary(sample: list[tuple[int, bytes]], config: FieldConfig) -> list[tuple[int, bytes]]:
    """Entries significantly more frequent in toxic documents, most significant first; ties by the entry.

    An entry that a shorter chosen beginning covers is left out.
    """
    groups: list[dict[tuple, list[bytes]]] = [{}, {}]
    for y, text in sample:
        # Near copies mostly share the two smallest hashes of their words.
        mark = tuple(sorted(map(zlib.crc32, set(text.translate(FOLD).split())))[:2])
        groups[y].setdefault(mark, []).append(text)
    if not all(groups):
        return []
    # One group at a time, and of the other documents only what enough toxic ones hold: the driver never has the entries of all.
    seen: list[dict[tuple[int, bytes], int]] = [{}, {}]
    for y in (1, 0):
        count, wanted = seen[y], seen[1] if y == 0 else None
        for texts in groups[y].values():
            for e in set().union(*(entries_of(text, config) for text in texts)):
                if wanted is None or e in wanted:
                    count[e] = count.get(e, 0) + 1
        if y == 1:
            seen[1] = {e: a for e, a in count.items() if a >= config.least_docs}
    share = len(groups[1]) / (len(groups[0]) + len(groups[1]))
    found = []
    for e, a in seen[1].items():
        b = seen[0].get(e, 0)
        if a / len(groups[1]) < config.least_ratio * b / len(groups[0]):
            continue
        gain = 2 * (a * math.log(a / (a + b) / share) + (b * math.log(b / (a + b) / (1 - share)) if b else 0))
        if gain >= config.least_gain:
            found.append((-gain, e))
    chosen: list[tuple[float, tuple[int, bytes]]] = []
    for size in (*config.beginnings, 0):
        taken = {e for _, e in chosen}
        chosen += [(g, (n, w)) for g, (n, w) in found if n == size
                   and not any(len(w) > k and (k, w[:k]) in taken for k in config.beginnings)]
    return [e for _, e in sorted(chosen)[: config.vocabulary]]


def fit_field(sample: list[tuple[int, bytes]], words: list[tuple[int, bytes]], config: FieldConfig) -> Field:
    """Weights by gradient ascent (Adam) on stretches of labelled tokens."""
    number = {w: i + 1 for i, w in enumerate(words)}
    heads = heads_of(number)
    rng = np.random.default_rng(3)
    ids, labels, plain = [], [], []
    for y, text in sample:
        row = np.array([number_of(w, number, config) if w[:HEAD] in heads else 0
                        for w in text.translate(FOLD).split()], dtype=np.int64)
        for a in range(0, len(row), config.stretch):
            part = np.full(config.stretch, -1)
            cut = row[a: a + config.stretch]
            part[: len(cut)] = cut
            if (cut > 0).any():
                ids.append(part), labels.append((part > 0) & (y == 1))
            else:
                plain.append(part)
    kept = rng.permutation(len(plain))[: config.clean_stretches]
    weight = np.concatenate([np.ones(len(ids)), np.full(len(kept), len(plain) / max(1, len(kept)))])
    x = np.array(ids + [plain[i] for i in kept]).reshape(-1, config.stretch)
    t = np.array(labels + [plain[i] > 0 for i in kept]).reshape(-1, config.stretch).astype(np.int64)
    weight = weight / weight.sum()
    live = x >= 0
    n_words = len(words) + 1
    theta = np.concatenate([[-4.0], np.full(len(words), 1.0), [0.0, -1.0, 0.0, 0.5], [-2.0]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    safe = np.maximum(x, 0)
    for step in range(1, config.steps + 1 if len(x) else 1):
        emit, move, start = theta[:n_words], theta[n_words: n_words + 4].reshape(2, 2), theta[-1]
        e = np.stack([np.ones(x.shape), np.exp(emit[safe])], axis=2)
        m = np.exp(move)
        alpha = np.empty((*x.shape, 2))
        a = np.array([1.0, math.exp(start)])[None, :] * e[:, 0]
        alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
        for k in range(1, config.stretch):
            a = (alpha[:, k - 1] @ m) * e[:, k]
            a = np.where(live[:, k, None], a, alpha[:, k - 1])
            alpha[:, k] = a / a.sum(axis=1, keepdims=True)
        beta = np.ones((len(x), 2))
        grad = np.zeros_like(theta)
        for k in range(config.stretch - 1, -1, -1):
            p = alpha[:, k] * beta
            p /= p.sum(axis=1, keepdims=True)
            diff = np.where(live[:, k], t[:, k] - p[:, 1], 0) * weight
            grad[:n_words] += np.bincount(safe[:, k], diff, n_words)
            if k == 0:
                grad[-1] += diff.sum()
                break
            after = e[:, k] * beta
            pair = alpha[:, k - 1, :, None] * m[None] * after[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            use = live[:, k]
            for i in (0, 1):
                for j in (0, 1):
                    seen = (t[:, k - 1] == i) & (t[:, k] == j)
                    grad[n_words + 2 * i + j] += (np.where(use, seen - pair[:, i, j], 0) * weight).sum()
            b = after @ m.T
            b = np.where(use[:, None], b, beta)
            beta = b / b.sum(axis=1, keepdims=True)
        grad -= config.l2 * theta / max(1, len(x))
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        theta += config.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-10)
    return Field(number, theta[:n_words], theta[n_words: n_words + 4].reshape(2, 2), float(theta[-1]), config=config)


def calibrate(model: Field, sample: list[tuple[int, bytes]], shares: dict[int, int]) -> None:
    """The logistic unit, fitted by Newton's method to the documents' labels, classes weighed as in the whole."""
    known = sum(shares.values())
    prior = (shares.get(1, 0) + 1) / (known + 2)
    y = np.array([y for y, _ in sample], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        model.unit[:] = [math.log(prior / (1 - prior)), 0, 0, 0]
        return
    rows = []
    for _, text in sample:
        n, _, marginals = model.findings(text)
        rows.append(model.features(n, marginals))
    x = np.array(rows)
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    w = np.zeros(4)
    ridge = np.diag([1e-6, 1.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - ridge @ w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        change = np.linalg.solve(h, g)
        w += change
        if np.abs(change).max() < 1e-8:
            break
    model.unit[:] = w


def train(documents: DataFrame, labels: DataFrame, learn, config: FieldConfig = FieldConfig()) -> Field:
    """Fits the field to ``labels.toxic`` of the rows of ``labels`` that ``learn`` picks."""
    sample = labelled_sample(documents, labels, "toxic", learn, config.per_class, config.max_chars)
    model = fit_field(sample, vocabulary(sample, config), config)
    calibrate(model, sample, class_shares(labels, "toxic", learn))
    return model


def score(documents: DataFrame, model: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, n_toxic, offsets) of every row.

    offsets: (start, end, p) of the tokens whose marginal reaches the least one,
    in code points of the text, end exclusive; n_toxic: the sum of all marginals.
    """
    fixed = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary
    kind = documents.schema[key].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = fixed.value
        scores, sums, offsets = [], [], []
        for body in batch.column(1).to_pylist():
            n, places, marginals = m.findings(body)
            scores.append(m.score(n, marginals)), sums.append(sum(marginals))
            wanted = {i: p for i, p in zip(places, marginals, strict=True) if p >= m.config.least}
            found, chars, at = [], 0, 0
            if wanted:
                for i, word in enumerate(WORD.finditer(body.translate(FOLD))):
                    if i in wanted:
                        chars += len(body[at: word.start()].decode())
                        size = len(body[word.start(): word.end()].decode())
                        found.append({"start": chars, "end": chars + size, "p": wanted[i]})
                        chars, at = chars + size, word.end()
            offsets.append(found)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64()), pa.array(sums, pa.float64()), pa.array(offsets, pa.list_(span))],
            names=["key", "score", "n_toxic", "offsets"])

    rows = documents.select(F.col(key).alias("key"), raw(text).alias("body"))
    return map_slices(rows, work, f"key {kind}, score double, n_toxic double, offsets array<struct<start:long,end:long,p:double>>",
                      "body").withColumnRenamed("key", key)


THRESHOLD = 0.7


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: score of every document; learned from the folds 0 and 2 of 3."""
    documents = table(spark, sf_dir, "documents")
    model = train(documents, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return score(documents, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("offsets").cast("long").alias("n_spans"))
