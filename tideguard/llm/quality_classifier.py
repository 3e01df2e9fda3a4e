"""Quality classifier: a byte-level convolutional network in numpy.

A document is its UTF-8 bytes. ``filters`` learned filters of ``width`` bytes
slide over every byte; each filter is max-pooled inside chunks of two half
chunks (consecutive chunks overlap by one half) that together cover the whole
document, and the pooled values are combined, as their mean and their maximum
over the chunks, into one probability by a logistic unit. No prefix, no cap:
the work is linear in the bytes of a document.

Defined results: a null text counts as empty; an empty text scores what the
network gives a document of padding; repeated rows score alike; an empty table
gives an empty result; the score depends on nothing but the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideguard.llm.common import class_shares, fold, free_name, labelled_sample, map_slices, raw, table

HALF = 512  # bytes of a half chunk; a chunk is two of them


@dataclass(frozen=True)
class NetConfig:
    width: int = 6
    filters: int = 12
    epochs: int = 6
    batch: int = 16
    rate: float = 0.02
    l2: float = 1e-5
    per_class: int = 1500  #: bound on the labelled documents that are learned from, per class
    seed: int = 7


@dataclass
class ByteNet:
    """Weights: ``table[j, byte]`` per filter, bias per filter, and the logistic unit."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    config: NetConfig = field(default_factory=NetConfig)

    # -- forward ---------------------------------------------------------
    def lay_out(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All texts in whole half chunks, zeros before and behind each; first half chunk of each."""
        pad = self.config.width - 1
        halves = np.array([-(-(len(t) + 2 * pad) // HALF) or 1 for t in texts])
        first = np.concatenate([[0], np.cumsum(halves)])
        flat = np.zeros(int(first[-1]) * HALF, dtype=np.uint8)
        for t, f in zip(texts, first.tolist(), strict=False):
            flat[f * HALF + pad: f * HALF + pad + len(t)] = np.frombuffer(t, dtype=np.uint8)
        return flat, first

    def pooled_halves(self, flat: np.ndarray, places: bool = False):
        """Maximum of each filter in each half chunk (and where it is)."""
        width, n = self.config.width, len(flat) // HALF
        best = np.empty((n, self.config.filters), dtype=np.float32)
        where = np.empty((n, self.config.filters), dtype=np.int64) if places else None
        step = 64  # half chunks at a time: small enough for the cache
        for a in range(0, n, step):
            b = min(n, a + step)
            lead = min(a * HALF, width - 1)
            part = flat[a * HALF - lead: b * HALF].astype(np.intp)
            z = np.take(self.table[0], part[lead:], axis=0)
            for j in range(1, width):
                if lead >= j:
                    z += np.take(self.table[j], part[lead - j: len(part) - j], axis=0)
                else:
                    z[j:] += np.take(self.table[j], part[: len(part) - j], axis=0)
                    z[:j] += self.table[j][0]
            z = z.reshape(b - a, HALF, -1)
            best[a:b] = z.max(axis=1)
            if places:
                where[a:b] = z.argmax(axis=1) + (np.arange(a, b) * HALF)[:, None]
        return best, where

    def features(self, best: np.ndarray, first: np.ndarray):
        """Mean and maximum over the overlapping chunks of each document, and which half chunk gave each chunk."""
        n = len(best)
        last = np.zeros(n, dtype=bool)
        last[first[1:] - 1] = True
        right = np.minimum(np.arange(n) + 1, n - 1)
        right[last] = np.flatnonzero(last)
        from_right = best[right] > best
        chunk = np.maximum(np.where(from_right, best[right], best) + self.bias, 0)
        # A chunk starts at every half chunk but the last one of a longer document.
        count = np.maximum(np.diff(first) - 1, 1)
        use = ~last
        use[first[:-1][np.diff(first) == 1]] = True
        used = np.where(use[:, None], chunk, 0)
        mean = np.add.reduceat(used, first[:-1], axis=0) / count[:, None]
        top = np.maximum.reduceat(used, first[:-1], axis=0)
        return mean, top, used, right, from_right, count

    def probability(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        flat, first = self.lay_out(texts)
        mean, top, *_ = self.features(self.pooled_halves(flat)[0], first)
        # Summed row by row: a product of matrices rounds by the number of rows, and equal texts must score alike.
        z = (np.hstack([mean, top]).astype(np.float64) * self.out).sum(axis=1) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(sample: list[tuple[int, bytes]], shares: dict[int, int], config: NetConfig = NetConfig()) -> ByteNet:
    """Trains on a bounded sample; ``shares`` (rows per class) weigh its classes as in the whole.

    Without a document of both classes the network answers the share of class 1 (a half if nothing is known).
    """
    rng = np.random.default_rng(config.seed)
    f, width = config.filters, config.width
    net = ByteNet(rng.normal(0, 0.3, (width, 256, f)).astype(np.float32), np.zeros(f, np.float32),
                  rng.normal(0, 0.1, 2 * f), 0.0, config)
    known = sum(shares.values())
    prior = (shares.get(1, 0) + 1) / (known + 2)
    if len({y for y, _ in sample}) < 2:
        net.out[:], net.shift = 0, float(np.log(prior / (1 - prior)))
        return net
    labels = np.array([y for y, _ in sample])
    weight = np.where(labels == 1, prior / (labels == 1).mean(), (1 - prior) / (labels == 0).mean())
    values = [net.table, net.bias, net.out, np.array([0.0])]
    moments = [(np.zeros_like(v, dtype=np.float64), np.zeros_like(v, dtype=np.float64)) for v in values]
    steps = 0
    for epoch in range(config.epochs):
        rate = config.rate * (1 - epoch / config.epochs)
        order = rng.permutation(len(sample))
        for a in range(0, len(order), config.batch):
            chosen = order[a: a + config.batch]
            flat, first = net.lay_out([sample[i][1] for i in chosen])
            best, where = net.pooled_halves(flat, places=True)
            mean, top, used, right, from_right, count = net.features(best, first)
            x = np.hstack([mean, top]).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(x @ net.out + net.shift, -60, 60)))
            error = (p - labels[chosen]) * weight[chosen] / len(chosen)
            grads = [np.zeros(net.table.shape), np.zeros(f), x.T @ error + config.l2 * net.out, np.array([error.sum()])]
            owner = np.repeat(np.arange(len(chosen)), np.diff(first))
            d_mean = (error[:, None] * net.out[None, :f] / count[:, None])[owner]
            is_top = used == top[owner]
            d_top = (error[:, None] * net.out[None, f:])[owner] * is_top
            down = (d_mean + d_top) * (used > 0)
            grads[1] = down.sum(axis=0)
            source = np.where(from_right, where[right], where)
            for k in range(f):
                live = np.flatnonzero(down[:, k])
                for j in range(width):
                    at = source[live, k] - j
                    byte = np.where(at >= 0, flat[np.maximum(at, 0)], 0)
                    grads[0][j, :, k] += np.bincount(byte, weights=down[live, k], minlength=256)
            steps += 1
            for v, g, (m1, m2) in zip(values, grads, moments, strict=True):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                v -= (rate * (m1 / (1 - 0.9 ** steps)) / (np.sqrt(m2 / (1 - 0.999 ** steps)) + 1e-8)).astype(v.dtype)
            net.shift = float(values[3][0])
    return net


def train(documents: DataFrame, labels: DataFrame, learn, config: NetConfig = NetConfig()) -> ByteNet:
    """Fits the network to ``labels.quality`` of the rows of ``labels`` that ``learn`` picks."""
    return fit(labelled_sample(documents, labels, "quality", learn, config.per_class),
               class_shares(labels, "quality", learn), config)


def score(documents: DataFrame, net: ByteNet, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row; other columns are not looked at."""
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(net)  # fixed size
    kind = documents.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model.value.probability(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["key", "score"])

    rows = documents.select(F.col(key).alias("key"), raw(text).alias("body"))
    return map_slices(rows, work, f"key {kind}, score double", "body").select(
        F.col("key").alias(key), "score")


def accepted(documents: DataFrame, net: ByteNet, threshold: float, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose score reaches ``threshold``; one pass, no join."""
    model = documents.sparkSession.sparkContext.broadcast(net)
    columns = documents.columns
    at = len(columns)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = model.value.probability(batch.column(at).to_pylist()) >= threshold
        return pa.RecordBatch.from_arrays(batch.columns[:at], schema=pa.schema(list(batch.schema)[:at])).filter(pa.array(keep))

    body = free_name("_body_of_the_row", columns)
    return map_slices(documents.withColumn(body, raw(text)), work, documents.schema, body).select(*columns)


THRESHOLD = 0.3


def learn_from():
    return fold("doc_id", 5) != 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: score of every document; learned from the folds 1 to 4 of 5."""
    documents = table(spark, sf_dir, "documents")
    net = train(documents, table(spark, sf_dir, "labels"), learn_from())
    return score(documents, net).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


