"""Quality classifier: random-indexing word vectors, a small network, calibrated probabilities.

1. Word vectors. Every token falls into one of ``BUCKETS`` hash buckets and
   every bucket has a fixed sparse ternary index vector. The vector of a bucket is
   the sum of the index vectors of its left and right neighbours over the
   whole corpus: each task sums its own matrix, Spark sums the matrices in
   blocks of buckets.
2. Pooling. A document is the mean and the spread of its tokens' vectors, the mean
   step between neighbours, and its length; all of its tokens count.
3. Network. Two layers in numpy, fitted on at most ``LEARN_ROWS`` labelled rows
   (the first by a hash of the id), with a temperature fitted on a fifth of
   them that the network has not seen.

Defined cases: a null or empty text has no tokens and is scored from zero
features; labels that are null or without a document are not learned from; a
document labelled twice is learned twice; with labels of one kind only, or
none, every score is their share (0.5 without any); an empty table gives an
empty result; other columns are kept.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import BATCH_ROWS, map_texts, per_worker

BUCKETS, DIMS, NONZERO = 8192, 24, 4
BLOCK = 512              # buckets whose vectors are summed in one row
LEARN_ROWS = 20_000      # documented bound of the labelled sample the network is fitted on
HIDDEN, EPOCHS, STEP, DECAY = 24, 60, 0.01, 1e-4
SEED = 7
CACHED_CHUNKS = 400_000
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


@functools.lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    """(BUCKETS, NONZERO) places and signs of the ternary index vectors."""
    draw = np.random.RandomState(SEED)
    places = np.argsort(draw.rand(BUCKETS, DIMS), axis=1)[:, :NONZERO]
    return places.astype(np.int64), draw.choice([-1.0, 1.0], (BUCKETS, NONZERO))


class TokenCache(dict):
    """Chunk between spaces -> its buckets as int32 bytes."""

    def __missing__(self, chunk: str) -> bytes:
        ids = [zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in TOKEN.findall(chunk)]
        found = np.array(ids, np.int32).tobytes()
        if len(self) > CACHED_CHUNKS:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = found
        return found


def _tokens() -> TokenCache:
    return per_worker("tokens", TokenCache)


def buckets(text: str, cache: TokenCache) -> np.ndarray:
    return np.frombuffer(b"".join(map(cache.__getitem__, text.split())), np.int32)


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(BUCKETS, DIMS) sums of neighbours' index vectors over every document."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def neighbours(texts):
        cache = _tokens()
        for text in texts:
            b = buckets(text, cache)
            yield b[:-1], b[1:]

    def count(batches):
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMS)
        for batch in batches:
            pairs = list(neighbours(x for x in batch.column(0).to_pylist() if x))
            if pairs:
                left, right = (np.concatenate(side).astype(np.int64) for side in zip(*pairs))
                for own, other in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        total += np.bincount(own * DIMS + places[other, k], signs[other, k], BUCKETS * DIMS)
        for block in range(0, BUCKETS, BLOCK):
            part = total[block * DIMS:(block + BLOCK) * DIMS].astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part], pa.binary())], names=["block", "sums"])

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in table.column("sums").to_pylist())
        return pa.table({"block": table.column("block")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    # in two steps, so that no task meets the matrices of all tasks
    each = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "block int, sums binary")
    some = each.groupBy("block", F.pmod(F.spark_partition_id(), F.lit(16)).alias("lane"))
    once = some.applyInArrow(lambda t: merge(t.select(["block", "sums"])), "block int, sums binary")
    rows = once.groupBy("block").applyInArrow(merge, "block int, sums binary").collect()  # BUCKETS x DIMS numbers
    total = np.zeros((BUCKETS, DIMS))
    for r in rows:
        total[r["block"]:r["block"] + BLOCK] = np.frombuffer(r["sums"], "<f8").reshape(-1, DIMS)
    return total


def word_vectors(sums: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.where(norm == 0, 1, norm)).astype(np.float32)


N_FEATURES = 3 * DIMS + 1


def pool(b: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of one document from the buckets of all its tokens."""
    out = np.zeros(N_FEATURES, np.float32)
    if len(b):
        total, square, step = (np.zeros(DIMS) for _ in range(3))
        for at in range(0, len(b), 1 << 16):
            v = vectors[b[max(0, at - 1):at + (1 << 16)]]
            step += np.abs(np.diff(v, axis=0)).sum(axis=0)
            v = v[1:] if at else v
            total += v.sum(axis=0)
            square += (v * v).sum(axis=0)
        mean = total / len(b)
        out[:DIMS] = mean
        out[DIMS:2 * DIMS] = np.sqrt(np.maximum(square / len(b) - mean * mean, 0))
        out[2 * DIMS:3 * DIMS] = step / len(b)
        out[-1] = np.log1p(len(b)) / 10
    return out


class Network:
    """Two layers; ``probability`` is divided by the temperature before the logistic curve."""

    def __init__(self, share: float):
        self.share, self.w1 = share, None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.std) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.w1 is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    share = float(y.mean()) if len(y) else 0.5
    net = Network(share)
    if len(y) < 20 or share in (0.0, 1.0):
        return net
    draw = np.random.RandomState(SEED)
    order = draw.permutation(len(y))
    held, used = order[:len(y) // 5], order[len(y) // 5:]
    net.mean, net.std = x.mean(axis=0), x.std(axis=0) + 1e-6
    weights = [draw.randn(x.shape[1], HIDDEN) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), draw.randn(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    z, t = (x - net.mean) / net.std, 0
    for _ in range(EPOCHS):
        mixed = draw.permutation(used)
        for at in range(0, len(mixed), 256):
            rows = mixed[at:at + 256]
            w1, b1, w2, b2 = weights
            h = np.tanh(z[rows] @ w1 + b1)
            d = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -60, 60))) - y[rows]) / len(rows)
            back = np.outer(d, w2) * (1 - h * h)
            grads = [z[rows].T @ back + DECAY * w1, back.sum(axis=0), h.T @ d + DECAY * w2, d.sum(keepdims=True)]
            t += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] = weights[i] - STEP * (first[i] / (1 - 0.9 ** t)) / (np.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights
    logits, target = net.logits(x[held]), y[held]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _features(docs: DataFrame, text_col: str, vectors: np.ndarray, added: str, finish) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def start():
        table, cache = shared.value, _tokens()
        return lambda texts: finish(np.stack([pool(buckets(t.decode("utf-8", "replace"), cache), table) for t in texts]))

    return map_texts(docs, text_col, added, start)


def learn(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text") -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs``, the network from the labelled rows that are not held out."""
    vectors = word_vectors(context_sums(docs, text_col))
    used = (labels.select(F.col(id_col).alias("_label_id"), F.col(label_col).cast("double").alias("_label"))
            .where(F.col("_label_id").isNotNull() & F.col("_label").isNotNull() & ~held_out("_label_id"))
            .orderBy(F.xxhash64("_label_id"), "_label_id", "_label").limit(LEARN_ROWS))
    # LEARN_ROWS rows at most
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(used), F.col("_id") == F.col("_label_id"))
    found = _features(rows, "_text", vectors, "features array<float>",
                      lambda x: [pa.array(list(x), pa.list_(pa.float32()))])
    got = found.select("doc._id", "doc._label", "features").collect()
    got.sort(key=lambda r: (r[0], r[1], r[2]))
    x = np.array([r[2] for r in got], np.float64).reshape(-1, N_FEATURES)
    return vectors, fit(x, np.array([r[1] for r in got]))


def score(docs: DataFrame, model: tuple[np.ndarray, Network], text_col: str = "text") -> DataFrame:
    """``doc`` with score: the calibrated probability of label 1."""
    vectors, net = model
    return _features(docs, text_col, vectors, "score double", lambda x: [pa.array(net.probability(x.astype(np.float64)))])
