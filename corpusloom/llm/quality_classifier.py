"""Operator 2. Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities.

Word vectors. Words are hashed to `slots` ids; with more different words than slots, several share a vector. Each id has a sparse random index vector (a few +1 and -1 by hash); a word's vector is the sum
of the index vectors of the words up to `window` places away, over all documents, then scaled to unit length. Sums are integers, so the
order of tasks doesn't matter, and the table has slots x dims cells whatever the corpus.

Pooling. A text is the mean and the spread of its word vectors, the mean over its different words, and how many words it
has and how many of them are different.

Network. One hidden layer of tanh units and a logistic output, trained with Adam in numpy on at most `limit` labelled rows in the
order of a hash of the id, outside the held-out fold; a tenth of them is kept apart to choose the temperature that divides the logits.

Defined results: null and empty texts pool to zeros and get a score like any other; without labels of both kinds all scores
are the share of label 1 (0 without labels); labels with null ids or values are ignored, the largest of a repeated id wins; a null doc_id
counts as the empty text in the fold rule; repeated rows have equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_words, mix, pieces, remainder, sample_labels

SLOTS, DIMS, ONES, WINDOW = 1 << 16, 32, 2, 2
LIMIT, HIDDEN, EPOCHS = 20_000, 32, 30
CUT = 0.3


def index_vectors(slots: int = SLOTS, dims: int = DIMS, ones: int = ONES) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs (slots x ones) of the index vector of each slot."""
    h = mix(np.arange(slots * ones, dtype=np.uint64) + np.uint64(77))
    return (h % np.uint64(dims)).astype(np.int64).reshape(slots, ones), np.where(h >> np.uint64(63), 1.0, -1.0).reshape(slots, ones)


def slots_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, first = hashed_words(texts)
    return (h % np.uint64(SLOTS)).astype(np.int64), h, first


def cooccurrence(texts: pa.Array) -> np.ndarray:
    """Sum of the index vectors around each word, by slot."""
    slot, _, first = slots_of(texts)
    place, sign = index_vectors()
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = np.zeros(SLOTS * DIMS)
    for gap in range(1, WINDOW + 1):
        same = doc[gap:] == doc[:-gap]
        a, b = slot[:-gap][same], slot[gap:][same]
        for k in range(ONES):
            total += np.bincount(a * DIMS + place[b, k], sign[b, k], SLOTS * DIMS)
            total += np.bincount(b * DIMS + place[a, k], sign[a, k], SLOTS * DIMS)
    return total.reshape(SLOTS, DIMS)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all slots, from all documents; one partial table per task, summed by slot."""

    def run(batches):
        total = np.zeros((SLOTS, DIMS))
        for whole in batches:
            for b in pieces(whole):
                total += cooccurrence(b.column("text"))
        at = np.flatnonzero(np.abs(total).sum(axis=1))
        for k in range(0, len(at), 4096):
            rows = total[at[k : k + 4096]]
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 4096]), *[pa.array(rows[:, d].astype(np.int64)) for d in range(DIMS)]], names=["slot", *[f"d{d}" for d in range(DIMS)]])

    names = [f"d{d}" for d in range(DIMS)]
    sums = docs.select("text").mapInArrow(run, "slot long, " + ", ".join(f"{n} long" for n in names)).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros((SLOTS, DIMS))
    out[sums["slot"].to_numpy(np.int64)] = sums[names].to_numpy(float)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text: mean, spread and distinct mean of its word vectors, and two sizes."""
    slot, h, first = slots_of(texts)
    n, size = len(first) - 1, np.diff(first)
    doc = np.repeat(np.arange(n), size)
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    one = np.sort(order[new])

    def sums(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        count = np.bincount(owner, minlength=n)
        full = np.flatnonzero(count)
        out = np.zeros((n, DIMS), np.float32)
        if len(full):
            out[full] = np.add.reduceat(values, (np.cumsum(count) - count)[full], axis=0)
        return out / np.maximum(count, 1)[:, None]

    v = vectors[slot]
    mean, square, distinct = sums(v, doc), sums(v * v, doc), sums(v[one], doc[one])
    kinds = np.bincount(doc[one], minlength=n)
    return np.c_[mean, np.sqrt(np.maximum(square - mean * mean, 0)), distinct, np.log1p(size), kinds / np.maximum(size, 1)].astype(np.float32)


class Network:
    """Standardised inputs, tanh hidden units, logistic output, temperature."""

    def __init__(self, prior: float):
        self.prior, self.weights, self.temperature = prior, None, 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        mean, scale, a, b, c, d = self.weights
        return np.tanh(np.clip((x - mean) / scale, -8, 8) @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(float) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        apart = np.arange(len(x)) % 10 == 9
        tx, ty = x[~apart].astype(float), y[~apart]
        mean, scale = tx.mean(axis=0), tx.std(axis=0) + 1e-6
        z = np.clip((tx - mean) / scale, -8, 8)
        p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, s, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        for _ in range(max(EPOCHS, min(400, 60_000 // max(1, len(z))))):
            order = rng.permutation(len(z))
            for k in range(0, len(z), 128):
                i = order[k : k + 128]
                hidden = np.tanh(z[i] @ p[0] + p[1])
                err = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - ty[i]) / len(i)
                back = err[:, None] * p[2] * (1 - hidden * hidden)
                grads = [z[i].T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ err + 1e-4 * p[2], err.sum(keepdims=True)]
                t += 1
                for j, g in enumerate(grads):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    s[j] = 0.999 * s[j] + 0.001 * g * g
                    p[j] = p[j] - 0.003 * (m[j] / (1 - 0.9**t)) / (np.sqrt(s[j] / (1 - 0.999**t)) + 1e-8)
        self.weights = (mean.astype(np.float32), scale.astype(np.float32), *[w.astype(np.float32) for w in p])
        if apart.any():
            logits, cy = self.logits(x[apart]).astype(float), y[apart]
            grid = np.exp(np.linspace(-2, 2, 81))
            loss = [np.mean(np.logaddexp(0, logits / g) - cy * logits / g) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(docs)
    chosen = sample_labels(labels.where(remainder(F.col("doc_id"), 5) != 0), "quality", limit)
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")

    def run(batches):
        for whole in batches:
            for b in pieces(whole):
                x = pooled(b.column("text"), vectors)
                yield pa.RecordBatch.from_arrays([b.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))], names=["label", "x"])

    rows = marked.mapInArrow(run, "label int, x array<float>").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float32).reshape(rows.num_rows, 3 * DIMS + 2)
    y = rows.column("label").to_numpy().astype(float)
    net = Network(float(y.mean()) if len(y) else 0.0)
    if len(set(y)) == 2:
        order = np.lexsort((*x.T[:8], y))  # the rows' order doesn't depend on the tasks
        net.fit(x[order], y[order])
    return vectors, net


def quality_scores(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    vectors, net = train(docs, labels, limit)

    def run(batches):
        for whole in batches:
            for b in pieces(whole):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(net.scores(pooled(b.column("text"), vectors)).astype(float))], names=["doc_id", "score"])

    kind = docs.select("doc_id").dtypes[0][1]
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
