"""Quality classifier: learned vectors of words, word pairs and character n-grams, averaged for each document.

Words are runs without white space as they stand, pairs are neighbours (a word followed by itself is one pair of its
own kind, whatever the word), n-grams are 2 to 4 code points that cross no white space but may begin or end at one.
Each is hashed to one of 2^BITS buckets that has a vector; a document is the mean of the vectors of all its features,
repeats included, and a softmax layer over it gives the score. Vectors and layer are learned together by stochastic
gradient descent in numpy on a bounded sample. As the layer is linear in the mean, a task first multiplies every vector
by it: a document's logit is then the mean of one number a feature, over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import carried, without
from .folds import fold, sample
from .textblocks import SPACE, TextBlock, U, mix, small_batches, span_hash

BITS = 17
DIM = 8
NGRAMS = (2, 3, 4)
#: Fixed values, drawn at random: the base of n-gram hashes, what tells pairs from words, and the pair of equal words.
NGRAM_BASE, PAIR, SAME = U(0x9E6C63D0876A9A47), U(0xD1B54A32D192ED03), U(0x2545F4914F6CDD1D)


@dataclass
class Model:
    """One vector a bucket, the softmax layer over their mean, its bias, and the share of label 1."""

    vectors: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> np.ndarray:
        """What each bucket adds to the logit of label 1."""
        return (self.vectors @ (self.out[:, 1] - self.out[:, 0])).astype(np.float64)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> U(64 - BITS)).astype(np.int32)


def features(block: TextBlock) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every feature: words, pairs, then n-grams of each length. Documents ascend in each part."""
    starts, ends, first = block.spans()
    doc = np.repeat(np.arange(block.n), np.diff(first))
    h = span_hash(block.data, starts, ends)
    yield doc, _bucket(h)
    near = np.flatnonzero(doc[1:] == doc[:-1])
    a, b = h[near], h[near + 1]
    yield doc[near], _bucket(np.where(a == b, SAME, a * PAIR + b))
    data = np.where(SPACE[block.data], np.uint8(32), block.data)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    owner = np.repeat(np.arange(block.n), np.diff(block.off))[at]
    size = np.diff(np.append(at, len(data)))
    point = data[at].astype(U)
    for k in (1, 2, 3):
        long = np.flatnonzero(size > k)
        point[long] |= data[at[long] + k].astype(U) << U(8 * k)
    gap = point == 32
    point += U(1)
    run, inner = point, np.ones(len(point), bool)
    for n in range(2, NGRAMS[-1] + 1):
        m = len(point) - n + 1
        if m <= 0:
            return
        run = run[:m] * NGRAM_BASE + point[n - 1 :]
        if n > 2:
            inner = inner[:m] & ~gap[n - 2 : n - 2 + m]
        if n in NGRAMS:
            ok = np.flatnonzero(inner[:m] & (owner[:m] == owner[n - 1 :]) & ~(gap[:m] & gap[n - 1 :]))
            yield owner[ok], _bucket(run[ok] + U(n))


def _counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the sample: first entry of each text (n + 1), bucket and share of the text's features."""
    sizes, buckets, shares = [], [], []
    for batch in small_batches(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), "text"):
        block = TextBlock.of(batch.column(0))
        key = np.concatenate([(doc.astype(np.int64) << BITS) | bucket for doc, bucket in features(block)] or [np.zeros(0, np.int64)])
        key, n = np.unique(key, return_counts=True)
        doc = key >> BITS
        total = np.bincount(doc, n, block.n)
        sizes.append(np.bincount(doc, minlength=block.n))
        buckets.append((key & ((1 << BITS) - 1)).astype(np.int32))
        shares.append((n / total[doc]).astype(np.float32))
    return np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate(buckets), np.concatenate(shares)


def fit(labelled: pa.Table, epochs: int = 5, batch: int = 32, rate: float = 0.5, least_steps: int = 300) -> Model:
    """Vectors and layer by stochastic gradient descent, each number's step scaled by its past gradients; small samples
    are gone through more often, for `least_steps` steps. Without both labels: a constant score, the share of label 1."""
    y = np.array([1 if v else 0 for v in labelled.column("label").to_pylist()], np.int64)
    if not len(y) or y.min() == y.max():
        p = (float(y.mean()) if len(y) else 0.5) * 0.998 + 0.001
        return Model(np.zeros((1 << BITS, 1), np.float32), np.zeros((1, 2), np.float32), np.array([0.0, np.log(p / (1 - p))]))
    texts = labelled.column("text").combine_chunks()
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    first, bucket, share = _counted(texts)
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.log(np.array([1 - y.mean(), y.mean()])).astype(np.float32)
    seen_v, seen_o, seen_b = np.full((1 << BITS, 1), 1e-8, np.float32), np.full(out.shape, 1e-4, np.float32), np.full(2, 1e-2, np.float32)
    epochs = max(epochs, -(-least_steps * batch // len(y)))
    for epoch in range(epochs):
        now = rate * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            rows = order[lo : lo + batch]
            size = first[rows + 1] - first[rows]
            at = np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            own = np.repeat(np.arange(len(rows)), size)
            f, s = bucket[at], share[at][:, None]
            some = np.flatnonzero(size)
            mean = np.zeros((len(rows), DIM), np.float32)
            if not len(some):
                continue
            mean[some] = np.add.reduceat(vectors[f] * s, (np.cumsum(size) - size)[some])
            z = mean @ out + bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            err = e / e.sum(axis=1, keepdims=True)
            err[np.arange(len(rows)), y[rows]] -= 1
            err = (err / len(rows)).astype(np.float32)
            back = err @ out.T
            g_out, g_bias = mean.T @ err, err.sum(axis=0)
            by = np.argsort(f, kind="stable")
            start = np.flatnonzero(np.append(True, np.diff(f[by]) != 0))
            few, g = f[by][start], np.add.reduceat((back[own] * s)[by], start)
            seen_v[few] += (g * g).mean(axis=1, keepdims=True)
            vectors[few] -= now * 0.2 * g / np.sqrt(seen_v[few])
            seen_o += g_out * g_out
            out -= now * 0.2 * g_out / np.sqrt(seen_o)
            seen_b += g_bias * g_bias
            bias -= now * 0.2 * g_bias / np.sqrt(seen_b)
    return Model(vectors, out, bias)


def scores(model: Model, text: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Score of every text; one without features has the bias's."""
    block = TextBlock.of(text)
    total, n = np.zeros(block.n), np.zeros(block.n)
    for doc, bucket in features(block):
        total += np.bincount(doc, weights[bucket], block.n)
        n += np.bincount(doc, minlength=block.n)
    return 1 / (1 + np.exp(-(total / np.maximum(n, 1) + model.bias[1] - model.bias[0])))


def train(docs: DataFrame, labels: DataFrame, most: int = 4000, most_bytes: int = 12 << 20, where: Column | None = None, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on about `most` whole labelled texts, `most_bytes` bytes in all; `where` restricts the label rows."""
    rows = labels if where is None else labels.where(where)
    return fit(sample(docs, rows, label, most, id_col, text, most_bytes))


def quality(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from `threshold` on) added, for every whole text.

    Null, empty and blank texts have no word and get the score of what features they have, at last of the bias alone.
    Very long texts are a slice of their own. Input columns named score or predicted are replaced; all others pass
    through, repeated rows included. An empty table gives an empty result.
    """
    base = without(carried(docs), "score", "predicted")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights()
        for batch in small_batches(batches, text):
            s = scores(model, batch.column(names.index(text)), weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*names, "score"])

    scored = base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label is never learned from: fold 2 of 4."""
    return F.coalesce(fold(id_col, 4) == 2, F.lit(False))
