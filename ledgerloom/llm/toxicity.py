"""Toxicity: a counterfactually regularised classifier over the terms of whole texts.

Terms are lower-cased runs of letters and digits, and their beginnings. Those whose presence goes with the label become
features of a logistic model, fitted in numpy on a bounded sample of labelled texts. Sentences of the sample that name
a group are repeated with another group's name in its place (and, so that the penalty always has something to hold on
to, a few sentences get a name put in front); the squared change of the score between the two is part of the loss, so
naming a group neutrally moves no score. Scoring runs inside Arrow tasks, over every term of every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import carried, without
from .folds import fold, sample
from .textblocks import LOWER, NOT_TERM, TextBlock, U, small_batches, span_hash

#: Names of groups that are swapped for one another, by kind.
IDENTITY_TERMS = {
    "faith": ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    "origin": ["african", "asian", "european", "american", "latino", "arab", "immigrant", "refugee"],
    "colour": ["black", "white"],
    "gender": ["women", "men", "woman", "man", "transgender", "nonbinary"],
    "orientation": ["gay", "lesbian", "bisexual", "straight"],
    "ability": ["deaf", "blind", "disabled", "autistic"],
}
PREFIXES = (4, 5, 6, 7, 8)
TABLE_BITS = 20


@dataclass
class Model:
    """Sorted feature hashes with weights, the bias, and a table from hash bits to a feature's place + 1."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << TABLE_BITS, np.int32)
        out[(self.hashes >> U(64 - TABLE_BITS)).astype(np.int64)] = np.arange(1, len(self.hashes) + 1)
        return out


def term_hashes(block: TextBlock) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, hash) of every term, then of the beginnings of longer terms, one length at a time."""
    data = LOWER[block.data]
    starts, ends, first = block.spans(NOT_TERM)
    doc = np.repeat(np.arange(block.n), np.diff(first))
    yield doc, span_hash(data, starts, ends)
    for n in PREFIXES:
        long = ends - starts > n
        yield doc[long], span_hash(data, starts[long], starts[long] + n)


def _present(texts: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of the given features."""
    docs, feats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    base = 0
    for batch in small_batches(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), "text"):
        block = TextBlock.of(batch.column(0))
        for doc, h in term_hashes(block):
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            docs.append(doc[hit] + base)
            feats.append(at[hit])
        base += block.n
    key = np.unique(np.concatenate(docs) * len(hashes) + np.concatenate(feats))
    return key // len(hashes), key % len(hashes)


def _associated(texts: pa.Array, y: np.ndarray, most: int, least_docs: int) -> np.ndarray:
    """The hashes that go with the label most, by the excess of labelled texts that have them."""
    found: dict[str, list[np.ndarray]] = {"h": [], "n": [], "pos": []}
    base = 0
    for batch in small_batches(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), "text"):
        block = TextBlock.of(batch.column(0))
        parts_ = list(term_hashes(block))
        doc, h = np.concatenate([d for d, _ in parts_]), np.concatenate([x for _, x in parts_])
        order = np.lexsort((doc, h))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        doc, h = doc[new], h[new]
        u, start = np.unique(h, return_index=True)
        found["h"].append(u)
        found["n"].append(np.diff(np.append(start, len(h))))
        found["pos"].append(np.add.reduceat(y[base + doc], start) if len(start) else np.zeros(0))
        base += block.n
    u, inverse = np.unique(np.concatenate(found["h"]), return_inverse=True)
    n = np.bincount(inverse, np.concatenate(found["n"]), len(u))
    pos = np.bincount(inverse, np.concatenate(found["pos"]), len(u))
    rate = y.mean()
    z = (pos - n * rate) / np.sqrt(n * rate * (1 - rate) + 1)
    ok = np.flatnonzero((n >= least_docs) & (z > 0))
    return u[ok[np.argsort(-z[ok], kind="stable")[:most]]]


def counterfactuals(texts: list[str], injected: int = 40) -> tuple[list[str], list[str]]:
    """Sentences that name a group, and the same with another group of the kind; plus some with a name put in front."""
    kinds = {t: (k, i) for k, terms in IDENTITY_TERMS.items() for i, t in enumerate(terms)}
    pattern = re.compile(r"\b(" + "|".join(kinds) + r")\b", re.IGNORECASE)

    def other(m: re.Match) -> str:
        kind, i = kinds[m[0].lower()]
        terms = IDENTITY_TERMS[kind]
        return terms[(i + 1) % len(terms)]

    was, now = [], []
    for text in texts:
        for s in re.split(r"[.!?\n]", text) if pattern.search(text) else ():
            if pattern.search(s):
                was.append(s)
                now.append(pattern.sub(other, s))
    for k, text in enumerate(texts[:injected]):
        s = next((x for x in re.split(r"[.!?\n]", text) if x.strip()), "")
        for terms in IDENTITY_TERMS.values():
            was.append(f"{terms[k % len(terms)]} {s}")
            now.append(f"{terms[(k + 1) % len(terms)]} {s}")
    return was, now


def fit(labelled: pa.Table, features: int = 800, least_docs: int = 4, l2: float = 1e-4, penalty: float = 1.0, steps: int = 300) -> Model:
    """Logistic regression with the counterfactual penalty, by Adam. Without both labels: a constant score."""
    y = np.array([1.0 if v else 0.0 for v in labelled.column("label").to_pylist()])
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(0, U), np.zeros(0), float(np.log((rate + 1e-3) / (1 - rate + 1e-3))))
    texts = labelled.column("text").combine_chunks()
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    own = _associated(texts, y, features, min(least_docs, max(1, len(y) // 100)))
    names = [t for terms in IDENTITY_TERMS.values() for t in terms]
    named = np.concatenate([h for _, h in term_hashes(TextBlock.of(pa.array(names)))])
    hashes = np.union1d(own, named)
    _, one = np.unique(hashes >> U(64 - TABLE_BITS), return_index=True)  # one feature for each place of the table
    hashes = hashes[one]
    doc, feat = _present(texts, hashes)
    was, now = counterfactuals(texts.to_pylist())
    d1, f1 = _present(pa.array(was), hashes)
    d2, f2 = _present(pa.array(now), hashes)
    w, bias, n = np.zeros(len(hashes)), float(np.log(y.mean() / (1 - y.mean()))), len(y)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        s = np.bincount(doc, w[feat], n) + bias
        err = (1 / (1 + np.exp(-s)) - y) / n
        change = np.bincount(d1, w[f1], len(was)) - np.bincount(d2, w[f2], len(was))
        g = np.bincount(feat, err[doc], len(w)) + l2 * w
        g += 2 * penalty / len(was) * (np.bincount(f1, change[d1], len(w)) - np.bincount(f2, change[d2], len(w)))
        g = np.append(g, err.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    return Model(hashes, w, bias)


def scores(model: Model, text: pa.Array, table: np.ndarray) -> np.ndarray:
    """Score of every text; a text without known terms gets the bias's score."""
    block = TextBlock.of(text)
    keys = [np.zeros(0, np.int64)]
    if len(model.hashes):
        for doc, h in term_hashes(block):
            at = table[(h >> U(64 - TABLE_BITS)).astype(np.int64)]
            hit = np.flatnonzero(at)
            hit = hit[model.hashes[at[hit] - 1] == h[hit]]
            keys.append(doc[hit] * len(model.hashes) + at[hit] - 1)
    key = np.unique(np.concatenate(keys))
    n = max(1, len(model.hashes))
    s = np.bincount(key // n, model.weights[key % n] if len(key) else None, block.n) + model.bias
    return 1 / (1 + np.exp(-s))


def train(docs: DataFrame, labels: DataFrame, most: int = 8000, where: Column | None = None, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on at most `most` labelled texts; `where` restricts the label rows."""
    rows = labels if where is None else labels.where(where)
    return fit(sample(docs, rows, label, most, id_col, text))


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from `threshold` on) added, for every whole text.

    Null and empty texts count as texts without terms and get the score of the bias. Input columns named score or
    predicted are replaced; all others pass through, repeated rows included. An empty table gives an empty result.
    """
    base = without(carried(docs), "score", "predicted")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in small_batches(batches, text):
            s = scores(model, batch.column(names.index(text)), table)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*names, "score"])

    scored = base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label is never learned from: fold 2 of 4."""
    return F.coalesce(fold(id_col, 4) == 2, F.lit(False))
