"""Language ID: a byte convolutional network over fixed-length windows, trained in numpy.

A text is cut into windows of WINDOW bytes. Filters of 2, 3 and 4 bytes slide over each window, the largest response of
each filter (max pooling) goes through a rectifier into a softmax layer, and a text's probabilities are the mean of its
windows', weighted by their bytes. Inside tasks the filters are tables over pairs of byte classes, so that a filter
bank of width 4 costs two table rows for each byte.
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
from .textblocks import TextBlock, small_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
UNKNOWN = "und"
#: Classes of bytes: 0 padding and control, 1 white space, 2 digits, 3 punctuation, 4-29 letters without case; each byte
#: beyond ASCII is a class of its own.
CLASSES = 158
CLASS = np.zeros(256, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 1
CLASS[33:127] = 3
CLASS[48:58] = 2
CLASS[65:91] = np.arange(4, 30)
CLASS[97:123] = np.arange(4, 30)
CLASS[0x80:] = np.arange(30, 158)


@dataclass
class Network:
    """filters[w]: (w, CLASSES, FILTERS); bias of each filter; the softmax layer; the languages in order."""

    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    languages: list[str]

    def tables(self) -> dict[int, list[tuple[int, np.ndarray]]]:
        """For each width (offset, rows by pair of classes, or by class for an odd last byte)."""
        t = {}
        for w, f in self.filters.items():
            t[w] = [(i, (f[i][:, None] + f[i + 1][None]).reshape(-1, FILTERS)) for i in range(0, w - 1, 2)]
            if w % 2:
                t[w].append((w - 1, f[w - 1]))
        return t


def windows_of(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, sizes, document) of all windows of all texts."""
    sizes = np.diff(block.off)
    n = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(block.n), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return block.off[doc] + k * WINDOW, np.minimum(WINDOW, sizes[doc] - k * WINDOW), doc


def window_classes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) classes, padded with 0."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < sizes[:, None]
    return np.where(inside, CLASS[data[np.minimum(at, len(data) - 1)]], 0).astype(np.int32)


def _responses(net: Network, tables, c: np.ndarray, where: bool = False):
    """Pooled responses (windows, filters), and with `where` the places of the largest ones."""
    pair = c[:, :-1] * CLASSES + c[:, 1:]
    pooled, places = [], []
    for w in WIDTHS:
        n = WINDOW - w + 1
        total = None
        for offset, rows in tables[w]:
            index = pair[:, offset : offset + n] if len(rows) > CLASSES else c[:, offset : offset + n]
            part = rows.take(index, axis=0)
            total = part if total is None else np.add(total, part, out=total)
        if where:
            at = total.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(total, at[:, None], 1)[:, 0])
        else:
            pooled.append(total.max(axis=1))
    return np.concatenate(pooled, axis=1), places


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(net: Network, c: np.ndarray, tables, step: int = 128) -> np.ndarray:
    """Softmax of every window, some windows at a time."""
    out = np.zeros((len(c), len(net.languages)))
    for i in range(0, len(c), step):
        pooled, _ = _responses(net, tables, c[i : i + step])
        out[i : i + step] = _softmax(np.maximum(pooled + net.bias, 0) @ net.out + net.out_bias)
    return out


def fit(labelled: pa.Table, epochs: int = 3, batch: int = 64, rate: float = 0.01) -> Network:
    """Train on all windows of each labelled text, by Adam; one language or none gives a constant."""
    languages = sorted(set(labelled.column("label").to_pylist()))
    rng = np.random.default_rng(11)
    n_out = len(WIDTHS) * FILTERS
    p = {f"f{w}": (rng.normal(0, 0.3, (w, CLASSES, FILTERS))).astype(np.float32) for w in WIDTHS}
    p |= {"bias": np.zeros(n_out, np.float32), "out": rng.normal(0, 0.3, (n_out, max(1, len(languages)))).astype(np.float32), "out_bias": np.zeros(max(1, len(languages)), np.float32)}

    def net() -> Network:
        return Network({w: p[f"f{w}"] for w in WIDTHS}, p["bias"], p["out"], p["out_bias"], languages)

    if len(languages) < 2:
        return net()
    block = TextBlock.of(labelled.column("text"))
    starts, sizes, doc = windows_of(block)
    index = {v: i for i, v in enumerate(languages)}
    y = np.array([index[v] for v in labelled.column("label").to_pylist()])[doc]
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            i = order[lo : lo + batch]
            cut = rng.integers(12, WINDOW + 1, len(i))  # short texts occur too
            size = np.where(rng.random(len(i)) < 0.3, np.minimum(sizes[i], cut), sizes[i])
            c = window_classes(block.data, starts[i], size)
            own = net()
            pooled, places = _responses(own, own.tables(), c, where=True)
            hidden = np.maximum(pooled + p["bias"], 0)
            err = _softmax(hidden @ p["out"] + p["out_bias"])
            err[np.arange(len(i)), y[i]] -= 1
            err = (err / len(i)).astype(np.float32)
            back = (err @ p["out"].T) * (hidden > 0)
            g = {"out": hidden.T @ err, "out_bias": err.sum(0), "bias": back.sum(0)}
            for b, w in enumerate(WIDTHS):
                part = back[:, b * FILTERS : (b + 1) * FILTERS]
                gw = np.zeros_like(p[f"f{w}"])
                for j in range(w):
                    np.add.at(gw[j], (c[np.arange(len(i))[:, None], places[b] + j], np.arange(FILTERS)[None]), part)
                g[f"f{w}"] = gw
            step += 1
            now = rate * (1 - 0.8 * epoch / epochs)
            for key, grad in g.items():
                m, v = state[key]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p[key] -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net()


def predict(net: Network, text: pa.Array, tables) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text: UNKNOWN and 0 without a letter."""
    block = TextBlock.of(text)
    has = np.zeros(block.n, bool)
    ascii_ = (CLASS[block.data] >= 4) & (CLASS[block.data] < 30)
    has = np.diff(np.concatenate([[0], np.cumsum(ascii_)])[block.off]) > 0
    for i in np.flatnonzero(~has):
        own = bytes(block.data[block.off[i] : block.off[i + 1]])
        has[i] = not own.isascii() and any(ch.isalpha() for ch in own.decode("utf-8", "replace"))
    total = np.zeros((block.n, len(net.languages)))
    starts, sizes, doc = windows_of(block)
    if not net.languages:
        return [UNKNOWN] * block.n, np.zeros(block.n)
    for lo in range(0, len(doc), 4096):
        s = slice(lo, lo + 4096)
        own = probabilities(net, window_classes(block.data, starts[s], sizes[s]), tables) * sizes[s][:, None]
        np.add.at(total, doc[s], own)
    total /= np.maximum(np.diff(block.off), 1)[:, None]
    best = total.argmax(axis=1)
    score = np.where(has, np.clip(total[np.arange(block.n), best], 0, 1), 0.0)
    return [net.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist())], score


def train(docs: DataFrame, most: int = 4000, most_bytes: int = 4 << 20, where: Column | None = None, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """Fit on at most `most` whole texts of a known language, `most_bytes` bytes in all; `where` restricts them."""
    rows = docs if where is None else docs.where(where)
    return fit(sample(docs, rows, lang, most, id_col, text, most_bytes))


def language(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """docs with lang_pred (a learned language, or "und" where the text is null or has no letter) and score (0 to 1).

    All windows of every whole text count. Input columns named lang_pred or score are replaced, others pass through,
    repeated rows included. An empty table gives an empty result.
    """
    base = without(carried(docs), "lang_pred", "score")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables()
        for batch in small_batches(batches, text, 1 << 20):
            lang, score = predict(net, batch.column(names.index(text)), tables)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is never learned from: fold 1 of 3."""
    return F.coalesce(fold(id_col, 3) == 1, F.lit(False))
