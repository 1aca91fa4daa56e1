"""Subword quality classifier: features against brute force, held-out accuracy, edge cases; and bounded samples."""

import collections
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import folds, langid, subwords
from ledgerloom.llm.textblocks import TextBlock

BIG = "/root/testdata/sf0.1"
BLANK = " \t\n\r\x0b\x0c"


def brute_counts(text):
    """How many features of each kind a text has: words, pairs, then n-grams of code points."""
    words = text.translate({ord(c): " " for c in BLANK}).split(" ")
    n_words = len([w for w in words if w])
    flat = [" " if c in BLANK else c for c in text]
    grams = 0
    for n in subwords.NGRAMS:
        for i in range(len(flat) - n + 1):
            g = flat[i : i + n]
            grams += " " not in g[1:-1] and not (g[0] == " " and g[-1] == " ")
    return n_words + max(0, n_words - 1) + grams


def test_features_match_brute_force():
    texts = ["one two two  three", "", " ", "é", "naïve 中文 text\n\nnew", "a", "aa bb", "x " * 300, "ab\tcd"]
    found = np.zeros(len(texts), int)
    kinds = collections.defaultdict(set)
    for k, (doc, bucket) in enumerate(subwords.features(TextBlock.of(pa.array(texts)))):
        found += np.bincount(doc, minlength=len(texts))
        for d, b in zip(doc.tolist(), bucket.tolist()):
            kinds[d, k].add(b)
    assert found.tolist() == [brute_counts(t) for t in texts]
    assert len(kinds[7, 1]) == 1 and kinds[7, 1] <= kinds[0, 1], "a word followed by itself is one kind of pair"
    alone = [np.sort(np.concatenate([b for _, b in subwords.features(TextBlock.of(pa.array([t])))] or [[]])).tolist() for t in texts]
    together = [[] for _ in texts]
    for doc, bucket in subwords.features(TextBlock.of(pa.array(texts))):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            together[d].append(b)
    assert [sorted(t) for t in together] == alone, "neighbours in a block don't touch"


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{BIG}/labels.parquet")
    model = subwords.train(docs, labels, where=~subwords.held_out())
    out = subwords.quality(docs, model).join(labels, "doc_id").where(subwords.held_out()).toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id)
    assert (out.predicted[out.quality == 1] == 1).mean() > 0.99 and (out.predicted[out.quality == 0] == 0).mean() > 0.8
    assert ((out.score >= 0.7) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    good, bad = out.score[out.quality == 1].to_numpy(), out.score[out.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.98
    texts = pa.array(["plain words of a text", "", None])
    assert subwords.scores(model, texts, model.weights()) == pytest.approx(whole_path(model, texts), abs=1e-6), "the folded layer gives the softmax of the mean vector"


def whole_path(model, texts):
    """Mean of all vectors, then the softmax layer, text by text."""
    out = []
    for t in texts.to_pylist():
        f = np.concatenate([b for _, b in subwords.features(TextBlock.of(pa.array([t or ""])))] or [np.zeros(0, int)]).astype(int)
        mean = model.vectors[f].mean(axis=0) if len(f) else np.zeros(model.vectors.shape[1])
        z = mean @ model.out + model.bias
        e = np.exp(z - z.max())
        out.append(float((e / e.sum())[1]))
    return out


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "s", 1), (None, "", None, 2), (2, "a " * 200_000, "x", 3), (3, " \n ", "y", 4), (3, " \n ", "y", 4)], "doc_id long, text string, score string, Predicted int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = subwords.quality(docs, subwords.train(docs, labels))
    assert out.count() == 5 and out.columns == ["doc_id", "text", "score", "predicted"] and out.where("score is null or score < 0 or score > 1").count() == 0
    assert subwords.quality(docs.limit(0), subwords.train(docs, labels)).count() == 0
    one = subwords.train(docs, spark.createDataFrame([(2, 1)], "doc_id long, quality int"))
    assert {r.predicted for r in subwords.quality(docs, one).collect()} == {1}


def lowest(ids):
    return min(ids, key=lambda r: r["h"])["doc_id"]


def test_one_oversized_text_changes_nothing_else(spark):
    words = {"de": "haus baum fluss garten wasser", "en": "house tree river garden water"}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words[k].split(), 20)), k) for i, k in enumerate(["de", "en"] * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = lowest(docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect())
    whole = F.expr(f"CASE WHEN doc_id = {first} THEN repeat(text, 5000000 DIV length(text) + 1) ELSE text END")
    long = docs.withColumn("text", whole)
    assert long.where("length(text) > 5000000").count() == 1
    a, b = langid.train(docs), langid.train(long)
    assert a.languages == b.languages == ["de", "en"]
    out = langid.language(long, b)
    assert out.where("lang = lang_pred").count() >= 198
    near = docs.withColumn("text", F.expr(f"CASE WHEN doc_id = {first} THEN repeat(text, 3900000 DIV length(text) + 1) ELSE text END"))
    assert langid.train(near).languages == ["de", "en"]
    labels = docs.select("doc_id", F.col("lang").eqNullSafe("en").cast("int").alias("quality"))
    taken = folds.sample(long, labels, "quality", 1000, most_bytes=1 << 20)
    assert taken.num_rows == 199 and set(taken.column("label").to_pylist()) == {0, 1}
    with pytest.raises(ValueError):
        folds.sample(long.where(f"doc_id = {first}"), labels, "quality", 1000, most_bytes=1 << 20)


def test_every_label_is_represented(spark):
    rows = [(i, f"text {i}", "common") for i in range(500)] + [(1000, "rare one", "rare"), (1001, "y" * 2000, "long"), (1002, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = folds.sample(docs, docs, "lang", 50, most_bytes=64_000, each=3).to_pandas()
    assert set(got.label) == {"common", "rare", "long"} and len(got) <= 100
    sizes = pd.DataFrame({"rank": [1, 2, 3, 4], "size": [100, 1, 1, 1], "label": ["a", "a", "b", "b"]})
    assert folds.fitting(sizes, 640)["rank"].tolist() == [2, 3, 4]
