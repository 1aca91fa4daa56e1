"""Ranked search against a brute-force ranking; bounds, skipping and edge cases."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counted = [(i, collections.Counter(w), len(w)) for i, w in ((i, words(t)) for i, t in docs)]
    n_docs, length = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            score = 0
            for t in set(words(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // length)))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("rank", F.lit(1)).repartition(how.pop("parts", 3))
    out = ranked_search.search(d, spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(0)), **how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("docs_a_block", [1, 7, 50, 16_384])
def test_against_brute_force(spark, monkeypatch, docs_a_block):
    rng = np.random.default_rng(docs_a_block)
    vocabulary = [f"w{i}" for i in range(60)] + ["ÄÖ", "中", "Ünï"]
    p = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=p / p.sum()))
    docs = [(i, text(rng.integers(1, 60))) for i in range(400)]
    items = [(i, text(rng.integers(1, 25))) for i in range(30)]
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 40 * docs_a_block)
    assert found(spark, docs, items, seed_blocks=4) == brute(docs, items)


def test_edges(spark):
    docs = [(1, None), (2, ""), (None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"), (4, "ALPHA"), (5, "!!"), (6, "alpha " * 30_000), (7, "é-É é")]
    items = [(1, "Alpha, alpha BETA"), (2, None), (3, ""), (4, "nowhere"), (5, "é"), (5, "é"), (None, "beta")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, most_items=2, k=2) == brute(docs, items, 2)
    assert found(spark, docs, [(2, None)]) == []
    empty = spark.createDataFrame(docs, "doc_id long, text string").limit(0)
    assert ranked_search.search(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")).count() == 0


def test_equal_scores_across_many_tasks(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000, "other text")]
    items = [(1, "words"), (2, "same here")]
    got = found(spark, docs, items, parts=20)
    assert got == brute(docs, items) and [r[2] for r in got if r[0] == 1 and r[1] == 1] == [1]


def test_pair_bounds_skip_more_than_single_ones():
    """Two terms that never meet: pair bounds rule out what sums of single maxima could not."""
    items = ranked_search.Items.of([(0, "left right")])
    items.weigh(np.array([3, 3]), 6)
    doc, impact = np.arange(6), np.array([90, 80, 70, 60, 50, 40])
    block = object.__new__(ranked_search.Block)
    block.doc, block.known = doc, np.ones(6, bool)
    block.first, block.place, block.impact = np.array([0, 3, 6]), doc.astype(np.int32), impact
    block.most = np.array([90, 60])
    block.pair_first, block.pair_place, block.pair_most = np.array([0, 0]), np.zeros(0, np.int32), np.zeros(1, np.int64)
    assert len(block.candidates(items, 0, 100)[0]) == 0, "singles allow 150, the pair at most 90"
    assert block.scores(items, 0, 90)[0].tolist() == [0]
    block.pair_first, block.pair_place, block.pair_most = np.array([0, 1]), np.array([2], np.int32), np.array([130])
    assert block.candidates(items, 0, 100)[0].tolist() == [2], "only the intersection list can reach it"


def test_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(spark, docs, items) == brute(docs, items)
