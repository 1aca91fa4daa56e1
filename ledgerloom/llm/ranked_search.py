"""Ranked lexical search: MaxScore over blocks of documents, with bounds of term pairs.

Three passes. The first reads every whole text once and writes, for each block of documents, the postings of the terms
that the items have, and the counts from which N, L and every df are summed. The second turns postings into impacts and
adds to each block the intersection lists of term pairs with their joint impacts, and the largest impact of every term
and pair. The third evaluates the items, block by block: a pair never brings more than the largest of its joint and its
single impacts, so the sum of pair bounds is below the sum of term maxima; blocks whose sum stays below an item's tenth
score are skipped, and where a block could reach it only through a pair's joint impact, that pair's intersection list
alone holds the candidates. Items start from the tenth score over a few blocks, and tasks hand on ten rows an item.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cluster import carried, new_folder, without
from .textblocks import LOWER, NOT_TERM, TextBlock, small_batches, span_hash

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 16_384
POSTINGS = "block long, n_docs long, n_terms long, doc binary, known binary, size binary, first binary, place binary, tf binary, terms array<int>, dfs array<int>"
IMPACTS = "block long, doc binary, known binary, first binary, place binary, impact binary, most binary, pair_first binary, pair_place binary, joint binary, pair_most binary"


def terms_of(text: str | None) -> list[str]:
    """Distinct terms of an item, in order of appearance."""
    return list(dict.fromkeys(TERM.findall((text or "").translate(ASCII_LOWER))))


@dataclass
class Items:
    """Items of one block: ids, the places of their terms in the vocabulary, and, once df is known, weights and pairs."""

    ids: list
    terms: list[np.ndarray]
    hashes: np.ndarray  # sorted
    lengths: np.ndarray  # bytes of each term
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int64))
    units: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # of each item: pairs, single terms

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        words = [terms_of(text) for _, text in rows]
        vocabulary = sorted({w for own in words for w in own})
        raw = [w.encode() for w in vocabulary]
        lengths = np.array([len(w) for w in raw], np.int64)
        ends = np.cumsum(lengths)
        h = span_hash(np.frombuffer(b"".join(raw), np.uint8), ends - lengths, ends) if raw else np.zeros(0, np.uint64)
        order = np.argsort(h)
        place = {vocabulary[k]: i for i, k in enumerate(order.tolist())}
        return cls([i for i, _ in rows], [np.array([place[w] for w in own], np.int64) for own in words], h[order], lengths[order])

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Weights by df, and each item's terms in pairs: the two rarest ones, the next two, and so on."""
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        found: dict[tuple[int, int], int] = {}
        self.units = []
        for own in self.terms:
            rare = own[np.lexsort((own, df[own]))]
            even = len(rare) // 2 * 2
            pairs = [tuple(sorted(p)) for p in zip(rare[:even:2].tolist(), rare[1:even:2].tolist())]
            self.units.append((np.array([found.setdefault(p, len(found)) for p in pairs], np.int64), rare[even:]))
        self.pairs = np.array(list(found), np.int64).reshape(-1, 2)


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """One row for each block of documents: ids, sizes, and postings of the items' terms ordered by term and document."""
    vocabulary, lengths = items.hashes, items.lengths
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        weight = n_docs = 0

        def row() -> pa.RecordBatch:
            nonlocal block, weight, n_docs
            ids, known, sizes = (np.concatenate([h[k] for h in held]) for k in range(3))
            key, tf = np.concatenate([h[3] for h in held]), np.concatenate([h[4] for h in held])
            order = np.argsort(key)
            key, tf = key[order], tf[order]
            term, place = key >> 32, (key & 0xFFFFFFFF).astype(np.int32)
            first = np.searchsorted(term, np.arange(len(vocabulary) + 1)).astype(np.int32)
            df = np.diff(first)
            some = np.flatnonzero(df)
            values = [
                pa.array([block]), pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())]), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, known, sizes, first, place, tf.astype(np.int32))),
                *(pa.array([x.tolist()], pa.list_(pa.int32())) for x in (some, df[some])),
            ]
            block, weight, n_docs = block + 1, 0, 0
            held.clear()
            return pa.RecordBatch.from_arrays(values, names=[c.split()[0] for c in POSTINGS.split(", ")])

        for batch in small_batches(batches, "text"):
            text = TextBlock.of(batch.column("text"))
            starts, ends, first = text.spans(NOT_TERM)
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.diff(first)
            doc = np.repeat(np.arange(text.n), sizes)
            if len(vocabulary):
                h = span_hash(LOWER[text.data], starts, ends)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                hit = (vocabulary[at] == h) & (lengths[at] == ends - starts)
                key, tf = np.unique((at[hit].astype(np.int64) << 32) | (doc[hit] + n_docs), return_counts=True)
            else:
                key, tf = np.zeros(0, np.int64), np.zeros(0, np.int64)
            held.append((ids.fill_null(0).to_numpy(), known, sizes.astype(np.int64), key, tf))
            weight += len(text.data)
            n_docs += text.n
            if weight >= BLOCK_BYTES or n_docs >= BLOCK_DOCS:
                yield row()
        if held:
            yield row()

    return base.mapInArrow(run, POSTINGS)


def impacts(blocks: DataFrame, items: Items, n_docs: int, n_terms: int) -> DataFrame:
    """The blocks with impacts instead of counts, and with the pairs' intersection lists and all largest impacts."""
    weights, pairs = items.weights, items.pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = {c: np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in (("size", np.int64), ("first", np.int32), ("place", np.int32), ("tf", np.int32))}
                first, place, tf = get["first"].astype(np.int64), get["place"], get["tf"].astype(np.int64)
                m = 100 - 90 + (90 * get["size"] * n_docs) // max(1, n_terms)
                df = np.diff(first)
                term = np.repeat(np.arange(len(df)), df)
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[place]))
                most = _largest(value, first)
                a, b = pairs[:, 0], pairs[:, 1]
                left, right = (np.concatenate([np.zeros(0, np.int64), *(np.arange(first[t], first[t + 1]) for t in side.tolist())]).astype(np.int64) for side in (a, b))
                key_a = (np.repeat(np.arange(len(a)), df[a]) << 32) | place[left]
                key_b = (np.repeat(np.arange(len(b)), df[b]) << 32) | place[right]
                at = np.minimum(np.searchsorted(key_b, key_a), max(0, len(key_b) - 1))
                hit = key_b[at] == key_a if len(key_b) else np.zeros(len(key_a), bool)
                joint = value[left[hit]] + value[right[at[hit]]]
                pair_first = np.searchsorted(key_a[hit] >> 32, np.arange(len(pairs) + 1)).astype(np.int32)
                values = [batch.column(c).slice(r, 1) for c in ("block", "doc", "known")]
                values += [pa.array([x.tobytes()], pa.binary()) for x in (get["first"], place, value, most, pair_first, place[left[hit]], joint, _largest(joint, pair_first.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(values, names=[c.split()[0] for c in IMPACTS.split(", ")])

    return blocks.mapInArrow(run, IMPACTS)


def _largest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest of each run values[first[i]:first[i + 1]]; 0 for an empty one."""
    out = np.zeros(len(first) - 1, np.int64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.maximum.reduceat(values, first[:-1][some])
    return out


class Block:
    """One block's lists as views of its row."""

    def __init__(self, batch: pa.RecordBatch, r: int):
        get = {c: np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in (("doc", np.int64), ("known", bool), ("first", np.int32), ("place", np.int32), ("impact", np.int64), ("most", np.int64), ("pair_first", np.int32), ("pair_place", np.int32), ("pair_most", np.int64))}
        self.__dict__.update(get)

    def docs(self, term: int) -> np.ndarray:
        return self.place[self.first[term] : self.first[term + 1]]

    def candidates(self, items: Items, item: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of documents that may score `least`, the item's terms by falling impact, their largest impacts)."""
        pairs, singles = items.units[item]
        a, b = items.pairs[pairs, 0], items.pairs[pairs, 1]
        alone = np.maximum(self.most[a], self.most[b])
        bound = np.concatenate([np.maximum(alone, self.pair_most[pairs]), self.most[singles]])
        total = int(bound.sum())
        terms = items.terms[item]
        terms = terms[np.argsort(-self.most[terms], kind="stable")]
        top = self.most[terms]
        if total < least or not total:
            return np.zeros(0, np.int32), terms, top
        joint_only = pairs[total - bound[: len(pairs)] + alone < least]
        if len(joint_only):  # every such pair must be there whole: the shortest intersection list has all candidates
            size = self.pair_first[joint_only + 1] - self.pair_first[joint_only]
            p = int(joint_only[size.argmin()])
            return self.pair_place[self.pair_first[p] : self.pair_first[p + 1]], terms, top
        order = np.argsort(bound, kind="stable")
        needed = order[np.cumsum(bound[order]) >= least] if least else order  # the others together stay below
        lists = [self.docs(int(t)) for u in needed.tolist() for t in ((a[u], b[u]) if u < len(pairs) else (singles[u - len(pairs)],))]
        mark = np.zeros(len(self.doc), bool)
        for own in lists:
            mark[own] = True
        return np.flatnonzero(mark), terms, top

    def scores(self, items: Items, item: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of all documents of this block that reach `least`, dropping candidates on the way."""
        at, terms, top = self.candidates(items, item, least)
        score = np.zeros(len(at), np.int64)
        rest = int(top.sum())
        for t, most in zip(terms.tolist(), top.tolist()):
            if not len(at) or not most:
                break
            own = self.docs(t)
            k = np.minimum(np.searchsorted(own, at), len(own) - 1)
            score += np.where(own[k] == at, self.impact[self.first[t] + k], 0)
            rest -= most
            stay = score + rest >= least
            if not stay.all():
                at, score = at[stay], score[stay]
        ok = (score > 0) & (score >= least)
        return at[ok], score[ok]


def best_of(index: DataFrame, items: Items, k: int, least: np.ndarray) -> DataFrame:
    """For each item the k best rows of each task: item, doc_id, score. `least` are scores that an item's k-th best
    reaches for certain; only what lies below is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = least.tolist()
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in items.ids]
        for batch in batches:
            for r in range(batch.num_rows):
                block = Block(batch, r)
                for i in range(len(items.ids)):
                    at, score = block.scores(items, i, floor[i])
                    if not len(at):
                        continue
                    doc, known, score = (np.concatenate(x) for x in zip(best[i], (block.doc[at], block.known[at], score)))
                    top = np.lexsort((doc, ~known, -score))[:k]
                    best[i] = (doc[top], known[top], score[top])
                    if len(top) == k:
                        floor[i] = max(floor[i], int(score[top[-1]]))
        item = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        doc, known, score = (np.concatenate([b[c] for b in best] or [np.zeros(0, np.int64)]) for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=~known.astype(bool)), pa.array(score)], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def _search(docs: DataFrame, rows: list[tuple], item_type: str, k: int, seed_blocks: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items.of(rows)
    folder = new_folder(spark, "ranked-search")
    postings(docs, items).write.parquet(f"{folder}/postings")
    blocks = spark.read.schema(POSTINGS).parquet(f"{folder}/postings")
    n_blocks, n_docs, n_terms = (x or 0 for x in blocks.agg(F.count("*"), F.sum("n_docs"), F.sum("n_terms")).first())
    df = np.zeros(len(items.hashes), np.int64)
    counts = blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy("t.terms").agg(F.sum("t.dfs").alias("df")).toPandas()
    df[counts["terms"].to_numpy(int)] = counts["df"].to_numpy(np.int64)
    items.weigh(df, n_docs)
    impacts(blocks.drop("terms", "dfs"), items, n_docs, n_terms).write.parquet(f"{folder}/impacts")
    index = spark.read.schema(IMPACTS).parquet(f"{folder}/impacts").drop("joint")
    every = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = F.row_number().over(every)
    least = np.zeros(len(rows), np.int64)
    some = best_of(index.where(F.pmod(F.xxhash64("block"), F.lit(max(16, -(-n_blocks // seed_blocks)))) == 0), items, k, least)
    for item, score in some.withColumn("rank", ranked).where(F.col("rank") == k).select("item", "score").collect():
        least[item] = score
    best = best_of(index, items, k, least).withColumn("rank", ranked).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, v) for i, v in enumerate(items.ids)], f"item long, item_id {item_type}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, most_items: int = 2000, seed_blocks: int = 64) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score of the k best documents of each item with a score above 0.

    docs has doc_id and text, items has item_id and text; other columns play no part. Items are taken `most_items` at a
    time, each time over all documents; their terms are what tasks are sent. Null and empty texts have no term: such a
    document counts nowhere, such an item has no result. Repeated items are ranked each; repeated documents are documents
    each; a null doc_id comes after others of its score. Equal scores go by ascending doc_id. Very long texts are a slice
    of their own. An empty table gives an empty result. Terms are equal if their XXH64 and length are.
    """
    docs, items = carried(docs), without(items, "__part").select("item_id", "text")
    n = max(1, -(-items.count() // most_items))
    part = items.withColumn("__part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    out = None
    for p in range(n):
        rows = [(r[0], r[1]) for r in part.where(F.col("__part") == p).select("item_id", F.col("text").cast("string")).collect()]
        found = _search(docs, rows, items.schema["item_id"].dataType.simpleString(), k, seed_blocks)
        out = found if out is None else out.union(found)
    return out
