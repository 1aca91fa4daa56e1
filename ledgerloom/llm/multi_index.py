"""Approximate nearest neighbours by multi-index hashing.

Codes: a bounded sample of vectors gives principal axes and TURNS learned rotations (iterative quantisation, each from
another start); the signs of the rotated vectors are the binary code. A code is cut into substrings of 16 bits, and each
substring has an index from its value to the rows that hold it.

Search: a code within Hamming radius r = m * a + b of a query (m substrings, b < m) differs from it in at most a bits of
one of the first b + 1 substrings, or in at most a - 1 bits of another one (pigeonhole), so probing all values within
those distances and verifying the codes retrieves every code in the radius. The radius grows until it holds the k nearest
codes, and then by a margin learned from the sample: how much farther than the k nearest codes true neighbours lie. What
is in the radius is reranked by exact inner products in double precision.

Layout: vectors are dealt into shards, each of which is indexed once, by one task; queries, the smaller side, go to every
shard as a sorted stream behind its vectors. No task holds more than a shard, and pairs of rows never leave it but for
the k best of each query. Spark then keeps the k best of all shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cluster import carried
from .textblocks import ragged

TURNS = 4
#: Vectors of one shard: 64 MB of 64 doubles each.
SHARD_ROWS = 131_072
LEAST_ROWS = 2_048


class Codes:
    """Learned map from vectors to binary codes: mean, axes and rotations in one matrix; and the margin to search."""

    def __init__(self, matrix: np.ndarray, mean: np.ndarray, margin: int):
        self.matrix, self.mean, self.margin = matrix, mean, margin

    def encode(self, x: np.ndarray) -> np.ndarray:
        """(rows, substrings) codes."""
        return np.packbits((x - self.mean) @ self.matrix > 0, axis=1).view(np.uint16)


def learn(x: np.ndarray, k: int, recall: float = 0.97, rounds: int = 30) -> Codes:
    """Axes and rotations from a sample; the margin is the least that keeps `recall` of true neighbours in the sample.

    Bits are TURNS times the dimensions, rounded up to whole substrings for each turn.
    """
    n, dim = x.shape
    bits = -(-dim // 16) * 16
    mean = x.mean(axis=0)
    rng = np.random.default_rng(5)
    axes = np.linalg.eigh(np.cov(x - mean, rowvar=False).reshape(dim, dim) if n > 1 else np.eye(dim))[1]
    if bits > dim:
        axes = np.concatenate([axes, rng.normal(size=(dim, bits - dim))], axis=1)
    v = (x - mean) @ axes
    turns = []
    for _ in range(TURNS):
        rotation, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(v @ rotation).T @ v)
            rotation = (left @ right).T
        turns.append(axes @ rotation)
    codes = Codes(np.concatenate(turns, axis=1), mean, 0)
    code = codes.encode(x)
    beyond: list[np.ndarray] = []
    for q in rng.permutation(n)[: min(n, 300)]:
        score = x @ x[q]
        score[q] = -np.inf
        far = np.bitwise_count(code ^ code[q]).sum(axis=1, dtype=np.int64)
        far[q] = 16 * code.shape[1] + 1
        best = np.argsort(-score)[: min(k, n - 1)]
        beyond.append(far[best] - np.partition(far, min(k, n - 1) - 1)[min(k, n - 1) - 1] if n > 1 else far[:0])
    each = np.concatenate(beyond)
    codes.margin = max(0, int(np.quantile(each, recall, method="higher"))) if len(each) else 0
    return codes


@cache
def flips(most: int) -> np.ndarray:
    """Substring differences of at most `most` bits."""
    return np.array([sum(1 << b for b in c) for d in range(most + 1) for c in combinations(range(16), d)], np.uint16)


class Index:
    """Indexes of one shard of codes, one for each substring: rows in order of value, and where each value starts."""

    def __init__(self, code: np.ndarray):
        self.code = code
        self.by_substring = np.ascontiguousarray(code.T)
        self.rows = [np.argsort(s, kind="stable").astype(np.int32) for s in self.by_substring]
        self.starts = [np.concatenate([[0], np.cumsum(np.bincount(s, minlength=1 << 16))]) for s in self.by_substring]
        self.words = np.zeros((len(code), -(-code.shape[1] // 4) * 4), np.uint16)
        self.words[:, : code.shape[1]] = code
        self.words = self.words.view(np.uint64)
        self.probed = 0  # rows that probing visited and verified, for tests and figures

    def probe(self, query: np.ndarray, radius: int, found: np.ndarray) -> np.ndarray:
        """Rows not yet in `found` (which is updated) among which are all codes within the radius."""
        fresh = np.zeros(len(self.code), bool)
        a, b = divmod(radius, len(query))
        for j, value in enumerate(query.tolist()):
            most = a if j <= b else a - 1
            if most < 0:
                continue
            if most >= 16:
                fresh[:] = True
                break
            if most > 7 or len(flips(most)) > len(self.code):  # more values in reach than rows: go by the rows
                fresh |= np.bitwise_count(self.by_substring[j] ^ np.uint16(value)) <= most
            else:
                near = flips(most) ^ np.uint16(value)
                starts = self.starts[j]
                at = starts[near]
                fresh[self.rows[j][ragged(at, starts[near.astype(np.int64) + 1] - at)]] = True
        fresh &= ~found
        found |= fresh
        out = np.flatnonzero(fresh)
        self.probed += len(out)
        return out

    def within(self, query: np.ndarray, k: int, margin: int) -> np.ndarray:
        """Every row whose code is no farther than the k-th nearest code plus `margin`; k is at most the rows."""
        word = np.zeros(self.words.shape[1] * 4, np.uint16)
        word[: len(query)] = query
        word = word.view(np.uint64)
        found, bits = np.zeros(len(self.code), bool), 16 * len(query)
        rows, far, radius, wanted = [], [], len(query) - 1, None
        while True:
            new = self.probe(query, radius, found)
            rows.append(new)
            far.append(np.bitwise_count(self.words[new] ^ word).sum(axis=1, dtype=np.int64))
            every = np.concatenate(far)
            if wanted is None and (every <= radius).sum() >= k:
                wanted = min(bits, int(np.partition(every, k - 1)[k - 1]) + margin)
            if wanted is not None and radius >= wanted:
                return np.sort(np.concatenate(rows)[every <= wanted])
            radius = min(bits, radius + len(query) if wanted is None else max(wanted, radius))


def search(codes: Codes, index: Index, vid: np.ndarray, v: np.ndarray, qid: np.ndarray, q: np.ndarray, k: int):
    """The k best rows of one shard for each query (fewer only if the shard has fewer): query ids, ids, scores."""
    out_q, out_v, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for i, code in enumerate(codes.encode(q)):
        own = vid == qid[i]
        rows = index.within(code, min(k + int(own.sum()), len(v)), codes.margin)
        rows = rows[~own[rows]]
        score = (v[rows] * q[i]).sum(axis=1)
        if len(rows) > k:
            least = np.partition(score, len(rows) - k)[len(rows) - k]
            rows, score = rows[score >= least], score[score >= least]
            best = np.lexsort((vid[rows], -score))[:k]
            rows, score = rows[best], score[best]
        out_q.append(np.full(len(rows), qid[i]))
        out_v.append(vid[rows])
        out_s.append(score)
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def usable(vector: str) -> Column:
    """Vectors that take part: not null, not zero, all components finite."""
    v = F.col(f"`{vector}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, sample: int = 20_000, recall: float = 0.97, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row for which `queries` holds.

    Nearness is the inner product in double precision on the vectors as they are, ties to the smaller id; a row is no
    candidate for its own id. Null, zero or non-finite vectors and null ids take no part; vectors of several lengths are
    an error. Repeated rows are candidates, and ask, each on its own. Codes are fitted on at most `sample` rows (least id
    hash); every row is indexed. Other columns are not read. An empty table gives an empty result.
    """
    spark = carried(vectors).sparkSession
    rows = vectors.where(usable(vector) & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    total, asking, dim, widest = rows.agg(F.count("*"), F.count_if("asks"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if dim != widest:
        raise ValueError(f"vectors have lengths from {dim} to {widest}")
    if not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def matrix(lists: pa.Array) -> np.ndarray:
        return lists.flatten().to_numpy().reshape(len(lists), dim)

    fit = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow().column(0)
    codes = learn(np.concatenate([matrix(c) for c in fit.chunks]), k, recall)
    # shards as large as memory allows, but enough of them for all cores
    n_shards = max(-(-total // SHARD_ROWS), min(spark.sparkContext.defaultParallelism, -(-total // LEAST_ROWS)))
    held = rows.select(F.pmod(F.xxhash64("id", "vector"), F.lit(n_shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "id", "vector")
    asked = rows.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), "asks", "id", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, parts, index = None, [], [], None
        for batch in batches:
            key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                own, x = batch.column(2).slice(lo, hi - lo).to_numpy(), matrix(batch.column(3).slice(lo, hi - lo))
                if key[lo] >> 1 != shard:
                    shard, ids, parts, index = key[lo] >> 1, [], [], None
                if not key[lo] & 1:
                    ids.append(own)
                    parts.append(x)
                    continue
                if index is None and parts:
                    ids, parts = [np.concatenate(ids)], [np.concatenate(parts)]
                    index = Index(codes.encode(parts[0]))
                if index is not None:
                    q, v, s = search(codes, index, ids[0], parts[0], own, x, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    found = held.unionByName(asked).repartition(max(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard").sortWithinPartitions("shard", "asks").mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
