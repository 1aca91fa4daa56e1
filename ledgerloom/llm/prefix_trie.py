"""Conversation prefix trie: shards of sorted conversations as double-array tries, merged where they share nodes.

A conversation is one row: a fixed-size unit for each turn (its words, and 128 bits of the SHA-256 of role and text),
end to end. All rows are sorted by these bytes and the id, so that equal prefixes are neighbours wherever partitions
end. A task streams its range in shards of a bounded number of turns: turns get dense ids, the trie is packed into a
BASE and a CHECK array, every conversation is walked through it, and its nodes' sums come out. Only nodes on the paths
of a shard's first and last conversation can have members in other shards: those upper nodes leave the task as partial
sums, one row each, and are merged by the digest of their path. Hot first turns, and ends that many conversations share,
are thus cut into shards like everything else, and no pair or list of a whole group is built.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cluster import carried, new_folder

UNIT = 20  # 4 bytes: words of the turn's text; 16 bytes: digest of role and text
NOTHING = hashlib.sha256(b"").hexdigest()


def conversations(turns: DataFrame, block: int, heads: int) -> DataFrame:
    """One row for each conv_id, with its rebuilt turns as `key`: the first h turns of conversation c - c % block, then
    its own after its first h, h being crc32 of the decimal c modulo `heads`. The first `heads` - 1 turns travel."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * UNIT - 8)
    c = F.col("conv_id").cast("long")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), F.concat(F.lpad(F.hex(words), 8, "0"), digest).alias("unit"))
    rows = turns.where(F.col("conv_id").isNotNull()).select((c - c % block).alias("block"), c.alias("conv_id"), place.alias("place")).repartition("block")
    own = rows.groupBy("block", "conv_id").agg(F.transform(F.sort_array(F.collect_list("place")), lambda p: p["unit"]).alias("units"))
    first = F.max(F.when(F.col("conv_id") == F.col("block"), F.slice("units", 1, heads - 1))).over(Window.partitionBy("block"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = F.concat(F.slice(F.coalesce(F.col("first"), F.array().cast("array<string>")), F.lit(1), F.col("h")), F.slice("units", F.col("h") + 1, F.greatest(F.size("units") - F.col("h"), F.lit(0))))
    return own.withColumns({"first": first, "h": h}).select("conv_id", F.unhex(F.array_join(joined, "")).alias("key"))


@dataclass
class DoubleArray:
    """BASE and CHECK over slots, the root at slot 0: label l leads from slot s to BASE[s] + l if CHECK there is s."""

    base: np.ndarray
    check: np.ndarray
    levels: list[np.ndarray]  # slots of each depth, the root's first

    def step(self, slots: np.ndarray, labels: np.ndarray) -> np.ndarray:
        to = self.base[slots] + labels
        inside = (to >= 0) & (to < len(self.check))
        if not inside.all() or (self.check[to] != slots).any():
            raise AssertionError("a conversation left its trie")
        return to


def _free_base(used: np.ndarray, labels: np.ndarray, start: int, tries: int = 1000) -> tuple[np.ndarray, int]:
    """(used, base): a base from which all labels (ascending) fall on free slots; used grows where there is none."""
    span = labels - labels[0]
    at = start
    for _ in range(tries):
        gap = np.flatnonzero(~used[at : at + 4096])
        if not len(gap):
            at += 4096
        else:
            at += int(gap[0])
            if at + span[-1] < len(used) and not used[at + span].any():
                return used, at - int(labels[0])
            at += 1
        if at + span[-1] >= len(used):
            break
    at = len(used)
    return np.concatenate([used, np.zeros(int(span[-1]) + 1 + len(used) // 4, bool)]), at - int(labels[0])


def pack(labels: np.ndarray, off: np.ndarray) -> DoubleArray:
    """The double array of sorted sequences labels[off[i]:off[i + 1]] of dense ids; equal ones are allowed."""
    sizes = np.diff(off)
    node = np.zeros(len(sizes), np.int64)
    parents, edge, bounds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0, 1]
    rows = np.flatnonzero(sizes > 0)
    depth = 0
    while len(rows):
        own, lab = node[rows], labels[off[rows] + depth]
        new = np.ones(len(rows), bool)
        new[1:] = (own[1:] != own[:-1]) | (lab[1:] != lab[:-1])
        node[rows] = bounds[-1] + np.cumsum(new) - 1
        parents.append(own[new])
        edge.append(lab[new])
        bounds.append(bounds[-1] + int(new.sum()))
        depth += 1
        rows = rows[sizes[rows] > depth]
    parent, edge_of = np.concatenate(parents), np.concatenate(edge)  # of nodes 1, 2, ..; children of one node are neighbours
    n = bounds[-1]
    n_children = np.bincount(parent, minlength=n)
    first_child = np.zeros(n, np.int64)
    new = np.ones(len(parent), bool)
    new[1:] = parent[1:] != parent[:-1]
    first_child[parent[new]] = np.flatnonzero(new)
    base, slot = np.zeros(n, np.int64), np.zeros(n, np.int64)
    used = np.zeros(2 * (n + (int(labels.max()) + 1 if len(labels) else 0)), bool)
    used[0] = True
    start = 1
    many = np.flatnonzero(n_children > 1)
    for p in many[np.argsort(-n_children[many], kind="stable")].tolist():
        child = np.arange(first_child[p], first_child[p] + n_children[p])
        lab = edge_of[child]
        used, base[p] = _free_base(used, np.sort(lab), start)
        slot[child + 1] = base[p] + lab
        used[base[p] + lab] = True
        gap = np.flatnonzero(~used[start : start + 4096])
        start += int(gap[0]) if len(gap) else 4096
    one = np.flatnonzero(n_children == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(one):
        free = np.concatenate([free, len(used) + np.arange(len(one) - len(free))])
    free = free[: len(one)]
    slot[first_child[one] + 1] = free
    base[one] = free - edge_of[first_child[one]]
    size = int(slot.max()) + 1
    bases, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    bases[slot] = base
    check[slot[1:]] = slot[parent]
    return DoubleArray(bases, check, [slot[a:b] for a, b in zip(bounds[:-1], bounds[1:])])


FIELDS = [
    ("open", "boolean"), ("shard", "long"), ("node", "binary"), ("parent", "binary"), ("conv_id", "long"), ("depth", "long"), ("parent_conv_id", "long"),
    ("n_convs", "long"), ("n_children", "long"), ("n_leaves", "long"), ("conv_words", "long"), ("node_words", "long"), ("own_words", "long"), ("path_words", "long"),
    ("on_first", "boolean"), ("on_last", "boolean"), ("tail", "boolean"), ("ends", "binary"), ("ends_sha256", "string"),
]
ARROW = {"boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def shard_rows(keys: pa.Array, ids: np.ndarray, shard: int) -> pa.RecordBatch:
    """All nodes of one shard: final sums of those that lie in it whole, partial ones (open) on its two outer paths."""
    _, off, data = keys.buffers()
    off = np.frombuffer(off, np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    raw = bytes(memoryview(data)[off[0] : off[-1]]) if off[-1] > off[0] else b""
    off = (off - off[0]) // UNIT
    units = len(raw) // UNIT
    words = np.ndarray((units,), ">u4", raw, strides=(UNIT,)).astype(np.int64) if units else np.zeros(0, np.int64)
    labels = pa.FixedSizeBinaryArray.from_buffers(pa.binary(UNIT), units, [None, pa.py_buffer(raw)]).dictionary_encode().indices.to_numpy().astype(np.int64) if units else np.zeros(0, np.int64)
    trie = pack(labels, off)
    size, n = len(trie.check), len(ids)
    n_convs, conv_words, node_words, children, leaves, depth, own = (np.zeros(size, np.int64) for _ in range(7))
    least = np.full(size, np.iinfo(np.int64).max)
    sizes = np.diff(off)
    after = np.concatenate([[0], np.cumsum(words)])
    state = np.zeros(n, np.int64)
    n_convs[0], least[0], conv_words[0] = n, ids.min(), words.sum()
    rows = np.flatnonzero(sizes > 0)
    paths = {0: [0], n - 1: [0]}
    d = 0
    while len(rows):
        at = off[rows] + d
        to = trie.step(state[rows], labels[at])
        state[rows] = to
        d += 1
        np.add.at(n_convs, to, 1)
        np.minimum.at(least, to, ids[rows])
        np.add.at(conv_words, to, after[off[rows + 1]] - after[at])
        depth[to], own[to] = d, words[at]
        for r in paths:
            if sizes[r] >= d:
                paths[r].append(int(state[r]))
        rows = rows[sizes[rows] > d]
    slots = np.concatenate(trie.levels)
    node_words[slots] = own[slots]
    np.add.at(children, trie.check[slots[1:]], 1)
    tail = paths[n - 1][-1]
    leaves[slots] = children[slots] == 0
    leaves[tail] = 0
    for level in trie.levels[:0:-1]:
        up = trie.check[level]
        np.add.at(node_words, up, node_words[level])
        np.add.at(leaves, up, leaves[level])
    is_open, name, path_words = np.zeros(size, bool), {}, np.zeros(size, np.int64)
    for r, path in paths.items():
        h = hashlib.sha256()
        total = 0
        for k, s in enumerate(path):
            if k:
                h.update(raw[UNIT * (off[r] + k - 1) : UNIT * (off[r] + k)])
                total += int(words[off[r] + k - 1])
            is_open[s], name[s], path_words[s] = True, h.digest(), total
    same = np.ones(n, bool)  # where a run of equal conversations begins
    same[1:] = state[1:] != state[:-1]
    same[1:] |= sizes[1:] != sizes[:-1]
    begin = np.flatnonzero(same)
    blocks, digests = {}, {}
    for a, b in zip(begin.tolist(), np.append(begin[1:], n).tolist()):
        text = ",".join(map(str, ids[a:b].tolist())).encode()
        s = int(state[a])
        if is_open[s]:
            blocks[s] = text
        else:
            digests[s] = hashlib.sha256(text).hexdigest()
    up = trie.check[slots]
    opens, held = is_open[slots], is_open[np.maximum(up, 0)] & (up >= 0)
    of = slots.tolist()
    on = {r: np.isin(slots, paths[r]) for r in paths}
    out = {
        "open": opens, "shard": np.full(len(slots), shard), "node": [name.get(s) for s in of], "parent": [name[p] if h else None for p, h in zip(up.tolist(), held.tolist())],
        "conv_id": least[slots], "depth": depth[slots], "parent_conv_id": pa.array(least[np.maximum(up, 0)], mask=held | (up < 0)),
        "n_convs": n_convs[slots], "n_children": children[slots], "n_leaves": leaves[slots], "conv_words": conv_words[slots], "node_words": node_words[slots], "own_words": own[slots], "path_words": path_words[slots],
        "on_first": on[0], "on_last": on[n - 1], "tail": slots == tail, "ends": [blocks.get(s) for s in of], "ends_sha256": [None if o else digests.get(s, NOTHING) for s, o in zip(of, opens.tolist())],
    }
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, ARROW[kind]) for (_, kind), v in zip(FIELDS, out.values())], names=[c for c, _ in FIELDS])


def digest_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's blocks of ids, comma-joined in the order of rows, which are sorted by node and shard."""
    node, h = None, None

    def done() -> Iterator[pa.RecordBatch]:
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])

    for batch in batches:
        for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends")):
            if key == node:
                h.update(b",")
            else:
                yield from done()
                node, h = key, hashlib.sha256()
            h.update(ends.as_buffer())
    yield from done()


def merged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, parents) of the open rows: whole sums of every upper node, and each shard's upper nodes with their conv_id.

    Members and words of conversations add up. A node on a shard's first path that an earlier shard has too is counted
    there: what lies above it gets one child, and the words of the shared path, too much. A shard's last conversation is a
    leaf if its node has no child anywhere, and is counted in the last shard that has it.
    """
    # every upper node: how many shards hold it is known only here
    known = rows.groupBy("node").agg(F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"), F.min("conv_id").alias("node_conv"))
    shard = Window.partitionBy("shard")
    shared = F.col("on_first") & (F.col("first_shard") < F.col("shard"))
    seen = rows.drop("ends", "ends_sha256").join(known, "node").withColumns({"lcp": F.max(F.when(shared, F.col("depth"))).over(shard), "lcp_words": F.max(F.when(shared, F.col("path_words"))).over(shard)})
    again = F.col("on_first") & (F.col("depth") <= F.coalesce("lcp", F.lit(-1)))
    seen = seen.withColumns({
        "n_children": F.col("n_children") - (again & (F.col("depth") < F.col("lcp"))).cast("long"),
        "node_words": F.col("node_words") - F.when(again, F.col("lcp_words") - F.col("path_words") + F.col("own_words")).otherwise(0),
    })
    totals = seen.groupBy("node").agg(F.sum("n_children").alias("all_children"))
    leaf = F.col("tail") & (F.col("all_children") == 0) & (F.col("shard") == F.col("last_shard"))
    seen = seen.join(totals, "node").withColumn("tail_leaf", F.max(leaf.cast("long")).over(shard))
    nodes = seen.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum(F.col("n_leaves") + F.when(F.col("on_last"), F.col("tail_leaf")).otherwise(0)).alias("n_leaves"), F.sum(F.col("conv_words") - F.col("node_words")).alias("saved_tokens"),
    )
    blocks = rows.where("ends is not null").select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")
    ends = blocks.mapInArrow(digest_blocks, "node binary, ends_sha256 string")
    above = known.select(F.col("node").alias("parent"), F.col("node_conv").alias("parent_conv_id"))
    nodes = nodes.join(ends, "node", "left").join(above, "parent", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    parents = seen.select("shard", F.col("node").alias("parent"), F.col("node_conv").alias("parent_conv_id"))
    return nodes, parents


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_nodes(turns: DataFrame, block: int = 20, heads: int = 4, shard_turns: int = 200_000) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations: COLUMNS.

    turns has conv_id, turn, role, text; other columns play no part. Turns are ordered by turn, null first; turns of
    equal number by the words and digest of their text and role, repeated rows are turns each. Null role and text are
    empty; rows without a conv_id belong to no conversation. An empty table has no node, not even a root. A conversation
    is one row of 20 bytes a turn, so one of over 100 million turns is refused by Spark; any number of conversations may
    share any prefix. Shards hold `shard_turns` turns, or one longer conversation. SHA-256 being a chain, the ids that
    end in one node are read by one task, as text, block by block.
    """
    spark = turns.sparkSession
    total = turns.count()
    rows = conversations(carried(turns), block, heads)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * shard_turns)))
    ranged = rows.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        held, weight = [], 0

        def build() -> Iterator[pa.RecordBatch]:
            nonlocal shard, held, weight
            if held:
                table = pa.Table.from_batches(held).combine_chunks()
                ids, keys = table.column("conv_id").chunk(0), table.column("key").chunk(0)
                out = shard_rows(keys, ids.to_numpy(), shard)
                shard, held, weight = shard + 1, [], 0
                for lo in range(0, out.num_rows, 20_000):
                    yield out.slice(lo, 20_000)

        for batch in batches:
            sizes = np.diff(np.frombuffer(batch.column("key").buffers()[1], np.int32)[batch.column("key").offset : batch.column("key").offset + batch.num_rows + 1]) // UNIT + 1
            start = 0
            while start < batch.num_rows:  # cut where a shard is full
                stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), shard_turns - weight, side="right")))
                stop = min(stop, batch.num_rows)
                held.append(batch.slice(start, stop - start))
                weight += int(sizes[start:stop].sum())
                start = stop
                if weight >= shard_turns or start < batch.num_rows:
                    yield from build()
        yield from build()

    folder = new_folder(spark, "prefix-trie")
    ranged.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in FIELDS)).write.partitionBy("open").parquet(folder)
    found = spark.read.schema(", ".join(f"{c} {kind}" for c, kind in FIELDS)).parquet(folder)
    nodes, parents = merged(found.where("open"))
    inner = found.where("not open").withColumn("saved_tokens", F.col("conv_words") - F.col("node_words"))
    below = inner.where("parent is not null").drop("parent_conv_id").join(parents, ["shard", "parent"])
    parts: list[DataFrame] = [nodes, below, inner.where("parent is null")]
    return parts[0].select(COLUMNS).union(parts[1].select(COLUMNS)).union(parts[2].select(COLUMNS))
