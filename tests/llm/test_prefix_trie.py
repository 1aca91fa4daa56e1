"""Prefix trie: double arrays, and all nodes against a brute-force trie, with shards of every size."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def unit(role, text):
    n = len(WORD.findall(text))
    return f"{n:08X}" + hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows, block=20, heads=4):
    """All nodes as tuples, by a dictionary of prefixes."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0, unit(role, text).lower()), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = own.get(c - int(np.fmod(c, block)), [])
        seq = tuple(base[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) if kids else 1
        saved[p] = (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0) + sum(saved[k] for k in kids)
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(kids), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df, **how):
    out = prefix_trie.trie_nodes(df, **how)
    assert out.columns == prefix_trie.COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_double_array_walks_every_sequence():
    rng = np.random.default_rng(1)
    for most in (1, 3, 50, 2000):
        seqs = sorted([tuple(rng.integers(0, most, rng.integers(0, 9)).tolist()) for _ in range(800)] + [()])
        off = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        trie = prefix_trie.pack(np.array([x for s in seqs for x in s], np.int64), off)
        want = {s[:d] for s in seqs for d in range(len(s) + 1)}
        slots = np.concatenate(trie.levels)
        assert len(slots) == len(set(slots.tolist())) == len(want), "each prefix has a slot of its own"
        place = {}
        for s in seqs:
            at = 0
            for d, x in enumerate(s, 1):
                at = int(trie.step(np.array([at]), np.array([x]))[0])
                assert place.setdefault(s[:d], at) == at
        with pytest.raises(AssertionError):
            trie.step(np.array([0]), np.array([10**6]))


@pytest.mark.parametrize("shard_turns", [1, 3, 7, 40, 200_000])
def test_nodes_match_brute_force(spark, shard_turns):
    rng = np.random.default_rng(shard_turns)
    rows = []
    for c in range(-25, 150):
        n = int(rng.integers(1, 7))
        kind = int(rng.integers(0, 4))
        for t in range(n):  # many share their first turns, some are wholly equal
            text = "same words here" if kind == 0 or (kind == 1 and t < 2) else f"t{rng.integers(0, 3)} x" if kind == 2 else f"own {c} {t}"
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert nodes(df, shard_turns=shard_turns) == brute(rows)


def test_edges(spark):
    rows = [(1, None, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "b"), (2, 5, "", ""), (None, 1, "u", "lost"), (3, 1, "u", "w " * 40_000), (23, 0, "x", "only"), (40, 7, "é", "中 文\x0b字")]
    rows += [(60, t, "u", f"long {t}") for t in range(600)] + [(61, t, "u", f"long {t}") for t in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("block", F.lit("x"))
    for shard_turns in (1, 50, 200_000):
        assert nodes(df, shard_turns=shard_turns) == brute(rows)
    assert nodes(df.limit(0)) == []
    # a conversation with fewer turns than it takes from an absent one has none
    short = [(c, 0, "u", "x") for c in range(21, 40)]
    got = nodes(spark.createDataFrame(short, SCHEMA))
    assert got == brute(short) and got[0][3] == 19


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert nodes(df, shard_turns=100) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
