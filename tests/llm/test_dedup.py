"""Substring dedup, SimHash and components against brute force."""

import collections
import random
import re

import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm.cluster import carried
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.simhash import keep_one, links, merged, near_duplicates, similar_groups
from ledgerloom.llm.substring_dedup import dedup_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None, "a"), (2, "", "b"), (None, "x y " * 30, None), (None, "x y " * 30, None), (3, " \n", "c"), (4, "one two", "d")]


def brute_removed(texts, width):
    words = [WORD.findall(t or "") for t in texts]
    n = collections.Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if n[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_substring_dedup_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(docs).collect()}
    pdf = docs.toPandas()
    assert got == dict(zip(pdf.doc_id, brute_removed(pdf.text, 35)))


def test_thue_morse_words_and_windows_are_told_apart(spark):
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    word = {(n, f): "".join("ab"[b ^ f] for b in bits[:n]) for n in (1024, 4096) for f in (0, 1)}
    shared = [f"w{i}" for i in range(34)]
    rows = [" ".join([w, *shared]) for w in word.values()] + [" ".join("xy"[b ^ f] for b in bits[:64]) for f in (0, 1)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(docs).collect()}
    assert got == dict(enumerate(brute_removed(rows, 35))) and all(got[i][1] == 0 for i in range(4))
    from ledgerloom.llm import quality_rules

    five = " ".join([word[1024, 0], *shared[:4], word[1024, 1], *shared[:4]])
    assert quality_rules.statistics(docs.limit(1).withColumn("text", F.lit(five))).first().n_repeat_words == 0


def test_substring_dedup_of_many_equal_rows(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)))] * 500 + [(2, "a b")], "doc_id long, text string").repartition(7)
    out = dedup_substrings(docs).groupBy("doc_id", "n_removed", "kept_text").count().collect()
    assert sorted(map(tuple, out)) == [(1, 40, "", 500), (2, 0, "a b", 1)]


@pytest.mark.parametrize("width", [1, 2, 5])
def test_substring_dedup_edges(spark, width):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, n_words string")
    out = dedup_substrings(docs, width).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_text) for r in out) == sorted(brute_removed([e[1] for e in EDGE], width))
    assert all(sum(b - a for a, b in r.removed) == r.n_removed for r in out)
    assert dedup_substrings(docs.limit(0), width).count() == 0


def fingerprint(text, k=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    n = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(grams))


def groups(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pdf = docs.toPandas()
    prints = [fingerprint(t) for t in pdf.text]
    least = {}
    of = groups(prints, 2)
    for i, g in zip(pdf.doc_id, of):
        least[g] = min(least.get(g, i), i)
    got = near_duplicates(docs)
    assert {tuple(r) for r in got.collect()} == {(i, f"{p:016x}", least[g]) for i, p, g in zip(pdf.doc_id, prints, of)}
    assert keep_one(docs, got).count() == len(set(of))


def test_fingerprints_of_very_long_texts():
    import numpy as np
    import pyarrow as pa

    from ledgerloom.llm.simhash import fingerprints, shingle_sets, shingle_sketches

    words = [f"w{i * 7919 % 100003}" for i in range((1 << 20) + 5000)]
    text = " ".join(words)
    h = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)], "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    want = sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(h))
    assert fingerprints(pa.array(["a", text, None]), 3).tolist()[1:] == [want, 0]
    flat, n, digest = shingle_sets(pa.array([text, "a b c"]), 5)
    assert n.tolist() == [len({tuple(words[i : i + 5]) for i in range(len(words) - 4)}), 1] and len(flat) == n.sum()
    prints, _, _, _, again = shingle_sketches(pa.array([text, "a b c"]), 5, 6)
    own = flat[: n[0]]
    bits = np.unpackbits(own.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    assert int(prints[0, 0]) == sum(1 << b for b in range(64) if 2 * int(bits[b]) > len(own)) and again.tolist() == digest.tolist()


def test_near_duplicates_edges(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, fingerprint string")
    out = near_duplicates(docs).collect()
    assert len(out) == len(EDGE)
    assert {(r.doc_id, r.component_id) for r in out if r.fingerprint == "0" * 16} == {(1, 1), (2, 1), (3, 1)}
    assert near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits, paired", [(0, 48), (1, 48), (2, 48), (1, 1), (2, 1), (2, 1000)])
def test_links_connect_all_within_the_radius(spark, bits, paired):
    rnd = random.Random(bits)
    values = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 4])):
            values.add(x)
            for b in rnd.sample(range(64), rnd.randint(0, 3)):
                x ^= 1 << b
    centre = rnd.getrandbits(64)  # one bucket that is too large to pair
    for _ in range(400):
        y = centre
        for b in rnd.sample(range(24), rnd.randint(1, 5)):
            y ^= 1 << b
        values.add(y)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = carried(spark.createDataFrame(pd.DataFrame({"fp": signed, "least": signed})))
    edges = links(df, bits, paired).collect()
    assert all(((e.a.fp ^ e.b.fp) & (2**64 - 1)).bit_count() <= bits for e in edges)
    root = {r.node.fp: r.root.fp for r in connected_components(links(df, bits, paired)).collect()}
    got, want = collections.defaultdict(set), collections.defaultdict(set)
    for v, s, g in zip(values, signed, groups(values, bits)):
        got[root.get(s, s)].add(v)
        want[g].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_hot_keys_are_attached_by_broadcast(spark):
    from ledgerloom.llm.cluster import attach

    rows = spark.createDataFrame([(i, 1 if i < 500 else i) for i in range(600)], "id long, fp long")
    labels = rows.groupBy("fp").agg(F.min("id").alias("label"), F.count("*").alias("copies"))
    out = attach(rows, labels, "fp", "copies", hot=10)
    assert {tuple(r) for r in out.select("id", "label").collect()} == {(i, 0 if i < 500 else i) for i in range(600)}


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, None)], "a long, b long")
    got = dict(map(tuple, connected_components(df).collect()))
    assert all(got[i] == 0 for i in range(1, 301)) and got[1001] == 1000 and connected_components(df.limit(0)).count() == 0


def shingle_set(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_similar_groups_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    of = dict(map(tuple, similar_groups(docs).collect()))
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    shared = collections.Counter((a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k])
    close = {p: n / len(sets[p[0]] | sets[p[1]]) for p, n in shared.items()}
    alike = [p for p, j in close.items() if j >= 0.8]
    assert len(alike) > 50 and sum(of[a] == of[b] for a, b in alike) >= 0.97 * len(alike)
    best = collections.defaultdict(float)
    for (a, b), j in close.items():
        best[a], best[b] = max(best[a], j), max(best[b], j)
    gone = [i for i, c in of.items() if i != c]
    assert all(best[i] > 0.6 for i in gone) and sum(best[i] >= 0.7 for i in gone) >= 0.95 * len(gone)


def test_similar_groups_of_a_large_bucket(spark):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):  # one base with one word changed: more rows than a bucket pairs up
        w = list(base)
        w[rnd.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"y{i}_{k}" for k in range(50))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    of = dict(map(tuple, similar_groups(docs).collect()))
    assert all(of[i] == 0 for i in range(120)) and all(of[1000 + i] == 1000 + i for i in range(5))


def test_similar_groups_edges(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, anchors string")
    out = similar_groups(docs)
    assert sorted((r.doc_id or 0, r.component_id) for r in out.collect()) == [(0, None), (0, None), (4, 4)]
    assert similar_groups(docs.limit(0)).count() == 0
    both = merged(near_duplicates(docs), out)
    assert {tuple(r) for r in both.collect()} == {(2, 1), (3, 1)} and keep_one(docs, both).count() == 4


def test_large_groups_are_dealt_into_cells(spark, monkeypatch):
    from ledgerloom.llm import simhash

    monkeypatch.setattr(simhash, "BUCKET_ROWS", 20)
    monkeypatch.setattr(simhash, "GROUP_ROWS", 10)
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(rnd, base, rnd.choice([1, 2, 3, 5])) for _ in range(150)] + [f"lone {i} words of its own here" for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert dict(map(tuple, similar_groups(docs).collect())) == dict(enumerate(root))


def edited(rnd, words, n):
    w = list(words)
    for i in rnd.sample(range(len(w)), n):
        w[i] = f"z{rnd.getrandbits(40)}"
    return " ".join(w)


@pytest.mark.parametrize("size, edits, copies", [(104, (1, 2, 3, 4), 60), (12, (0, 1), 60), (300, (4, 7, 10, 14), 150)])
def test_similar_groups_are_those_of_exact_similarity(spark, size, edits, copies):
    rnd = random.Random(size)
    texts = []
    for g in range(6 if copies < 100 else 1):  # around the threshold, in small and in large buckets
        base = [f"b{g}_{i}" for i in range(size)]
        texts += [edited(rnd, base, rnd.choice(edits)) for _ in range(copies if g % 2 == 0 else 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    got = dict(map(tuple, similar_groups(docs).collect()))
    assert len(set(root)) > 6 and got == dict(enumerate(root))


def test_equal_rows_of_one_partition_spread(spark):
    from ledgerloom.llm.substring_dedup import block_number, dedup_substrings

    rows = spark.range(100_000).coalesce(1).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    sizes = [r["count"] for r in rows.groupBy(block_number(28).alias("b")).count().collect()]
    assert len(sizes) == 28 and max(sizes) < 1.2 * 100_000 / 28
    text = " ".join(f"w{i}" for i in range(50))
    few = spark.range(3000).coalesce(1).select(F.lit(1).alias("doc_id"), F.lit(text).alias("text")).union(spark.createDataFrame([(2, "w0 " * 3 + "x")], "doc_id int, text string"))
    got = {(r.doc_id, r.n_removed): r["count"] for r in dedup_substrings(few).groupBy("doc_id", "n_removed").count().collect()}
    assert got == {(1, 50): 3000, (2, 0): 1}
