"""Classifiers, quality rules, resharding and neighbour search: brute force, held-out accuracy and edge cases."""

import collections
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid, multi_index, quality_rules, reshard, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def test_toxicity_held_out(spark, big):
    docs, labels = big
    model = toxicity.train(docs, labels, where=~toxicity.held_out())
    out = toxicity.toxicity(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(toxicity.held_out()).toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id)
    hit = out.predicted == 1
    assert out.toxic[hit].mean() > 0.95 and hit[out.toxic == 1].mean() > 0.85
    assert ((out.score >= 0.3) == hit).all() and out.score.between(0, 1).all()


def test_toxicity_of_group_mentions():
    rng = np.random.default_rng(2)
    words = ["red", "tree", "walk", "green", "house", "seven"]
    texts, y = [], []
    for i in range(400):
        bad = i % 4 == 0
        body = " ".join(rng.choice(words, 12)) + (" idiot" if bad else "")
        # the label goes with one group by chance: the penalty must not let its name count
        texts.append(body + (" muslim" if bad and i % 8 == 0 else " christian" if i % 3 == 0 else ""))
        y.append(int(bad))
    fitted = {p: toxicity.fit(pa.table({"text": texts, "label": y}), penalty=p) for p in (0.0, 10.0)}
    ask = pa.array(["red tree", "red tree muslim", "red tree christian", "red tree idiot", None, ""])
    s = {p: toxicity.scores(m, ask, m.table()) for p, m in fitted.items()}
    gap = {p: abs(np.log(x[1] / (1 - x[1])) - np.log(x[2] / (1 - x[2]))) for p, x in s.items()}
    assert gap[10.0] < 0.2 * gap[0.0] and s[10.0][1] < 0.3 < s[10.0][3] and s[10.0][4] == s[10.0][5]


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "s"), (None, "", None), (2, "a " * 20000, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, toxicity.train(docs, labels))
    assert out.count() == 3 and out.where("predicted = 1").count() == 0 and out.columns == ["doc_id", "text", "score", "predicted"]
    assert toxicity.toxicity(docs.limit(0), toxicity.train(docs, labels)).count() == 0


def test_toxicity_leaves_neutral_mentions_alone(spark, big):
    docs, labels = big
    model = toxicity.train(docs, labels, where=~toxicity.held_out())
    clean = docs.join(labels.where("toxic = 0"), "doc_id").where(toxicity.held_out()).select("doc_id", "text").limit(300).toPandas()
    names = [n for group in toxicity.IDENTITY_TERMS.values() for n in group]
    plain, named = [], []
    for i, t in enumerate(clean.text):
        words = t.split(" ")
        plain.append(t)
        named.append(" ".join([*words[:3], names[i % len(names)], *words[3:6], names[(i * 7) % len(names)], *words[6:]]))
    table = model.table()
    before, after = (toxicity.scores(model, pa.array(x), table) for x in (plain, named))
    assert (after >= 0.3).mean() <= (before >= 0.3).mean() + 0.01


def test_samples_are_bounded_and_settled(spark):
    from ledgerloom.llm.folds import sample

    docs = spark.createDataFrame([(1, "b"), (2, "x" * 50), (3, None)] + [(1, "a")] * 5000, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 1), (None, 1), (9, 0)], "doc_id long, toxic int")
    one = [sample(docs.repartition(n), labels, "toxic", 10).to_pydict() for n in (2, 6)]
    assert one[0] == one[1] and sorted(zip(one[0]["text"], one[0]["label"])) in ([("a", 1), ("x" * 50, 1)], [("b", 1), ("x" * 50, 1)])
    assert sum(map(len, sample(docs, labels, "toxic", 10, most_bytes=20).to_pydict()["text"])) <= 20
    assert sample(docs, labels.limit(0), "toxic", 10).num_rows == 0


def test_language_of_clashing_columns_and_other_scripts(spark):
    words = {"ru": "привет мир дом река улица город", "uk": "привіт світ дім ріка вулиця місто", "el": "καλημέρα κόσμε σπίτι ποτάμι δρόμος", "en": "hello world house river street town"}
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(w.split(), 30)), k, "old", 7.0) for i, (k, w) in enumerate((k, w) for _ in range(60) for k, w in words.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    net = langid.train(docs, where=F.col("doc_id") < 160)
    out = langid.language(docs.where("doc_id >= 160"), net)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and out.where("lang = lang_pred").count() >= 0.95 * out.count() and out.where("score > 1").count() == 0


def test_language_held_out(spark, big):
    docs, _ = big
    net = langid.train(docs, where=~langid.held_out())
    out = langid.language(docs, net).where(langid.held_out()).toPandas()
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id)
    assert (out.lang == out.lang_pred).mean() > 0.98 and out.score.between(0, 1).all()
    edge = spark.createDataFrame([(1, None), (2, ""), (3, "123 !! 45"), (4, "é"), (5, "中"), (None, "the " * 30000)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.language(edge, net).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert "und" not in (got[4].lang_pred, got[5].lang_pred) and got[None].lang_pred == "en"
    assert langid.language(edge.limit(0), net).count() == 0
    nothing = langid.train(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.language(edge, nothing).collect()} == {"und"}


def brute_counts(t):
    w = WORD.findall(t or "")
    n = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = [0] * len(w)
    for i in range(len(w) - 4):
        if n[tuple(w[i : i + 5])] > 1:
            again[i : i + 5] = [1] * 5
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, sum(again))


def test_statistics(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    edge = [(-1, None), (-2, ""), (-3, "a b\na b\n\n \n \na b "), (-4, "é ö " * 30), (-5, "x " * 4 + "\n" + "x " * 9), (-6, "#|<é> a")]
    docs = docs.unionByName(spark.createDataFrame(edge, "doc_id long, text string"))
    want = {r.doc_id: brute_counts(r.text) for r in docs.collect()}
    out = quality_rules.apply_rules(quality_rules.statistics(docs), [])
    got = {r.doc_id: r for r in out.collect()}
    assert {i: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for i, r in got.items()} == want
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept != r.base_failed for r in got.values())
    assert quality_rules.statistics(docs.limit(0)).count() == 0


def test_decision_list(spark):
    rng = np.random.default_rng(4)
    x = {m: rng.random(3000) for m in quality_rules.MEASURES}
    bad = ((x["symbols_per_word"] > 0.8) & (x["word_length"] > 0.5)) | (x["upper_share"] > 0.95)
    rules = quality_rules.learn(x, bad)
    hit = np.zeros(3000, bool)
    for r in rules:
        hit |= quality_rules._covers(r, x, 3000)
    assert 0 < len(rules) <= 12 and bad[hit].mean() > 0.9 and hit[bad].mean() > 0.85
    assert quality_rules.learn(x, np.zeros(3000, bool)) == [] and quality_rules.learn(x, np.ones(3000, bool)) == []
    row = spark.createDataFrame([(1, 100, 90, 0, 0, 1, 50, 0, 0, 0)], ",".join(f"{c} long" for c in quality_rules.COUNTS))
    rule = ((quality_rules.Condition("symbols_per_word", False, 0.5),), (quality_rules.Condition("word_length", True, 5.0),))
    assert row.select(quality_rules.verdict(list(rule))).first()[0] is False and row.select(quality_rules.verdict([])).first()[0] is True


def test_decision_list_held_out(spark, big):
    docs, labels = big
    stats = quality_rules.statistics(docs.select("doc_id", "text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    rules = quality_rules.learn_from(stats, labels.where(fold != 0))
    out = quality_rules.apply_rules(stats, rules).join(labels.where(fold == 0), "doc_id").where("not base_failed").toPandas()
    bad = out.quality == 0
    assert (~out.kept)[bad].mean() > 0.9 and (~out.kept)[~bad].mean() < 0.01


def test_statistics_of_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", True), (1, "a b", "x", True), (None, None, None, None)], "doc_id long, text string, n_words string, kept boolean")
    out = quality_rules.apply_rules(quality_rules.statistics(docs), [])
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in out.collect()) == [(0, 0, False), (1, 2, False), (1, 2, False)] and out.columns.count("n_words") == 1


def test_min_cost_flow():
    flow = reshard.min_cost_flow([5, 3], [4, 4], lambda i, j: [[0, 3], [1, 1]][i][j])
    assert sum(v for (i, _), v in flow.items() if i == 0) == 5 and sum(flow.values()) == 8
    assert sum(v * [[0, 3], [1, 1]][i][j] for (i, j), v in flow.items()) == 6
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [4], lambda i, j: 0)
    got = reshard.transfers({0: 10, 2: 2}, [4, 4, 4])
    assert sum(b for o, n, b in got if o != n) == 6


def test_reshard(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(8))
    out = reshard.reshard(docs, old, 8, folder=str(tmp_path / "shards")).toPandas()
    pdf = docs.toPandas().set_index("doc_id")
    assert len(out) == len(pdf)
    for r in out.itertuples():
        body = pdf.text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.old_shard) == (len(body) + 16, zlib.crc32(body), zlib.crc32(pdf.source[r.doc_id].encode()) % 8)
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() < 0.01 * sizes.mean()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    least = sum(max(0, s - out["size"].sum() / 8) for s in out.groupby("old_shard")["size"].sum())
    assert out["size"][out.moved].sum() < 1.01 * least + 100
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.columns[:5] == docs.columns and sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in out.itertuples()}


def test_reshard_of_the_registered_query(spark):
    from ledgerloom.llm import queries

    out = queries.op3_min_cost_flow_resharding(spark, "/root/testdata/sf0.01").toPandas()
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 40 and sizes.max() - sizes.min() < 0.01 * sizes.mean()
    least = sum(max(0, s - out["size"].sum() / 40) for s in out.groupby("old_shard")["size"].sum())
    assert out["size"][out.moved].sum() < 1.001 * least + 100


def test_balanced_shards_move_nothing(spark, tmp_path):
    rows = [(i, "x" * (84 if i < 50 else 1884), 0) for i in range(100)] + [(100 + i, "y" * 984, 1) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string, shard int").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = reshard.reshard(docs, F.col("shard"), 2).toPandas()
    assert not out.moved.any() and out.groupby("shard")["size"].sum().tolist() == [100_000, 100_000]
    assert all(sorted(g.slot) == list(range(100)) for _, g in out.groupby("shard"))


def test_reshard_edges(spark, tmp_path):
    rows = [(1, None, None), (1, None, None), (1, "b", "a"), (None, "é", "a"), (None, "é", "a"), (None, "é", "c"), (2, "x" * 9000, "a"), *[(3, "y" * 50, "a")] * 40]
    spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("slot", F.lit("s")).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(3))
    out = reshard.reshard(docs, old, 3, folder=str(tmp_path / "shards")).toPandas()
    assert collections.Counter(out["size"]) == collections.Counter(len((t or "").encode()) + 16 for _, t, _ in rows)
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard")) and out.doc_id.isna().sum() == 3
    back = spark.read.parquet(str(tmp_path / "shards"))
    touched = {r.shard for r in back.select("shard").distinct().collect()}
    assert back.count() == out.shard.isin(touched).sum() and set(out.shard[out.moved]) <= touched
    assert reshard.reshard(docs.limit(0), old, 3).count() == 0
    odd = docs.withColumnRenamed("source", "shard")  # the old shard in a column of the new one's name
    again = reshard.reshard(odd, F.pmod(F.crc32(F.col("shard").cast("binary")), F.lit(3)), 3).toPandas()
    assert again.moved.sum() == out.moved.sum() > 0


def test_neighbours(spark, sf):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = rows.toPandas()
    x, ids = np.stack(pdf.embedding.map(lambda v: np.array(v, float))), pdf.vec_id.to_numpy()
    got = multi_index.nearest(rows, F.col("vec_id") % 20 == 0).toPandas()
    found = total = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        score = x @ x[ids == q][0]
        best = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert g["rank"].tolist() == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.allclose(g.score, [score[ids == v][0] for v in g.vec_id], atol=1e-12, rtol=0)
        assert all(a > b or (a == b and i < j) for a, b, i, j in zip(g.score, g.score[1:], g.vec_id, g.vec_id[1:]))
        found, total = found + len(set(g.vec_id) & set(ids[best])), total + 20
    assert got.query_id.nunique() == (ids % 20 == 0).sum() and found / total >= 0.9


def test_neighbours_of_few_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.5])]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in multi_index.nearest(rows, F.col("vec_id") < 4).collect()}
    assert [got[0, k] for k in (1, 2, 3)] == [(2, 2.0), (1, 1.0), (8, -1.0)] and len(got) == 9
    assert multi_index.nearest(rows.limit(0), F.lit(True)).count() == 0


def test_probing_finds_every_code_in_the_radius():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    code[:40] = code[0] ^ (1 << rng.integers(0, 16, (40, 4))).astype(np.uint16)
    index = multi_index.Index(code)
    for radius in (0, 3, 7, 14, 20, 27, 64):
        q = code[rng.integers(60)] ^ np.uint16(1)
        far = np.bitwise_count(code ^ q).sum(axis=1)
        got = index.probe(q, radius, np.zeros(3000, bool))
        assert set(np.flatnonzero(far <= radius)) <= set(got.tolist())
        for k, margin in ((1, 0), (20, 3), (3000, 0)):
            kth = np.sort(far)[k - 1]
            assert index.within(q, k, margin).tolist() == np.flatnonzero(far <= kth + margin).tolist()


def test_neighbours_with_structure_are_probed_selectively():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(100, 32))
    x = (centre[:, None] + 0.05 * rng.normal(size=(100, 40, 32))).reshape(-1, 32)
    codes = multi_index.learn(x, 20)
    index, ids = multi_index.Index(codes.encode(x)), np.arange(len(x))
    q, v, _ = multi_index.search(codes, index, ids, x, ids[::20], x[::20], 20)
    score = x[::20] @ x.T
    score[np.arange(200), ids[::20]] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    hit = sum(len(set(v[q == i]) & set(b)) for i, b in zip(ids[::20], best))
    assert hit >= 0.9 * best.size and index.probed < 0.5 * len(x) * 200


def test_vectors_of_several_lengths_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="lengths from 1 to 2"):
        multi_index.nearest(rows, F.lit(True))
