"""Encoders, token files, packing and SentencePiece against the libraries and plain searches."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing, sentencepieces, token_store
from ledgerloom.llm.tokens import Encoder

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab cé'\n\t  st reX1,.9!#ßÀ ×\r;)(  €中́😀"
EDGE = [None, "", " ", "a", " a ", "\n\n a\n b  c \t", "don't  stop's", "<|endoftext|> x", "a\r\nb"]


def random_texts(n, size):
    rnd = random.Random(n)
    return ["".join(rnd.choice(ALPHABET[:20] if rnd.random() < 0.6 else ALPHABET) for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("name, drops", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_encoder_is_the_library(name, drops):
    e = Encoder(public_tokenizers.path(name), drops)
    texts = EDGE + random_texts(1500, 50)
    for _ in range(2):  # the second time from memory
        ids, counts = e.encode(pa.array(texts))
        at = np.cumsum(counts) - counts
        for t, a, n in zip(texts, at, counts):
            assert ids[a : a + n].tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids, t


def docs_of(spark, texts):
    return spark.createDataFrame([(i * 3 % len(texts), t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")


def test_token_files_round_trip(spark, tmp_path):
    texts = EDGE + random_texts(91, 400)
    docs = docs_of(spark, texts)
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_store.write_sequences(docs, str(tmp_path), path, 1, True, length=64, file_ids=1000)
    assert manifest.count() >= 4
    t = Tokenizer.from_file(path)
    want, start, stream = set(), 0, []
    for doc_id, text in sorted((r.doc_id, r.text) for r in docs.collect()):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.add((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        stream += ids
    assert {tuple(r) for r in token_store.read_documents(spark, str(tmp_path)).collect()} == want
    got = []
    for row in sorted(manifest.collect()):
        reader, source = token_store.open_file(str(tmp_path), row.path)
        for i in range(row.n_sequences):
            ids, mask = token_store.sequence(reader, i)
            assert len(ids) == 8 * len(mask) == 64 and not ids.flags.owndata and not mask.flags.owndata
            got += ids[np.unpackbits(mask, bitorder="little").astype(bool)].tolist()
    assert got == stream


def test_token_files_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.write_sequences(empty, str(tmp_path / "f"), public_tokenizers.path("word_bpe_49k.json"), 1, True).count() == 0
    assert token_store.read_documents(spark, str(tmp_path / "f")).count() == 0


def test_null_and_repeated_ids_keep_their_documents(spark, tmp_path):
    texts = [(None, "a b"), (None, "c"), (2, "x y z"), (2, "x y z"), (2, None), (1, "the " * 300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    size = [(i, len(t.encode(x or "", add_special_tokens=False).ids) + 1) for i, x in texts]
    token_store.write_sequences(docs, str(tmp_path), path, 1, True, length=64)
    rows = token_store.read_documents(spark, str(tmp_path)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 2, 2] and sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((i or 0, n) for i, n in size)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    packed = packing.pack_documents(docs, path, 1, 64, True).toPandas()
    assert packed.length.sum() == sum(n for _, n in size) and packed.doc_id.isna().sum() == 2
    assert not packed.duplicated(["sequence_id", "offset"]).any() and (packed.groupby("sequence_id").length.sum() <= 64).all()


def test_packing(spark):
    rnd = random.Random(7)
    words = ["ab", "the", "of", "xyz", "é"]
    texts = EDGE + [" ".join(rnd.choices(words, k=rnd.randint(1, 120))) for _ in range(300)] + ["the " * 500]
    docs = docs_of(spark, texts)
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack_documents(docs, path, capacity=64)
    rows = packed.toPandas()
    t = Tokenizer.from_file(path)
    own = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    for doc_id, g in rows.groupby("doc_id"):
        g = g.sort_values("piece")
        assert g.piece.tolist() == list(range(len(g))) and g.length.sum() == len(own[doc_id]) and (g.length[g.piece > 0] == 64).all()
        for r in g.itertuples():
            assert zlib.crc32(np.array(own[doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    full = {}
    for s, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() <= 64
        full[s] = [i for r in g.itertuples() for i in own[r.doc_id][r.start : r.start + r.length]]
    assert len(rows) == rows.groupby(["doc_id", "piece"]).ngroups and len(full) <= 1.03 * -(-rows.length.sum() // 64) + 2
    assert {r.sequence_id: list(r.ids) for r in packing.sequences(packed, docs, path, capacity=64).collect()} == full
    assert packing.pack_documents(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("n", [1, 50, 3000])
def test_plan_holds_every_piece_once(n):
    rng = np.random.default_rng(n)
    lengths, counts = np.unique(np.minimum(rng.lognormal(6, 1.2, n).astype(int) + 1, 2048), return_counts=True)
    plan, info = packing.plan(lengths, counts, 2048)
    held = {}
    for config, times in plan:
        assert sum(size * copies for size, copies in config) <= 2048 and times > 0
        for size, copies in config:
            held[size] = held.get(size, 0) + copies * times
    assert held == dict(zip(lengths.tolist(), counts.tolist()))
    total = sum(t for _, t in plan)
    assert info["bound"] <= total + 1e-6 and total <= sum(packing.best_fit(lengths, counts, 2048).values())
    assert total == info["full"] + info["program"] + info["best_fit"]


def test_plan_where_best_fit_does_badly():
    lengths, counts = np.array([497, 518, 524, 1030]), np.array([12000, 6000, 6000, 6000])
    plan, info = packing.plan(lengths, counts, 2048)
    assert sum(t for _, t in plan) <= 9002 < sum(packing.best_fit(lengths, counts, 2048).values()) and info["bound"] > 8980


def test_program_packs_the_documents_table():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = np.array([len(e.ids) + 1 for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)])
    lengths, counts = np.unique(np.concatenate([(n - 1) % 2048 + 1, np.full(int(((n - 1) // 2048).sum()), 2048)]), return_counts=True)
    plan, info = packing.plan(lengths, counts, 2048)
    total = sum(times for _, times in plan)
    assert total - info["bound"] < 1 and info["program"] >= 0.9 * (total - info["full"])


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


@pytest.mark.parametrize("name, drops", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_thue_morse_words_are_told_apart(name, drops):
    e, t = Encoder(public_tokenizers.path(name), drops), Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["".join("ab"[b ^ flip] for b in thue_morse(n)) for n in (1024, 4096) for flip in (0, 1)]
    for x in texts:
        assert e.encode(pa.array([x]))[0].tolist() == t.encode(x, add_special_tokens=False).ids
    s = sentencepieces.PieceEncoder(MODEL)
    for x in texts:
        assert s.encode(pa.array([x]))[0].tolist() == sentencepieces.encode_text(s.pieces, x)


def test_units_of_one_hash_are_compared_by_their_bytes(monkeypatch):
    from ledgerloom.llm import tokens

    monkeypatch.setattr(tokens, "span_hash", lambda d, a, b: (b - a).astype(np.uint64))
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, t = Encoder(path, False), Tokenizer.from_file(path)
    texts = ["one two six ten", "ten six two one", "abc abd abe", "xyz"]
    for _ in range(2):
        ids, counts = e.encode(pa.array(texts))
        assert ids.tolist() == [i for x in texts for i in t.encode(x, add_special_tokens=False).ids]


def plain_viterbi(p, text):
    if not text:
        return []
    t = (" " + text).replace(" ", sentencepieces.SPACE_MARK)
    score, back = [0.0], [None]
    for end in range(1, len(t) + 1):
        hit = p.ids.get(t[end - 1])
        best, path = (score[end - 1] + hit[1], (end - 1, hit[0])) if hit else (score[end - 1] + p.unknown_score, (end - 1, -1))
        for start in range(end - 2, max(-1, end - 1 - p.longest), -1):
            hit = p.ids.get(t[start:end])
            if hit and score[start] + hit[1] > best:
                best, path = score[start] + hit[1], (start, hit[0])
        score.append(best)
        back.append(path)
    out, end = [], len(t)
    while end:
        start, i = back[end]
        out.append([i] if i >= 0 else p.unknown_ids(t[start:end]))
        end = start
    return [i for ids in reversed(out) for i in ids]


def test_streaming_viterbi_is_viterbi():
    p = sentencepieces.Pieces(MODEL)
    texts = EDGE + random_texts(400, 200)
    e = sentencepieces.PieceEncoder(MODEL)
    ids, counts = e.encode(pa.array(texts))
    at = np.cumsum(counts) - counts
    for t, a, n in zip(texts, at, counts):
        want = plain_viterbi(p, t or "")
        assert sentencepieces.encode_text(p, t or "") == want
        assert ids[a : a + n].tolist() == want
        bits = [t[i : i + 7] for i in range(0, len(t), 7)] if t else []
        assert [i for part in sentencepieces.encode_stream(p, bits) for i in part] == want
    assert sentencepieces.decode_ids(p, ids.astype(np.int64), counts).to_pylist() == [t or "" for t in texts]


def test_window_stays_bounded():
    v = sentencepieces.StreamingViterbi(sentencepieces.Pieces(MODEL))
    out = []
    for _ in range(400):
        out += v.feed("the▁quick▁brown▁fox▁" * 5)
    assert v.widest < 200 and len(out) > 5000


def test_encode_and_decode_tables(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(EDGE + ["é" * 5000])], "doc_id long, text string, decoded string")
    out = sentencepieces.decode(sentencepieces.encode(docs, MODEL), MODEL)
    assert {r.doc_id: r.decoded for r in out.collect()} == {i: t or "" for i, t in enumerate(EDGE + ["é" * 5000])}
    assert sentencepieces.encode(docs.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("name, drops", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_added_tokens_are_those_of_the_tokenizer_as_loaded(name, drops):
    path = public_tokenizers.path(name)
    untouched = Tokenizer.from_file(path)
    added = [t.content for t in untouched.get_added_tokens_decoder().values()]
    texts = EDGE + random_texts(200, 50) + ["<|startoftext|>", "a<|endof", "text|>b", "<|ENDOFTEXT|> x", "é <|endoftext|>\n", "€<|endoftext|><|endoftext|>"]
    texts += [f"{a}{t}{b}" for t in added for a in ("", "no ", "x") for b in ("", " yes", "y\n")]
    ids, counts = Encoder(path, drops).encode(pa.array(texts))
    at = np.cumsum(counts) - counts
    for t, a, n in zip(texts, at, counts):
        assert ids[a : a + n].tolist() == untouched.encode(t or "", add_special_tokens=False).ids, t


def test_token_files_and_packing_use_the_tokenizer_as_loaded(spark, tmp_path):
    texts = EDGE + random_texts(41, 200) + ["one <|endoftext|> two", "<|startoftext|>é<|ENDOFTEXT|>"]
    docs = docs_of(spark, texts)
    words, pieces = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    token_store.write_sequences(docs, str(tmp_path), words, 1, True, length=64)
    want, start, rows = set(), 0, sorted((r.doc_id, r.text) for r in docs.collect())
    for doc_id, text in rows:
        ids = Tokenizer.from_file(words).encode(text or "", add_special_tokens=False).ids + [1]
        want.add((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in token_store.read_documents(spark, str(tmp_path)).collect()} == want
    packed = packing.pack_documents(docs, pieces).select("doc_id", "length", "ids_crc32")
    own = {i: Tokenizer.from_file(pieces).encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    assert {tuple(r) for r in packed.collect()} == {(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in own.items()}
