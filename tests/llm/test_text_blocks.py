"""Words, hashes and windows of text blocks against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.textblocks import TextBlock, small_batches, span_hash, windows
from ledgerloom.llm.xxh64 import hash_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t ,中", max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_joined_and_kept(values):
    block = TextBlock.of(pa.array(values, pa.string()))
    plain = [t or "" for t in values]
    starts, ends, first = block.spans()
    words = [w for t in plain for w in WORD.findall(t)]
    assert [bytes(block.data[a:b]).decode() for a, b in zip(starts, ends)] == words
    assert np.diff(first).tolist() == [len(WORD.findall(t)) for t in plain]
    keep = np.array([i % 3 != 1 for i in range(len(words))], bool)
    it = iter(keep)
    assert block.joined(keep)[0].strings().to_pylist() == [" ".join(w for w in WORD.findall(t) if next(it)) for t in plain]
    assert block.joined()[0].strings().to_pylist() == [" ".join(WORD.findall(t)) for t in plain]


def test_hashes_name_spans_and_windows():
    rnd = random.Random(1)
    values = ["".join(rnd.choice("ab é\n") for _ in range(rnd.randint(0, 60))) for _ in range(500)] + ["abc " * 100_000]
    block = TextBlock.of(pa.array(values))
    starts, ends, first = block.spans()
    h = span_hash(block.data, starts, ends)
    seen = {}
    for a, b, x in zip(starts, ends, h.tolist()):
        assert seen.setdefault(bytes(block.data[a:b]), x) == x
    assert len(set(seen.values())) == len(seen)
    at, w = windows(h, first, 3)
    split = [WORD.findall(t) for t in values]
    want = [tuple(s[i : i + 3]) for s in split for i in range(len(s) - 2)]
    seen = {}
    for key, x in zip(want, w.tolist(), strict=True):
        assert seen.setdefault(key, x) == x
    assert len(set(seen.values())) == len(seen)


def test_xxh64():
    rnd = random.Random(3)
    data = np.frombuffer(bytes(rnd.randrange(256) for _ in range(3000)), np.uint8)
    starts = np.array([rnd.randrange(2900) for _ in range(2000)])
    ends = starts + np.array([rnd.randrange(70) for _ in starts])
    assert hash_spans(data, starts, ends, 42).tolist() == [xxhash.xxh64_intdigest(bytes(data[a:b]), 42) for a, b in zip(starts, ends)]


def test_small_batches_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 100, 0, 7, 60)] + [None])], names=["text"])
    parts = list(small_batches(iter([batch]), "text", 50))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist() and len(parts) > 1
