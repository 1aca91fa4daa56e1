"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, merged into removal intervals.

1. Texts are dealt into blocks of a few megabytes. Each block rolls the hash of every window of `width` words and sends
   its distinct hashes, packed by ranges of hashes, with a bit for "twice or more in this block". That is the partial
   count: however often one window occurs, a block sends it once, so no hash comes more often than there are blocks.
2. A range's hashes lie in one partition, are unpacked and sorted there, and are read as a stream: a hash that comes
   twice, or with a set bit, is repeated and goes back to the blocks that sent it.
3. Each block rolls its hashes again and merges the repeated windows of each text into maximal intervals of words, which
   it removes.

Messages grow with the number of windows, memory with a block. Windows are equal if two independent rolling hashes over
a prime field agree, the second in 8 of its bits: n windows lose about n / 2^69 of theirs wrongly, which is less than two
windows in 10^9 for 10^12 windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import carried, parts, text_bytes, without
from .textblocks import TextBlock, U, mix, release, span_hash, windows

BLOCK_BYTES = 2 << 20
#: Bits of the second hash in a message; the block's number and the bit for "twice" follow them.
CHECK_BITS = 8
BLOCK_BITS = 64 - CHECK_BITS - 1
#: Leading bits of a hash that make its range, at least; a block's message for one range holds about 75 hashes.
RANGE_BITS = 12


def _hashed(text: pa.ChunkedArray, width: int, check: bool = False):
    """(block, words, first word of each window, its hash, CHECK_BITS bits of its second hash if asked for)."""
    block = TextBlock.of(text)
    words = block.spans()
    hashes = span_hash(block.data, words[0], words[1])
    at, h = windows(hashes, words[2], width)
    second = mix(windows(hashes, words[2], width, 1)[1]) & U((1 << CHECK_BITS) - 1) if check else None
    return block, words, at, mix(h), second


def block_number(n: int) -> Column:
    """Block of a row by its place in its partition, so that equal rows spread, too."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")


def dedup_substrings(docs: DataFrame, width: int = 35, text: str = "text") -> DataFrame:
    """docs with n_words, n_removed, removed (intervals of word numbers, end excluded) and kept_text added.

    Words are runs of bytes other than \\x20 and \\x09-\\x0D. Every word covered by a window of `width` words whose
    word sequence also starts anywhere else, in the same text included, is removed from all places; windows are judged
    on the input. kept_text holds the rest, joined by one space.

    Null and empty texts have no words and an empty kept_text. Texts below `width` words keep all; a very long text is
    part of one block. Repeated rows are copies of each other, dealt into blocks one by one. Other columns pass through; an input column named like an added one is replaced. An empty table gives
    an empty result. docs must come from stored rows or a shuffle, whose partitions are the same when a task is retried.
    """
    base = without(carried(docs), "n_words", "n_removed", "removed", "kept_text", "__block")
    spark = docs.sparkSession
    n_blocks, n_parts = parts(spark, text_bytes(docs, text), BLOCK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(RANGE_BITS, (4 * n_parts - 1).bit_length())
    dealt = base.withColumn("__block", block_number(n_blocks)).repartition(max(n_blocks, n_parts), "__block")

    def send(key, table):
        _, _, _, h, check = _hashed(table.column(text), width, True)
        order = np.lexsort((check, h))
        h, check = h[order], check[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        first = np.flatnonzero(new)
        twice = np.diff(np.append(first, len(h))) > 1
        h, check = h[first], check[first]
        part = (h >> U(64 - bits)).astype(np.int32)
        head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(h) else np.zeros(0, np.int64)
        runs = list(zip(head.tolist(), np.append(head[1:], len(h)).tolist()))
        word = h << U(8) | check  # the hash without its first byte, which is the range's, and the second hash's byte
        return pa.table(
            {
                "range": pa.array(part[head]),
                "block": pa.array([key[0].as_py()] * len(runs), pa.int32()),
                "hashes": pa.array([word[a:b].tobytes() for a, b in runs], pa.binary()),
                "twice": pa.array([np.packbits(twice[a:b]).tobytes() for a, b in runs], pa.binary()),
            }
        )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 256):
                batch = big.slice(lo, 256)
                hashes, twice = ([x.as_buffer() for x in batch.column(i)] for i in (2, 3))
                sizes = np.array([len(x) // 8 for x in hashes])
                word = np.frombuffer(b"".join(hashes), U)
                h = word >> U(8) | np.repeat(batch.column(0).to_numpy().astype(U) >> U(bits - 8), sizes) << U(56)
                check = word & U(0xFF)
                again = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(twice, sizes.tolist())])
                block = np.repeat(batch.column(1).to_numpy(), sizes)
                note = check << U(64 - CHECK_BITS) | block.astype(U) << U(1) | again
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(note.view(np.int64))], names=["h", "note"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_h, last_note, told = None, None, True  # the latest row, and whether its block has been told
        for batch in batches:
            if not batch.num_rows:
                continue
            h, note = batch.column(0).to_numpy().view(U), batch.column(1).to_numpy().view(U)
            if last_h is not None:
                h, note = np.append(last_h, h), np.append(last_note, note)
            same = (h[1:] == h[:-1]) & (note[1:] >> U(64 - CHECK_BITS) == note[:-1] >> U(64 - CHECK_BITS))
            repeated = (note & U(1)).astype(bool)
            repeated[1:] |= same
            repeated[:-1] |= same
            send_ = repeated.copy()
            send_[0] &= last_h is None or not told
            last_h, last_note, told = h[-1:], note[-1:], bool(repeated[-1])
            block = ((note[send_] & U((1 << (BLOCK_BITS + 1)) - 1)) >> U(1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(h[send_].view(np.int64))], names=["__block", "h"])

    added = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("removed", T.ArrayType(T.ArrayType(T.LongType()))), ("kept_text", T.StringType())]
    schema = T.StructType([*base.schema.fields, *(T.StructField(n, t) for n, t in added)])
    names = base.columns

    def remove(table, answers):
        block, words, at, h, _ = _hashed(table.column(text), width)
        first = words[2]
        cover = np.zeros(len(words[0]) + 1, np.int32)
        if answers.num_rows:
            repeated = np.sort(answers.column("h").to_numpy().view(U))
            near = np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)
            hit = at[repeated[near] == h]
            cover[hit] += 1
            cover[hit + width] -= 1  # a window ends at the latest where its text ends
        gone = np.cumsum(cover[:-1]) > 0
        kept = block.joined(~gone, words)[0]
        total_gone = np.concatenate([[0], np.cumsum(gone)])[first]
        edge = np.ones(len(gone) + 1, bool)
        edge[1:-1] = gone[1:] != gone[:-1]
        edge[first] = True
        cut = np.flatnonzero(edge)
        runs = [(a, b) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()) if gone[a]]
        doc = np.searchsorted(first, [a for a, _ in runs], side="right") - 1
        removed: list[list[list[int]]] = [[] for _ in range(block.n)]
        for (a, b), d in zip(runs, doc.tolist()):
            removed[d].append([a - int(first[d]), b - int(first[d])])
        release()
        out = [table.column(c) for c in names] + [pa.array(np.diff(first), pa.int64()), pa.array(np.diff(total_gone), pa.int64()), pa.array(removed, pa.list_(pa.list_(pa.int64()))), kept.strings()]
        return pa.Table.from_arrays(out, names=[*names, *(n for n, _ in added)])

    # with all columns, so that both readers share one shuffle of the texts
    sent = dealt.groupBy("__block").applyInArrow(send, "range int, block int, hashes binary, twice binary")
    rows = sent.repartition(max(n_blocks, n_parts), "range").mapInArrow(unpack, "h long, note long")
    answers = rows.sortWithinPartitions("h", "note").mapInArrow(count, "__block int, h long")
    return dealt.groupBy("__block").cogroup(answers.groupBy("__block")).applyInArrow(remove, schema)
