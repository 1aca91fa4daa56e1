"""SimHash near-dedup through pivot distance tables.

Fingerprints: every shingle of a text has an XXH64; a bit of the fingerprint is set if it is set in over half of them.

Links: fingerprints are compared through a table of their Hamming distances to reference fingerprints (pivots). The 64
bits are cut into BLOCKS parts; each part has PIVOTS_PER_BLOCK references, which are random in the part and count
distances there only, so each coordinate obeys the triangle inequality: a coordinate of two fingerprints differs by no
more than their distance within the part. Fingerprints at distance d <= `bits` agree wholly in at least BLOCKS - bits
parts, and so in all coordinates of those parts: rows that agree in all coordinates of some choice of BLOCKS - bits
parts are the candidates. A pair is discarded if, part by part, its largest coordinate differences add up to more than
`bits`; what survives is verified bit by bit. No link is lost, and equal fingerprints are one row from the start.

Buckets with more than `paired` rows (near copies in thousands) do not pair up. Two fingerprints are within two bits of
each other exactly if they share a neighbour within one bit; rows of such a bucket link to the least row that shares a
neighbour, one star for each neighbour, which keeps the links linear in the bucket and loses no connection.

Texts that share most of their words but not their fingerprints are grouped by similar_groups(): candidates share one
of the least shingle hashes, a wide distance of longer fingerprints connects them into coarse groups, and within a
coarse group the shingle sets themselves decide. Both steps hand on a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import attach, carried, celled, cut
from .components import connected_components
from .textblocks import TextBlock, U, mix, ragged, small_batches, span_hash, windows
from .xxh64 import hash_spans

SEED = 42
BLOCKS = 5
PIVOTS_PER_BLOCK = 12
PAIRED = 48
#: Text that is hashed at once; its shingles take some forty times as much memory.
SLICE_BYTES = 1 << 20
#: 64-bit words of the longer fingerprints of similar_groups().
SKETCH_WORDS = 4
#: Rows of one shingle that are compared in one task, and sets of one coarse group; larger ones are dealt into cells.
BUCKET_ROWS = 2048
GROUP_ROWS = 1024
#: Fixed odd value that keeps the longer fingerprints' words apart.
GOLDEN = 0x9E3779B97F4A7C15
#: Bits of each part, in order.
WIDTHS = [64 * (i + 1) // BLOCKS - 64 * i // BLOCKS for i in range(BLOCKS)]
MASKS = [U(((1 << w) - 1) << sum(WIDTHS[:i])) for i, w in enumerate(WIDTHS)]
PIVOTS = np.stack([mix(np.arange(1 + 100 * b, 1 + 100 * b + PIVOTS_PER_BLOCK, dtype=U)) & m for b, m in enumerate(MASKS)])


def fingerprints(text: pa.Array, words_per_shingle: int) -> np.ndarray:
    """64-bit SimHash of every text: A-Z lower-cased, words joined by one space, shingles with repeats."""
    block, starts, ends, first = TextBlock.of(text).joined(lower=True)
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= words_per_shingle, n_words - words_per_shingle + 1, np.minimum(n_words, 1))
    at = ragged(first[:-1], n_shingles)
    last = np.minimum(at + words_per_shingle, np.repeat(first[1:], n_shingles)) - 1
    h = hash_spans(block.data, starts[at], ends[last], SEED)
    out = np.zeros(block.n, U)
    stop = np.cumsum(n_shingles)
    start = 0
    while start < block.n:  # some documents at a time: 64 bytes for each of their shingles
        end = max(start + 1, int(np.searchsorted(stop, (stop[start - 1] if start else 0) + (1 << 18), side="right")))
        lo, hi = (stop[start - 1] if start else 0), stop[end - 1]
        has = np.flatnonzero(n_shingles[start:end]) + start
        if len(has):
            counts = np.zeros((len(has), 64), np.int64)
            for a in range(lo, hi, 1 << 20):  # a very long text in pieces
                b = min(a + (1 << 20), hi)
                bits = np.unpackbits(h[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                from_ = np.maximum(stop[has] - n_shingles[has], a)
                here = np.flatnonzero((from_ < b) & (stop[has] > a))
                counts[here] += np.add.reduceat(bits, from_[here] - a, axis=0, dtype=np.int32)
            over = (2 * counts > n_shingles[has][:, None]).astype(np.uint8)
            out[has] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
        start = end
    return out


def simhash(docs: DataFrame, words_per_shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp long) of every row. Null, empty and wordless texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SLICE_BYTES):
            fp = fingerprints(batch.column(1), words_per_shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return carried(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """(rows, parts, PIVOTS_PER_BLOCK) distances of fingerprints (rows, 64-bit words) to the pivots, each within its part."""
    columns = [np.bitwise_count((word[:, None] & m) ^ p[None, :]) for word in fp.T for m, p in zip(MASKS, PIVOTS)]
    return np.stack(columns, axis=1).astype(np.int8)


def _pairs(fp: np.ndarray, coords: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs within runs of rows that share a bucket."""
    for step in range(1, int(sizes.max(initial=1))):
        big = sizes > step
        i = ragged(starts[big], sizes[big] - step)
        j = i + step
        for lo in range(0, len(i), 1 << 16):
            a, b = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
            far = np.abs(coords[a] - coords[b]).max(axis=2).sum(axis=1)
            a, b = a[far <= bits], b[far <= bits]
            near = np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1) <= bits
            yield a[near], b[near]


def _stars(fp: np.ndarray, free: U, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one large bucket whose rows differ only in the bits of `free`: links (row numbers) to the least row of each
    shared neighbour; some of the neighbours at a time."""
    flips = [U(0), *(U(1 << b) for b in range(64) if int(free) >> b & 1)] if bits == 2 else [U(0)]
    turns = -(-len(fp) * len(flips) // (1 << 22))
    for turn in range(turns):
        variants, owner = [], []
        for f in flips:
            v = fp ^ f
            own = np.flatnonzero(mix(v) % U(turns) == turn) if turns > 1 else np.arange(len(fp))
            variants.append(v[own])
            owner.append(own)
        variants, owner = np.concatenate(variants), np.concatenate(owner)
        order = np.lexsort((owner, variants))
        variants, owner = variants[order], owner[order]
        head = np.concatenate([[True], variants[1:] != variants[:-1]])
        least = owner[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        other = least != owner
        yield owner[other], least[other]


def links(prints: DataFrame, bits: int = 2, paired: int = PAIRED) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all pairs within `bits` (0 to 2) bits.

    prints has fp and least, one row for each fingerprint; a and b are structs (none, id, fp) in whose order least ids
    come first and null ones last. Each bucket's rows lie together after one shuffle by bucket and one sort, and are
    read as a stream: a bucket of up to `paired` rows is paired and verified, a larger one is linked by stars. Both
    connect the same rows; `paired` is a matter of time only.
    """
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    choices = list(combinations(range(BLOCKS), BLOCKS - bits))
    shared = [U(sum(int(MASKS[b]) for b in c)) for c in choices]
    kind = prints.schema["least"].dataType.simpleString()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(U)
            coords = pivot_table(fp[:, None])
            for k, c in enumerate(choices):
                row = np.zeros(len(fp), U)
                for b in c:  # all coordinates of the chosen parts, folded into one key
                    for x in range(PIVOTS_PER_BLOCK):
                        row = mix(row * U(31) + coords[:, b, x].astype(U) + U(1 + k))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(row.view(np.int64)), *batch.columns], names=["choice", "bucket", "fp", "least"])

    def done(choice, bucket, fp):
        """Links, as row numbers, of whole buckets."""
        if len(fp) < 2:
            return
        head = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (choice[1:] != choice[:-1])]))
        sizes = np.diff(np.append(head, len(fp)))
        few = (sizes > 1) & (sizes <= paired)
        at = ragged(head[few], sizes[few])
        starts = np.cumsum(sizes[few]) - sizes[few]
        for a, b in _pairs(fp[at][:, None], pivot_table(fp[at][:, None]), starts, sizes[few], bits):
            yield at[a], at[b]
        for s, n in zip(head[sizes > paired].tolist(), sizes[sizes > paired].tolist()):
            run, k = fp[s : s + n], choice[s]
            part = run & shared[k]  # a bucket may hold rows of other parts with the same coordinates: go by their bits
            for value in np.unique(part):
                own = np.flatnonzero(part == value) + s
                for a, b in _stars(fp[own], ~shared[k], bits):
                    yield own[a], own[b]
                if bits == 1:
                    for f in (U(1 << b) for b in range(64) if not int(shared[k]) >> b & 1):
                        order = np.argsort(fp[own])
                        near = order[np.minimum(np.searchsorted(fp[own], fp[own] ^ f, sorter=order), len(own) - 1)]
                        hit = np.flatnonzero(fp[own][near] == fp[own] ^ f)
                        yield own[hit], own[near[hit]]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 2):
            fp = table.column("fp").to_numpy()
            for a, b in done(table.column("choice").to_numpy(), table.column("bucket").to_numpy(), fp.view(U)):
                ids = [table.column("least").take(pa.array(x)).combine_chunks() for x in (a, b)]
                yield pa.RecordBatch.from_arrays([*(x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in ids), pa.array(fp[a]), pa.array(fp[b])], names=["a_id", "b_id", "a_fp", "b_fp"])

    keyed = prints.select("fp", "least").mapInArrow(expand, f"choice int, bucket long, fp long, least {kind}")
    n = max(2, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = keyed.repartition(n, "choice", "bucket").sortWithinPartitions("choice", "bucket", "fp").mapInArrow(match, f"a_id {kind}, b_id {kind}, a_fp long, b_fp long")
    return found.select(node("a_id", "a_fp").alias("a"), node("b_id", "b_fp").alias("b")).distinct()


def node(id_: str, fp: str) -> Column:
    """A fingerprint's place in the order of least ids, null ones last."""
    return F.struct(F.col(id_).isNull().alias("none"), F.col(id_).alias("id"), F.col(fp).alias("fp"))


def whole_runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of a sorted stream in tables that hold whole runs of equal values in the first `n_keys` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in range(n_keys)]
        same = np.ones(batch.num_rows, bool)
        for k in range(n_keys):
            same &= batch.column(k).to_numpy() == last[k]
        stop = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if stop or (held and any(held[-1].column(k)[held[-1].num_rows - 1].as_py() != last[k] for k in range(n_keys))):
            yield pa.Table.from_batches([*held, batch.slice(0, stop)])
            held = []
        held.append(batch.slice(stop))
    if held:
        yield pa.Table.from_batches(held)


def shingle_sets(text: pa.Array, words_per_shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, ascending and end to end; how many each text has; a digest of each set).

    Shingles are hashed by rolling over word hashes. Texts of fewer words have their whole sequence as one shingle.
    """
    block, starts, ends, first = TextBlock.of(text).joined(lower=True)
    n_words = np.diff(first)
    words = span_hash(block.data, starts, ends)
    at, h = windows(words, first, words_per_shingle)
    h = mix(h)
    doc = np.repeat(np.arange(block.n), np.maximum(n_words - words_per_shingle + 1, 0))
    few = np.flatnonzero((n_words > 0) & (n_words < words_per_shingle))
    if len(few):
        whole = span_hash(block.data, starts[first[few]], ends[first[few + 1] - 1])
        doc, h = np.concatenate([doc, few]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[new], h[new]
    n = np.bincount(doc, minlength=block.n)
    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + U(GOLDEN)), dtype=U)])
    stop = np.cumsum(n)
    return h, n, mix(total[stop] - total[stop - n] + n.astype(U))


def shingle_sketches(text: pa.Array, words_per_shingle: int, anchors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(SKETCH_WORDS fingerprints of the distinct shingles, anchors end to end, anchors of each text, shingles of each
    text, digest of each set); a text's anchors are its least shingle hashes."""
    h, n, digest = shingle_sets(text, words_per_shingle)
    out, start = np.zeros((len(n), SKETCH_WORDS), U), np.cumsum(n) - n
    for word in range(SKETCH_WORDS):
        hw = h if not word else mix(h + U(word * GOLDEN % (1 << 64)))
        for lo in range(0, len(n), 256):  # 64 bytes for each shingle of some documents
            own = np.arange(lo, min(lo + 256, len(n)))
            own = own[n[own] > 0]
            if len(own):
                a, b = start[own[0]], start[own[-1]] + n[own[-1]]
                counts = np.zeros((len(own), 64), np.int64)
                for c in range(a, b, 1 << 18):
                    d = min(c + (1 << 18), b)
                    bits = np.unpackbits(hw[c:d].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    begin = np.maximum(start[own], c)
                    here = np.flatnonzero((begin < d) & (start[own] + n[own] > c))
                    counts[here] += np.add.reduceat(bits, begin[here] - c, axis=0, dtype=np.int32)
                out[own, word] = np.packbits((2 * counts > n[own][:, None]).astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()
    k = np.minimum(n, anchors)
    return out, h[ragged(start, k)], k, n, digest


def _chunks(head: np.ndarray, n: int, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows (numbers) within runs that start at `head`, about `most` at a time."""
    later = np.repeat(np.append(head[1:], n), np.diff(np.append(head, n))) - np.arange(n) - 1
    upto = np.cumsum(later)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
        yield np.repeat(np.arange(lo, hi), later[lo:hi]), ragged(np.arange(lo, hi) + 1, later[lo:hi])
        lo = hi


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components (least row of each row's) that links a - b connect."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            root = label[label]
            if (root == label).all():
                break
            label[:] = root


def _close(fp: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int, similarity: float) -> np.ndarray:
    """Which pairs of rows a and b may be that similar, by the sizes of their sets and their sketches."""
    fits = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9
    at = np.flatnonzero(fits)
    far = np.zeros(len(at), np.int64)
    for word in range(fp.shape[1]):
        far += np.bitwise_count(fp[a[at], word] ^ fp[b[at], word])
    fits[at] = far <= bits
    return fits


class ShingleSets:
    """Sets of one task's rows, for counting what pairs share: bit rows over the shingles that several rows hold, or
    sorted arrays where those would take more than BITS_BYTES."""

    BITS_BYTES = 64 << 20

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.n, self.at, self.bits = flat, sizes, np.cumsum(sizes) - sizes, None
        values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        place = np.cumsum(counts > 1) - 1
        width = -(-int((counts > 1).sum()) // 64)
        if width * 8 * len(sizes) <= self.BITS_BYTES:
            self.bits = np.zeros((len(sizes), width), U)
            several = counts[inverse] > 1
            row, column = np.repeat(np.arange(len(sizes)), sizes)[several], place[inverse[several]]
            np.bitwise_or.at(self.bits, (row, column >> 6), U(1) << (column & 63).astype(U))

    def similar(self, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
        shared = np.zeros(len(a), np.int64)
        if self.bits is not None:
            step = max(1, (1 << 20) // max(1, self.bits.shape[1]))
            for lo in range(0, len(a), step):
                s = slice(lo, lo + step)
                shared[s] = np.bitwise_count(self.bits[a[s]] & self.bits[b[s]]).sum(axis=1, dtype=np.int64)
        else:
            own = [self.flat[i : i + n] for i, n in zip(self.at.tolist(), self.n.tolist())]
            shared[:] = [len(np.intersect1d(own[i], own[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())]
        return shared >= similarity * (self.n[a] + self.n[b] - shared) - 1e-9


def widest_distance(similarity: float, slack: float = 4, small: float = 1.25) -> int:
    """Bits of a long fingerprint in which sets of shingles of that Jaccard similarity differ, `slack` deviations included.

    Two large sets differ in arccos(2 s / (1 + s)) / pi of the bits; small ones, by ties, in up to a quarter more (4 of
    5 shingles at 0.8: 0.1875 for 0.1515).
    """
    share = small * np.arccos(2 * similarity / (1 + similarity)) / np.pi
    n = 64 * SKETCH_WORDS
    return int(round(n * share + slack * np.sqrt(n * share * (1 - share))))


def similar_groups(docs: DataFrame, words_per_shingle: int = 5, similarity: float = 0.8, anchors: int = 6, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, component_id): groups of texts that links of a Jaccard similarity of `similarity` or more connect.

    The similarity is that of the sets of shingles, and every link is one of the sets themselves. Candidates share one
    of the least `anchors` shingle hashes; texts of that similarity share none with a chance of (1 - similarity) **
    anchors. Rows of one anchor whose set sizes and sketches (SKETCH_WORDS * 64 bits, four deviations wide) allow the
    similarity are one coarse group; the sets of each coarse group meet in tasks that compare them. An anchor or coarse
    group of many rows is dealt into cells for many tasks. Equal sets are one row from the start. Null, empty and
    wordless texts have no anchors and stay alone here; a very long text is one row like others. A null id is never the
    least one of a group that has others. Other columns are not read; repeated rows all come back. An empty table gives
    an empty result.
    """
    return _labelled(*_set_links(docs, words_per_shingle, similarity, anchors, id_col, text)).select(F.col("id").alias(id_col), "component_id")


def _set_links(docs: DataFrame, words_per_shingle: int, similarity: float, anchors: int, id_col: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, fp) with fp a digest of their set, one row (fp, least, copies, ..) for each set, and links of nodes."""
    wide = widest_distance(similarity)
    words = [f"w{i}" for i in range(SKETCH_WORDS)]
    kind = docs.schema[id_col].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SLICE_BYTES):
            fp, least, k, n, digest = shingle_sketches(batch.column(1), words_per_shingle, anchors)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(k)]).astype(np.int32)), pa.array(least.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest.view(np.int64)), pa.array(n.astype(np.int32)), lists, *(pa.array(w.view(np.int64)) for w in np.ascontiguousarray(fp.T))], names=["id", "fp", "n", "anchors", *words])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SLICE_BYTES):
            h, n, digest = shingle_sets(batch.column(1), words_per_shingle)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), lists], names=["fp", "shingles"])

    def runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where runs of key and cell begin; fingerprints, set sizes and sketches."""
        key, cell = table.column(0).to_numpy(), table.column(1).to_numpy()
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
        return head, table.column("fp").to_numpy(), table.column("n").to_numpy(), np.stack([table.column(w).to_numpy() for w in words], axis=1).view(U)

    def coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 2):
            head, fp, n, long = runs(table)
            label = np.arange(len(fp))
            for a, b in _chunks(head, len(fp)):
                near = _close(long, n, a, b, wide, similarity)
                _join(label, a[near], b[near])
            linked = np.flatnonzero(label != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], names=["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, 2):
            head, fp, n, long = runs(table)
            lists = table.column("shingles").combine_chunks()
            lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
            own = ShingleSets(lists.flatten().to_numpy().view(U), lists.value_lengths().to_numpy().astype(np.int64))
            label = np.arange(len(fp))
            for a, b in _chunks(head, len(fp), 1 << 14):
                near = np.flatnonzero((label[a] != label[b]) & _close(long, n, a, b, wide, similarity))
                near = near[own.similar(a[near], b[near], similarity)]
                _join(label, a[near], b[near])
            linked = np.flatnonzero(label != np.arange(len(fp)))
            ids = [table.column("least").take(pa.array(x)).combine_chunks() for x in (linked, label[linked])]
            yield pa.RecordBatch.from_arrays([*(pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x for x in ids), pa.array(fp[linked]), pa.array(fp[label[linked]])], names=["a_id", "b_id", "a_fp", "b_fp"])

    n_parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = carried(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    prints = cut(own.mapInArrow(sketch, f"id {kind}, fp long, n int, anchors array<long>, " + ", ".join(f"{w} long" for w in words)).where("size(anchors) > 0"))
    columns = ["n", *words]
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("anchors").alias("anchors"), *[F.first(c).alias(c) for c in columns]))
    keyed = celled(distinct.select(F.explode("anchors").alias("anchor"), "fp", *columns), "anchor", "fp", BUCKET_ROWS)
    near = keyed.select("anchor", "cell", "fp", *columns).repartition(n_parts, "anchor", "cell").sortWithinPartitions("anchor", "cell", "fp").mapInArrow(coarse, "a long, b long")
    member = connected_components(near).withColumnRenamed("node", "fp")
    member = cut(member.unionByName(member.select(F.col("root").alias("fp"), "root").distinct()))
    # texts are read again for the rows of coarse groups, once for each set
    named = distinct.join(member, "fp").select("least").distinct()
    again = own.join(named, F.col("id").eqNullSafe(F.col("least")), "left_semi").mapInArrow(sets, "fp long, shingles array<long>")
    groups = celled(member.join(distinct.select("fp", "least", *columns), "fp"), "root", "fp", GROUP_ROWS)
    rows = groups.join(again.dropDuplicates(["fp"]), "fp").select("root", "cell", "fp", "least", *columns, "shingles")
    found = rows.repartition(n_parts, "root", "cell").sortWithinPartitions("root", "cell", "fp").mapInArrow(exact, f"a_id {kind}, b_id {kind}, a_fp long, b_fp long")
    return prints, distinct, found.select(node("a_id", "a_fp").alias("a"), node("b_id", "b_fp").alias("b"))


def _labelled(prints: DataFrame, distinct: DataFrame, links_: DataFrame) -> DataFrame:
    """prints with the least id that links between fingerprints reach."""
    roots = connected_components(links_).select(F.col("node.fp").alias("fp"), "root")
    component = F.when(F.col("root").isNotNull(), F.col("root.id")).otherwise(F.col("least"))
    labels = cut(distinct.select("fp", "least", "copies").join(roots, "fp", "left").select("fp", component.alias("component_id"), "copies"))
    return attach(prints, labels, "fp", "copies")


def merged(first: DataFrame, second: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, component_id) of the rows that two groupings together put into a component of a smaller id.

    Rows that stay alone or are the least of theirs don't come back; null ids link nothing; repeated rows come back once.
    Two empty groupings give an empty result.
    """
    links_ = [g.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("a"), F.col("component_id").alias("b")) for g in (first, second)]
    return connected_components(links_[0].unionByName(links_[1])).select(F.col("node").alias(id_col), F.col("root").alias("component_id"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, bits: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id) of every row; component_id is the least id that links reach, itself included.

    Fingerprints link at `bits` or fewer differing bits; equal ones always do. Null, empty and wordless texts share
    fingerprint 0; a very long text is hashed piece by piece. A null id never is the least id of a component that has others. Repeated rows all come back. Other
    columns are not read. An empty table gives an empty result.
    """
    return _labelled(*_print_links(docs, words_per_shingle, bits, id_col, text)).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _print_links(docs: DataFrame, words_per_shingle: int, bits: int, id_col: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, fp), one row (fp, least, copies) for each fingerprint, and links of nodes."""
    prints = cut(simhash(docs, words_per_shingle, id_col, text))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")))
    return prints, distinct, links(distinct, bits)


def _id_links(prints: DataFrame, distinct: DataFrame, links_: DataFrame) -> DataFrame:
    """(a, b) links between ids: those of equal fingerprints to their least one, and those between fingerprints."""
    own = attach(prints.select("id", "fp"), distinct.where("copies > 1").select("fp", "least", "copies"), "fp", "copies")
    return own.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).unionByName(links_.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")))


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without the rows that `groups` assigns to a component of a smaller id; rows of a null id stay."""
    extra = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col)).distinct()
    return docs.join(extra, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with exactly one row of each group that near_duplicates() and similar_groups() together connect.

    Groups go by texts, so null ids and ids of several rows are rows like others. The row of least id stays, null ids
    last, then that of the least digest of its columns; of rows that agree in all columns one stays. An empty table
    gives an empty result.
    """
    whole = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))])
    keyed = docs.withColumn("__text", F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))).withColumn("__row", F.concat("__text", F.hex(whole)))
    both = _id_links(*_print_links(keyed, 3, 2, "__text", text)).unionByName(_id_links(*_set_links(keyed, 5, 0.8, 6, "__text", text)))
    groups = connected_components(both).select(F.col("node").alias("__text"), F.col("root").alias("component_id"))
    rows = keyed.groupBy("__text", "__row").agg(F.min(F.col(f"`{id_col}`")).alias("id"), F.count("*").alias("copies"))
    member = cut(rows.join(groups, "__text", "left").withColumn("group", F.coalesce("component_id", "__text")).select("group", "__row", "id", "copies"))
    best = member.groupBy("group").agg(F.min(F.struct(F.isnull("id").alias("without"), "id", "__row")).alias("best")).select(F.col("best.__row").alias("__row"))
    stays = member.join(best.withColumn("best", F.lit(True)), "__row", "left").select("__row", F.coalesce("best", F.lit(False)).alias("best"), "copies")
    apart = cut(stays.where("not best or copies > 1").select("__row", "best"))
    out = keyed.join(apart.select("__row"), "__row", "left_anti")
    again = apart.where("best").select("__row")
    if not again.isEmpty():
        out = out.unionByName(keyed.join(again, "__row", "left_semi").dropDuplicates(["__row"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
