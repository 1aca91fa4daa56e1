"""Vectorised views of text columns inside Arrow tasks.

A TextBlock lays a few megabytes of texts end to end as bytes and finds words, lines and their 64-bit hashes with
numpy, so that per-word work costs nanoseconds. A span's hash is its XXH64. Windows of words are hashed by a rolling
polynomial over the prime field of 2^61 - 1 with fixed bases drawn at random, so that no pattern of words cancels out.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from .xxh64 import U, hash_spans

SPAN_SEED = 0x1F3D5B79
PRIME = (1 << 61) - 1
#: Fixed values, drawn once at random: bases of the rolling window hashes.
WINDOW_BASES = (0x15F0A3C6E49B7D21, 0x0B7E62D94F1C8A53)
#: Words whose windows are rolled at once; longer runs of words go in pieces that overlap.
ROLLED = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = np.array(x, dtype=U)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for any 64-bit x."""
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, for values below it."""
    low, shift = U((1 << 31) - 1), U(31)
    a0, a1, b0, b1 = a & low, a >> shift, b & low, b >> shift
    mid = a1 * b0
    mid += a0 * b1
    out = a0 * b0  # each term stays below 2^62, their sum below 2^64
    out += (a1 * b1) << U(1)
    out += mid >> U(30)
    out += (mid & U((1 << 30) - 1)) << shift
    return _reduced(out)


@cache
def field_powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo PRIME."""
    out = np.ones(n, U)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = times(out[:more], np.array(pow(base, have, PRIME), U))
        have += more
    return out


#: The separators of words in every contract here, \x20 and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[10] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Whatever is neither an ASCII letter or digit nor part of a non-ASCII character separates terms.
NOT_TERM = np.ones(256, dtype=bool)
NOT_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each span."""
    return hash_spans(data, starts, ends, SPAN_SEED)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, .. of every run, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


class TextBlock:
    """Texts end to end: data (bytes) and off (n + 1 byte offsets). Null texts count as empty."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self.n = data, off, len(off) - 1

    @classmethod
    def of(cls, col: pa.Array | pa.ChunkedArray) -> TextBlock:
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        if col.type not in (pa.string(), pa.large_string(), pa.binary(), pa.large_binary()):
            col, wide = col.cast(pa.string()), False
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"") if col.null_count else col
        if not len(col):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, off, data = col.buffers()
        off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        return cls(data, off - off[0])

    def spans(self, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes that aren't separators, within texts: starts, ends, and per text the first run (n + 1)."""
        d = self.data
        if not len(d):
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.n + 1, np.int64)
        sep = separators[d]
        first, last = np.empty(len(d), bool), np.empty(len(d), bool)
        first[0], last[-1] = True, True
        first[1:], last[:-1] = sep[:-1], sep[1:]
        inner = self.off[(self.off > 0) & (self.off < len(d))]
        first[inner] = True
        last[inner - 1] = True
        np.logical_not(sep, out=sep)
        first &= sep
        last &= sep
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, self.off)

    def joined(self, keep: np.ndarray | None = None, words=None, lower: bool = False) -> tuple[TextBlock, np.ndarray, np.ndarray, np.ndarray]:
        """The kept words (default: all) of each text joined by one space, as a block with its starts, ends and firsts."""
        starts, ends, first = words or self.spans()
        if keep is not None:
            counts = np.concatenate([[0], np.cumsum(keep)])[first]
            starts, ends = starts[keep], ends[keep]
            first = counts
        lengths = ends - starts
        n_words = np.diff(first)
        full = lengths + 1
        has = np.flatnonzero(n_words)
        full[first[1:][has] - 1] -= 1
        after = np.cumsum(full)
        new_starts = after - full
        out = np.full(int(after[-1]) if len(after) else 0, 32, np.uint8)
        if len(out):
            inside = np.zeros(len(out) + 1, np.int8)
            inside[new_starts] += 1
            inside[new_starts + lengths] -= 1
            to = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
            src = np.zeros(len(self.data) + 1, np.int8)
            src[starts] += 1
            src[ends] -= 1
            took = self.data[np.cumsum(src[:-1], dtype=np.int8).view(bool)]
            out[to] = LOWER[took] if lower else took
        off = np.concatenate([[0], after])[first] if len(after) else np.zeros(self.n + 1, np.int64)
        # a text's last word has no space after it, so the next text starts right there
        return TextBlock(out, off.astype(np.int64)), new_starts, new_starts + lengths, first

    def strings(self) -> pa.Array:
        """The texts as an Arrow string column."""
        if len(self.data) < 2**31 - 1:
            return pa.StringArray.from_buffers(self.n, pa.py_buffer(self.off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(self.data)))
        return pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(self.off), pa.py_buffer(np.ascontiguousarray(self.data)))


def _rolled(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every `width` consecutive values (below PRIME, at most ROLLED + width of them)."""
    n = len(values)
    size = 1 << max(10, (n - 1).bit_length())
    terms = times(values, field_powers(base, size)[:n])
    low, high = np.zeros(n + 1, U), np.zeros(n + 1, U)
    np.cumsum(terms & U(0xFFFFFFFF), out=low[1:])
    np.cumsum(terms >> U(32), out=high[1:])
    total = _reduced((high >> U(29)) + ((high & U((1 << 29) - 1)) << U(32)) + _reduced(low))
    part = total[width:] + (U(PRIME) - total[:-width])
    return times(_reduced(part), field_powers(pow(base, -1, PRIME), size)[: n - width + 1])


def windows(hashes: np.ndarray, first: np.ndarray, width: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hash of every `width` consecutive words of one text: (index of the first word, hash below 2^61).

    `base` names one of WINDOW_BASES; hashes by different bases are independent.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    values = _reduced(hashes)
    h = np.empty(n, U)
    for lo in range(0, n, ROLLED):
        hi = min(lo + ROLLED, n)
        h[lo:hi] = _rolled(values[lo : hi + width - 1], width, WINDOW_BASES[base])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return at, h[at]


def release() -> None:
    """Give freed memory back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def small_batches(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        off = TextBlock.of(col).off
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(off, off[start] + most, side="right")) - 1)
            stop = min(stop, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    release()
