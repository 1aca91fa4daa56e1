"""Ids of whole texts by the tokenizers library, at the cost of its distinct units.

A text whose bytes are plain (ASCII, white space and the letters U+00C0 to U+00FF) is cut at places that no token of the
tokenizer crosses; each distinct unit is encoded once by the library and remembered by its worker. Any other text, and
any with the content of an added token such as <|endoftext|> in any case, goes to the library whole. Both ways give the
ids of encode(text, add_special_tokens=False) by the tokenizer as it is loaded.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from .textblocks import LOWER, SPACE, TextBlock, U, ragged, span_hash

#: Units that one worker remembers; beyond it the memory starts anew, which costs time only.
REMEMBERED = 1_200_000
REMEMBERED_BYTES = 24 << 20
PLAIN = np.zeros(256, bool)
PLAIN[[*range(9, 14), *range(32, 127), *range(0x80, 0xC0), 0xC3]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = True


def plain_texts(block: TextBlock) -> np.ndarray:
    """Which texts consist of ASCII, white space and the letters U+00C0 to U+00FF (without U+00D7 and U+00F7)."""
    d = block.data
    odd = ~PLAIN[d]
    if len(d) > 1:
        odd[1:] |= (d[:-1] == 0xC3) & ((d[1:] == 0x97) | (d[1:] == 0xB7))
    return np.diff(np.concatenate([[0], np.cumsum(odd)])[block.off]) == 0


class Encoder:
    """Encodes blocks of texts with one tokenizer file; drops_space: white space yields no ids and case doesn't matter."""

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted({t.content.strip().encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()} - {b""})
        self.drops_space = drops_space
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size, self.flat = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.begin, self.length, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, count of each text)."""
        ids, sizes = [], []
        for i in range(0, len(texts), 1024):
            for e in self.tokenizer.encode_batch(texts[i : i + 1024], add_special_tokens=False):
                ids.extend(e.ids)
                sizes.append(len(e.ids))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def has_added(self, block: TextBlock) -> np.ndarray:
        """Which texts hold the content of an added token, whatever its case."""
        out = np.zeros(block.n, bool)
        data = LOWER[block.data].tobytes()
        for content in self.added:
            at = data.find(content)
            while at >= 0:
                doc = int(np.searchsorted(block.off, at, side="right")) - 1
                if at + len(content) <= block.off[doc + 1]:
                    out[doc] = True
                    at = data.find(content, int(block.off[doc + 1]))
                else:
                    at = data.find(content, at + 1)
        return out

    def units(self, block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the units of plain texts."""
        d, n = block.data, len(block.data)
        starts, ends, _ = block.spans()
        letter = LETTER[d]
        turn = np.zeros(n + 1, bool)
        turn[1:n] = letter[1:] != letter[:-1]
        quotes = np.flatnonzero(d == 39)
        if len(quotes):  # contractions: such words stay whole
            w = np.unique(np.searchsorted(starts, quotes, side="right") - 1)
            turn[ragged(starts[w], ends[w] - starts[w])] = False
        space = np.ones(n + 1, bool)
        space[:n] = SPACE[d]
        first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        first[starts] = True
        if self.drops_space:
            cut = (turn & ~space) & ~first
            cut[block.off] = False
            last[ends] = True
            first |= cut
            last |= cut
            return np.flatnonzero(first), np.flatnonzero(last)
        first |= turn & ~space
        after_space = starts[~np.isin(starts, block.off, assume_unique=False)] if len(starts) else starts
        first[after_space] = d[after_space - 1] != 32
        first[after_space - 1] = True
        first[ends] = True  # white space after a word, or the next text
        first[block.off] = True
        first[n] = False
        at = np.flatnonzero(first)
        return at, np.append(at[1:], n)

    def remembered(self, d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per unit its place and count in self.flat. Units are found by hash and compared by their bytes."""
        keys, index, inverse = np.unique(span_hash(d, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > REMEMBERED or len(self.bytes) > REMEMBERED_BYTES:
            self.forget()
        near = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(near, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        if len(new):
            a, b = starts[index[new]], ends[index[new]]
            at, sizes = self._taken(d, a, b)
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            self.keys = np.concatenate([self.keys, keys[new]])[order]
            self.at = np.concatenate([self.at, at])[order]
            self.size = np.concatenate([self.size, sizes.astype(np.int32)])[order]
            self.begin = np.concatenate([self.begin, np.cumsum(b - a) - (b - a) + len(self.bytes)])[order]
            self.length = np.concatenate([self.length, b - a])[order]
            self.bytes = np.concatenate([self.bytes, d[ragged(a, b - a)]])
        place = np.searchsorted(self.keys, keys)[inverse]
        at, size = self.at[place], self.size[place].astype(np.int64)
        other = self._others(d, starts, ends, place)
        if len(other):  # two units of one hash: this one isn't the remembered one
            at[other], size[other] = self._taken(d, starts[other], ends[other])
        return at, size

    def _taken(self, d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units encoded by the library: their places and counts in self.flat, to which their ids are added."""
        view = memoryview(np.ascontiguousarray(d))
        ids, sizes = self.library([str(view[a:b], "utf-8") for a, b in zip(starts.tolist(), ends.tolist())])
        at = np.cumsum(sizes) - sizes + len(self.flat)
        self.flat = np.concatenate([self.flat, ids])
        return at, sizes

    def _others(self, d: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Units whose bytes aren't those remembered at their place."""
        size = ends - starts
        differs = size != self.length[place]
        for lo in range(0, len(starts), 1 << 17):
            own = np.flatnonzero(~differs[lo : lo + (1 << 17)]) + lo
            unlike = d[ragged(starts[own], size[own])] != self.bytes[ragged(self.begin[place[own]], size[own])]
            if unlike.any():
                differs[own[np.searchsorted(np.cumsum(size[own]), np.flatnonzero(unlike), side="right")]] = True
        return np.flatnonzero(differs)

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, count of each text); null texts count as empty."""
        block = TextBlock.of(text)
        plain = plain_texts(block) & ~self.has_added(block)
        sizes = np.diff(block.off)
        counts = np.zeros(block.n, np.int64)
        own = TextBlock(block.data[ragged(block.off[:-1][plain], sizes[plain])] if not plain.all() else block.data, np.concatenate([[0], np.cumsum(sizes[plain])]))
        data = LOWER[own.data] if self.drops_space else own.data
        starts, ends = self.units(TextBlock(data, own.off)) if len(data) else (np.zeros(0, np.int64),) * 2
        at, n = self.remembered(data, starts, ends)
        ids = self.flat[ragged(at, n)]
        before = np.concatenate([[0], np.cumsum(n)])
        counts[plain] = np.diff(before[np.searchsorted(starts, own.off)])
        if plain.all():
            return ids, counts
        rest = np.flatnonzero(~plain)
        other, other_counts = self.library([bytes(block.data[block.off[i] : block.off[i + 1]]).decode() for i in rest])
        counts[rest] = other_counts
        out = np.zeros(int(counts.sum()), np.uint32)
        begin = np.cumsum(counts) - counts
        out[ragged(begin[plain], counts[plain])] = ids
        out[ragged(begin[rest], other_counts)] = other
        return out, counts


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, drops_space: bool) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    key = (path, drops_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, drops_space)
    return _ENCODERS[key]
