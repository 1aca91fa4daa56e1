"""SentencePiece encoding by a streaming Viterbi over a model's pieces and scores, and decoding.

The best segmentation is the one of the greatest sum of piece scores; characters outside the vocabulary cost a fixed
amount and become byte pieces. The search keeps a window that only pieces up to the longest one can still reach, and
commits ids as soon as all surviving backpointer paths meet in one boundary, so memory doesn't grow with the text.

Where two neighbouring characters stand inside no piece, every path has a boundary between them. Tasks cut texts at
such places before spaces and around control characters, and each worker remembers the ids of what stands between.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import carried, without
from .textblocks import TextBlock, ragged, small_batches
from .tokens import Encoder

SPACE_MARK = "▁"
UNKNOWN_COST = 10.0


class Pieces:
    """Vocabulary of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids: dict[str, tuple[int, float]] = {}
        self.byte_ids = [-1] * 256
        self.unknown = model.unk_id()
        self.raw: list[bytes] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_unknown(i) or model.is_control(i) or model.is_unused(i):
                self.raw.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                self.ids[piece] = (i, model.get_score(i))
                self.raw.append(piece.replace(SPACE_MARK, " ").encode())
        self.longest = max(map(len, self.ids), default=1)
        #: Endings of pieces: a text that is none of them ends no longer piece either.
        self.endings = {p[i:] for p in self.ids for i in range(len(p))}
        self.unknown_score = min((s for _, s in self.ids.values()), default=0.0) - UNKNOWN_COST
        self.sizes = np.array([len(b) for b in self.raw])
        self.at = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        joined = {p[i - 1 : i + 1] for p in self.ids for i in range(1, len(p))}
        #: Whether every path has a boundary before a run of spaces, and which control characters always stand alone.
        self.space_breaks = not any(b == SPACE_MARK and a != SPACE_MARK for a, b in joined)
        self.alone = np.zeros(256, bool)
        self.alone[:32] = True
        self.alone[[ord(c) for pair in joined for c in pair if c < " "]] = False

    def unknown_ids(self, ch: str) -> list[int]:
        out = [self.byte_ids[b] for b in ch.encode("utf-8", "surrogatepass")]
        return out if min(out) >= 0 else [self.unknown]


class StreamingViterbi:
    """feed() text bit by bit and take the ids that are settled; finish() gives the rest."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.widest = 0  # the most characters that were ever unsettled, for tests
        self._start()

    def _start(self) -> None:
        self.text = ""  # characters after the last committed boundary
        self.score = [0.0]  # best score up to each boundary
        self.back: list[tuple[int, int]] = [(0, -1)]  # (boundary before, id or -1 for an unknown character)
        self.checked = 0

    def feed(self, text: str) -> list[int]:
        """Ids that became certain. Ties go to the shorter last piece."""
        out: list[int] = []
        step = 2 * self.pieces.longest
        for lo in range(0, len(text), step):
            self._extend(text[lo : lo + step])
            if len(text) > step or len(self.text) - self.checked >= step:
                out += self._settle()
        return out

    def _extend(self, bit: str) -> None:
        get, longest, unknown, endings = self.pieces.ids.get, self.pieces.longest, self.pieces.unknown_score, self.pieces.endings
        begin = len(self.text)
        self.text += bit
        text, score, back = self.text, self.score, self.back
        for end in range(begin + 1, len(text) + 1):
            hit = get(text[end - 1])
            if hit is None:
                best, path = score[end - 1] + unknown, (end - 1, -1)
            else:
                best, path = score[end - 1] + hit[1], (end - 1, hit[0])
            for start in range(end - 2, max(-1, end - 1 - longest), -1):
                part = text[start:end]
                if part not in endings:
                    break
                hit = get(part)
                if hit is not None and score[start] + hit[1] > best:
                    best, path = score[start] + hit[1], (start, hit[0])
            score.append(best)
            back.append(path)
        self.widest = max(self.widest, len(text))

    def _settle(self) -> list[int]:
        """Commit up to the boundary in which the paths of all boundaries that a later piece can start from meet."""
        end = len(self.text)
        alive = set(range(max(0, end - self.pieces.longest + 1), end + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(self.back[last][0])
        meet = alive.pop()
        out = self._path(meet)
        if meet:
            base = self.score[meet]
            self.text = self.text[meet:]
            self.score = [s - base for s in self.score[meet:]]
            self.back = [(0, -1)] + [(b - meet, i) for b, i in self.back[meet + 1 :]]
        self.checked = len(self.text)
        return out

    def _path(self, end: int) -> list[int]:
        out: list[list[int]] = []
        while end:
            start, piece = self.back[end]
            out.append([piece] if piece >= 0 else self.pieces.unknown_ids(self.text[start:end]))
            end = start
        return [i for ids in reversed(out) for i in ids]

    def finish(self) -> list[int]:
        out = self._path(len(self.text))
        self._start()
        return out


def encode_text(pieces: Pieces, text: str) -> list[int]:
    """Ids of one text: a space in front, spaces as U+2581; an empty text has none."""
    if not text:
        return []
    v = StreamingViterbi(pieces)
    marked = (" " + text).replace(" ", SPACE_MARK)
    return v.feed(marked) + v.finish()


def encode_stream(pieces: Pieces, texts: Iterable[str], space_first: bool = True) -> Iterator[list[int]]:
    """Ids of one text that comes in bits, as they are settled."""
    v, begun = StreamingViterbi(pieces), not space_first
    for bit in texts:
        if bit and not begun:
            bit, begun = " " + bit, True
        yield v.feed(bit.replace(" ", SPACE_MARK))
    yield v.finish()


class PieceEncoder(Encoder):
    """Encoder of text blocks: a worker's memory of units in front of the Viterbi search."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.search = StreamingViterbi(self.pieces)
        self.forget()

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for t in texts:
            own = self.search.feed(t.replace(" ", SPACE_MARK)) + self.search.finish()
            ids += own
            sizes.append(len(own))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def units(self, block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
        d, n = block.data, len(block.data)
        first = np.zeros(n + 1, bool)
        alone = self.pieces.alone[d]
        first[:n] = alone
        first[1:n] |= alone[:-1]
        if self.pieces.space_breaks:
            space = d == 32
            first[1:n] |= space[1:] & ~space[:-1]
        first[block.off] = True
        first[n] = False
        at = np.flatnonzero(first)
        return at, np.append(at[1:], n)

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        block = TextBlock.of(text)
        sizes = np.diff(block.off)
        some = sizes > 0
        off = np.concatenate([[0], np.cumsum(sizes + some)])
        data = np.full(int(off[-1]), 32, np.uint8)
        data[ragged(off[:-1] + some, sizes)] = block.data
        own = TextBlock(data, off)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(block.n, np.int64)
        starts, ends = self.units(own)
        at, n = self.remembered(data, starts, ends)
        before = np.concatenate([[0], np.cumsum(n)])
        return self.flat[ragged(at, n)], np.diff(before[np.searchsorted(starts, off)])


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def decode_ids(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of ids end to end: byte pieces give their bytes, and the space in front is dropped."""
    sizes = pieces.sizes[ids]
    data = pieces.flat[ragged(pieces.at[ids], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    raw = io.BytesIO(data.tobytes()).getbuffer()
    cuts = zip(ends[:-1].tolist(), ends[1:].tolist())
    return pa.array([bytes(raw[a + (b > a and raw[a] == 32) : b]).decode("utf-8", "replace") for a, b in cuts], pa.string())


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """docs with ids (array<int>) instead of the text column.

    Null and empty texts have no ids. An input column named ids is replaced, others pass through, repeated rows
    included. An empty table gives an empty result.
    """
    base = without(carried(docs), "ids")
    names = base.columns
    at = names.index(text)
    keep = [i for i in range(len(names)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(model)
        for batch in small_batches(batches, text, 3 << 20):
            ids, counts = own.encode(batch.column(at))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), lists], names=[*(names[i] for i in keep), "ids"])

    return base.mapInArrow(run, T.StructType([*(base.schema.fields[i] for i in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(coded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """coded with its ids and the decoded text as column decoded (replaced if there); null ids give an empty text.

    Bytes that are no valid UTF-8 decode to U+FFFD.
    """
    base = without(carried(coded), "decoded")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(model).pieces
        for big in batches:
            for lo in range(0, big.num_rows, 512):
                batch = big.slice(lo, 512)
                lists = batch.column(names.index(ids))
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*batch.columns, decode_ids(pieces, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)], names=[*names, "decoded"])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("decoded", T.StringType())]))
