"""Best-fit packing by a configuration linear program over the length histogram.

1. Documents become pieces of at most `capacity` ids; the piece table holds no ids and is checkpointed.
2. The histogram of piece lengths has at most `capacity` rows whatever the input, so the driver solves its
   configuration program: multiplicative weights price the lengths by the share of them that is still uncovered, a
   knapsack by dynamic programming over all lengths finds configurations of the greatest price, and prices of lengths
   that these cover fall. The prices also bound from below how many sequences any packing needs.
3. Steps are whole multiples of a configuration, so the solution is rounded as it grows. Where best-fit, longest
   first, needs fewer sequences for what no full configuration holds in the end, it packs that.
4. The plan (configuration, how many times) becomes a table of rank ranges for each length, bounded by the number of
   configurations, and each piece finds its sequence and place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cluster import carried, cut, parts
from .textblocks import small_batches
from .tokens import encoder

#: How fast prices fall with coverage, how much long pieces are worth beyond their length, configurations read from one
#: knapsack table, and the share of a step that the scarcest length allows.
STEP = 0.1
LONG = (0.1, 0.2, 0.05)
COLUMNS = 16
SHARE = 8
#: The most ids that a configuration may leave empty grows by this much, at first less, whenever none is fuller.
RELAXED = 4
#: Share of the capacity beyond which best-fit is tried for what is left.
MISSING = 0.01
#: Pieces of one length that are ranked together on average; a frequent length is spread over many buckets.
RANKED = 500

Configuration = tuple[tuple[int, int], ...]


def knapsack(prices: np.ndarray) -> np.ndarray:
    """Greatest total price for every capacity, by dynamic programming over all lengths (prices by length, index 0 unused)."""
    value = np.zeros(len(prices))
    for room in range(1, len(prices)):
        value[room] = max(value[room - 1], (value[:room][::-1] + prices[1 : room + 1]).max())
    return value


def read_off(value: np.ndarray, prices: np.ndarray, left: np.ndarray) -> Configuration:
    """A configuration from a knapsack table: at each step the length whose price and remaining value are greatest,
    among those of which pieces are left."""
    room, prices, take = len(prices) - 1, prices.copy(), {}
    while room:
        worth = value[:room][::-1] + prices[1 : room + 1]
        length = int(worth.argmax()) + 1
        if worth[length - 1] == -np.inf:
            break
        take[length] = take.get(length, 0) + 1
        if take[length] >= left[length]:
            prices[length] = -np.inf
        room -= length
    return tuple(sorted(take.items()))


def program(lengths: np.ndarray, counts: np.ndarray, capacity: int, long: float = LONG[0]) -> tuple[dict[Configuration, int], dict[Configuration, int], float]:
    """(configurations and how often to use each, those of them that lack at most MISSING of the capacity, and a lower
    bound on the sequences of any packing). The first cover everything."""
    size = np.arange(capacity + 1)
    need = np.zeros(capacity + 1, np.int64)
    need[lengths] = counts
    left, used, full, missing = need.copy(), {}, {}, 0
    bound = float((size * need).sum()) / capacity
    rng = np.random.default_rng(7)
    while left.any():
        open_ = left / np.maximum(need, 1)
        weight = np.exp(STEP * (open_ - open_.max()) + long * (size / capacity - 1))
        weight *= 1 + 1e-4 * rng.random(capacity + 1)  # breaks the tie that all prices start with
        prices = np.where(left > 0, size / capacity * weight, -np.inf)
        value = knapsack(prices)
        bound = max(bound, float((need * np.where(left > 0, prices, 0.0)).sum() / value[capacity]))
        before = left.sum()
        for _ in range(COLUMNS):
            config = read_off(value, prices, left)
            if not config or sum(length * copies for length, copies in config) < capacity - missing:
                break
            times = max(1, min(int(left[length]) // copies for length, copies in config) // SHARE)
            used[config] = used.get(config, 0) + times
            for length, copies in config:
                left[length] -= times * copies
                if not left[length]:
                    prices[length] = -np.inf
        if before == left.sum():
            if missing < MISSING * capacity <= missing + RELAXED:
                full = dict(used)
            missing += min(max(missing, 1), RELAXED) if missing < MISSING * capacity else missing
    return used, full or used, bound


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[Configuration, int]:
    """Best-fit, longest first, on a histogram: open sequences of equal room and content are one entry."""
    by_room: dict[int, dict[Configuration, int]] = {}
    for length, left in sorted(zip(lengths.tolist(), counts.tolist()), reverse=True):
        while left:
            room = min((r for r in by_room if r >= length), default=None)
            if room is None:
                per = capacity // length
                whole, rest = divmod(left, per)
                for n_seq, k in ((whole, per), (1 if rest else 0, rest)):
                    if n_seq:
                        key, r = ((length, k),), capacity - k * length
                        by_room.setdefault(r, {})
                        by_room[r][key] = by_room[r].get(key, 0) + n_seq
                left = 0
                continue
            content, n = by_room[room].popitem()
            if not by_room[room]:
                del by_room[room]
            fits = room // length
            whole, rest = divmod(left, fits)
            full = min(n, whole)
            moves = [(full, fits)]
            left -= full * fits
            if full < n and left:
                moves.append((1, left))
                left = 0
            back = n - sum(m for m, _ in moves)
            for m, k in moves:
                if m:
                    key, r = (*content, (length, k)), room - k * length
                    by_room.setdefault(r, {})
                    by_room[r][key] = by_room[r].get(key, 0) + m
            if back:
                by_room.setdefault(room, {})
                by_room[room][content] = by_room[room].get(content, 0) + back
    out: dict[Configuration, int] = {}
    for group in by_room.values():
        for key, n in group.items():
            out[key] = out.get(key, 0) + n
    return out


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[Configuration, int]], dict[str, float]]:
    """((configuration, times) that hold every piece exactly once; how many sequences come from the program, from the
    best-fit remainder and from full pieces, and the lower bound).

    The program is solved for each preference in LONG until it needs no more sequences than best-fit alone; of packings
    that all need more, that of the fewest sequences is taken, best-fit alone included.
    """
    counts = counts.astype(np.int64)
    whole = lengths == capacity
    full = int(counts[whole].sum())
    out: list[tuple[Configuration, int]] = [(((capacity, 1),), full)] if full else []
    lengths, counts = lengths[~whole & (counts > 0)], counts[~whole & (counts > 0)]
    info = {"full": full, "program": 0, "best_fit": 0, "bound": float(full)}
    if not len(lengths):
        return out, info
    alone = best_fit(lengths, counts, capacity)
    tried = []
    for long in LONG:
        covering, fullest, bound = program(lengths, counts, capacity, long)
        info["bound"] = max(info["bound"], full + bound)
        for used in (covering, fullest):
            left = dict(zip(lengths.tolist(), counts.tolist()))
            for config, times in used.items():
                for length, copies in config:
                    left[length] -= times * copies
            rest = np.array([n for n in left if left[n]], np.int64)
            tail = best_fit(rest, np.array([left[n] for n in rest.tolist()], np.int64), capacity)
            tried.append((sum(used.values()) + sum(tail.values()), used, tail))
        if min(t[0] for t in tried) <= sum(alone.values()):
            break
    total, used, tail = min([*tried, (sum(alone.values()), {}, alone)], key=lambda x: x[0])
    info |= {"program": sum(used.values()), "best_fit": sum(tail.values())}
    return [*out, *used.items(), *tail.items()], info


def slots(plan_: list[tuple[Configuration, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies, first sequence, offset): ranks of a length that one configuration takes."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for config, times in plan_:
        offset = 0
        for length, copies in config:
            a = ranks.get(length, 0)
            out.append((length, a, a + copies * times, copies, sequence, offset))
            ranks[length] = a + copies * times
            offset += copies * length
        sequence += times
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, drops_space: bool = False, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document with its end id; longer ones are cut so that
    only the first piece is shorter than `capacity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, drops_space)
        for batch in small_batches(batches, "text", 2 << 20):
            ids, counts = own.encode(batch.column(1))
            n = counts + 1
            stop = np.cumsum(n)
            flat = np.full(int(stop[-1]), end_id, "<u4")
            inside = np.ones(len(flat), bool)
            inside[stop - 1] = False
            flat[inside] = ids
            k = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), k)
            piece = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
            head = n - (k - 1) * capacity
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[doc], capacity)
            at = (stop - n)[doc] + start
            raw = memoryview(flat).cast("B")
            cuts = list(zip(at.tolist(), (at + length).tolist()))
            cols = [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in cuts], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array([raw[4 * a : 4 * b].tobytes() for a, b in cuts], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return carried(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)


def pack(table: DataFrame, capacity: int = 2048) -> DataFrame:
    """A piece table (column length, 1 to capacity) with sequence_id and offset added.

    Every piece has one place; a sequence's pieces fill it without gaps from 0 and never exceed `capacity`. Columns
    sequence_id and offset of the input are replaced, all others pass through. Equal pieces are packed like others. An
    empty table gives an empty result.
    """
    spark = table.sparkSession
    histogram = {r[0]: r[1] for r in table.groupBy("length").count().collect()}  # at most `capacity` rows
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    if len(lengths) and (lengths[0] < 1 or lengths[-1] > capacity):
        raise ValueError("lengths must be between 1 and the capacity")
    places = spark.createDataFrame(slots(plan(lengths, counts, capacity)[0]) if len(lengths) else [], "slot_length long, first_rank long, end_rank long, copies long, first_sequence long, first_offset long")
    spread = spark.createDataFrame([(n, parts(spark, k, RANKED)) for n, k in histogram.items()], "length long, __buckets int")
    names = [c for c in table.columns if c.lower() not in ("sequence_id", "offset")]
    own = table.select(*[F.col(f"`{c}`") for c in names]).join(F.broadcast(spread), "length")
    dealt = own.withColumn("__bucket", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.col("__buckets")).cast("int")).drop("__buckets")
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "__bucket").count().select("length", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    within = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy(*[F.col(f"`{c}`") for c in names]))
    ranked = dealt.withColumn("__within", within).join(bases, ["length", "__bucket"]).withColumn("__rank", F.col("__base") + F.col("__within") - 1)
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col("slot_length")) & (F.col("__rank") >= F.col("first_rank")) & (F.col("__rank") < F.col("end_rank")))
    k = F.col("__rank") - F.col("first_rank")
    return placed.select(
        *[F.col(f"`{c}`") for c in names],
        (F.col("first_sequence") + F.expr("(__rank - first_rank) div copies")).alias("sequence_id"),
        (F.col("first_offset") + (k % F.col("copies")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, drops_space: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Null and empty texts are the end id alone; very long ones are cut into pieces. Other columns are not read; repeated
    rows, null ids and ids of several rows are packed each on its own. An empty table gives an empty result.
    """
    return pack(cut(pieces(docs, tokenizer, end_id, capacity, drops_space, id_col, text)), capacity)


def sequences(packed: DataFrame, docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, drops_space: bool = False) -> DataFrame:
    """(sequence_id, ids array<int>): the packed sequences themselves, from packed pieces and their documents.

    A sequence has at most `capacity` ids, so a group is bounded. Needs a unique doc_id.
    """

    def fill(key, table):
        table = table.sort_by("offset")
        ids = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table.column("ids")]).astype(np.int32)
        return pa.table({"sequence_id": pa.array([key[0].as_py()], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32()))})

    bodies = pieces(docs, tokenizer, end_id, capacity, drops_space, with_ids=True).select("doc_id", "piece", "ids")
    joined = packed.select("doc_id", "piece", "sequence_id", "offset").join(bodies, ["doc_id", "piece"])
    return joined.groupBy("sequence_id").applyInArrow(fill, "sequence_id long, ids array<int>")
