"""Minimum-cost-flow resharding: move the fewest bytes from an old layout to new shard capacities.

1. One flow over the whole sizes of the old shards, with new shards as sinks and a cost for each byte that changes
   shards, says how many bytes each old shard hands to each new one.
2. A histogram of (old shard, size class) turns these amounts into numbers of documents: large classes first, each to
   the transfers with the most room, so that small documents even out what large ones leave. Old shards that keep
   everything move nothing. Classes are as wide as the PRECISION-th part of a size, so the histogram is bounded by the
   number of shards and classes.
3. A document's rank by a hash within its class decides which transfer takes it. Ranks are needed at the transfers'
   bounds only: the hashes there make a table of bounded size, against which every document finds its shard where it is
   read, and one shuffle takes it to its new file.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cluster import cut, new_folder, without

OVERHEAD = 16
#: Rows of one size class that are ranked together on average; a frequent class is spread over many buckets.
BUCKET_ROWS = 500
#: Sizes up to twice this are classes of their own; larger ones share a class if their leading bits agree.
PRECISION = 64
#: Files of a new shard hold about this many bytes of text.
FILE_BYTES = 128 << 20


def min_cost_flow(supply: list[int], room: list[int], cost: Callable[[int, int], int]) -> dict[tuple[int, int], int]:
    """Amounts to send from source i to sink j at the least total cost: successive shortest paths with potentials.

    Total room must be at least total supply. The network has a few nodes for each shard, whatever the data.
    """
    n, m = len(supply), len(room)
    source, sink = n + m, n + m + 1
    edges: list[list[int]] = []  # to, capacity, cost
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(a: int, b: int, capacity: int, price: int) -> None:
        out[a].append(len(edges))
        edges.append([b, capacity, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    arcs = {}
    for i, s in enumerate(supply):
        add(source, i, s, 0)
        for j in range(m):
            arcs[i, j] = len(edges)
            add(i, n + j, s, cost(i, j))
    for j, r in enumerate(room):
        add(n + j, sink, r, 0)
    potential = [0] * (n + m + 2)
    left = sum(supply)
    while left:
        far = [float("inf")] * (n + m + 2)
        via = [-1] * (n + m + 2)
        far[source] = 0
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                b, capacity, price = edges[e]
                if capacity and (x := d + price + potential[a] - potential[b]) < far[b]:
                    far[b], via[b] = x, e
                    heapq.heappush(queue, (x, b))
        if far[sink] == float("inf"):
            raise ValueError("the new capacities can't hold the old shards")
        potential = [p + (f if f < float("inf") else 0) for p, f in zip(potential, far)]
        amount, node = left, sink
        while node != source:
            amount, node = min(amount, edges[via[node]][1]), edges[via[node] ^ 1][0]
        node = sink
        while node != source:
            edges[via[node]][1] -= amount
            edges[via[node] ^ 1][1] += amount
            node = edges[via[node] ^ 1][0]
        left -= amount
    return {k: edges[e ^ 1][1] for k, e in arcs.items() if edges[e ^ 1][1]}


def transfers(supply: dict[int, int], room: list[int]) -> list[tuple[int, int, int]]:
    """(old, new, bytes): staying costs nothing, moving costs one for each byte."""
    old = sorted(k for k, v in supply.items() if v)
    flow = min_cost_flow([supply[k] for k in old], room, lambda i, j: int(old[i] != j))
    return sorted((old[i], j, b) for (i, j), b in flow.items())


def deal(flow: list[tuple[int, int, int]], classes: dict[int, list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int]]:
    """(old, class, new, how many documents) from the flow's (old, new, bytes) and each old shard's (class, documents,
    bytes). Within an old shard and class, rows are in the order in which ranks are handed out."""
    out, owed = [], {}
    for old in sorted(classes):
        need = {new: amount for o, new, amount in flow if o == old}
        need = {new: amount + owed.pop(new, 0.0) for new, amount in need.items()}
        for kind, n, total in sorted(classes[old], key=lambda c: -c[2] / c[1]):
            size, room = total / n, sum(max(v, 0.0) for v in need.values())
            took = {new: int(n * max(v, 0.0) / room) if room else n // len(need) for new, v in need.items()}
            for new, k in took.items():
                need[new] -= k * size
            for _ in range(n - sum(took.values())):
                new = max(need, key=lambda j: need[j])
                took[new] += 1
                need[new] -= size
            out += [(old, kind, new, k) for new, k in took.items() if k]
        for new, left in need.items():  # later old shards even out what is left over
            owed[new] = owed.get(new, 0.0) + left
    return out


def size_class(size: Column) -> Column:
    """Sizes below 2 * PRECISION as they are, of larger ones the leading bits."""
    low = F.greatest(F.floor(F.log2(size.cast("double"))) - int(np.log2(PRECISION)), F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, low), low)


@dataclass
class Placement:
    """Where documents go: bounds of hashes for each (old shard, class), the shards that gain or lose a row, and the
    number of parts of a shard."""

    bounds: DataFrame
    affected: list[int]
    n_parts: int


def _keyed(docs: DataFrame, old_shard: Column, text: str) -> DataFrame:
    """docs with size, text_crc32, old_shard, class__ and hash__ (63 bits); equal rows differ in hash__."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    base = docs.withColumns({"old__": F.coalesce(old_shard, F.lit(0)).cast("int"), "size__": (F.octet_length(body) + OVERHEAD).cast("long"), "crc__": F.crc32(body)})
    base = without(base, "size", "text_crc32", "old_shard", "shard", "slot", "moved").withColumnsRenamed({"old__": "old_shard", "size__": "size", "crc__": "text_crc32"})
    return base.withColumn("class__", size_class(F.col("size"))).withColumn("hash__", F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id(), "size", "text_crc32"), 1))


def place(docs: DataFrame, old_shard: Column, n_shards: int = 40, text: str = "text") -> Placement:
    """Solve the flow for new shards of equal capacities and find the bounds of its transfers.

    The driver sees one row for each old shard and size class.
    """
    spark = docs.sparkSession
    rows = _keyed(docs, old_shard, text).select("old_shard", "class__", "size", "hash__")
    classes: dict[int, list[tuple[int, int, int]]] = {}
    for old, kind, n, total in rows.groupBy("old_shard", "class__").agg(F.count("*"), F.sum("size")).collect():
        classes.setdefault(old, []).append((kind, n, total))
    supply = {old: sum(c[2] for c in own) for old, own in classes.items()}
    whole = sum(supply.values())
    room = [whole * (j + 1) // n_shards - whole * j // n_shards for j in range(n_shards)]
    ends: dict[tuple[int, int], int] = {}
    ranges: list[tuple[int, int, int, int]] = []
    for old, kind, new, n in deal(transfers(supply, room), classes):
        ranges.append((old, kind, new, ends.get((old, kind), 0)))
        ends[old, kind] = ranges[-1][3] + n
    table = spark.createDataFrame(ranges, "b_old int, b_class long, shard int, first_rank long")
    shared = {(old, kind) for old, kind, _, first in ranges if first}
    buckets = spark.createDataFrame([(old, kind, -(-n // BUCKET_ROWS)) for old, kind in shared for n in (ends[old, kind],)], "old_shard int, class__ long, buckets__ int")
    # ranks are in the order of hashes: a bucket is a range of them
    share = (F.shiftright("hash__", 31) * F.col("buckets__") / float(1 << 32)).cast("int")
    own = rows.drop("size").join(F.broadcast(buckets), ["old_shard", "class__"]).withColumn("bucket__", share).drop("buckets__")
    keys = ["old_shard", "class__", "bucket__"]
    before = Window.partitionBy(*keys[:2]).orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    bases = own.groupBy(*keys).count().select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base__"))
    ranked = own.withColumn("n__", F.row_number().over(Window.partitionBy(*keys).orderBy("hash__"))).join(bases, keys)
    ranked = ranked.select("old_shard", "class__", "hash__", (F.col("base__") + F.col("n__") - 1).alias("rank__"))
    on = (F.col("old_shard") == F.col("b_old")) & (F.col("class__") == F.col("b_class")) & (F.col("rank__") == F.col("first_rank"))
    found = ranked.join(F.broadcast(table.where("first_rank > 0").drop("shard")), on).select("b_old", "b_class", "first_rank", F.col("hash__").alias("from"))
    bounds = table.join(found, ["b_old", "b_class", "first_rank"], "left").withColumn("from", F.coalesce("from", F.lit(0).cast("long")))
    upto = F.lead("from").over(Window.partitionBy("b_old", "b_class").orderBy("first_rank"))
    bounds = cut(bounds.withColumn("upto", F.coalesce(upto, F.lit((1 << 63) - 1))).select("b_old", "b_class", "shard", "from", "upto"))
    affected = sorted({x for old, _, new, _ in ranges if old != new for x in (old, new)})
    return Placement(bounds, affected, max(1, round(whole / n_shards / FILE_BYTES)))


def placed(docs: DataFrame, old_shard: Column, placement: Placement, text: str = "text") -> DataFrame:
    """docs with size, text_crc32, old_shard, shard, part and place added (input columns of those names are replaced).

    Every row finds its shard where it is read, against the placement's bounds: a broadcast of at most one row for each
    old shard, size class and new shard. Rows of a part stand in the order of place.
    """
    rows = _keyed(without(docs, "part", "place"), old_shard, text)
    hit = (F.col("old_shard") == F.col("b_old")) & (F.col("class__") == F.col("b_class")) & (F.col("hash__") >= F.col("from")) & (F.col("hash__") < F.col("upto"))
    out = rows.join(F.broadcast(placement.bounds), hit).drop("b_old", "b_class", "from", "upto", "class__")
    return out.withColumn("part", F.pmod("hash__", F.lit(placement.n_parts)).cast("int")).withColumnRenamed("hash__", "place")


def rewrite(docs: DataFrame, old_shard: Column, placement: Placement, folder: str | None = None, text: str = "text") -> str:
    """Write docs below `folder`, one directory for each shard that gains or loses a row, and return the folder.

    Rows keep all their columns but those that are replaced; old_shard, part and place are added. One shuffle takes a row from where it is read to its file;
    a file holds about FILE_BYTES.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "shards")
    rows = placed(docs, old_shard, placement, text).where(F.col("shard").isin(placement.affected)).drop("size", "text_crc32")
    n_tasks = max(placement.n_parts * len(placement.affected), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(n_tasks, "shard", "part").sortWithinPartitions("shard", "part", "place")
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return folder


def reshard(docs: DataFrame, old_shard: Column, n_shards: int = 40, id_col: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """(id_col, size, text_crc32, old_shard, shard, slot, moved) of every document, after the affected shards are written.

    size is the UTF-8 bytes of the text (null: none) plus OVERHEAD; old_shard gives the present shard of a row by its
    columns (null: 0). Shards that gain or lose a row are written below `folder` (see rewrite()) and their rows are read
    back from there; all others stay where they are. slot counts a shard's rows from 0 without gaps. Repeated rows and
    null ids are rows like others; a text larger than a shard stays whole. docs must come from stored rows: a row's place
    in its file tells equal rows apart. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    placement = place(docs, old_shard, n_shards, text)
    columns = ["size", "text_crc32", "old_shard", "shard", "part", "place"]
    rows = placed(docs, old_shard, placement, text).where(~F.col("shard").isin(placement.affected)).select(F.col(f"`{id_col}`").alias("id__"), *columns)
    if placement.affected:
        folder = rewrite(docs, old_shard, placement, folder, text)
        kept = without(docs, "part", "place", "size", "text_crc32", "old_shard", "shard", "slot", "moved")
        written = spark.read.schema(", ".join(f"`{c}` {kind}" for c, kind in kept.dtypes) + ", old_shard int, place long, part int, shard int").parquet(folder)
        back = _keyed(written.withColumn("shard__", F.col("shard")), F.col("old_shard"), text).withColumnRenamed("shard__", "shard")
        rows = rows.unionByName(back.select(F.col(f"`{id_col}`").alias("id__"), *columns))
    own = rows.withColumn("n__", F.row_number().over(Window.partitionBy("shard", "part").orderBy("place")))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard", "part").count().select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base__"))
    out = own.join(bases, ["shard", "part"]).withColumn("slot", F.col("base__") + F.col("n__") - 1)
    return out.select(F.col("id__").alias(id_col), "size", "text_crc32", "old_shard", "shard", "slot", (F.col("shard") != F.col("old_shard")).alias("moved"))
