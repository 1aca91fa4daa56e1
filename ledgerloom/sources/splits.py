"""Large text files cut into byte ranges that many tasks read, with exact record numbers.

A first pass counts the record ends of each range; sums over the ranges before it say which record a range begins with,
and the second pass reads the records that begin in it. Where quotes may hide line ends (CSV), a range doesn't know
whether it begins inside quotes: it counts for both cases, and the number of quotes before it tells which one holds. Only
one row for each range is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship
from .archives import _open

RANGE = 32 << 20
CHUNK = 4 << 20
LINES = 10_000
COUNTS = "path string, start long, stop long, size long, odd int, ends0 long, ends1 long, blank0 long, blank1 long, mid0 int, mid1 int"

SCHEMA = pa.schema([(c.split(" ")[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[c.split(" ")[1]]) for c in COUNTS.split(", ")])


def _chunks(f, at: int, stop: int) -> Iterator[bytes]:
    f.seek(at)
    while at < stop:
        piece = f.read(min(CHUNK, stop - at))
        if not piece:
            return
        at += len(piece)
        yield piece


def _ends(data: np.ndarray, odd: int, quoted: bool) -> tuple[np.ndarray, int]:
    """(places of record ends, whether the data ends inside quotes), given whether it begins inside them."""
    newline = data == 10
    if not quoted:
        return np.flatnonzero(newline), 0
    quotes = np.cumsum(data == 34) + odd
    return np.flatnonzero(newline & (quotes % 2 == 0)), int(quotes[-1] % 2) if len(quotes) else odd


def _count(f, start: int, stop: int, quoted: bool) -> tuple[int, list[int], list[int], list[int]]:
    """(parity of the range's quotes; record ends, blank records that end in it, and whether the range begins in the
    middle of a blank one, each for both ways it may begin)."""
    lead = max(0, start - 2)  # what precedes tells whether the range's first record is blank
    ends, blank, mid = [0, 0], [0, 0], [0, 0]
    last: list[int] = [-1 if lead == 0 else -9, -1 if lead == 0 else -9]
    f.seek(lead)
    head = f.read(start - lead).count(b'"') if quoted else 0
    parity, total = [head % 2, (1 + head) % 2], -head
    at, before = lead, b""
    for piece in _chunks(f, lead, stop):
        data = np.frombuffer(before + piece, np.uint8)
        base = at - len(before)
        own = np.frombuffer(piece, np.uint8)
        total += int((own == 34).sum()) if quoted else 0
        for a in (0, 1) if quoted else (0,):
            places, parity[a] = _ends(own, parity[a], quoted)
            places = places + at
            previous = np.concatenate([[last[a]], places[:-1]]) if len(places) else places
            gap = places - previous
            returns = np.zeros(len(places), bool)
            two = np.flatnonzero(gap == 2)
            returns[two] = data[places[two] - 1 - base] == 13
            counted = places >= start
            ends[a] += int(counted.sum())
            blank[a] += int(((gap == 1) | returns)[counted].sum())
            mid[a] += int((returns & (places == start)).sum())
            last[a] = int(places[-1]) if len(places) else last[a]
        before = piece[-2:]
        at += len(piece)
    if not quoted:
        ends[1], blank[1], mid[1] = ends[0], blank[0], mid[0]
    return total % 2, ends, blank, mid


def ranges(spark: SparkSession, path: str, quoted: bool = False, size: int = RANGE) -> DataFrame:
    """(path, start, stop, size, inside, first, full, ends, blank, mid) of all ranges: whether one begins inside quotes, how
    many records of its file and how many with anything in them end before it, how many end in it and how many of these
    are blank, whether it begins in the middle of a blank one, and whether its number of quotes is odd."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    cut = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(size).cast("long"))).alias("start"))
    cut = cut.select("path", "start", F.least(F.col("start") + size, F.col("size")).alias("stop"), "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, start, stop, whole in zip(*(c.to_pylist() for c in rows.columns)):
                with _open(name) as f:
                    odd, ends, blank, mid = _count(f, start, stop, quoted)
                yield pa.RecordBatch.from_pylist([{"path": name, "start": start, "stop": stop, "size": whole, "odd": odd, "ends0": ends[0], "ends1": ends[1], "blank0": blank[0], "blank1": blank[1], "mid0": mid[0], "mid1": mid[1]}], schema=SCHEMA)

    counted = cut.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "start").mapInArrow(run, COUNTS)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    known = known.withColumns({"ends": F.when(F.col("inside"), F.col("ends1")).otherwise(F.col("ends0")), "blank": F.when(F.col("inside"), F.col("blank1")).otherwise(F.col("blank0")), "mid": F.when(F.col("inside"), F.col("mid1")).otherwise(F.col("mid0"))})
    known = known.withColumns({"first": F.coalesce(F.sum("ends").over(before), F.lit(0)), "full": F.coalesce(F.sum(F.col("ends") - F.col("blank")).over(before), F.lit(0))})
    return known.select("path", "start", "stop", "size", "inside", "first", "full", "ends", "blank", "mid", "odd")


def _records(f, start: int, stop: int, size: int, inside: bool, quoted: bool) -> Iterator[tuple[bool, list[bytes]]]:
    """Lists of the records that begin in [start, stop), each with whether the range's own first byte begins one."""
    lead = max(0, start - 1)
    odd, held, at = int(inside), b"", lead
    began = start == 0
    skip = not began  # until the first record end, what is read belongs to the range before
    at_start = began
    for piece in _chunks(f, lead, size):
        data = np.frombuffer(piece, np.uint8)
        if at == lead and not began:
            odd = int(inside) ^ (int(data[0] == 34) if quoted else 0)
        places, odd = _ends(data, odd, quoted)
        found, position = [], 0
        done = False
        for p in places.tolist():
            if skip:
                skip, at_start = False, at + p == lead and not began
            else:
                own = held + piece[position:p]
                found.append(own[:-1] if own.endswith(b"\r") else own)
            held, position = b"", p + 1
            if at + p + 1 >= stop:
                done = True
                break
        yield at_start, found
        if done:
            return
        held = b"" if skip else held + piece[position:]
        at += len(piece)
        if skip and at >= stop:
            return
    if not skip and held:
        yield at_start, [held]


def lines(spark: SparkSession, path: str, quoted: bool = False, size: int = RANGE) -> DataFrame:
    """(path, line_no from 1, row_no, value) of the records of UTF-8 text files, in ranges of `size` bytes.

    A record ends at a line end, with quoted=True at one outside quotes; \\r before that isn't a part of it. line_no counts
    all records of a file, row_no those of all files in the order of their names that have anything in them, and is null
    for the others. Broken characters are replaced. Files without a byte have no record; a last record needs no line end.
    """
    known = ranges(spark, path, quoted, size)
    per_file = known.groupBy("path").agg(F.sum(F.col("ends") - F.col("blank")).alias("n"), F.max("size").alias("bytes"), (F.sum("odd") % 2 == 1).alias("open"))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, n, whole, inside in zip(*(c.to_pylist() for c in rows.columns)):
                with _open(name) as f:
                    f.seek(whole - 1)
                    open_end = inside or f.read(1) != b"\n"
                yield pa.RecordBatch.from_pydict({"path": [name], "n": [n + int(open_end)]}, schema=pa.schema([("path", pa.string()), ("n", pa.int64())]))

    totals = per_file.mapInArrow(tails, "path string, n long")
    offsets = totals.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")  # a row for each file
    plan = known.join(offsets, "path").select("path", "start", "stop", "size", "inside", "first", "mid", (F.col("full") + F.col("offset")).alias("rows_before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, start, stop, whole, inside, first, mid, before in zip(*(c.to_pylist() for c in rows.columns)):
                with _open(name) as f:
                    at, full = None, before
                    for own_start, found in _records(f, start, stop, whole, inside, quoted):
                        if at is None and found:
                            # records before: those that ended, and the one that the range begins in the middle of
                            at = first if own_start else first + 1
                            full = before + (0 if own_start or mid else 1)
                        for lo in range(0, len(found), LINES):
                            texts = found[lo : lo + LINES]
                            some = np.array([len(x) > 0 for x in texts], bool)
                            number = full + np.cumsum(some)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([name] * len(texts), pa.string()), pa.array(at + 1 + np.arange(len(texts), dtype=np.int64)), pa.array(number.astype(np.int64), mask=~some), pa.array([x.decode("utf-8", "replace") for x in texts], pa.string())],
                                names=["path", "line_no", "row_no", "value"],
                            )
                            at, full = at + len(texts), int(number[-1])

    return plan.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "start").mapInArrow(run, "path string, line_no long, row_no long, value string")
