"""Lines of text files and zip members, JSONL parts named by manifests, and CSV rows.

Files are opened by the tasks that read them and stream out in batches: neither an archive nor a member is ever whole in
memory.
"""

from __future__ import annotations

import fnmatch
import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

LINES = 10_000


def _open(path: str):
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the files below a path, without their content, one task for each."""
    ship(spark)
    found = spark.read.format("binaryFile").load(path).select("path")
    return found.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")


def _numbered(lines, keys: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of (keys.., line_no, value) of one file."""
    at, held = 0, []

    def batch() -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays([*(pa.array([k] * n, pa.string()) for k in keys), pa.array(range(at + 1, at + n + 1), pa.int64()), pa.array(held, pa.string())], names=names)

    for line in lines:
        held.append(line.rstrip("\r\n"))
        if len(held) == LINES:
            yield batch()
            at, held = at + LINES, []
    if held:
        yield batch()


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no from 1, value) of UTF-8 text files; a large file is read in ranges by many tasks."""
    from .splits import lines

    return lines(spark, path).select("path", "line_no", "value")


def zip_names(spark: SparkSession, path: str, pattern: str | tuple[str, ...] = ("*.txt", "*.dat", "*.csv", "*.json")) -> DataFrame:
    """(archive, member) of the members that match a pattern, from the archives' directories."""
    patterns = (pattern,) if isinstance(pattern, str) else pattern

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name in rows.column(0).to_pylist():
                with _open(name) as f, zipfile.ZipFile(f) as z:
                    found = sorted(n for n in z.namelist() if any(fnmatch.fnmatch(n.lower(), p) for p in patterns))
                yield pa.RecordBatch.from_pydict({"archive": [name] * len(found), "member": found}, schema=pa.schema([("archive", pa.string()), ("member", pa.string())]))

    return _files(spark, path).mapInArrow(run, "archive string, member string")


def zip_lines(spark: SparkSession, path: str, pattern: str | tuple[str, ...] = ("*.txt", "*.dat", "*.csv", "*.json")) -> DataFrame:
    """(archive, member, line_no from 1, value) of the matching members, each read by one task. A broken archive fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, member in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                with _open(name) as f, zipfile.ZipFile(f) as z, z.open(member) as m:
                    yield from _numbered(io.TextIOWrapper(m, "utf-8", "replace"), [name, member], ["archive", "member", "line_no", "value"])

    members = zip_names(spark, path, pattern).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "archive", "member")
    return members.mapInArrow(run, "archive string, member string, line_no long, value string")


def zip_json(spark: SparkSession, path: str, pattern: str = "data/*.json") -> DataFrame:
    """(archive, member, ordinal, value): the JSON documents of an archive's matching members, numbered by name.

    A member is one value, so it must be small, as a record of an extracted bundle is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name in rows.column(0).to_pylist():
                with _open(name) as f, zipfile.ZipFile(f) as z:
                    for i, member in enumerate(sorted(n for n in z.namelist() if fnmatch.fnmatch(n, pattern))):
                        yield pa.RecordBatch.from_pydict({"archive": [name], "member": [member], "ordinal": [i + 1], "value": [z.read(member).decode("utf-8", "replace")]})

    return _files(spark, path).mapInArrow(run, "archive string, member string, ordinal long, value string")


def manifest_parts(spark: SparkSession, manifests: str) -> DataFrame:
    """(path) of the part files that manifests list in `chunks`, themselves or through the summaries that they name in
    `summary`, each once. Summaries are read by tasks; the driver sees no list."""
    listed = spark.read.json(manifests, schema="chunks array<string>, summary string", multiLine=True)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name in rows.column(0).to_pylist():
                with _open(name if "://" in name else f"file://{name}") as f:
                    body = json.loads(f.read().decode())
                found = [c for c in (body.get("chunks") or [] if isinstance(body, dict) else []) if isinstance(c, str)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["path"])

    named = listed.where("summary is not null").select("summary").distinct().repartition("summary")
    own = listed.select(F.explode("chunks").alias("path"))
    return own.union(named.mapInArrow(summaries, "path string")).where("path is not null").distinct()


def jsonl_of_manifests(spark: SparkSession, manifests: str, schema: str, most: int | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the JSONL parts that manifests name (the first `most` of them by name), with corrupt, valid and truncated.

    corrupt holds the text of rows that don't parse; valid is false for them and for rows without a required column;
    truncated says whether parts were left out. Parts are opened by the tasks that read them, however many there are.
    """
    paths = manifest_parts(spark, manifests)
    more = F.lit(False)
    if most is not None:
        more = F.lit(paths.limit(most + 1).count() > most)
        paths = paths.orderBy("path").limit(most)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name in rows.column(0).to_pylist():
                with _open(name if "://" in name else f"file://{name}") as f:
                    for batch in _numbered(io.TextIOWrapper(f, "utf-8", "replace"), [], ["line_no", "value"]):
                        yield batch.select(["value"])

    raw = paths.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path").mapInArrow(lines, "value string").where("value <> ''")
    parsed = raw.select(F.from_json("value", f"{schema}, corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}).alias("r")).select("r.*")
    valid: Column = F.col("corrupt").isNull()
    for c in required:
        valid = valid & F.col(c).isNotNull()
    return parsed.withColumn("valid", valid).withColumn("truncated", more)


def seed_rows(rows: DataFrame, number: str, start: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(the next `most` rows from row number `start` on, one row of taken, next_row and exhausted) of a numbered seed."""
    batch = rows.where((F.col(number) >= start) & (F.col(number) < start + most))
    ahead = rows.agg(F.coalesce(F.max(number), F.lit(0)).alias("last"), F.count_if((F.col(number) >= start) & (F.col(number) < start + most)).alias("taken"))
    return batch, ahead.select("taken", (F.lit(start) + F.least(F.lit(most), F.greatest(F.col("last") - start + 1, F.lit(0)))).alias("next_row"), (F.col("last") < start + most).alias("exhausted"))


def catalog_rows(spark: SparkSession, path: str, required: tuple[str, ...] = ("key", "url")) -> DataFrame:
    """Rows of a JSON catalog file (an array, or an object with `rows`) that have all required values as texts."""
    with _open(path if "://" in path else f"file://{path}") as f:
        body = json.loads(f.read().decode())
    rows = body.get("rows", []) if isinstance(body, dict) else body
    good = [r for r in rows if isinstance(r, dict) and all(isinstance(r.get(c), str) and r[c].strip() for c in required)]
    names = sorted({k for r in good for k in r}) or list(required)
    return spark.createDataFrame([[None if r.get(k) is None else str(r[k]) for k in names] for r in good], ", ".join(f"`{k}` string" for k in names))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: all strings, trimmed, quotes doubled inside quotes, line ends allowed in them, blank lines skipped."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="PERMISSIVE").dropna("all")
