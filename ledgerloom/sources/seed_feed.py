"""A seed file fed in batches by a stored state: every row once, wherever a run stops.

Below a folder, `state/<number>.json` holds the states, each published by one rename, and `batches/from=<row>` the rows
that were accepted from that row on. A batch is written before the state that goes past it; a run that stops between the
two writes the same batch again, for it depends on nothing but the state, the seed and what exists already.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .splits import RANGE, lines

#: Versions of stored states: the present one, and the older ones that can still be read.
SCHEMA_VERSION, READABLE = "seed-feed.v2", ("seed-feed.v2", "seed-feed.v1")


@dataclass(frozen=True)
class State:
    """Where a feed stands: the next row number (from 1), counters since its start, and whether the seed has an end there."""

    schema_version: str = SCHEMA_VERSION
    next_row: int = 1
    accepted: int = 0
    skipped_existing: int = 0
    skipped_invalid: int = 0
    exhausted: bool = False


def parse_state(text: str) -> State:
    """A stored state; missing or odd counters are 0, an odd row number is 1, another version is an error."""
    body = json.loads(text)
    if not isinstance(body, dict):
        raise ValueError("a feed's state must be a JSON object")
    if body.get("schema_version") not in READABLE:
        raise ValueError(f"unsupported state of a feed: {body.get('schema_version')}")
    whole = {k: int(v) for k, v in body.items() if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) < 2**63}
    return State(next_row=max(1, whole.get("next_row", 1)), **{k: whole.get(k, 0) for k in ("accepted", "skipped_existing", "skipped_invalid")}, exhausted=body.get("exhausted") is True)


def seed_rows(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """(row_no from 1, one column for each name of the header) of CSV files of one header each, numbered over all files.

    Blank lines are no rows; values keep their blanks; rows may have fewer or more values than the header. The files'
    headers must be equal.
    """
    records = lines(spark, path, quoted=True, size=size)
    head = records.where("row_no is not null").groupBy("path").agg(F.min(F.struct("row_no", "value")).alias("h"))
    headers = head.select("h.value").distinct().limit(2).collect()
    if not headers:
        return spark.createDataFrame([], "row_no long")
    if len(headers) > 1:
        raise ValueError("the files of a seed have different headers")
    names = spark.createDataFrame([(headers[0][0].lstrip("﻿"),)], "value string").select(F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(headers[0][0].count(",") + 1)))).alias("r")).select("r.*").first()
    names = [n.strip() for n in names if n is not None]
    # as many headers as files come before a row: its own and those of the files before it
    files = head.select("path", F.col("h.row_no").alias("__first"))
    order = files.groupBy().agg(F.array_sort(F.collect_list("__first")).alias("__firsts"))  # one number a file
    body = records.where("row_no is not null").join(files, "path").where("row_no <> __first").crossJoin(F.broadcast(order))
    number = F.col("row_no") - F.size(F.filter("__firsts", lambda x: x < F.col("row_no")))
    schema = ", ".join(f"`{n}` string" for n in names)
    return body.select(number.alias("row_no"), F.from_csv("value", F.lit(schema), {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}).alias("r")).select("row_no", "r.*")


class SeedFeed:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark._jvm
        self.store = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _numbers(self) -> list[int]:
        path = self._path("state")
        names = [s.getPath().getName() for s in self.store.listStatus(path)] if self.store.exists(path) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def state(self) -> State:
        """The last stored state, or that of a feed that hasn't begun."""
        known = self._numbers()
        return parse_state(self.spark.read.text(f"{self.folder}/state/{known[-1]:020d}.json", wholetext=True).first()[0]) if known else State()

    def _store(self, state: State) -> None:
        known = self._numbers()
        draft = self._path(f"state/draft-{uuid.uuid4().hex}")
        out = self.store.create(draft)
        out.write(bytearray(json.dumps(asdict(state)).encode()))
        out.close()
        if not self.store.rename(draft, self._path(f"state/{(known[-1] if known else 0) + 1:020d}.json")):
            raise RuntimeError("another run stored a state of this feed")

    def step(self, rows: DataFrame, batch: int, valid: Column, existing: DataFrame | None = None, keys: tuple[str, ...] = ()) -> State:
        """Accept the next `batch` rows (row_no, ..) that are valid and, by `keys`, not among the existing ones; skip and
        count the others up to the last accepted one. Returns the new state; an exhausted feed stays as it is."""
        was = self.state()
        if was.exhausted:
            return was
        ahead = rows.where(F.col("row_no") >= was.next_row).withColumn("__valid", F.coalesce(valid, F.lit(False)))
        if existing is not None:
            known = existing.select(*keys).distinct().withColumn("__known", F.lit(True))
            ahead = ahead.join(known, list(keys), "left")
        else:
            ahead = ahead.withColumn("__known", F.lit(None).cast("boolean"))
        kind = F.when(~F.col("__valid"), "invalid").when(F.col("__known"), "existing").otherwise("accepted")
        ahead = ahead.withColumn("__kind", kind)
        # as in a scan: the batch ends with its last accepted row, or with the seed
        last = ahead.where("__kind = 'accepted'").select("row_no").orderBy("row_no").limit(batch).agg(F.count("*").alias("n"), F.max("row_no").alias("last")).first()
        full = last["n"] == batch
        part = ahead.where(F.col("row_no") <= last["last"]) if full else ahead
        part.where("__kind = 'accepted'").drop("__valid", "__known", "__kind").write.mode("overwrite").parquet(f"{self.folder}/batches/from={was.next_row}")
        seen = part.agg(*[F.count_if(F.col("__kind") == k).alias(k) for k in ("accepted", "existing", "invalid")], F.max("row_no").alias("last")).first()
        now = State(
            next_row=(seen["last"] or was.next_row - 1) + 1, accepted=was.accepted + seen["accepted"], skipped_existing=was.skipped_existing + seen["existing"], skipped_invalid=was.skipped_invalid + seen["invalid"], exhausted=not full,
        )
        self._store(now)
        return now

    def accepted(self) -> DataFrame:
        """All rows that were accepted so far, with the number of the row (`from`) that their batch began with."""
        return self.spark.read.option("basePath", f"{self.folder}/batches").parquet(f"{self.folder}/batches/from=*")
