"""Structured Streaming over workflow events: routing, running error state, metric buckets and removals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import TableSpec, upsert

#: The event types that are routed; others go to quarantine.
ROUTES = ("WorkflowEvent", "ErrorResolved", "ErrorFailedToResolve")


def read_events(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """A file stream in small batches, from the earliest file on."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def routed(events: DataFrame, kind: str = "detail_type") -> tuple[dict[str, DataFrame], DataFrame]:
    """(branch by event type, quarantine with a reason)."""
    branches = {r: events.where(F.col(kind) == r) for r in ROUTES}
    return branches, events.where(F.col(kind).isNull() | ~F.col(kind).isin(*ROUTES)).withColumn("reason", F.concat(F.lit("unknown type "), F.coalesce(F.col(kind), F.lit("null"))))


def metric_buckets(events: DataFrame, ts: str = "ts", width: str = "5 minutes", late: str = "10 minutes", by: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts for each tumbling bucket; rows later than the watermark are left out. TIMESTAMP_NTZ is read as UTC."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return e.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("bucket"), *by, "n")


def error_totals(errors: DataFrame) -> DataFrame:
    """Running (execution_id, code) totals of a stream of errors, for update or complete mode.

    Spark keeps the state of each key: occurrences, first_pos and the details of the latest position. A batch that is
    delivered again counts once, which is what the checkpoint is for.
    """
    return errors.groupBy("execution_id", "code").agg(F.count("*").alias("occurrences"), F.max_by("details", "pos").alias("details"), F.min("pos").alias("first_pos"))


class Buckets:
    """A table below `folder` in buckets of a hash of its keys; a batch rewrites the buckets that it touches.

    A batch is one version: one job writes all buckets that it touches, and they count together once it has succeeded. A
    batch that comes again writes the same version again. Of a bucket the two latest versions stay.
    """

    def __init__(self, folder: str, spec: TableSpec, n: int = 64):
        self.folder, self.spec, self.n = folder, spec, n

    def _versions(self, spark: SparkSession) -> dict[int, list[int]]:
        """Versions of each bucket, ascending: n buckets at most, with a few versions each."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(self.folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found: dict[int, list[int]] = {}
        for version in store.listStatus(path) if store.exists(path) else ():
            name = version.getPath().getName()
            if name.startswith("version=") and store.exists(hadoop.Path(version.getPath(), "_SUCCESS")):
                for bucket in store.listStatus(version.getPath()):
                    if bucket.getPath().getName().startswith("bucket="):
                        found.setdefault(int(bucket.getPath().getName()[7:]), []).append(int(name[8:]))
        return {b: sorted(v) for b, v in found.items()}

    def _path(self, bucket: int, version: int) -> str:
        return f"{self.folder}/version={version}/bucket={bucket}"

    def table(self, spark: SparkSession, schema: str, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The latest version (before batch `before`) of all buckets or of some."""
        paths = []
        for bucket, versions in self._versions(spark).items():
            good = [v for v in versions if before is None or v < before]
            if good and (only is None or bucket in only):
                paths.append(self._path(bucket, good[-1]))
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def apply(self, rows: DataFrame, batch: int) -> None:
        """A foreachBatch function: upsert the batch (one row for each key) into the buckets that it touches, by one job."""
        spark = rows.sparkSession
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        # a batch of a stateful stream is computed once: it is written first, and read from there
        bucket = F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.n)).cast("int")
        rows.withColumn("bucket", bucket).write.mode("overwrite").parquet(f"{self.folder}/incoming")
        staged = spark.read.parquet(f"{self.folder}/incoming")
        touched = [r[0] for r in staged.select("bucket").distinct().collect()]
        if not touched:
            return
        before = self._versions(spark)
        new = upsert(self.table(spark, schema, batch, touched), staged.drop("bucket"), self.spec).drop("action")
        new.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/version={batch}")
        hadoop = spark._jvm.org.apache.hadoop.fs
        store = hadoop.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        for b in touched:
            for v in [v for v in before.get(b, []) if v < batch][:-1]:
                store.delete(hadoop.Path(self._path(b, v)), True)


class Outbox:
    """Executions that a stream has set going again, each once, however often a batch or a change is delivered.

    Below `folder`, `seen` is a bucketed table of the executions and the batch that first named them, and
    `emitted/batch=<n>` what batch n put out. What a batch puts out depends on the batches before it only, so a batch that
    comes again puts out the same and replaces what it wrote.
    """

    def __init__(self, folder: str, key: str = "execution_id", n: int = 64):
        self.folder, self.key = folder.rstrip("/"), key
        self.seen = Buckets(f"{self.folder}/seen", TableSpec((key,), None), n)

    def apply(self, rows: DataFrame, batch: int) -> None:
        """A foreachBatch function: put out the rows (one for each key) whose key no earlier batch has put out."""
        spark = rows.sparkSession
        kind = dict(rows.dtypes)[self.key]
        before = self.seen.table(spark, f"`{self.key}` {kind}, batch long", batch)
        fresh = rows.where(F.col(self.key).isNotNull()).join(before.select(self.key), self.key, "left_anti")
        path = f"{self.folder}/emitted/batch={batch}"
        fresh.write.mode("overwrite").parquet(path)
        out = spark.read.schema(fresh.schema).parquet(path).select(self.key, F.lit(batch).cast("long").alias("batch"))
        self.seen.apply(out, batch)

    def emitted(self, spark: SparkSession, schema: str) -> DataFrame:
        """Everything that was put out, with its batch."""
        return spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.folder}/emitted").parquet(f"{self.folder}/emitted/batch=*")


def removals(changes: DataFrame) -> DataFrame:
    """CDC rows (event_name, old struct) -> (execution_id, error_code, occurrences) of removed links.

    Only REMOVE events with a complete old image of an error link count; a missing number of occurrences is 1.
    """
    ok = (F.col("event_name") == "REMOVE") & (F.col("old.entity_type") == "ExecutionError") & F.col("old.execution_id").isNotNull() & F.col("old.error_code").isNotNull()
    return changes.where(ok).select("old.execution_id", "old.error_code", F.coalesce("old.occurrences", F.lit(1)).alias("occurrences"))


def solved_transitions(changes: DataFrame) -> DataFrame:
    """CDC rows (event_name, old struct, new struct) -> one row for each execution with a link that left `failed`.

    Columns execution_id, solved and unrecoverable: how many links went to maybeSolved and to maybeUnrecoverable. An
    execution comes once in a batch, so it restarts once.
    """
    moved = (F.col("event_name") == "MODIFY") & (F.col("new.entity_type") == "ExecutionError") & (F.col("old.status") == "failed") & F.col("new.status").isin("maybeSolved", "maybeUnrecoverable")
    hit = changes.where(F.coalesce(moved & F.col("new.execution_id").isNotNull(), F.lit(False)))
    return hit.groupBy(F.col("new.execution_id").alias("execution_id")).agg(F.count_if(F.col("new.status") == "maybeSolved").alias("solved"), F.count_if(F.col("new.status") == "maybeUnrecoverable").alias("unrecoverable"))


#: States of a phase, in the order in which they count when their times are equal.
PHASE_STATES = ["SCHEDULED", "IN_PROGRESS", "PARKED", "FAILED", "SUCCEEDED"]


def phase_states(events: DataFrame, ts: str = "ts") -> DataFrame:
    """(execution_id, phase, status, ts) -> the latest status of each phase and when; batch, or stream in update mode."""
    rank = F.array_position(F.array(*[F.lit(x) for x in PHASE_STATES]), F.col("status"))
    known = events.where(rank > 0)
    return known.groupBy("execution_id", "phase").agg(F.max_by("status", F.struct(F.col(ts), rank)).alias("status"), F.max(ts).alias(ts), F.count("*").alias("n_events"))


def partial_failures(rows: DataFrame, message_id: str, bad: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to go on with, one row of message id and reason for each failed one), the second for a quarantine table."""
    failed = F.coalesce(bad, F.lit(True))
    return rows.where(~failed), rows.where(failed).select(F.col(message_id).alias("item_identifier"), reason.alias("reason"))
