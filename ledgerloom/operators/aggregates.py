"""Folds over workflow events, gauges and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import error_type, sort_key


def error_occurrences(errors: DataFrame) -> DataFrame:
    """Rows (execution_id, code, details, pos) -> occurrences for each execution and code, with the first details."""
    return errors.groupBy("execution_id", "code").agg(F.count("*").alias("occurrences"), F.min_by("details", "pos").alias("details"), F.min("pos").alias("first_pos"))


def execution_stats(occurrences: DataFrame) -> DataFrame:
    """For each execution: total occurrences, unique codes, the type of its first code, and its padded sort key."""
    out = occurrences.groupBy("execution_id").agg(
        F.sum("occurrences").alias("total_occurrences"), F.count("*").alias("unique_errors"), error_type(F.min_by("code", "first_pos")).alias("error_type")
    )
    return out.withColumn("sort_key", sort_key(F.col("unique_errors")))


def code_totals(occurrences: DataFrame) -> DataFrame:
    return occurrences.groupBy("code").agg(F.sum("occurrences").alias("total_count"), F.count("*").alias("n_executions"), F.max_by("execution_id", F.struct("first_pos", "execution_id")).alias("latest_execution"))


def in_progress(metrics: DataFrame, phases_without_failed: Sequence[str] = ()) -> DataFrame:
    """(phase, status, value) -> phase and its gauge max(0, in progress - succeeded - failed).

    Phases in `phases_without_failed` don't subtract failures.
    """
    part = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("value"))), F.lit(0.0))
    sums = metrics.groupBy("phase").agg(part("IN_PROGRESS").alias("started"), part("SUCCEEDED").alias("succeeded"), part("FAILED").alias("failed"))
    less = F.when(F.col("phase").isin(*phases_without_failed), 0.0).otherwise(F.col("failed")) if phases_without_failed else F.col("failed")
    return sums.select("phase", F.greatest(F.lit(0.0), F.col("started") - F.col("succeeded") - less).alias("in_progress"))


def success_report(succeeded: DataFrame, failed: DataFrame, steps: DataFrame) -> DataFrame:
    """(county, succeeded), (county, failed), (county, step, n) -> one row for each county and named step.

    Missing counts are 0. What failures the steps don't explain is a step of its own, unknown, if above 0. The rate is
    a percentage, null without any execution.
    """
    known = steps.where("step <> 'unknown'").groupBy("county").agg(F.sum("n").alias("known"))
    base = succeeded.join(failed, "county", "full").join(known, "county", "full").fillna(0, ["succeeded", "failed", "known"])
    base = base.withColumn("success_rate", F.try_divide(100.0 * F.col("succeeded"), F.col("succeeded") + F.col("failed")))
    rest = base.where("failed > known").select("county", F.lit("unknown").alias("step"), (F.col("failed") - F.col("known")).alias("n"))
    every = steps.where("step <> 'unknown'").select("county", "step", "n").unionByName(rest)
    return base.drop("known").join(every, "county", "left")


def hashed_errors(errors: DataFrame) -> DataFrame:
    """(message, path, county, pos) -> one row for each SHA-256 of message#path#county with its count and first place."""
    h = F.sha2(F.concat_ws("#", F.coalesce("message", F.lit("Unknown error")), F.coalesce("path", F.lit("unknown")), "county"), 256)
    return errors.groupBy(h.alias("error_hash")).agg(F.count("*").alias("occurrences"), F.min_by("message", "pos").alias("message"), F.min("pos").alias("first_pos"))


def folder_flags(files: DataFrame, done: DataFrame, folder: str = "folder", name: str = "name", output: str = "output.zip", transformed: str = "transformed.zip") -> DataFrame:
    """(folder, n_files) of folders that have an output and no transformed file, and aren't in `done`."""
    out = files.groupBy(folder).agg(F.bool_or(F.col(name) == output).alias("has_output"), F.bool_or(F.col(name) == transformed).alias("has_transformed"), F.count("*").alias("n_files"))
    return out.where("has_output and not has_transformed").join(done.select(folder).distinct(), folder, "left_anti").select(folder, "n_files")


def failed_total(metrics: DataFrame, phases: Sequence[str]) -> DataFrame:
    """One row: the sum of failures over the named phases, 0 without any; and the sum of each."""
    part = lambda p: F.coalesce(F.sum(F.when((F.col("phase") == p) & (F.col("status") == "FAILED"), F.col("value"))), F.lit(0))
    sums = [part(p) for p in phases]
    total = sums[0]
    for s in sums[1:]:
        total = total + s
    return metrics.agg(total.alias("total_failed"), *[s.alias(p) for p, s in zip(phases, sums)])


def job_counters(rows: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """One row with the number of rows for which each named test holds, by one pass."""
    return rows.agg(*[F.count_if(test).alias(name) for name, test in counters.items()])


def unmatched_sources(comparisons: DataFrame, kinds: Sequence[str] = ("QUANTITY", "DATE", "ORGANIZATION", "LOCATION")) -> DataFrame:
    """(source): distinct trimmed sources of the unmatched entities of all kinds.

    comparisons has a column for each kind, a struct with unmatched_from_a: array<struct<source:string>>.
    """
    every = F.flatten(F.array(*[F.coalesce(F.col(f"{k}.unmatched_from_a.source"), F.array().cast("array<string>")) for k in kinds]))
    return comparisons.select(F.explode(F.transform(every, lambda s: F.trim(s))).alias("source")).where("source <> ''").distinct()


def queue_depths(queues: DataFrame, limit: str = "limit") -> DataFrame:
    """queues (visible, in_flight, delayed as texts or numbers, and a limit) with total and blocked; what doesn't parse is 0."""
    n = lambda c: F.coalesce(F.col(c).try_cast("long"), F.lit(0))
    total = n("visible") + n("in_flight") + n("delayed")
    return queues.withColumn("total", total).withColumn("blocked", F.coalesce(F.col("total") >= F.col(limit), F.lit(False)))


def queue_backlog(queues: DataFrame, prefix: str) -> DataFrame:
    """One row: messages, available and in flight, of all queues whose name begins with the prefix."""
    n = lambda c: F.coalesce(F.col(c).try_cast("long"), F.lit(0))
    return queues.where(F.startswith("name", F.lit(prefix))).agg(F.coalesce(F.sum(n("visible") + n("in_flight")), F.lit(0)).alias("backlog"))


def verdict_summary(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    """One row: total, PASS, REVIEW and other verdicts."""
    v = F.col(verdict)
    return rows.agg(F.count("*").alias("total"), F.count_if(v == "PASS").alias("passed"), F.count_if(v == "REVIEW").alias("review"), F.count_if(v.isNull() | ~v.isin("PASS", "REVIEW")).alias("other"))


def aligned(*lists: tuple[str, DataFrame], keys: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """Rows of several lists side by side: those of one key and ordinal are one row, missing ones null."""
    out = None
    for prefix, df in lists:
        one = df.select(*keys, ordinal, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in (*keys, ordinal)])
        out = one if out is None else out.join(one, [*keys, ordinal], "full")
    return out


def report_lines(report: DataFrame) -> DataFrame:
    """(line): one row of a success report as text, counties in order, steps by falling count, then by name."""
    steps = F.array_sort(F.collect_list(F.when(F.col("step").isNotNull(), F.struct((-F.col("n")).alias("less"), F.col("step").alias("step"), F.col("n").alias("n")))))
    out = report.groupBy("county", "succeeded", "failed", "success_rate").agg(F.array_join(F.transform(steps, lambda s: F.format_string("%s=%d", s["step"], s["n"])), ", ").alias("steps"))
    rate = F.when(F.col("success_rate").isNull(), "n/a").otherwise(F.format_string("%.1f%%", "success_rate"))
    return out.select("county", F.concat_ws(" | ", "county", F.concat(F.lit("ok "), F.col("succeeded").cast("string")), F.concat(F.lit("failed "), F.col("failed").cast("string")), rate, F.nullif("steps", F.lit(""))).alias("line"))
