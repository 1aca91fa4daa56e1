"""State tables of workflow runs: eligibility, transitions, orphans and gauges of locks and queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sort_key

EVERYTHING = "__ALL__"


def eligibility(usage: Column, allowed: Sequence[str], on_demand: Column | None = None) -> Column:
    """struct(eligible, reason): on demand passes always, an empty list nothing, the sentinel everything."""
    listed = [a.strip().lower() for a in allowed if a.strip()]
    word = F.lower(F.trim(usage))
    reason = F.when(on_demand, "on-demand") if on_demand is not None else F.when(F.lit(False), "")
    if EVERYTHING.lower() in listed:
        reason = reason.otherwise("all")
    elif not listed:
        reason = reason.otherwise("no-allow-list")
    else:
        reason = reason.when(word.isNull() | (word == ""), "missing-usage").when(word.isin(*listed), "allowed").otherwise("not-allowed")
    return F.struct(reason.isin("on-demand", "all", "allowed").alias("eligible"), reason.alias("reason"))


def transition(df: DataFrame, status: str, to: str, only_from: str = "failed") -> DataFrame:
    """df with rows of status `only_from` moved to `to`; all others stay."""
    return df.withColumn(status, F.when(F.col(status) == only_from, to).otherwise(F.col(status)))


def orphans(executions: DataFrame, links: DataFrame, key: str = "execution_id", open_count: str = "open_error_count") -> DataFrame:
    """Executions that claim open errors but have no link left."""
    return executions.where(F.col(open_count) > 0).join(links, key, "left_anti")


def release_stale_locks(proxies: DataFrame, now: Column, after: str = "30 minutes") -> DataFrame:
    """Locks older than `after` are released."""
    stale = F.col("locked") & (F.col("locked_at") < now - F.expr(f"interval {after}"))
    return proxies.withColumn("locked", F.when(stale, False).otherwise(F.col("locked")))


def least_recently_used(proxies: DataFrame) -> DataFrame:
    """The unlocked proxy whose last use is longest ago; never used ones first, then by id."""
    return proxies.where(~F.col("locked")).orderBy(F.asc_nulls_first("last_used"), "proxy_id").limit(1)


def assessed(statuses: DataFrame, key: str = "execution_id") -> DataFrame:
    """(key, all_solved, any_unrecoverable) over statuses; a key of null statuses only counts as solved."""
    s = F.col("status")
    return statuses.groupBy(key).agg(F.coalesce(F.bool_and(s == "maybeSolved"), F.lit(True)).alias("all_solved"), F.coalesce(F.bool_or(s == "maybeUnrecoverable"), F.lit(False)).alias("any_unrecoverable"))


def layered(df: DataFrame, layers: Sequence[tuple[DataFrame, str | None, str]], key: str, into: str) -> DataFrame:
    """df with `into` from the first layer that has a value: (table, key column or None for a general one, value column).

    Layers are configuration, one row for each key at most.
    """
    found = []
    for i, (layer, on, value) in enumerate(layers):
        name = f"__layer{i}"
        if on is None:
            df = df.crossJoin(F.broadcast(layer.select(F.max(value).alias(name))))  # one row
        else:
            df = df.join(layer.select(F.col(on).alias(key), F.col(value).alias(name)), key, "left")
        found.append(F.col(name))
    return df.withColumn(into, F.coalesce(*found)).drop(*[f"__layer{i}" for i in range(len(layers))])


def delete_execution(links: DataFrame, execution_id: str) -> tuple[DataFrame, DataFrame]:
    """(links that stay, hashes of the execution that no other one has) after an execution and its links are deleted."""
    own = links.where(F.col("execution_id") == execution_id).select("error_hash").distinct()
    stay = links.where(~F.col("execution_id").eqNullSafe(F.lit(execution_id)))
    return stay, own.join(stay.select("error_hash").distinct(), "error_hash", "left_anti")


def migrated(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """df with one value of a key column replaced, and changed; a second run changes nothing."""
    hit = F.coalesce(F.col(column) == old, F.lit(False))
    return df.withColumn("changed", hit).withColumn(column, F.when(hit, new).otherwise(F.col(column)))


def sort_keys(df: DataFrame, count: str, status: str, kind: str) -> DataFrame:
    """df with the keys that its counts derive: by count, by status and count, by kind and count."""
    padded = sort_key(F.col(count))
    return df.withColumn("count_key", padded).withColumn("status_key", F.concat_ws("#", F.upper(status), padded)).withColumn("kind_key", F.concat_ws("#", F.coalesce(kind, F.lit("unknown")), padded))


def unrecoverable(executions: DataFrame, links: DataFrame, records: DataFrame, execution_id: str | None = None, code: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(executions, links, records) with status maybeUnrecoverable where one execution, or one code, is given up.

    Of an execution: itself, its own links, and the records of its codes; links that other executions have to these codes
    stay. Of a code: its links, the executions that have one, and its record. Without any link nothing changes.
    """
    if (execution_id is None) == (code is None):
        raise ValueError("name an execution or a code")
    hit = F.col("execution_id") == execution_id if code is None else F.col("error_code") == code
    own = links.where(hit)

    def marked(df: DataFrame, key: str) -> DataFrame:
        found = own.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__own", F.lit(True))
        return df.join(found, key, "left").withColumn("status", F.when(F.col("__own"), "maybeUnrecoverable").otherwise(F.col("status"))).select(*df.columns)

    return marked(executions, "execution_id"), links.withColumn("status", F.when(hit, "maybeUnrecoverable").otherwise(F.col("status"))), marked(records, "error_code")


def remaining(df: DataFrame, count: str) -> DataFrame:
    """(kept rows with a fresh sort key) after a decrement: rows whose count has come to zero are gone."""
    return df.where(F.col(count) > 0).withColumn("sort_key", sort_key(F.col(count)))


def extremes(executions: DataFrame, count: str = "open_error_count", kind: str | None = None, status: str = "FAILED", least: bool = False) -> DataFrame:
    """The one execution of a status (and of types that begin with `kind`) with the most, or least, errors.

    It is the last, or first, in the order of count and id as texts: of equal counts the greatest id has the most, the
    least id the least. Rows without a count or an id take no part.
    """
    rows = executions.where((F.col("status") == status) & F.col(count).isNotNull() & F.col("execution_id").isNotNull())
    if kind is not None:
        rows = rows.where(F.startswith("error_type", F.lit(kind)))
    order = [F.col(count), F.col("execution_id").cast("string")]
    return rows.orderBy(*[o.asc() if least else o.desc() for o in order]).limit(1)


def verified(rows: DataFrame, bad: Column) -> DataFrame:
    """One row: how many rows still fail the test after a job, and whether none does."""
    return rows.agg(F.count_if(bad).alias("left_over")).withColumn("clean", F.col("left_over") == 0)
