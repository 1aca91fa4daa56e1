"""Hash-guarded upserts over tables without MERGE: a full outer join that writes a new version of the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """Natural key of a table, its hash column, and the derived foreign keys that also count as a change."""

    keys: tuple[str, ...] = ("source_system", "source_record_key")
    hash: str | None = "source_record_hash"
    derived: tuple[str, ...] = ()
    keep: tuple[str, ...] = field(default=("created_at",))


def changed(spec: TableSpec, columns: Sequence[str]) -> Column:
    """Whether a matched row is distinct in its hash or a derived key; rows without either always are."""
    tests = [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*([spec.hash] if spec.hash else []), *spec.derived) if c in columns]
    if not tests:
        return F.lit(True)
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def upsert(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """target after the upsert, with action: insert, update, unchanged (matched, nothing new) or untouched.

    The source must have one row for each key. Columns that the source lacks keep the target's values, as do the spec's
    `keep` columns and the keys. One shuffle of each side by the key.
    """
    t, s = target.alias("t"), source.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in spec.keys]
    in_t, in_s = F.col(f"t.{spec.keys[0]}").isNotNull(), F.col(f"s.{spec.keys[0]}").isNotNull()
    hit = changed(spec, source.columns)
    action = F.when(~in_t, "insert").when(~in_s, "untouched").when(hit, "update").otherwise("unchanged")
    cols = []
    for c in target.columns:
        if c in spec.keys:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c not in source.columns:
            cols.append(F.col(f"t.{c}").alias(c))
        elif c in spec.keep:
            cols.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            cols.append(F.when(in_s & (~in_t | hit), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return t.join(s, on, "full").select(*cols, action.alias("action"))


def counters(result: DataFrame) -> DataFrame:
    """attempted, changed and unchanged rows of an upsert."""
    return result.agg(
        F.count_if(F.col("action") != "untouched").alias("attempted"),
        F.count_if(F.col("action").isin("insert", "update")).alias("changed"),
        F.count_if(F.col("action") == "unchanged").alias("unchanged"),
    )


def load(spark: SparkSession, folder: str, version: int, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply source to version `version` of the table below folder and write the next one; never in place."""
    target = spark.read.parquet(f"{folder}/v{version}")
    upsert(target, source, spec).drop("action").write.parquet(f"{folder}/v{version + 1}")
    return spark.read.parquet(f"{folder}/v{version + 1}")


def decrement(state: DataFrame, amounts: DataFrame, key: str, count: str, amount: str) -> DataFrame:
    """state with counts less the amounts; a key whose count is too small keeps it. Adds success (null: not asked)."""
    out = state.join(amounts.select(key, F.col(amount).alias("__amount")), key, "left")
    enough = F.col(count) >= F.col("__amount")
    return out.withColumn("success", enough).withColumn(count, F.when(enough, F.col(count) - F.col("__amount")).otherwise(F.col(count))).drop("__amount")
