"""First, last, best and capped rows of a key. Every order must be total for a fixed result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def last_at_first_place(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The last row of each key, at the position of its first one; two aggregates, no window."""
    rest = [c for c in df.columns if c not in keys and c != position]
    out = df.groupBy(*keys).agg(F.min(position).alias(position), F.max_by(F.struct(*rest), position).alias("__row"))
    return out.select(*keys, position, *[F.col("__row")[c].alias(c) for c in rest])


def capped(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows of each key, with truncated: whether the key has more."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumn("__n", F.row_number().over(w.orderBy(*order))).withColumn("__all", F.count("*").over(w))
    return ranked.where(F.col("__n") <= n).withColumn("truncated", F.col("__all") > n).drop("__n", "__all")


def batches(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], size: int) -> DataFrame:
    """df with batch (from 0): rows of a key in groups of `size`, in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("batch", F.expr("0") + F.floor((F.row_number().over(w) - 1) / size).cast("long"))
