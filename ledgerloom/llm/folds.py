"""Fold numbers of documents, and bounded samples of labelled texts for fitting on the driver."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cluster import cut

#: A text of more than this share of the bytes of a sample is skipped, so that one long text never crowds others out.
TEXT_SHARE = 64


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % n


def fitting(found: pd.DataFrame, most_bytes: int) -> pd.DataFrame:
    """The rows (rank, size, label) whose texts are taken, by ascending rank: each label has bytes in proportion to its
    rows, an eighth of an even share at least. A text that doesn't fit is skipped, not the ones after it; a label of
    long texts only is represented by its shortest one, if that fits into the label's bytes."""
    found = found.sort_values(["rank", "size"], kind="stable").reset_index(drop=True)
    if found.empty:
        return found
    share = found["label"].value_counts(normalize=True)
    share = share.clip(lower=1 / (8 * len(share)))
    left = (most_bytes * share / share.sum()).to_dict()
    taken, has = [], set()
    for k, (label, size) in enumerate(zip(found["label"], found["size"])):
        if size <= min(left[label], most_bytes // TEXT_SHARE):
            left[label] -= size
            has.add(label)
            taken.append(k)
    for label, rows in found[~found["label"].isin(has)].groupby("label"):
        if rows["size"].min() <= left[label]:
            taken.append(rows["size"].idxmin())
    return found.loc[sorted(taken)]


def sample(docs: DataFrame, rows: DataFrame, label: str, most: int, id_col: str = "doc_id", text: str = "text", most_bytes: int = 128 << 20, each: int = 100) -> pa.Table:
    """Texts and labels of about `most` labelled ids and `most_bytes` bytes of text: columns text, label.

    rows has id_col and label. The `most` ids of least hash take part, and besides them the `each` first ones of every
    label (`most` in all at most). Texts of more than a 64th of the bytes, and those that don't fit into their label's
    share any more, are skipped, but for the shortest text of a label that has no shorter ones. An id with several labels has the largest; of several texts with one id that of the
    least hash is taken. Ids without a label or text take no part. If labelled texts exist and none of them fits, that
    is an error, never an empty sample.
    """
    ids = rows.where(F.col(label).isNotNull()).groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.max(F.col(f"`{label}`")).alias("label")).withColumn("rank", F.xxhash64("__id"))
    first = ids.orderBy("rank", "__id").limit(most)
    of_each = ids.withColumn("part", F.pmod("rank", F.lit(64)))
    for keys in (("label", "part"), ("label",)):  # a label of most rows is cut down in parts first
        of_each = of_each.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "__id"))).where(F.col("turn") <= each)
    of_each = of_each.orderBy("turn", "rank", "__id").limit(most).drop("turn", "part")
    few = first.union(of_each).distinct()
    own = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null").join(F.broadcast(few), "__id")
    one = own.groupBy("__id", "label", "rank").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    one = cut(one.select("rank", "__id", F.octet_length("t.text").cast("long").alias("size"), "t.text", "label"))
    found = one.select("rank", "size", "label").toPandas()
    taken = fitting(found, most_bytes)
    if len(found) and taken.empty:
        raise ValueError(f"none of {len(found)} labelled texts fits into {most_bytes} bytes: raise most_bytes")
    if len(taken) < len(found):
        wanted = docs.sparkSession.createDataFrame(pd.DataFrame({"rank": taken["rank"].astype("int64")}), "rank long").distinct()
        one = one.join(F.broadcast(wanted), "rank")
    table = one.select("rank", "__id", "text", "label").toArrow()
    return table.sort_by([("rank", "ascending"), ("__id", "ascending")]).select(["text", "label"])
