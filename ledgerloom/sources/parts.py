"""Rolling JSONL parts of several datasets with receipts, and CSV that quotes only where needed."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parts(datasets: Mapping[str, DataFrame], folder: str, records: int = 50_000) -> DataFrame:
    """Each dataset as JSONL below folder/dataset=name, `records` rows at most in a file; returns the receipts.

    Null fields are left out of the JSON. Parts without rows have no receipt.
    """
    spark: SparkSession = next(iter(datasets.values())).sparkSession
    for name, df in datasets.items():
        df.write.mode("overwrite").option("maxRecordsPerFile", records).option("ignoreNullFields", "true").json(f"{folder}/dataset={name}")
    return receipts(spark, folder)


def receipts(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, file_name, records) of every part that has rows."""
    rows = spark.read.option("basePath", folder).text(f"{folder}/dataset=*")
    return rows.groupBy("dataset", F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("records"))


def split_write(rows: DataFrame, good: Column, folder: str, counters: Mapping[str, Column] | None = None, records: int = 50_000) -> dict:
    """Good rows and failures as JSONL, and a manifest of both, from one run over the rows; returns the manifest.

    Below folder, `dataset=profiles` and `dataset=failures` (rows whose test is false or null) hold parts of at most
    `records` rows, and manifest.json the numbers of both, what `counters` sum up over all rows, and the parts by name.
    The numbers are taken while the rows are written, never by a second scan. The manifest comes last: a folder without
    one is a run that failed.
    """
    spark = rows.sparkSession
    seen = Observation(f"split-{uuid.uuid4().hex}")
    ok = F.coalesce(good, F.lit(False))
    sums = {"profiles": F.count_if(ok), "failures": F.count_if(~ok), **{k: F.sum(v.cast("long")) for k, v in (counters or {}).items()}}
    marked = rows.observe(seen, *[v.alias(k) for k, v in sums.items()]).withColumn("dataset", F.when(ok, "profiles").otherwise("failures"))
    marked.write.mode("overwrite").partitionBy("dataset").option("maxRecordsPerFile", records).option("ignoreNullFields", "true").json(folder)
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    names = {}
    for dataset in ("profiles", "failures"):
        path = hadoop.Path(f"{folder}/dataset={dataset}")
        names[dataset] = sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []
    manifest = {"counts": {k: int(v or 0) for k, v in seen.get.items()}, "parts": names}
    out = store.create(hadoop.Path(f"{folder}/manifest.json"), True)
    out.write(bytearray(json.dumps(manifest, indent=1).encode()))
    out.close()
    return manifest


def write_csv(df: DataFrame, path: str) -> None:
    """Header, quotes doubled inside quotes, nulls as nothing, columns in their order."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")
