"""Session facts that the operators share: the shared folder, cut lineage, and sizes of work units."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a folder of our own where that is unset, which
    only a local master allows."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below this session's part of the shared folder, which is removed when the driver ends."""
    sc = spark.sparkContext
    if not getattr(sc, "_ledgerloom_folder", None):
        root = f"{shared_dir(spark).rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        store = path.getFileSystem(sc._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        sc._ledgerloom_folder = root
    return f"{sc._ledgerloom_folder}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads use the shared copy, and a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffles and checkpoints that nothing refers to any more; it goes by garbage
    collections of the driver, which iterations over small tables hardly cause."""
    spark.sparkContext._jvm.System.gc()


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, by one aggregate; sizes blocks and files in proportion to the input."""
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def parts(spark: SparkSession, total: int, unit: int) -> int:
    """How many units of about `unit` bytes hold `total` bytes."""
    return max(1, math.ceil(total / unit))


def attach(rows: DataFrame, labels: DataFrame, key: str, copies: str, hot: int = 10_000) -> DataFrame:
    """rows joined to labels, which has one row for each key and in `copies` how many of rows have it.

    Keys of more than 1 / hot of all rows, at most `hot` of them, are broadcast, so that no key's rows meet in one task;
    the others are shuffled. Both tables are read twice.
    """
    total = labels.agg(F.sum(copies)).first()[0] or 0
    often = F.col(copies) > total // hot
    few, rest = labels.where(often).drop(copies), labels.where(~often).drop(copies)
    return rows.join(F.broadcast(few), key).unionByName(rows.join(F.broadcast(few.select(key)), key, "left_anti").join(rest, key))


def celled(rows: DataFrame, key: str, row: str, size: int) -> DataFrame:
    """rows with a column cell: any two rows of one key share a cell of it, and no cell has much more than 2 * size rows.

    A key of up to `size` rows is one cell. A larger one is dealt into slots by a hash of column `row`, and each two of
    its slots are a cell.
    """
    slots = rows.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias("__slots")).where("__slots > 1")
    dealt = rows.join(slots, key, "left").withColumn("__slot", F.pmod(F.xxhash64(row), F.col("__slots")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("__slots") - 1), lambda j: j != F.col("__slot"))
    pairs = F.transform(others, lambda j: F.least(j, "__slot") * F.col("__slots") + F.greatest(j, "__slot"))
    cells = F.when(F.col("__slots").isNull(), F.array(F.lit(0))).otherwise(pairs)
    return dealt.withColumn("cell", F.explode(cells)).drop("__slots", "__slot")


#: Arrow batches of at most this many bytes for Python workers, where the session has Spark's own default of 64 MB: rows
#: here hold whole texts.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 4 << 20)


def carried(df: DataFrame) -> DataFrame:
    """df, once its session's Python workers have this package and take batches of moderate size."""
    spark = df.sparkSession
    ship(spark)
    key, default, ours = BATCH_BYTES
    if spark.conf.get(key).rstrip("b") == str(default):
        spark.conf.set(key, str(ours))
    return df


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns whose names (in any case) the operator is about to produce."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])
