"""Session defaults, and shipping of this package to Python workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; conf adds to or replaces the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | conf).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the session's Python workers this package, once, wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="ledgerloom-")) / "ledgerloom_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(path.relative_to(root.parent)))
    sc.addPyFile(str(target))
    sc._ledgerloom_shipped = True


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir, removed when the driver ends; where that is unset, in a folder of our own,
    which only a local master allows."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return path
