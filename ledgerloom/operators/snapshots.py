"""Several tables as one: versions in a log, loads that publish all their tables together or leave no trace.

Below a folder, `data/<load>/<table>` holds Parquet files that never change, and `log/<number>.json` names the files of
every table at one version. A load stages its tables one after the other, so that later ones can refer to earlier ones,
and publishes them by one rename that fails if another load was faster. Readers take the last log entry: they see all of
a load or nothing of it, and a version that they have begun to read stays. On object stores without an atomic rename the
folder must lie on a file system that has one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import REFERENCES
from .upsert import TableSpec, upsert

ROWS = "id string, source_record_key string, source_record_hash string, refs map<string,string>, ids array<struct<name:string,id:string>>, values map<string,string>"
KINDS = list(REFERENCES.values())
SPEC = TableSpec(keys=("source_record_key",), derived=("ids",), keep=("id",))


class Conflict(RuntimeError):
    """Another load published its version first; nothing of this one is left."""


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark._jvm
        self.store = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def versions(self) -> list[int]:
        """Published versions, ascending."""
        log = self._path("log")
        names = [s.getPath().getName() for s in self.store.listStatus(log)] if self.store.exists(log) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def tables(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """(version, path of each table) of one version, the last one by default; version 0 has none."""
        known = self.versions()
        version = (known[-1] if known else 0) if version is None else version
        if not version:
            return 0, {}
        return version, json.loads(self.spark.read.text(f"{self.folder}/log/{version:020d}.json", wholetext=True).first()[0])

    def table(self, name: str, version: int | None = None, schema: str = ROWS) -> DataFrame:
        """A table as of a version; empty where it has no rows yet."""
        path = self.tables(version)[1].get(name)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{path}") if path else self.spark.createDataFrame([], schema).limit(0)  # known to be empty by plan: no join

    def _keys(self, name: str, staged: Mapping[str, DataFrame], keyed: DataFrame, paths: Mapping[str, str]) -> DataFrame:
        """(source_record_key, id, is_new) of a table as this load leaves it; where it isn't staged yet, a key may come twice."""
        if name in staged:
            return staged[name].select("source_record_key", "id", F.lit(False).alias("is_new"))
        new = keyed.where(F.col("table_name") == name).select("source_record_key", "id", F.lit(True).alias("is_new"))
        if name not in paths:
            return new
        return new.union(self.spark.read.schema(ROWS).parquet(f"{self.folder}/{paths[name]}").select("source_record_key", "id", F.lit(False)))

    def _publish(self, version: int, tables: Mapping[str, str]) -> None:
        """Version `version` by one rename; Conflict if it is there already."""
        draft = self._path(f"log/draft-{uuid.uuid4().hex}")
        out = self.store.create(draft)
        out.write(bytearray(json.dumps(tables).encode()))
        out.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self.store.makeQualified(draft), self.store.makeQualified(self._path(f"log/{version:020d}.json")), never_over)
        except Exception as e:
            self.store.delete(draft, False)
            if version in self.versions():
                raise Conflict(f"version {version} is another load's") from e
            raise

    def load(self, rows: DataFrame, order: Sequence[str], link: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None, missing: str = "omit") -> DataFrame:
        """Upsert prepared rows (table_name, source_record_key, source_record_hash, refs, values) of all tables as the next
        version; one row for each table with attempted, changed, unchanged, total and version.

        Tables are staged in `order`; a row's references are looked up in the tables as they will be, whichever of them
        this load brings. One without a parent is left out (missing="omit", a later load heals it, which counts as a
        change) or fails the load ("throw"). `link` may then replace staged tables by others made of all of them, in the
        same columns. Rows of a table that isn't in `order` fail the load, as does whatever else fails; then no version is
        published and staged files are deleted. Rows must have one row for each table and key; ids are hashes of these.
        """
        base, paths = self.tables()
        name = f"data/{uuid.uuid4().hex}"
        staged: dict[str, DataFrame] = {}
        try:
            kinds = _kinds(rows, order, missing)
            keyed = rows.withColumn("id", F.substring(F.sha2(F.concat_ws("\n", "table_name", "source_record_key"), 256), 1, 24))
            counts = []
            for t in order:
                own = _resolved(keyed.where(F.col("table_name") == t), {i: self._keys(KINDS[i][1], staged, keyed, paths) for i in kinds[t]}, missing)
                done = upsert(self.table(t, base), own, SPEC)
                done.write.parquet(f"{self.folder}/{name}/{t}")
                staged[t] = self.spark.read.parquet(f"{self.folder}/{name}/{t}")
                counts.append(staged[t].agg(F.lit(t).alias("table_name"), F.count_if(F.col("action") != "untouched").alias("attempted"), F.count_if(F.col("action").isin("insert", "update")).alias("changed"), F.count_if(F.col("action") == "unchanged").alias("unchanged"), F.count("*").alias("total")))
            new = {**paths, **{t: f"{name}/{t}" for t in order}}
            for t, linked in (link({t: df.drop("action") for t, df in staged.items()}) if link else {}).items():
                linked.select(*[c.split(" ")[0] for c in ROWS.split(", ")]).write.parquet(f"{self.folder}/{name}/{t}-linked")
                new[t] = f"{name}/{t}-linked"
            self._publish(base + 1, new)
        except BaseException:
            self.store.delete(self._path(name), True)
            raise
        out = counts[0]
        for c in counts[1:]:
            out = out.union(c)
        return out.withColumn("version", F.lit(base + 1))

    def vacuum(self, keep: int = 2, older_than_s: int = 86_400) -> int:
        """Delete what neither one of the last `keep` versions nor a load of the last `older_than_s` seconds can need:
        the rest of loads whose driver died, and old versions. Returns how many loads were deleted."""
        known = self.versions()
        needed = {p.split("/")[1] for v in known[-keep:] for p in self.tables(v)[1].values()}
        now = self.jvm.java.lang.System.currentTimeMillis()
        data = self._path("data")
        gone = [s.getPath() for s in (self.store.listStatus(data) if self.store.exists(data) else []) if s.getPath().getName() not in needed and s.getModificationTime() <= now - 1000 * older_than_s]
        for path in gone:
            self.store.delete(path, True)
        for v in known[:-keep]:
            if not needed.issuperset(p.split("/")[1] for p in self.tables(v)[1].values()):
                self.store.delete(self._path(f"log/{v:020d}.json"), False)
        return len(gone)


def _kinds(rows: DataFrame, order: Sequence[str], missing: str) -> dict[str, list[int]]:
    """Places in KINDS of the references that rows of each table have, ascending, by one pass; ValueError for rows that no
    load can take. The driver gets a row for each table and kind, and a few of other tables."""
    places = F.create_map(*[F.lit(x) for i, (column, _, _) in enumerate(KINDS) for x in (column, i)])
    odd = ~F.col("table_name").isin(*order) | F.col("table_name").isNull()
    seen = rows.select("table_name", odd.alias("odd"), F.explode_outer(F.map_keys("refs")).alias("column"))
    kind = F.when(~F.col("odd") & F.col("column").isNotNull(), F.coalesce(F.try_element_at(places, F.col("column")), F.lit(-1)))
    found = seen.select("odd", "table_name", kind.alias("kind")).distinct().orderBy(F.desc("odd")).limit(5 + (len(KINDS) + 2) * len(order)).collect()
    others = [r["table_name"] for r in found if r["odd"]][:5]
    if others:
        raise ValueError(f"rows of tables that have no place in the order: {others}")
    unknown = sorted({r["table_name"] for r in found if r["kind"] == -1})
    if missing == "throw" and unknown:
        raise ValueError(f"no parent for references of unknown kinds in {unknown}")
    return {t: sorted(r["kind"] for r in found if r["table_name"] == t and r["kind"] not in (None, -1)) for t in order}


def _resolved(rows: DataFrame, parents: Mapping[int, DataFrame], missing: str) -> DataFrame:
    """Rows of one table with ids: (id column, id) of each reference whose parent is known, sorted by name; one join for
    all kinds. parents has the keys of the table of each kind (by its place in KINDS) that the rows refer by."""
    none = F.array().cast("array<struct<name:string,id:string>>")
    ids = none
    if parents:
        places = F.create_map(*[F.lit(x) for i in parents for x in (KINDS[i][0], i)])
        known = None
        for i, keys in parents.items():
            one = keys.select(F.lit(i).alias("__of"), F.col("source_record_key").alias("__parent"), "id", "is_new")
            known = one if known is None else known.union(one)
        known = known.groupBy("__of", "__parent").agg(F.min_by("id", "is_new").alias("__id"))
        asked = rows.select("source_record_key", F.explode("refs").alias("__column", "__parent")).select("source_record_key", F.try_element_at(places, F.col("__column")).alias("__of"), "__parent").where("__of is not null")
        found = asked.join(known, ["__of", "__parent"], "left" if missing == "throw" else "inner")
        if missing == "throw":  # in the column that every kind looks at
            columns = F.array(*[F.lit(column) for column, _, _ in KINDS])
            found = found.withColumn("__of", F.when(F.col("__id").isNull(), F.raise_error(F.concat_ws("", F.lit("no parent for "), columns[F.col("__of")], F.lit(": "), "__parent")).cast("int")).otherwise(F.col("__of")))
        # dealt by the key on which the rows and their target are joined, too
        one = found.select("source_record_key", "__of", "__id").repartition("source_record_key").groupBy("source_record_key").agg(*[F.max(F.when(F.col("__of") == i, F.col("__id"))).alias(f"__{i}") for i in parents])
        rows = rows.join(one, "source_record_key", "left")
        ids = F.concat(*[F.when(F.col(f"__{i}").isNotNull(), F.array(F.struct(F.lit(KINDS[i][2]).alias("name"), F.col(f"__{i}").alias("id")))).otherwise(none) for i in sorted(parents, key=lambda i: KINDS[i][2])])
    return rows.withColumn("ids", ids).select(*[c.split(" ")[0] for c in ROWS.split(", ")])
