"""Loads of several tables: all or nothing, order of references, conflicts, a load that dies between two tables."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.snapshots import ROWS, Conflict, Snapshots

ORDER = ["properties", "property_improvements"]
SCHEMA = "table_name string, source_record_key string, source_record_hash string, refs map<string,string>, values map<string,string>"


def rows(spark, *items):
    return spark.createDataFrame([(t, k, h, {"property_source_record_key": p} if p else {}, {"v": h}) for t, k, h, p in items], SCHEMA)


def state(store, version=None):
    return {(t, r.source_record_key, r.source_record_hash, tuple(i.name for i in r.ids)) for t in ORDER for r in store.table(t, version).collect()}


def test_load_heal_and_read_old_versions(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}")
    assert store.versions() == [] and store.tables() == (0, {}) and store.table("properties").count() == 0
    # the child comes before its parent: left out, healed by the second load
    store.load(rows(spark, ("property_improvements", "i1", "a", "p1"), ("property_improvements", "i2", "a", None)), ORDER)
    one = {("property_improvements", "i1", "a", ()), ("property_improvements", "i2", "a", ())}
    assert state(store) == one
    got = {r.table_name: tuple(r)[1:5] for r in store.load(rows(spark, ("properties", "p1", "x", None), ("property_improvements", "i1", "a", "p1"), ("property_improvements", "i2", "a", None)), ORDER).collect()}
    assert got == {"properties": (1, 1, 0, 1), "property_improvements": (2, 1, 1, 2)}
    assert state(store) == {("properties", "p1", "x", ()), ("property_improvements", "i1", "a", ("property_id",)), ("property_improvements", "i2", "a", ())}
    assert state(store, 1) == one and store.versions() == [1, 2]
    store.load(rows(spark), ORDER)
    assert len(state(store)) == 3 and store.versions() == [1, 2, 3]
    parent, child = store.table("properties").first(), store.table("property_improvements").where("source_record_key = 'i1'").first()
    assert child.ids[0].id == parent.id


def test_failed_loads_leave_no_trace(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}")
    store.load(rows(spark, ("properties", "p1", "x", None)), ORDER)
    before = state(store)

    def left():
        return sorted(os.listdir(tmp_path / "data")), store.versions(), [n for n in os.listdir(tmp_path / "log") if n.startswith("draft")]

    was = left()
    bad = rows(spark, ("properties", "p2", "y", None), ("property_improvements", "i1", "a", "p9"))
    with pytest.raises(Exception, match="no parent"):
        store.load(bad, ORDER, missing="throw")
    with pytest.raises(ValueError):
        store.load(rows(spark, ("odd", "p2", "y", None)), ORDER)

    def link(tables):
        raise KeyError("link")

    with pytest.raises(KeyError):  # both tables are staged by now
        store.load(bad, ORDER, link)
    assert left() == was and state(store) == before


def test_the_slower_of_two_loads_conflicts(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}")
    store.load(rows(spark, ("properties", "p1", "x", None)), ORDER)

    def link(tables):  # another load publishes in the middle of this one
        Snapshots(spark, f"file://{tmp_path}").load(rows(spark, ("properties", "p2", "fast", None)), ORDER)
        return {}

    with pytest.raises(Conflict):
        store.load(rows(spark, ("properties", "p2", "slow", None)), ORDER, link)
    assert {r[1:3] for r in state(store)} == {("p1", "x"), ("p2", "fast")} and store.versions() == [1, 2]


def test_linked_tables_are_published_with_the_others(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}")

    def link(tables):
        only = tables["properties"].agg(F.min("id").alias("pid"))
        return {"property_improvements": tables["property_improvements"].crossJoin(F.broadcast(only)).withColumn("ids", F.array(F.struct(F.lit("property_id").alias("name"), F.col("pid").alias("id"))))}

    store.load(rows(spark, ("properties", "p1", "x", None), ("property_improvements", "i1", "a", None)), ORDER, link)
    assert ("property_improvements", "i1", "a", ("property_id",)) in state(store) and store.table("property_improvements").schema.simpleString() == spark.createDataFrame([], ROWS).schema.simpleString()


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from ledgerloom.operators import snapshots
from ledgerloom.session import build_session
from tests.test_snapshots import ORDER, rows
spark = build_session("killed", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
store = snapshots.Snapshots(spark, "file://" + {folder!r})
own, real = [0], snapshots.upsert
def upsert(*a):
    own[0] += 1
    if own[0] == 2:
        os._exit(9)  # the first table is staged, the second isn't
    return real(*a)
snapshots.upsert = upsert
store.load(rows(spark, ("properties", "p2", "y", None), ("property_improvements", "i1", "a", "p2")), ORDER)
"""


def test_a_load_killed_between_two_tables(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}")
    store.load(rows(spark, ("properties", "p1", "x", None)), ORDER)
    before = state(store)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = subprocess.run([sys.executable, "-c", KILLED.format(root=root, folder=str(tmp_path))], capture_output=True, timeout=300).returncode
    assert code == 9 and len(os.listdir(tmp_path / "data")) == 2
    assert state(store) == before and store.versions() == [1]
    assert store.vacuum(older_than_s=3600) == 0 and store.vacuum(older_than_s=0) == 1
    store.load(rows(spark, ("properties", "p2", "y", None)), ORDER)
    assert {r[1] for r in state(store)} == {"p1", "p2"} and store.versions() == [1, 2]
