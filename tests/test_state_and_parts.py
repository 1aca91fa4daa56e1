"""State rules, part files, permit texts and polygons."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerloom.functions import geo, permits
from ledgerloom.operators import state
from ledgerloom.sources import parts


def test_eligibility(spark):
    df = spark.createDataFrame([(" Residential", False), ("farm", False), (None, False), (None, True)], "u string, d boolean")
    got = [tuple(r[0]) for r in df.select(state.eligibility(F.col("u"), ["residential"], F.col("d"))).collect()]
    assert got == [(True, "allowed"), (False, "not-allowed"), (False, "missing-usage"), (True, "on-demand")]
    assert df.select(state.eligibility(F.col("u"), ["__ALL__"])).first()[0].eligible and not df.select(state.eligibility(F.col("u"), [])).first()[0].eligible


def test_locks_and_orphans(spark):
    now = dt.datetime(2024, 1, 1, 12)
    p = spark.createDataFrame([(1, True, now - dt.timedelta(hours=1), None), (2, True, now, None), (3, False, None, now)], "proxy_id int, locked boolean, locked_at timestamp, last_used timestamp")
    free = state.release_stale_locks(p, F.lit(now))
    assert {r.proxy_id: r.locked for r in free.collect()} == {1: False, 2: True, 3: False} and state.least_recently_used(free).first().proxy_id == 1
    e = spark.createDataFrame([("a", 1), ("b", 0), ("c", 2)], "execution_id string, open_error_count int")
    assert [r.execution_id for r in state.orphans(e, spark.createDataFrame([("c",)], "execution_id string")).collect()] == ["a"]
    t = state.transition(spark.createDataFrame([("failed",), ("maybeSolved",)], "status string"), "status", "maybeUnrecoverable")
    assert sorted(r[0] for r in t.collect()) == ["maybeSolved", "maybeUnrecoverable"]
    a = state.assessed(spark.createDataFrame([("x", "maybeSolved"), ("x", "maybeUnrecoverable"), ("y", None)], "execution_id string, status string"))
    assert {tuple(r) for r in a.collect()} == {("x", False, True), ("y", True, False)}


def test_layers(spark):
    df = spark.createDataFrame([("lee",), ("lake",)], "county string")
    own = spark.createDataFrame([("lee", "1")], "c string, v string")
    general = spark.createDataFrame([("9",)], "v string")
    assert {tuple(r) for r in state.layered(df, [(own, "c", "v"), (general, None, "v")], "county", "setting").collect()} == {("lee", "1"), ("lake", "9")}


def test_parts_and_receipts(spark, tmp_path):
    got = parts.write_parts({"company": spark.range(5).coalesce(1), "address": spark.createDataFrame([(1, None)], "a int, b string").coalesce(1), "none": spark.range(0)}, str(tmp_path), 2)
    counts = sorted((r.dataset, r.records) for r in got.collect())
    assert counts == [("address", 1), ("company", 1), ("company", 2), ("company", 2)]
    assert json.loads(next((tmp_path / "dataset=address").glob("*.json")).read_text()) == {"a": 1}
    parts.write_csv(spark.createDataFrame([('q "x", y', None)], "b string, a string").coalesce(1), str(tmp_path / "csv"))
    assert next((tmp_path / "csv").glob("*.csv")).read_text() == 'b,a\n"q ""x"", y",\n'


def test_permit_text_without_rows(spark):
    df = spark.createDataFrame([(None,), ("",), ("nothing here",)], "c string")
    c = F.col("c")
    out = df.select(permits.status(c).alias("s"), F.coalesce(F.size(permits.fees(c)), F.lit(0)).alias("f"), F.coalesce(F.size(permits.inspections(c)), F.lit(0)).alias("i"), permits.licence(c).alias("l"), permits.split_address(c)["address"].alias("a")).collect()
    assert [(r.s, max(r.f, 0), max(r.i, 0), r.l, r.a) for r in out] == [(None, 0, 0, None, None), (None, 0, 0, None, None), ("nothing here", 0, 0, None, None)]
    assert df.limit(1).select(permits.numbered(F.lit("1) Ann Lee 2) Bo, Inc"))).first()[0] == ["Ann Lee", "Bo, Inc"]
    assert tuple(df.limit(1).select(permits.banner(F.lit("Showing 1-10 of 1,234"))).first()[0]) == (1, 10, 1234)
    long = spark.createDataFrame([("Issued  Create a New Collection x",), ("y" * 300,)], "c string").select(permits.status(F.col("c"))).collect()
    assert [r[0] for r in long] == ["Issued", "y" * 256]


def test_polygons(spark):
    shapes = ["[[1,2],[3,4],[5,6]]", '{"type":"Polygon","coordinates":[[[1,2],[3,4]]]}', "[[[[1,2],[3,4],[5,6]]],[[[7,8],[9,10],[11,12]]]]", "x", None, "[1]"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in shapes], "c string").select(F.transform(geo.polygons(F.col("c")), geo.exterior)).collect()]
    assert got[0] == [[(2.0, 1.0), (4.0, 3.0), (6.0, 5.0)]] and got[1] == [None] and len(got[2]) == 2 and got[3:] == [None] * 3
