"""Joins, upserts, sources, graph and streams."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, dedupe, joins, ranges, upsert
from ledgerloom.sources import archives, fixed_width
from ledgerloom.streaming import event_state


def test_upsert_twice_changes_nothing(spark):
    spec = upsert.TableSpec(derived=("fk",))
    t = spark.createDataFrame([("s", "1", "h1", 1, "old"), ("s", "2", "h2", 2, "old")], "source_system string, source_record_key string, source_record_hash string, fk int, created_at string")
    s = spark.createDataFrame([("s", "1", "h1", None, "new"), ("s", "3", "h3", 3, "new")], t.schema)
    out = upsert.upsert(t, s, spec)
    assert {r.source_record_key: (r.action, r.fk, r.created_at) for r in out.collect()} == {"1": ("update", None, "old"), "2": ("untouched", 2, "old"), "3": ("insert", 3, "new")}
    again = upsert.counters(upsert.upsert(out.drop("action"), s, spec)).first()
    assert tuple(again) == (2, 0, 2)


def test_resolve_keys(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, k string")
    parent = spark.createDataFrame([("a", 10)], "pk string, pid int")
    assert {r.id: r.pid2 for r in joins.resolve_keys(child, parent, [("k", "pk")], "pid", "pid2").collect()} == {1: 10, 2: None, 3: None}
    with pytest.raises(Exception, match="no parent"):
        joins.resolve_keys(child, parent, [("k", "pk")], "pid", "pid2", missing="throw").collect()


def test_any_key_join_has_no_nested_loop(spark):
    a = spark.createDataFrame([(1, "x", "p"), (2, "y", "q")], "id int, k1 string, k2 string")
    b = spark.createDataFrame([(7, "y", "p"), (8, "z", "q")], "rid int, r1 string, r2 string")
    out = joins.any_key_join(a, b, [(F.col("k1"), F.col("r1")), (F.col("k2"), F.col("r2"))], ["id"], [F.col("rid")])
    assert {r.id: (r.rid, r.key_no) for r in out.collect()} == {1: (7, 2), 2: (7, 1)}
    assert "NestedLoop" not in out._jdf.queryExecution().toString()


def test_references_alternates_and_join_updates(spark):
    child = spark.createDataFrame([("c1", "p1", None, None), ("c2", None, "k9", None), ("c3", "nope", "k9", 7)], "id string, property_source_record_key string, company_source_record_key string, property_id int")
    parents = {"properties": spark.createDataFrame([("p1", 10)], "source_record_key string, property_id int"), "companies": spark.createDataFrame([("k9", 90)], "source_record_key string, company_id int")}
    out = joins.resolve_references(child, parents)
    assert {r.id: (r.property_id, r.company_id) for r in out.collect()} == {"c1": (10, None), "c2": (None, 90), "c3": (None, 90)}
    with pytest.raises(Exception, match="no parent"):
        joins.resolve_references(child, parents, "throw").collect()
    reg = spark.createDataFrame([("s", "a", "D1", 1), ("s", "b", "D2", 3), ("s", "c", "D2", 2)], "source_system string, source_record_key string, document_number string, rid int")
    docs = spark.createDataFrame([(1, "a", "s", "D2"), (2, None, "s", "D2"), (3, "zz", "s", "D1"), (4, None, "t", "D1")], "n int, key string, source_system string, doc string")
    got = joins.resolve_or_alternate(docs, reg, ("key", "source_record_key"), [("source_system", "source_system"), ("doc", "document_number")], "rid", "rid")
    assert {r.n: r.rid for r in got.collect()} == {1: 1, 2: 2, 3: None, 4: None}
    target = spark.createDataFrame([(1, "A1", None, None), (2, None, "22", 5), (3, "A1", "22", 1), (4, None, None, None)], "n int, k1 string, k2 string, property_id int").withColumn("method", F.lit("high").cast("string"))
    source = spark.createDataFrame([("A1", 1), ("22", 5)], "key string, property_id int")
    out = joins.join_update(target, source, [F.col("k1"), F.col("k2")], F.col("key"), ["property_id"], {"method": "high"})
    assert {r.n: (r.property_id, r.matched, r.changed) for r in out.collect()} == {1: (1, True, True), 2: (5, True, False), 3: (1, True, False), 4: (None, False, False)}


def test_address_candidates(spark):
    rows = spark.createDataFrame([(1, "Fort Myers", "FL", "33901-1"), (2, "Naples", "fl", "34102"), (3, None, "FL", None)], "id int, city string, state string, zip string")
    assert [r.id for r in joins.address_candidates(rows, "FL", "myers", "33901-9999").collect()] == [1]
    assert [r.id for r in joins.address_candidates(rows, "fl", most=2, order=["id"]).collect()] == [1, 2]


def test_dedupe(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("v", 2, "b"), ("u", 3, "c")], "url string, pos int, x string")
    assert {(r.url, r.pos, r.x) for r in dedupe.last_at_first_place(df, ["url"], "pos").collect()} == {("u", 1, "c"), ("v", 2, "b")}
    assert {(r.url, r.truncated) for r in dedupe.capped(df, ["url"], ["pos"], 1).collect()} == {("u", True), ("v", False)}


def test_ranges_of_nothing(spark):
    assert ranges.split_until(spark.createDataFrame([], "d date"), "d", 5).count() == 0


def test_report_residual(spark):
    ok = spark.createDataFrame([("a", 3)], "county string, succeeded long")
    bad = spark.createDataFrame([("a", 2), ("b", 1)], "county string, failed long")
    steps = spark.createDataFrame([("a", "load", 2), ("b", "unknown", 1)], "county string, step string, n long")
    got = {(r.county, r.step, r.n, r.success_rate) for r in aggregates.success_report(ok, bad, steps).collect()}
    assert got == {("a", "load", 2, 60.0), ("b", "unknown", 1, 0.0)}


def test_registry_file_in_a_zip(spark, tmp_path):
    line = "P1".ljust(12) + "ACME".ljust(192) + "A" + "X".ljust(15) + "1 North Street".ljust(42) + "".ljust(42) + "Estero".ljust(28) + "FL" + "33901".ljust(10) + "US"
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("a.txt", line + "\r\n" + "\n" + "".ljust(20) + "\n")
        z.writestr("b.txt", "x" * 30 + "\n")
        z.writestr("data/2.json", "{}")
        z.writestr("data/1.json", "[1]")
    lines = fixed_width.read_lines(spark, str(tmp_path / "r.zip"))
    assert sorted((r.source_file_name, r.line_no) for r in lines.collect() if r.source_file_name.endswith("txt")) == [("a.txt", 1), ("a.txt", 3), ("b.txt", 1)]
    assert [tuple(r)[1:] for r in archives.zip_json(spark, str(tmp_path / "r.zip")).orderBy("ordinal").collect()] == [("data/1.json", 1, "[1]"), ("data/2.json", 2, "{}")]
    (tmp_path / "plain.zip.txt").write_text("one\n\ntwo\r\nthree")
    plain = fixed_width.read_lines(spark, str(tmp_path / "plain.zip.txt"))
    assert sorted((r.line_no, r.value) for r in plain.collect()) == [(1, "one"), (3, "two"), (4, "three")]
    e = fixed_width.parse_lines(lines.where("source_file_name = 'a.txt'"))
    r = {x.valid: x for x in e.collect()}
    assert r[True].principal_address.normalized == "1 N ST ESTERO FL 33901 US" and r[True].status == "ACTIVE" and r[True].officers == []
    assert r[False].document_number is None


def test_manifest_and_csv(spark, tmp_path):
    (tmp_path / "c1.jsonl").write_text('{"a": 1}\n{broken\n')
    (tmp_path / "m.json").write_text(json.dumps({"chunks": [str(tmp_path / "c1.jsonl")]}))
    got = archives.jsonl_of_manifests(spark, str(tmp_path / "m.json"), "a int").collect()
    assert sorted((r.a is None, r.corrupt is None, r.valid) for r in got) == [(False, True, True), (True, False, False)]
    (tmp_path / "top.json").write_text(json.dumps({"summary": str(tmp_path / "m.json")}))
    assert archives.jsonl_of_manifests(spark, str(tmp_path / "top.json"), "a int, b int", required=("b",)).where("valid").count() == 0
    (tmp_path / "catalog.json").write_text(json.dumps({"rows": [{"key": "a", "url": "u", "n": 1}, {"key": "", "url": "u"}, 5, {"url": "x"}]}))
    assert [r.asDict() for r in archives.catalog_rows(spark, str(tmp_path / "catalog.json")).collect()] == [{"key": "a", "n": "1", "url": "u"}]
    rows = spark.range(1, 8).withColumnRenamed("id", "n")
    batch, state = archives.seed_rows(rows, "n", 3, 3)
    assert [r.n for r in batch.collect()] == [3, 4, 5] and tuple(state.first()) == (3, 6, False)
    assert tuple(archives.seed_rows(rows, "n", 6, 3)[1].first()) == (2, 8, True)
    (tmp_path / "x.csv").write_text('a,b\n 1 ,"q ""x""\nline"\n\n')
    assert [tuple(r) for r in archives.csv_rows(spark, str(tmp_path / "x.csv")).collect()] == [("1", 'q "x"\nline')]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, "00001", "a", 1), (1, "00002", "b", 2), (2, "00001", "c", 3), (1, "00001", "d", 4)]
    schema = "execution_id int, code string, details string, pos int"
    for i in range(2):
        spark.createDataFrame(rows[2 * i : 2 * i + 2], schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    files = event_state.read_events(spark, str(tmp_path / "in" / "*"), schema)
    buckets = event_state.Buckets(str(tmp_path / "state"), upsert.TableSpec(("execution_id", "code"), None), 4)
    totals = event_state.error_totals(files)
    q = totals.writeStream.outputMode("update").foreachBatch(buckets.apply).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in totals.schema.fields)
    got = {(r.execution_id, r.code): (r.occurrences, r.details, r.first_pos) for r in buckets.table(spark, kinds).collect()}
    assert got == {(1, "00001"): (2, "d", 1), (1, "00002"): (1, "b", 2), (2, "00001"): (1, "c", 3)}
    buckets.apply(spark.createDataFrame([(1, "00001", 5, "e", 1)], kinds), 7)
    buckets.apply(spark.createDataFrame([(1, "00001", 6, "f", 1)], kinds), 7)  # delivered again
    after = {(r.execution_id, r.code): r.occurrences for r in buckets.table(spark, kinds).collect()}
    assert after == {(1, "00001"): 6, (1, "00002"): 1, (2, "00001"): 1}
    assert buckets.table(spark, kinds, before=7).where("code = '00001' and execution_id = 1").first().occurrences == 2


def test_routing_and_buckets_of_a_stream(spark, tmp_path):
    import datetime as dt

    at = [dt.datetime(2024, 1, 1, 0, m) for m in (1, 4, 7)]
    rows = [("WorkflowEvent", at[0]), ("WorkflowEvent", at[1]), ("Odd", at[2]), (None, at[2]), ("ErrorResolved", at[2])]
    spark.createDataFrame(rows, "detail_type string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    branches, odd = event_state.routed(spark.read.parquet(str(tmp_path / "in")))
    assert {k: v.count() for k, v in branches.items()} == {"WorkflowEvent": 2, "ErrorResolved": 1, "ErrorFailedToResolve": 0}
    assert sorted(r.reason for r in odd.collect()) == ["unknown type Odd", "unknown type null"]
    stream = event_state.metric_buckets(event_state.read_events(spark, str(tmp_path / "in"), "detail_type string, ts timestamp"), by=("detail_type",))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("buckets").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.bucket.minute, r.detail_type): r.n for r in spark.table("buckets").collect()}
    assert got == {(0, "WorkflowEvent"): 2, (5, "Odd"): 1, (5, None): 1, (5, "ErrorResolved"): 1}


def test_transitions_phases_and_partial_failures(spark):
    image = "struct<entity_type:string,execution_id:string,status:string>"
    rows = [("MODIFY", ("ExecutionError", "e", "failed"), ("ExecutionError", "e", "maybeSolved"))] * 2
    rows += [("MODIFY", ("ExecutionError", "e", "failed"), ("ExecutionError", "e", "maybeUnrecoverable")), ("MODIFY", ("ExecutionError", "f", "maybeSolved"), ("ExecutionError", "f", "failed")), ("REMOVE", ("ExecutionError", "g", "failed"), None), ("INSERT", None, None)]
    assert [tuple(r) for r in event_state.solved_transitions(spark.createDataFrame(rows, f"event_name string, old {image}, new {image}")).collect()] == [("e", 2, 1)]
    phases = [("x", "load", "SCHEDULED", 1), ("x", "load", "SUCCEEDED", 2), ("x", "load", "IN_PROGRESS", 2), ("x", "hash", "PARKED", 5), ("x", "hash", "?", 9)]
    got = event_state.phase_states(spark.createDataFrame(phases, "execution_id string, phase string, status string, ts int"))
    assert {tuple(r) for r in got.collect()} == {("x", "load", "SUCCEEDED", 2, 3), ("x", "hash", "PARKED", 5, 1)}
    good, failed = event_state.partial_failures(spark.createDataFrame([("m1", 1), ("m2", -1), ("m3", None)], "id string, n int"), "id", F.col("n") < 0, F.lit("negative"))
    assert [r.id for r in good.collect()] == ["m1"] and sorted(r.item_identifier for r in failed.collect()) == ["m2", "m3"]


def test_removals(spark):
    old = "struct<entity_type:string,execution_id:string,error_code:string,occurrences:int>"
    df = spark.createDataFrame([("REMOVE", ("ExecutionError", "e", "c", None)), ("MODIFY", ("ExecutionError", "e", "c", 3)), ("REMOVE", None), ("REMOVE", ("Other", "e", "c", 1))], f"event_name string, old {old}")
    assert [tuple(r) for r in event_state.removals(df).collect()] == [("e", "c", 1)]
