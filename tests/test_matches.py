"""Address inputs against brute force, merges, the second owner grammar, split writes, and an outbox."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import json_merge, owners
from ledgerloom.operators.address_match import address_matches
from ledgerloom.sources.parts import split_write
from ledgerloom.streaming.event_state import Outbox

INPUT, ROW = "input_id int, query string, city string, state string, zip string", "row_no int, address string, city string, state string, zip string"


def brute(inputs, rows, most):
    out, done = set(), set()
    for i, q, city, state, zip_ in inputs:
        if i is None or i in done or not (q or "").split():
            continue
        done.add(i)
        hits = []
        for n, a, c, s, z in sorted(rows, key=lambda r: r[0]):
            if not a or (city and city.upper() not in (c or "").upper()) or (state and state.upper() != (s or "").upper()) or (zip_ and not (z or "").startswith(zip_[:5])):
                continue
            it = iter(a.split())
            if q in a or all(t in it for t in q.split()):
                hits.append(n)
        cut = hits[:most]
        out |= {(i, n, len(cut) == most and cut[-1] < max(r[0] for r in rows)) for n in cut}
    return out


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_addresses_against_brute_force(spark, most):
    r = random.Random(most)
    words = ["12", "1", "123", "N", "OAK", "HARBOR", "HARBORSIDE", "DR", "BAY", "A"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    place = lambda: (r.choice(["CAPE CORAL", "CORAL", "ESTERO", "", None]), r.choice(["FL", "fl", "GA", None]), r.choice(["33901", "339011234", "33902", "339", "", None]))
    rows = [(n, r.choice([text(r.randrange(1, 6)), None, ""]) if n % 9 == 0 else text(r.randrange(1, 6)), *place()) for n in range(150)]
    inputs = []
    for i in range(80):
        q = text(r.randrange(1, 5))
        q = r.choice([q, q[: max(1, len(q) - 1)].strip(), q[1:].strip(), None, ""]) if i % 3 else q
        city, state, zip_ = place()
        inputs.append((i, q, r.choice([city, None]), r.choice([state, None]), r.choice([zip_, None])))
    inputs += [(None, "OAK", None, None, None), inputs[0]]
    got = {tuple(x) for x in address_matches(spark.createDataFrame(inputs, INPUT), spark.createDataFrame(rows, ROW), most).collect()}
    assert got == brute(inputs, rows, most)


def test_addresses_of_empty_tables(spark):
    inputs, rows = spark.createDataFrame([(1, "OAK", None, None, None)], INPUT), spark.createDataFrame([(1, "OAK", None, None, None)], ROW)
    assert [tuple(r) for r in address_matches(inputs, rows, 1).collect()] == [(1, 1, False)]
    assert address_matches(inputs.limit(0), rows, 1).count() == 0 and address_matches(inputs, rows.limit(0), 1).count() == 0


@pytest.mark.parametrize(
    "a, b, merged, conflicts",
    [
        ('{"x":1,"y":{"z":null}}', '{"x":2,"y":{"z":3,"w":[]},"n":0}', {"x": 1, "y": {"z": 3, "w": []}, "n": 0}, ["$.x"]),
        ('{"x":" ","l":[1],"e":[]}', '{"x":"v","l":[2],"e":[3]}', {"x": "v", "l": [1], "e": [3]}, ["$.l"]),
        ('{"x":{"a":1}}', '{"x":5}', {"x": {"a": 1}}, ["$.x"]), ('{"x":5}', '{"x":{"a":1}}', {"x": 5}, ["$.x"]), ('{"x":1}', '{"x":1.0}', {"x": 1}, ["$.x"]),
        ('{"x":null}', '{"x":null,"y":null}', {"x": None, "y": None}, []), ('{"x":{}}', '{"x":{"y":1}}', {"x": {"y": 1}}, []), ('{"x":null}', '{"x":{"y":1}}', {"x": {"y": 1}}, []),
        ("[1]", '{"x":1}', {"x": 1}, []), (None, None, None, []), ("{bad", "", None, []), ('{"x":0,"f":false}', '{"x":9,"f":true}', {"x": 0, "f": False}, ["$.f", "$.x"]),
    ],
)
def test_merge_without_overwrite(spark, a, b, merged, conflicts):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(json_merge.merged(F.col("a"), F.col("b")).alias("m")).first().m
    assert (json.loads(r.merged) if r.merged else None) == merged and r.conflicts == conflicts


@pytest.mark.parametrize(
    "line, want",
    [
        ("John & Jane Smith", [("person", "John", None, "Smith"), ("person", "Jane", None, "Smith")]),
        ("A & B & C DE ROE", [("person", "A", None, "Roe"), ("person", "B", None, "Roe"), ("person", "C", "De", "Roe")]),
        ("O'NEIL-ROE JR., PAT mc;x", [("person", "Pat", "Mc", "O'neil-roe"), ("rejected", None, None, None)]),
        ("Sun Trust and Bo Lee", [("company", None, None, None), ("person", "Bo", None, "Lee")]),
        ("Pat Roe|", [("person", "Pat", None, "Roe")]), ("Pat Roe III", [("rejected", None, None, None)]), ("& ", []), ("", []), (None, []), (", x", [("rejected", None, None, None)]),
    ],
)
def test_compound_owners(spark, line, want):
    got = spark.createDataFrame([(line,)], "c string").select(owners.compound_owners(F.col("c")).alias("o")).first().o
    assert [(r.kind, r.first_name, r.middle_name, r.last_name) for r in got] == want


def test_split_write_counts_what_it_wrote(spark, tmp_path):
    rows = spark.range(2500).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 10 > 2).alias("ok")).repartition(3)
    m = split_write(rows, F.col("ok"), f"{tmp_path}/out", {"ids": F.col("id")}, records=300)
    assert m == json.loads((tmp_path / "out" / "manifest.json").read_text()) and m["counts"] == {"profiles": 1750, "failures": 750, "ids": 2499 * 2500 // 2}
    for kind in ("profiles", "failures"):
        folder = tmp_path / "out" / f"dataset={kind}"
        lines = {p: len((folder / p).read_text().splitlines()) for p in os.listdir(folder) if p.endswith(".json")}
        assert sorted(lines) == m["parts"][kind] and sum(lines.values()) == m["counts"][kind] and max(lines.values()) <= 300
    empty = split_write(rows.limit(0), F.col("ok"), f"{tmp_path}/none")
    assert empty["counts"] == {"profiles": 0, "failures": 0} and empty["parts"] == {"profiles": [], "failures": []}


def test_outbox_puts_out_each_execution_once(spark, tmp_path):
    box = Outbox(f"{tmp_path}/box", n=4)
    batch = lambda *ids: spark.createDataFrame([(i, 1) for i in ids], "execution_id string, solved int")
    got = lambda: sorted((r.execution_id, r.batch) for r in box.emitted(spark, "execution_id string, solved int").collect())
    box.apply(batch("a", "b"), 0)
    box.apply(batch("b", "c", None), 1)
    box.apply(batch("b", "c"), 1)  # delivered twice
    assert got() == [("a", 0), ("b", 0), ("c", 1)]
    real, box.seen.apply = box.seen.apply, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt())
    with pytest.raises(KeyboardInterrupt):  # stops between the two writes
        box.apply(batch("c", "d"), 2)
    box.seen.apply = real
    box.apply(batch("c", "d"), 2)
    box.apply(batch("d", "a"), 3)
    assert got() == [("a", 0), ("b", 0), ("c", 1), ("d", 2)]
