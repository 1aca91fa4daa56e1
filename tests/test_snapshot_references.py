"""References of a load: several kinds a row, whose ids they take, and how little of the load they touch."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import snapshots
from ledgerloom.operators.snapshots import Snapshots

SCHEMA = "table_name string, source_record_key string, source_record_hash string, refs map<string,string>, values map<string,string>"
ORDER = ["properties", "people", "property_improvements"]
P, H = "property_source_record_key", "person_source_record_key"


def rows(spark, *items):
    return spark.createDataFrame([(t, k, "h", refs, {"v": "h"}) for t, k, refs in items], SCHEMA)


def ids(store, name):
    return {r.source_record_key: [tuple(i) for i in r.ids] for r in store.table(name).collect()}


def own(store, name):
    return {r.source_record_key: r.id for r in store.table(name).collect()}


def test_several_kinds_unknown_kinds_and_rows_of_one_key_in_two_tables(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}")
    items = [("properties", "k", {}), ("people", "k", {P: "k"}), ("people", "j", None), ("property_improvements", "a", {P: "k", H: "j"}), ("property_improvements", "b", {H: "no", P: "k", "odd": "k"}), ("property_improvements", "c", {P: None}), ("property_improvements", "k", {H: "k"})]
    store.load(rows(spark, *items), ORDER)
    property_, people = own(store, "properties"), own(store, "people")
    assert len({property_["k"], people["k"], people["j"]}) == 3
    assert ids(store, "properties") == {"k": []} and ids(store, "people") == {"k": [("property_id", property_["k"])], "j": []}
    assert ids(store, "property_improvements") == {"a": [("person_id", people["j"]), ("property_id", property_["k"])], "b": [("property_id", property_["k"])], "c": [], "k": [("person_id", people["k"])]}
    again = {r.table_name: (r.attempted, r.changed, r.unchanged, r.total) for r in store.load(rows(spark, *items), ORDER).collect()}
    assert again == {"properties": (1, 0, 1, 1), "people": (2, 0, 2, 2), "property_improvements": (4, 0, 4, 4)}
    for refs in ({H: "no"}, {"odd": "k"}, {P: None}):
        with pytest.raises(Exception, match="no parent"):
            store.load(rows(spark, ("property_improvements", "z", refs)), ORDER, missing="throw")
    store.load(rows(spark, ("property_improvements", "z", {P: "k", H: "k"})), ORDER, missing="throw")
    assert store.versions() == [1, 2, 3] and len(ids(store, "property_improvements")["z"]) == 2


@pytest.mark.parametrize("order", [["properties", "property_improvements"], ["property_improvements", "properties"]])
def test_a_reference_takes_the_id_that_its_parent_keeps(spark, tmp_path, order):
    store = Snapshots(spark, f"file://{tmp_path}")
    store.load(rows(spark, ("properties", "p", {})), order, lambda t: {"properties": t["properties"].withColumn("id", F.lit("other"))})
    store.load(rows(spark, ("properties", "p", {}), ("properties", "q", {}), ("property_improvements", "i", {P: "p"}), ("property_improvements", "j", {P: "q"})), order)
    kept = own(store, "properties")
    assert kept["p"] == "other" and ids(store, "property_improvements") == {"i": [("property_id", "other")], "j": [("property_id", kept["q"])]}


def test_a_table_without_references_is_not_joined_and_parents_are_read_as_staged(spark, tmp_path, monkeypatch):
    store, real, plans = Snapshots(spark, f"file://{tmp_path}"), snapshots.upsert, []

    def upsert(target, source, spec):
        plans.append([str(df._jdf.queryExecution().optimizedPlan().toString()) for df in (source, real(target, source, spec))])
        return real(target, source, spec)

    monkeypatch.setattr(snapshots, "upsert", upsert)
    path = str(tmp_path / "rows")
    for items in ([("properties", "p", {}), ("property_improvements", "i", {P: "p"})],) * 2:
        rows(spark, *items).write.mode("overwrite").parquet(path)
        store.load(spark.read.schema(SCHEMA).parquet(path), ["properties", "property_improvements"])
    joins = [[plan.count("Join ") for plan in pair] for pair in plans]
    assert joins == [[0, 0], [2, 2], [0, 1], [2, 3]]  # own rows: with the references; then with the table, if there is one
    assert all(pair[0].count("Relation ") <= 3 for pair in plans)  # the rows twice, and the parents' staged table
