"""Rows of permit records: what tells permits apart, and whole texts."""

import json

from pyspark.sql import functions as F

from ledgerloom.functions import permits
from ledgerloom.operators import table_rows


def rows_of(spark, *records):
    """{(table, key): (hash, refs, values)} and reasons of the skipped ones."""
    df = spark.createDataFrame([(json.dumps(r) if isinstance(r, dict) else r, "s3://b/k") for r in records], "record string, artifact_uri string")
    rows, skipped = table_rows.permit_rows(df)
    got = rows.collect()
    assert len({(r["table_name"], r["source_record_key"]) for r in got}) == len(got)
    return {(r["table_name"], r["source_record_key"]): (r["source_record_hash"], r["refs"], r["values"]) for r in got}, sorted(r["reason"] for r in skipped.collect())


def test_permits_without_a_number_have_hashes_of_their_own(spark):
    same = {"recordType": "Roof", "workLocation": "1 OAK ST, ESTERO, FL 33928", "feesRawText": "Outstanding 3/7/2021 INV1 $5.00 View Details"}
    rows, _ = rows_of(spark, same | {"idempotencyKey": "id-1"}, same | {"idempotencyKey": "id-2"})
    permits_ = {key: row for (table, key), row in rows.items() if table == "property_improvements"}
    assert sorted(permits_) == ["permits:permit:id-1", "permits:permit:id-2"]
    assert len({hash_ for hash_, _, _ in permits_.values()}) == 2
    assert permits_["permits:permit:id-2"][2]["idempotency_key"] == "id-2" and permits_["permits:permit:id-2"][2]["request_identifier"] == "permits:permit:id-2"


def test_inspections_are_read_to_the_end_of_the_text(spark):
    row = "Pass 101 Final Roof ({}) Result by: Ann Lee on 01/02/2021 "
    text = "x Completed (300) " + "".join(row.format(i) for i in range(300))
    df = spark.createDataFrame([(text,), (text + "Digital Projects Fail 9 Other (300) Result by: Bo on 01/02/2021",), ("Digital Projects " + text,), ("Completed (1)Digital Projects",), ("none",), (None,)], "t string")
    got = [[i["identifier"] for i in r[0] or []] for r in df.select(permits.inspections(F.col("t"))).collect()]
    assert got == [[str(i) for i in range(300)]] * 3 + [[], [], []]
    rows, _ = rows_of(spark, {"recordNumber": "A", "inspectionsRawText": text})
    assert sum(table == "inspections" for table, _ in rows) == 300


def test_a_text_of_professionals_is_parsed_once_and_shared_names_are_told_apart(spark):
    licensed = "Bo Roe SUNSHINE ROOFING 7 MAIN ST, ESTERO, FL, 33928 Primary Phone: 239 General Contractor CGC1"
    one = {"licensedProfessional": licensed, "inspectionsRawText": "Completed (2) Pass 2 B (5) Result by: Al on 01/02/2021 Pass 1 A (5) Result by: Al on 01/02/2021"}
    records = [one | {"recordNumber": "A", "applicant": "Zoe"}, one | {"recordNumber": "B"}, one | {"recordNumber": " A ", "applicant": "Ann"}, one, "[]", {"recordNumber": "C"}]
    got, reasons = rows_of(spark, *records)
    assert reasons == ["neither recordNumber nor idempotencyKey", "not a JSON object"]
    assert sorted(key.split(":")[2] for table, key in got if table == "property_improvements") == ["A", "B", "C"]
    assert got["permit_contacts", "permits:permit:A:contact:applicant"][2]["raw_name"] == "Ann"
    assert [got["inspections", f"permits:permit:{x}:inspection:5"][2]["inspection_code"] for x in "AB"] == ["1", "1"]
    assert sorted(table for table, key in got if not key.startswith("permits:permit:")) == ["addresses", "companies", "people"]
    company = next(key for table, key in got if table == "companies")
    assert got["property_improvements", "permits:permit:B"][1] == {"company_source_record_key": company} and got["property_improvements", "permits:permit:C"][1] == {}
    df = spark.createDataFrame([(json.dumps(r), "u") for r in records[:2]], "record string, artifact_uri string")
    rows, skipped = table_rows.permit_rows(df)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Primary Phone") == 0 and plan.count("from_json(StructField(recordNumber") == 1
    plan = skipped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(recordNumber") == 1
