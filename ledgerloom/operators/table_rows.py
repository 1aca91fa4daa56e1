"""Source records -> prepared rows of loaded tables: permits with their child tables, and appraisal bundles.

A prepared row is (table_name, source_record_key, source_record_hash, refs, values): refs maps reference columns to
source keys that resolve_references() looks up, values holds the table's columns as texts without its nulls.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import permits
from ..functions.profiles import let
from ..functions.text import address_key, collapse, is_json_object, lenient_date, number, parcel_id, string, zip_of_address
from ..session import work_folder
from .routing import dispatched

PREFIX = "permits"
#: Fixed value: what precedes the numbered blocks of further professionals.
MORE_PROFESSIONALS = "View Additional Licensed Professionals>>"
RECORD = "recordNumber string, idempotencyKey string, recordType string, recordStatus string, workLocation string, parcelIdentifier string, applicant string, licensedProfessional string, projectDescription string, sourceUrl string, retrievedAt string, moreDetails map<string,string>, inspectionsRawText string, processingStatusRawText string, feesRawText string, documentLinks array<struct<text:string,url:string,title:string>>, relatedLinks array<struct<text:string,url:string,title:string>>"
#: Columns that refer to other rows.
REFS = ["address_source_record_key", "company_source_record_key", "person_source_record_key", "property_improvement_source_record_key"]
ROW = f"struct<table_name:string,source_record_key:string,text:string,refs:struct<{','.join(f'{r}:string' for r in REFS)}>>"


def _map(pairs: Mapping[str, Column]) -> Column:
    """map of the texts that aren't null."""
    every = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))])
    return F.map_filter(every, lambda _, v: v.isNotNull())


def _row(table: str, key: Column, refs: Mapping[str, Column], values: Mapping[str, Column]) -> Column:
    """A row as ROW: its values are one JSON text with sorted keys and without nulls, so that rows can be ordered."""
    text = F.to_json(F.struct(*[values[name].cast("string").alias(name) for name in sorted(values)]), {"ignoreNullFields": "true"})
    return F.struct(F.lit(table).alias("table_name"), key.alias("source_record_key"), text.alias("text"), F.struct(*[refs.get(name, F.lit(None)).cast("string").alias(name) for name in REFS]).alias("refs"))


def _entity_key(kind: str, *parts: Column) -> Column:
    text = F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.concat(F.lit(f"{PREFIX}:{kind}:"), F.substring(F.sha2(text, 256), 1, 24))


def professionals(c: Column) -> Column:
    """array<struct> of a list of licensed professionals: the first block is primary, numbered ones follow it."""
    text = collapse(c)
    first = F.nullif(F.trim(F.substring_index(text, MORE_PROFESSIONALS, 1)), F.lit(""))
    more = F.when(F.contains(text, F.lit(MORE_PROFESSIONALS)), permits.numbered(F.substring_index(text, MORE_PROFESSIONALS, -1))).otherwise(F.array().cast("array<string>"))
    every = F.filter(F.concat(F.array(first), more), lambda b: b.isNotNull())

    def parsed(block: Column, i: Column) -> Column:
        def row(bare: Column, licence: Column, place: Column, who: Column) -> Column:
            return F.struct(
                (i + 1).alias("ordinal"), block.alias("raw"), licence["kind"].alias("licence_kind"), licence["number"].alias("licence_number"), place["address"].alias("address"), who["person"].alias("person"), who["company"].alias("company"),
                F.when(who["person"].isNotNull(), _entity_key("person", F.upper(who["person"]), licence["number"])).alias("person_key"), F.when(who["company"].isNotNull(), _entity_key("company", permits.canonical_company(who["company"]))).alias("company_key"),
                F.when(place["address"].isNotNull(), _entity_key("address", address_key(place["address"]))).alias("address_key"),
            )

        # each step's value is bound once: the parsers are large expressions
        return let(permits.without_phones(block), lambda bare: let(permits.licence(bare), lambda licence: let(permits.split_address(F.coalesce(licence["before"], bare)), lambda place: let(permits.contractor(place["prefix"]), lambda who: row(bare, licence, place, who)))))

    return F.transform(every, parsed)


def _address_row(key: Column, raw: Column, zip_: Column | None = None) -> Column:
    return let(address_key(raw), lambda base: _row("addresses", key, {}, {"unnormalized_address": raw, "normalized_address_key": base, "normalized_address_hash": F.sha2(base, 256), "postal_code": zip_of_address(raw) if zip_ is None else zip_, "state_code": F.when(raw.rlike(r"(?i)\bFL\b"), "FL"), "country_code": F.lit("US")}))


def permit_rows(records: DataFrame, record: str = "record", uri: str = "artifact_uri") -> tuple[DataFrame, DataFrame]:
    """(prepared rows, skipped records with a reason) of permit records as JSON texts; rows of equal keys come once.

    A record needs a number or an idempotency key. A first job, run at once, finds the distinct texts of professionals,
    which are parsed once each, and the names that several records have. All keys of a permit's own rows begin with its
    name, so these are told apart inside a record, and only rows of records that share a name are shuffled.
    """
    parsed = records.withColumn("r", F.from_json(record, RECORD, {"mode": "PERMISSIVE"}))
    own = F.coalesce(string(F.col("r.recordNumber")), string(F.col("r.idempotencyKey")))
    marked = parsed.withColumn("own", own).withColumn("ok", is_json_object(F.col(record)))
    reason = F.when(~F.col("ok"), "not a JSON object").when(F.col("own").isNull(), "neither recordNumber nor idempotencyKey")
    # no filters here: Spark would move them before the shuffles of the records, and parse every record a second time
    failed = F.when(reason.isNotNull(), F.array(F.struct(F.col(uri).alias(uri), F.col(record).alias(record), reason.alias("reason"))))
    skipped = marked.select(F.explode(failed).alias("f")).select("f.*")
    good = marked.select(uri, F.when(F.col("ok"), F.col("own")).alias("own"), F.col("r.licensedProfessional").alias("licensed"), "r")
    spark = records.sparkSession
    folder = work_folder(spark, "permit-rows")
    facts = F.when(F.col("own").isNotNull(), F.array(F.struct(F.lit("name").alias("kind"), F.col("own").alias("value")), F.struct(F.lit("licensed").alias("kind"), F.col("licensed").alias("value"))))
    counted = good.select(F.explode(facts).alias("f")).groupBy("f.kind", "f.value").count()
    counted.where("value is not null and (kind = 'licensed' or count > 1)").select("value", "kind").write.parquet(f"{folder}/facts", partitionBy="kind")
    read = lambda name, columns: spark.read.schema(columns).parquet(f"{folder}/{name}")
    facts = read("facts", "value string, kind string")
    texts = facts.where("kind = 'licensed'").repartition(4 * spark.sparkContext.defaultParallelism, "value")
    texts.select(F.col("value").alias("licensed"), professionals(F.col("value")).alias("people")).write.parquet(f"{folder}/people")
    people = read("people", f"licensed string, people {people_type()}")
    names = facts.where("kind = 'name'").select(F.col("value").alias("own"))

    out = _finished(_least(_entity_rows(people)))
    if names.isEmpty():
        out = _finished(_permit_rows(good, people, uri)).unionByName(out)
    else:
        once, shared = good.join(names, "own", "left_anti"), good.join(names, "own", "left_semi")
        out = _finished(_permit_rows(once, people, uri)).unionByName(_finished(_least(_permit_rows(shared, people, uri)))).unionByName(out)
    return out, skipped


def _rows(items: Column, make) -> Column:
    return F.coalesce(F.transform(items, make), F.array().cast(f"array<{ROW}>"))


def _entity_rows(people: DataFrame) -> DataFrame:
    """Persons, companies and their addresses of parsed professionals."""
    persons = _rows(F.filter("people", lambda p: p["person"].isNotNull()), lambda p: let(permits.person_name(p["person"]), lambda name: _row("people", p["person_key"], {}, {f"{part}_name": name[part] for part in ("first", "middle", "last", "suffix")})))
    companies = _rows(F.filter("people", lambda p: p["company"].isNotNull()), lambda p: _row("companies", p["company_key"], {}, {"name": p["company"]}))
    places = _rows(F.filter("people", lambda p: p["address"].isNotNull()), lambda p: _address_row(p["address_key"], p["address"]))
    return people.select(F.explode(F.concat(persons, companies, places)).alias("row")).select("row.*")


def _permit_rows(good: DataFrame, people: DataFrame, uri: str) -> DataFrame:
    """Rows of the permits themselves, their sites and children; those of equal keys in a record come once, with the least values."""
    key = F.concat(F.lit(f"{PREFIX}:permit:"), F.col("own"))
    place, place_key = string(F.col("r.workLocation")), F.concat(key, F.lit(":work_location"))
    details = F.coalesce(F.col("r.moreDetails"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    detail = lambda name: string(F.try_element_at(details, F.lit(name)))
    # values without lambdas are columns of their own, which are compiled and made once
    values = {
        "request_identifier": key, "idempotency_key": string(F.col("r.idempotencyKey")), "permit_number": string(F.col("r.recordNumber")), "improvement_type": F.coalesce(detail("Type"), string(F.col("r.recordType"))),
        "record_status": permits.status(F.col("r.recordStatus")), "record_type": string(F.col("r.recordType")), "work_location": place, "parcel_identifier": parcel_id(F.coalesce(string(F.col("r.parcelIdentifier")), detail("Parcel Number"))),
        "applicant": string(F.col("r.applicant")), "project_description": string(F.col("r.projectDescription")), "estimated_job_value": F.coalesce(number(detail("Estimated Job Value")), number(detail("Est Const. Value"))),
        "block": detail("Block"), "lot": detail("Lot"), "subdivision": detail("Subdivision"), "source_url": string(F.col("r.sourceUrl")), "source_artifact_uri": F.col(uri),
    }
    good = good.join(people, "licensed", "left").select(
        "own", "people", details.alias("details"), place_key.alias("place_key"), zip_of_address(place).alias("place_zip"), *[F.col(f"r.{name}").alias(name) for name in ("inspectionsRawText", "processingStatusRawText", "feesRawText", "documentLinks", "relatedLinks")], *[value.alias(name) for name, value in values.items()],
    )
    good = good.withColumn("people", F.coalesce("people", F.array().cast(people_type()))).withColumn("fees", F.coalesce(permits.fees(F.col("feesRawText")), F.array().cast("array<struct<paid_on:string,invoice:string,amount:double,status:string>>")))
    key, place, place_key, details = F.col("request_identifier"), F.col("work_location"), F.col("place_key"), F.col("details")
    none = F.array().cast(f"array<{ROW}>")
    parent = {"property_improvement_source_record_key": key}
    rows = _rows

    head = F.get("people", F.lit(0))
    site = F.when(place.isNotNull(), F.array(_address_row(place_key, place, F.col("place_zip")))).otherwise(none)
    permit = _row(
        "property_improvements", key, {"address_source_record_key": F.when(place.isNotNull(), place_key), "company_source_record_key": head["company_key"]},
        {name: F.col(name) for name in values} | {"fee": permits.fee_total(F.transform("fees", lambda f: f["amount"]))},
    )
    applicant = F.col("applicant")
    contacts = F.concat(
        F.when(applicant.isNotNull(), F.array(_row("permit_contacts", F.concat(key, F.lit(":contact:applicant")), parent, {"contact_role": F.lit("APPLICANT"), "raw_name": applicant}))).otherwise(none),
        rows(F.col("people"), lambda p: _row(
            "permit_contacts", F.when(p["ordinal"] == 1, F.concat(key, F.lit(":contact:licensed_professional"))).otherwise(F.concat(key, F.lit(":contact:licensed_professional:"), p["ordinal"].cast("string"))),
            {**parent, "person_source_record_key": p["person_key"], "company_source_record_key": p["company_key"], "address_source_record_key": p["address_key"]},
            {"contact_role": F.when(p["ordinal"] == 1, "LICENSED_PROFESSIONAL").otherwise("LICENSED_PROFESSIONAL_ADDITIONAL"), "raw_name": p["raw"], "license_type": p["licence_kind"], "license_number": p["licence_number"]},
        )),
    )
    hashed = lambda kind, *parts: F.concat(key, F.lit(f":{kind}:"), F.substring(F.sha2(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 16))
    inspections = rows(permits.inspections(F.col("inspectionsRawText")), lambda i: _row("inspections", F.concat(key, F.lit(":inspection:"), i["identifier"]), parent, {"inspection_result": i["result"], "inspection_code": i["code"], "inspection_type": i["type"], "inspector": i["inspector"], "inspection_date": lenient_date(i["day"])}))
    events = rows(permits.events(F.col("processingStatusRawText")), lambda e: _row("permit_events", hashed("event", e["kind"], e["status"], e["day"], e["actor"]), parent, {"event_kind": e["kind"], "event_status": e["status"], "event_date": e["day"], "actor": e["actor"]}))
    fee_rows = rows(F.col("fees"), lambda f: _row("permit_fees", hashed("fee", f["paid_on"], f["invoice"], f["amount"]), parent, {"fee_date": f["paid_on"], "invoice_number": f["invoice"], "assessed_amount": f["amount"], "fee_status": f["status"]}))
    linked = lambda name, kind: F.coalesce(F.transform(F.col(name), lambda x, i: F.struct(F.lit(kind).alias("kind"), F.coalesce(string(x["url"]), F.concat(F.lit("missing-url-"), i.cast("string"))).alias("url"), x["text"].alias("text"), x["title"].alias("title"))), F.array().cast("array<struct<kind:string,url:string,text:string,title:string>>"))
    link_rows = rows(F.concat(linked("documentLinks", "DOCUMENT"), linked("relatedLinks", "RELATED")), lambda x: _row("permit_links", hashed("link", x["kind"], x["url"]), parent, {"link_kind": x["kind"], "url": x["url"], "text": string(x["text"]), "title": string(x["title"])}))
    custom = rows(F.map_entries(details), lambda e: _row("permit_custom_fields", F.concat(key, F.lit(":custom:"), F.regexp_replace(F.regexp_replace(F.lower(e["key"]), "[^a-z0-9]+", "_"), "^_+|_+$", "")), parent, {"field_group": F.lit("more_details"), "field_name": e["key"], "field_value": e["value"]}))
    every = F.when(F.col("own").isNotNull(), F.sort_array(F.concat(site, F.array(permit), contacts, inspections, events, fee_rows, link_rows, custom)))
    same = lambda a, b: (a["source_record_key"] == b["source_record_key"]) & (a["table_name"] == b["table_name"])
    # all in the explode: compiled as a projection, so large an expression would be a method too long for the JIT
    first = let(every, lambda rows: F.filter(rows, lambda row, i: (i == 0) | ~same(row, F.get(rows, i - 1))))
    return good.select(F.explode(first).alias("row")).select("row.*")


def people_type() -> str:
    return "array<struct<ordinal:int,raw:string,licence_kind:string,licence_number:string,address:string,person:string,company:string,person_key:string,company_key:string,address_key:string>>"


def _least(rows: DataFrame) -> DataFrame:
    """Rows as ROW; equal keys of a table come once, with the least values."""
    return rows.groupBy("table_name", "source_record_key").agg(F.min(F.struct("text", "refs")).alias("least")).select("table_name", "source_record_key", "least.text", "least.refs")


def _finished(rows: DataFrame) -> DataFrame:
    """Prepared rows of rows as ROW."""
    *others, parent = [F.col(f"refs.{name}") for name in REFS]
    # most rows refer to their permit only, or to nothing
    only = F.coalesce(*others).isNull() & parent.isNotNull()
    refs = F.when(only, F.create_map(F.lit(REFS[-1]), parent)).otherwise(_map({name: F.col(f"refs.{name}") for name in REFS}))
    return rows.select("table_name", "source_record_key", F.sha2("text", 256).alias("source_record_hash"), refs.alias("refs"), F.from_json("text", "map<string,string>").alias("values"))


def _hashed(rows: DataFrame) -> DataFrame:
    """rows with source_record_hash of their values; equal keys of a table come once, with the least values."""
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("values"))))
    keyed = rows.withColumn("text", text).groupBy("table_name", "source_record_key").agg(F.min_by(F.struct("refs", "values"), "text").alias("row"), F.min("text").alias("text"))
    return keyed.select("table_name", "source_record_key", F.sha2("text", 256).alias("source_record_hash"), "row.refs", "row.values")


#: What is said of appraisal files that can't be placed.
NO_REQUEST = "appraisal record is missing request_identifier"
IS_LINK = "relationship files are represented through direct foreign-key references"


def appraisal_rows(records: DataFrame, request: str = "request_identifier", name: str = "file_name", body: str = "value") -> tuple[DataFrame, DataFrame]:
    """(prepared rows, quarantined records) of the files of appraisal bundles.

    A record belongs to the bundle that its own request_identifier names, or else the column; without either, and if its
    file only links others, it is quarantined. A row's key is its bundle, table and file; it refers to its bundle's
    property. Its values are all fields of the record that aren't null or blank, nested ones as JSON, and source_payload,
    the record as it is. A tax record with a market value, or else an assessed one, also gives a valuation; without
    either it gives none.
    """
    short = F.element_at(F.split(F.col(name), "/"), -1)
    is_link = F.startswith(short, F.lit("relationship_")) & is_json_object(F.col(body))
    links = records.where(F.coalesce(is_link, F.lit(False))).withColumn("reason", F.lit(IS_LINK))
    placed, bad = dispatched(records.where(~F.coalesce(is_link, F.lit(False))), name, body)
    fields = F.map_filter(F.from_json(body, "map<string,string>"), lambda _, v: string(v).isNotNull())
    placed = placed.withColumn("__fields", fields).withColumn("__owner", F.coalesce(string(F.try_element_at("__fields", F.lit("request_identifier"))), string(F.col(request))))
    good, lost = placed.where("__owner is not null"), placed.where("__owner is null")
    lost = lost.dropDuplicates([name, body]).select(*records.columns, F.lit(NO_REQUEST).alias("reason"))
    value = lambda c: string(F.try_element_at("__fields", F.lit(c)))
    stem = F.regexp_replace(short, r"\.json$", "")
    key = F.concat_ws(":", F.lit("appraisal"), F.col("__owner"), F.col("table_name"), stem)
    current = F.coalesce(number(value("property_market_value_amount")), number(value("property_assessed_value_amount")))
    from_tax = (F.col("table_name") == "property_valuations") & F.startswith(stem, F.lit("tax_"))
    valued = _map({"current_avm_value": current, "valuation_method_type": F.lit("county_assessed"), "valuation_date": F.concat(value("tax_year"), F.lit("-01-01"))})
    whole = F.map_concat(F.map_filter("__fields", lambda k, _: k != "source_payload"), _map({"source_payload": F.to_json(F.try_parse_json(F.col(body)))}))
    parent = F.when(F.col("table_name") != "properties", F.concat_ws(":", F.lit("appraisal"), F.col("__owner"), F.lit("properties"), F.lit("property")))
    kept = good.where(~from_tax | current.isNotNull())
    rows = kept.select("table_name", key.alias("source_record_key"), _map({"property_source_record_key": parent}).alias("refs"), F.when(from_tax, valued).otherwise(whole).alias("values"))
    return _hashed(rows), bad.unionByName(links).unionByName(lost)
