"""Permit page texts made of orders and customers, parsed back into rows; and parcel polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, owners, permits, rules
from ..operators import table_rows
from .tables import spread, table


def permit_contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contractor block for every customer: name, address, phone and licence."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    k = F.col("c_custkey")
    who = F.when(k % 3 == 0, "ACME BUILDERS, INC.").when(k % 3 == 1, "JOHN Q PUBLIC JR SUNSHINE ROOFING").otherwise("MARY SMITH")
    block = F.concat(who, F.lit(" "), (k + 1).cast("string"), F.lit(" HARBOR DR, ESTERO, FL, 33928 Primary Phone: (239) 555-0100 General Contractor "), F.lit("CGC"), F.format_string("%06d", k))
    steps = c.select("c_custkey", permits.without_phones(block).alias("block")).withColumn("found", permits.licence(F.col("block"))).withColumn("place", permits.split_address(F.col("found.before")))
    steps = steps.withColumn("who", permits.contractor(F.col("place.prefix"))).withColumn("person", permits.person_name(F.col("who.person")))
    return steps.select(
        "c_custkey", F.col("found.kind").alias("licence_kind"), F.col("found.number").alias("licence_number"), F.col("place.address").alias("address"), F.col("who.company").alias("company"),
        F.col("person.first").alias("first_name"), F.col("person.middle").alias("middle_name"), F.col("person.last").alias("last_name"), F.col("person.suffix").alias("suffix"), permits.canonical_company(F.col("who.company")).alias("company_key"),
    )


def permit_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fee rows of a page for every order: one outstanding, one paid; sums by status."""
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey")
    money = F.format_string("%.2f", "o_totalprice")
    page = F.concat(
        F.lit("Fees Outstanding: 3/7/2021 INV-"), k.cast("string"), F.lit(" $"), money, F.lit(" View Details "), F.repeat(F.lit("x "), 150),
        F.lit("Paid Fees 12/25/2020 P"), k.cast("string"), F.lit(" 1,050.25 View Details"),
    )
    rows = o.select("o_orderkey", F.explode(permits.fees(page)).alias("f")).select("o_orderkey", "f.*")
    return rows.select("o_orderkey", "paid_on", "invoice", "amount", "status")


def permit_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey")
    page = F.concat(
        F.lit("Status: Issued  Record Info .. Completed (2) Pass 101 Final Roof ("), k.cast("string"), F.lit(") Result by: Ann Lee on 01/02/2021 Fail B7 Slab ("), (k + 1).cast("string"), F.lit(") Result by: Bo on 03/04/2021 Digital Projects Pass 9 Not This (1) Result by: X on 01/01/2020"),
    )
    return o.select("o_orderkey", permits.status(F.regexp_extract(page, r"Status: (.*)", 1)).alias("status"), F.posexplode(permits.inspections(page)).alias("i", "x")).select("o_orderkey", "status", (F.col("i") + 1).alias("ordinal"), "x.*")


def parcel_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of every supplier in four shapes of text, split and reduced to their exterior rings."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    ring = F.concat(F.lit("[[-81.5,"), k.cast("string"), F.lit(".25],[-81.5,27],[-82,26.5],[-81.5,"), k.cast("string"), F.lit(".25]]"))
    text = (
        F.when(k % 4 == 0, ring).when(k % 4 == 1, F.concat(F.lit("["), ring, F.lit("]")))
        .when(k % 4 == 2, F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring, F.lit("],[[[1,2],[3,4],[5,6]]]]}"))).otherwise(F.lit("not json"))
    )
    parts = s.select(k.alias("s_suppkey"), geo.polygons(text).alias("p")).where("p is not null")
    out = parts.select("s_suppkey", F.size("p").alias("n"), F.posexplode("p").alias("i", "polygon"))
    points = geo.exterior(F.col("polygon"))
    return out.select("s_suppkey", geo.split_id(F.col("s_suppkey").cast("string"), F.col("i"), F.col("n")).alias("identifier"), F.size(points).alias("points"), points[0]["latitude"].alias("latitude"), points[0]["longitude"].alias("longitude"))


OWNERS = ["SMITH{} JOHN A  &  MARY", "Acme Holdings LLC / DOE, JANE", "LEE ANN ET AL and X", "Mary Ann Smith{} and Bob", "O'NEIL{} PAT & Roe, Rob R. / KIM JAE WOO LEE", "First Bank, N.A. & Solo", "SMITH{} JO & Smith{}, Jo", "Sandy Anderson"]


def owner_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner lines of every customer: couples that share a name, companies, placeholders, both orders of names."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    line = F.replace(F.element_at(F.array(*map(F.lit, OWNERS)), (F.col("c_custkey") % len(OWNERS) + 1).cast("int")), F.lit("{}"), F.col("c_custkey").cast("string"))
    return owners.owners(c.select("c_custkey", F.when(F.col("c_custkey") % 50 != 0, line).alias("line")), "line", ["c_custkey"])


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A permit record of every order as JSON, with all kinds of children; some can't be placed."""
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey").cast("string")
    money = F.format_string("%.2f", "o_totalprice")
    record = F.struct(
        F.when(F.col("o_orderkey") % 10 != 0, F.concat(F.lit("ROF"), k)).alias("recordNumber"), F.when(F.col("o_orderkey") % 20 != 0, F.concat(F.lit("id-"), k)).alias("idempotencyKey"), F.lit("Roof").alias("recordType"), F.lit("Issued  Record Info x").alias("recordStatus"),
        F.concat((F.col("o_custkey") % 100).cast("string"), F.lit(" HARBOR DR, ESTERO, FL 33928")).alias("workLocation"), F.lit("29-46").alias("parcelIdentifier"), F.when(F.col("o_orderkey") % 3 == 0, "Ann Lee").alias("applicant"),
        F.concat(F.lit("JOHN Q PUBLIC SUNSHINE ROOFING 7 MAIN ST, ESTERO, FL, 33928 Primary Phone: 239 General Contractor CGC"), (F.col("o_custkey") % 7).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " View Additional Licensed Professionals>> 1) ACME BUILDERS INC 9 OAK ST, NAPLES, FL 34102 2) Bo Roe").otherwise("")).alias("licensedProfessional"),
        F.create_map(F.lit("Type"), F.lit("Re-Roof"), F.lit("Lot #"), k).alias("moreDetails"), F.concat(F.lit("Completed (1) Pass 101 Final ("), k, F.lit(") Result by: Ann on 01/02/2021")).alias("inspectionsRawText"), F.lit("Marked as Approved on 1/2/2021 by Ann\n").alias("processingStatusRawText"),
        F.concat(F.lit("Outstanding 3/7/2021 INV"), k, F.lit(" $"), money, F.lit(" View Details")).alias("feesRawText"), F.array(F.struct(F.lit("a").alias("text"), F.concat(F.lit("u"), k).alias("url"), F.lit(None).cast("string").alias("title"))).alias("documentLinks"),
    )
    return o.select(F.when(F.col("o_orderkey") % 50 == 1, "[1]").otherwise(F.to_json(record)).alias("record"), F.lit("s3://b/k").alias("artifact_uri"))


def permit_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, hashes and references of each table that permit records make, and the records that are skipped."""
    rows, skipped = table_rows.permit_rows(_records(spark, sf_dir))
    out = rows.groupBy("table_name").agg(F.count("*").alias("n"), F.countDistinct("source_record_hash").alias("n_hashes"), F.sum(F.size("refs")).alias("n_refs"), F.min("source_record_key").alias("least_key"))
    return out.unionByName(skipped.groupBy(F.col("reason").alias("table_name")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("n_hashes"), F.lit(0).cast("long").alias("n_refs"), F.lit(None).cast("string").alias("least_key")))


def appraisal_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that appraisal bundles make: a property, a tax year and a sale for every part."""
    p = spread(table(spark, sf_dir, "part"), "p_partkey")
    k = F.col("p_partkey").cast("string")
    one = lambda name, value: F.struct(F.lit(name).alias("file_name"), value.alias("value"))
    files = F.array(
        one("property.json", F.to_json(F.struct(F.col("p_type").alias("property_type"), F.col("p_size").alias("number_of_units")))),
        one("tax_2024.json", F.to_json(F.struct(F.lit("2024").alias("tax_year"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice")).alias("property_market_value_amount"), F.when(F.col("p_partkey") % 3 == 0, F.lit(5.0)).alias("property_assessed_value_amount")))),
        one("sales_1.json", F.to_json(F.struct(F.lit("2020-01-01").alias("ownership_transfer_date"), F.col("p_retailprice").alias("purchase_price_amount")))), one("odd.txt", F.lit("{}")),
    )
    rows, bad = table_rows.appraisal_rows(p.select(k.alias("request_identifier"), F.explode(files).alias("f")).select("request_identifier", "f.*"))
    worth = F.sum(F.element_at("values", "current_avm_value").cast("double"))
    out = rows.groupBy("table_name").agg(F.count("*").alias("n"), F.round(worth, 2).alias("worth"), F.sum(F.size("refs")).alias("n_refs"), F.min("source_record_key").alias("least_key"))
    return out.unionByName(bad.groupBy(F.col("reason").alias("table_name")).agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("worth"), F.lit(0).cast("long").alias("n_refs"), F.lit(None).cast("string").alias("least_key")))


def submit_error_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of messages made of error events: plain, inside JSON, and unknown ones."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    k = F.col("event_id") % 5
    message = F.when(k == 0, '{"error": {"message": "Nonce too low"}}').when(k == 1, "contract creation code storage OUT OF GAS").when(k == 2, "out of gas").when(k == 3, '{"message": "socket timeout"}').otherwise(F.lit(None))
    return e.groupBy(rules.submit_error(message).alias("code")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


QUERIES = {f.__name__: f for f in (permit_contractors, permit_fees, permit_inspections, parcel_polygons, owner_names, permit_tables, appraisal_tables, submit_error_codes)}
ORACLE_SQL = {
    "permit_contractors": """SELECT c_custkey, 'General Contractor' AS licence_kind, 'CGC' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS licence_number, (c_custkey + 1) || ' HARBOR DR, ESTERO, FL, 33928' AS address,
        CASE c_custkey % 3 WHEN 0 THEN 'ACME BUILDERS INC' WHEN 1 THEN 'SUNSHINE ROOFING' END AS company, CASE c_custkey % 3 WHEN 1 THEN 'JOHN' WHEN 2 THEN 'MARY' END AS first_name,
        CASE c_custkey % 3 WHEN 1 THEN 'Q' END AS middle_name, CASE c_custkey % 3 WHEN 1 THEN 'PUBLIC' WHEN 2 THEN 'SMITH' END AS last_name, CASE c_custkey % 3 WHEN 1 THEN 'JR' END AS suffix,
        CASE c_custkey % 3 WHEN 0 THEN 'ACME BUILDERS INC' WHEN 1 THEN 'SUNSHINE ROOFING' END AS company_key FROM customer""",
    "permit_fees": """SELECT o_orderkey, '2021-03-07' AS paid_on, 'INV-' || o_orderkey AS invoice, CAST(printf('%.2f', o_totalprice) AS DOUBLE) AS amount, 'OUTSTANDING' AS status FROM orders
        UNION ALL SELECT o_orderkey, '2020-12-25', 'P' || o_orderkey, 1050.25, 'PAID_OR_DISCOUNTED' FROM orders""",
    "permit_inspections": """SELECT o_orderkey, 'Issued' AS status, 1 AS ordinal, 'Pass' AS result, '101' AS code, 'Final Roof' AS type, CAST(o_orderkey AS VARCHAR) AS identifier, 'Ann Lee' AS inspector, '01/02/2021' AS day FROM orders
        UNION ALL SELECT o_orderkey, 'Issued', 2, 'Fail', 'B7', 'Slab', CAST(o_orderkey + 1 AS VARCHAR), 'Bo', '03/04/2021' FROM orders""",
    "owner_names": rf"""WITH l AS (SELECT c_custkey AS k, replace([{", ".join("'" + x.replace("'", "''") + "'" for x in OWNERS)}][CAST(c_custkey % {len(OWNERS)} + 1 AS INT)], '{{}}', CAST(c_custkey AS VARCHAR)) AS line FROM customer WHERE c_custkey % 50 <> 0),
        s AS (SELECT k, list_transform(string_split_regex(line, '(?i)\s+&\s+|\s+and\s+|\s*/\s*'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))) AS parts FROM l),
        p AS (SELECT k, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM s),
        c AS (SELECT *, string_split(part, ' ') AS w, contains(part, ',') AS comma, CASE WHEN regexp_matches(part, '(?i)\bet\s*(al|ux|vir)\b|\b(est|estate)\b') THEN 'rejected'
            WHEN regexp_matches(part, '(?i)(^|[^a-z])(llc|bank|n[.]a|holdings)([^a-z]|$)') THEN 'company' ELSE 'person' END AS kind FROM p),
        o AS (SELECT *, CASE WHEN kind <> 'person' THEN NULL WHEN comma THEN split_part(part, ',', 1) WHEN len(w) < 2 THEN NULL WHEN part = upper(part) THEN w[1] ELSE w[len(w)] END AS own FROM c),
        f AS (SELECT *, min(CASE WHEN own IS NOT NULL THEN i END) OVER (PARTITION BY k) AS lead_i FROM o),
        g AS (SELECT *, CASE WHEN i = lead_i OR comma OR len(w) > 3 THEN own END AS stated, kind = 'person' AND NOT comma AND lead_i IS NOT NULL AND i > lead_i AND len(w) <= 3 AS shares FROM f),
        h AS (SELECT *, CASE WHEN kind <> 'person' THEN NULL WHEN shares THEN last_value(stated IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE stated END AS last FROM g),
        n AS (SELECT *, CASE WHEN comma THEN string_split(trim(split_part(part, ',', 2)), ' ') WHEN shares THEN w WHEN part = upper(part) THEN w[2:] ELSE w[:len(w) - 1] END AS given FROM h)
        SELECT k AS c_custkey, CAST(i + 1 AS INT) AS ordinal, part, CASE WHEN kind = 'person' AND last IS NULL THEN 'rejected' ELSE kind END AS kind, CASE WHEN last IS NOT NULL THEN replace(given[1], '.', '') END AS first_name,
            CASE WHEN last IS NOT NULL AND len(given) > 1 THEN replace(array_to_string(given[2:], ' '), '.', '') END AS middle_name, last AS last_name, CASE WHEN kind = 'company' THEN part END AS company FROM n""",
    "permit_tables": """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS price, CASE WHEN o_orderkey % 10 <> 0 THEN 'ROF' || o_orderkey ELSE 'id-' || o_orderkey END AS own FROM orders WHERE o_orderkey % 50 <> 1 AND o_orderkey % 20 <> 0),
        t AS (SELECT 'addresses' AS table_name, 'permits:permit:' || own || ':work_location' AS key, 0 AS refs, (c % 100) || ' HARBOR' AS body FROM o
            UNION ALL SELECT DISTINCT 'addresses', 'permits:address:' || substr(sha256('7 MAIN ST ESTERO FL 33928'), 1, 24), 0, '7 MAIN' FROM o
            UNION ALL SELECT DISTINCT 'addresses', 'permits:address:' || substr(sha256('9 OAK ST NAPLES FL 34102'), 1, 24), 0, '9 OAK' FROM o WHERE k % 2 = 0
            UNION ALL SELECT DISTINCT 'people', 'permits:person:' || substr(sha256('JOHN Q PUBLIC' || chr(10) || 'CGC' || (c % 7)), 1, 24), 0, 'JOHN' FROM o
            UNION ALL SELECT DISTINCT 'people', 'permits:person:' || substr(sha256('BO ROE' || chr(10)), 1, 24), 0, 'BO' FROM o WHERE k % 2 = 0
            UNION ALL SELECT DISTINCT 'companies', 'permits:company:' || substr(sha256('SUNSHINE ROOFING'), 1, 24), 0, 'SUN' FROM o
            UNION ALL SELECT DISTINCT 'companies', 'permits:company:' || substr(sha256('ACME BUILDERS INC'), 1, 24), 0, 'ACME' FROM o WHERE k % 2 = 0
            UNION ALL SELECT 'property_improvements', 'permits:permit:' || own, 2, own FROM o
            UNION ALL SELECT 'permit_contacts', 'permits:permit:' || own || ':contact:applicant', 1, 'Ann' FROM o WHERE k % 3 = 0
            UNION ALL SELECT 'permit_contacts', 'permits:permit:' || own || ':contact:licensed_professional', 4, 'JOHN' || (c % 7) FROM o
            UNION ALL SELECT 'permit_contacts', 'permits:permit:' || own || ':contact:licensed_professional:2', 3, 'ACME' FROM o WHERE k % 2 = 0
            UNION ALL SELECT 'permit_contacts', 'permits:permit:' || own || ':contact:licensed_professional:3', 2, 'Bo' FROM o WHERE k % 2 = 0
            UNION ALL SELECT 'inspections', 'permits:permit:' || own || ':inspection:' || k, 1, 'i' FROM o
            UNION ALL SELECT 'permit_events', 'permits:permit:' || own || ':event:' || substr(sha256(array_to_string(['MARKED_AS', 'Approved', '2021-01-02', 'Ann'], chr(10))), 1, 16), 1, 'e' FROM o
            UNION ALL SELECT 'permit_custom_fields', 'permits:permit:' || own || ':custom:type', 1, 'type' FROM o UNION ALL SELECT 'permit_custom_fields', 'permits:permit:' || own || ':custom:lot', 1, 'lot' || k FROM o
            UNION ALL SELECT 'permit_links', 'permits:permit:' || own || ':link:' || substr(sha256('DOCUMENT' || chr(10) || 'u' || k), 1, 16), 1, 'l' || k FROM o
            UNION ALL SELECT 'permit_fees', 'permits:permit:' || own || ':fee:' || substr(sha256(array_to_string(['2021-03-07', 'INV' || k, CAST(CAST(printf('%.2f', price) AS DOUBLE) AS VARCHAR)], chr(10))), 1, 16), 1, 'f' || k FROM o)
        SELECT table_name, count(*) AS n, count(DISTINCT body) AS n_hashes, CAST(sum(refs) AS BIGINT) AS n_refs, min(key) AS least_key FROM t GROUP BY 1
        UNION ALL SELECT 'not a JSON object', count(*), 0, 0, NULL FROM orders WHERE o_orderkey % 50 = 1 UNION ALL SELECT 'neither recordNumber nor idempotencyKey', count(*), 0, 0, NULL FROM orders WHERE o_orderkey % 20 = 0""",
    "appraisal_tables": """WITH p AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice WHEN p_partkey % 3 = 0 THEN 5.0 END AS v, 'appraisal:' || p_partkey || ':' AS b FROM part)
        SELECT 'properties' AS table_name, count(*) AS n, CAST(NULL AS DOUBLE) AS worth, CAST(0 AS BIGINT) AS n_refs, min(b || 'properties:property') AS least_key FROM p UNION ALL SELECT 'taxes', count(*), NULL, count(*), min(b || 'taxes:tax_2024') FROM p
        UNION ALL SELECT 'sales_histories', count(*), NULL, count(*), min(b || 'sales_histories:sales_1') FROM p UNION ALL SELECT 'property_valuations', count(*), round(sum(v), 2), count(*), min(b || 'property_valuations:tax_2024') FROM p WHERE v IS NOT NULL
        UNION ALL SELECT 'no table for odd.txt', count(*), NULL, 0, NULL FROM p""",
    "submit_error_codes": """SELECT CASE event_id % 5 WHEN 0 THEN '60402' WHEN 1 THEN '60411' WHEN 2 THEN '60404' WHEN 3 THEN '60409' ELSE '60999' END AS code, count(*) AS n, min(event_id) AS first_event
        FROM events WHERE event_type = 'error' GROUP BY 1""",
    "parcel_polygons": """SELECT s_suppkey, s_suppkey || CASE WHEN s_suppkey % 4 = 2 THEN '#1' ELSE '' END AS identifier, 4 AS points, s_suppkey + 0.25 AS latitude, -81.5 AS longitude FROM supplier WHERE s_suppkey % 4 <> 3
        UNION ALL SELECT s_suppkey, s_suppkey || '#2', 3, 2.0, 1.0 FROM supplier WHERE s_suppkey % 4 = 2""",
}
