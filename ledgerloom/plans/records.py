"""Registry parsing, keys, joins, upserts and date windows over the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import dedupe, graph, joins, ranges, upsert
from ..sources import fixed_width
from .tables import table

CITIES = ["Fort Myers", "St. Cape", "Estero", "Naples*1", "Lehigh  Acres"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed-width registry line for every customer; a line weighs far more than its customer, so they are dealt out."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    k = F.col("c_custkey")
    city = F.element_at(F.array(*map(F.lit, CITIES)), (k % 5 + 1).cast("int"))
    zip_ = F.format_string("%05d", k * 37 % 100000)
    street = F.concat(k.cast("string"), F.lit(" North Main Street"))

    def at(value, width):
        return F.rpad(value, width, " ")

    blank = F.lit("")
    head = [
        at(F.format_string("P%09d", k), 12), at(F.col("c_name"), 192), F.when(k % 3 == 0, "I").otherwise("A"), at(F.lit("DOMP"), 15),
        at(street, 42), at(blank, 42), at(city, 28), F.lit("FL"), at(F.concat(zip_, F.lit("1234")), 10), F.lit("US"),
        at(F.concat(F.lit("PO Box "), k.cast("string")), 42), at(blank, 42), at(city, 28), F.lit("FL"), at(zip_, 10), F.lit("US"),
        F.when(k % 10 == 0, "20240231").otherwise("19400124"), at(blank, 14), F.when(k % 4 == 0, "Y").otherwise("N"), at(blank, 8), F.lit("FL"),
        at(F.when(k % 2 == 0, "2023").otherwise(blank), 4), F.lit(" "), at(F.when(k % 2 == 0, "20230105").otherwise(blank), 8), at(blank, 26),
        at(F.concat(F.lit("Agent "), k.cast("string")), 42), F.lit("P"), at(street, 42), at(city, 28), F.lit("FL"), at(zip_, 9),
    ]
    officer = [at(F.lit("PRES"), 4), F.lit("P"), at(F.concat(F.lit("Officer "), k.cast("string")), 42), at(street, 42), at(city, 28), F.lit("FL"), at(zip_, 9)]
    return c.select(F.concat(*head, *officer, at(blank, 640)).alias("value"), k.alias("c_custkey"))


def fixed_width_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fixed_width.parse_lines(_lines(spark, sf_dir))
    return e.select(
        "c_custkey", "document_number", "entity_name", "status", F.col("principal_address.normalized").alias("address"), F.col("principal_address.zip").alias("zip"), "filed_date", "more_than_six_officers",
        F.size("annual_reports").alias("n_reports"), F.size("officers").alias("n_officers"), F.get("officers", F.lit(0))["name"].alias("officer"), "raw_record_length",
    )


def prefix_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles whose ZIP starts with a supplier's prefix: two to four digits of the supplier key."""
    placed = fixed_width.role_addresses(fixed_width.parse_lines(_lines(spark, sf_dir)))
    s = table(spark, sf_dir, "supplier")
    prefixes = s.select(F.substring(F.format_string("%04d", F.col("s_suppkey") * 97 % 10000), 1, (F.lit(2) + F.col("s_suppkey") % 3).cast("int")).alias("prefix")).distinct()
    out = joins.prefix_join(placed, F.col("address.zip"), prefixes, "prefix")
    return out.select("document_number", "role", F.col("address.zip").alias("zip"), "matched_prefix")


def entity_graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address vertices with their stable identifiers."""
    return graph.vertices(fixed_width.parse_lines(_lines(spark, sf_dir)))["address"]


def entity_graph_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of vertices, of distinct identifiers and the least identifier of each kind."""
    out = None
    for kind, df in graph.vertices(fixed_width.parse_lines(_lines(spark, sf_dir))).items():
        one = df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.countDistinct("request_identifier").alias("n_ids"), F.min("request_identifier").alias("least_id"))
        out = one if out is None else out.unionByName(one)
    return out


def entity_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every edge of the graph."""
    return graph.edges(fixed_width.parse_lines(_lines(spark, sf_dir)))


def token_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items whose words all occur in order in a document, by the rarest word."""
    q = table(spark, sf_dir, "benchmark").select("item_id", text.registry_address("text").alias("query"))
    d = table(spark, sf_dir, "documents").select("doc_id", text.registry_address("text").alias("body"))
    return joins.token_block_join(q, "item_id", "query", d, "doc_id", "body")


def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", text.name_key(F.concat("p_name", F.lit(" & Co., "), "p_type")).alias("name_key"), text.slug(F.col("p_name")).alias("slug"), text.parcel_id(F.concat_ws("-", "p_brand", "p_partkey")).alias("parcel_id"), text.parcel_search_key(F.concat_ws("-", "p_brand", "p_partkey")).alias("search_key"))


def address_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    raw = F.concat(F.col("c_custkey").cast("string"), F.lit(" Northwest  Harbor Drive, Apt. #"), (F.col("c_custkey") % 90).cast("string"), F.lit(", Fort Myers, FL "), F.format_string("%05d", F.col("c_custkey") % 99999), F.lit("-0001"))
    return c.select("c_custkey", text.address_key(raw).alias("address_key"), text.registry_address(raw).alias("registry_key"), text.zip_of_address(raw).alias("zip"), text.city_name(raw).alias("city"))


def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, booleans and dates read from text in the shapes that sources have them."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    raw = F.when(k % 5 == 0, F.concat(F.lit("$"), k.cast("string"), F.lit(",500.75"))).when(k % 5 == 1, F.lit(" 5f")).when(k % 5 == 2, F.lit("NaN")).when(k % 5 == 3, F.concat(F.lit(" -"), k.cast("string"), F.lit(".9 "))).otherwise(F.lit(""))
    flag = F.element_at(F.array(*map(F.lit, [" Yes", "t", "0", "TRUE"])), (k % 4 + 1).cast("int"))
    day = F.element_at(F.array(*map(F.lit, ["3/7/2021", "2021-13-45T00", "2021/03/07"])), (k % 3 + 1).cast("int"))
    return o.select("o_orderkey", text.number(raw).alias("number"), text.integer(raw).alias("integer"), text.boolean(flag).alias("flag"), text.lenient_date(day).alias("day"), F.date_format(text.strict_date(F.date_format("o_orderdate", "yyyyMMdd")), "yyyy-MM-dd").alias("strict_day"))


def orphan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


def candidate_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation and order count, those without orders first, then by latest order: rows 21 to 60."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("latest"))
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    pick = c.select("c_custkey", "n_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "latest")
    return pick.orderBy(F.when(F.col("n_orders") == 0, 0).when(F.col("n_orders") < 8, 1).otherwise(2), F.desc_nulls_last("latest"), "c_custkey").offset(20).limit(40)


def fk_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per brand and supplier nation through two resolved keys; parts with key modulo 7 = 0 aren't loaded."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").where("p_partkey % 7 <> 0")
    out = joins.resolve_keys(li, part, [("l_partkey", "p_partkey")], "p_brand", "brand")
    out = joins.resolve_keys(out, table(spark, sf_dir, "supplier"), [("l_suppkey", "s_suppkey")], "s_nationkey", "nation", missing="throw")
    return out.groupBy("brand", "nation").agg(F.count("*").alias("n"))


def any_key_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's best supplier by key, by name digits, or by nation; then the richest, then the least key."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    keys = [(F.col("c_custkey") * 2, F.col("s_suppkey")), (F.regexp_replace("c_name", r"\D", "").cast("long") % 500, F.regexp_replace("s_name", r"\D", "").cast("long")), (F.col("c_nationkey"), F.col("s_nationkey"))]
    return joins.any_key_join(c.select("c_custkey", "c_name", "c_nationkey"), s, keys, ["c_custkey"], [F.desc("s_acctbal"), F.col("s_suppkey")]).select("c_custkey", "key_no", "s_suppkey")


def any_key_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose key or tenfold key isn't three times a part's key or five times its half."""
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    half = F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("double") / 2 * 5).cast("long")
    return joins.any_key_semi(c, [F.col("c_custkey"), F.col("c_custkey") * 10], p, [F.col("p_partkey") * 3, half], ["c_custkey"], anti=True).select("c_custkey")


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A table of orders, and a source with the later half of them again: some repriced, some new, some linked anew."""
    o = table(spark, sf_dir, "orders")
    price = F.format_string("%.2f", "o_totalprice")
    base = o.select(F.lit("orders").alias("source_system"), F.col("o_orderkey").cast("string").alias("source_record_key"), F.sha2(price, 256).alias("source_record_hash"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"), F.lit("old").alias("created_at"))
    target = base.where(F.col("source_record_key").cast("long") % 3 != 0)
    k = F.col("source_record_key").cast("long")
    source = base.where(k % 2 == 0).withColumn("source_record_hash", F.when(k % 5 == 0, F.sha2(F.col("source_record_key"), 256)).otherwise(F.col("source_record_hash")))
    source = source.withColumn("customer_id", F.when(k % 7 == 0, F.lit(None).cast("long")).otherwise(F.col("customer_id"))).withColumn("status", F.lit("X")).withColumn("created_at", F.lit("new"))
    return target, source


def hash_guard_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _versions(spark, sf_dir)
    return upsert.upsert(target, source, upsert.TableSpec(derived=("customer_id",)))


def upsert_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.counters(hash_guard_upsert(spark, sf_dir))


def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")
    return dedupe.keep_first(li, ["l_partkey"], ["l_orderkey", "l_linenumber"])


def keep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest item of each supplier, the first one on ties."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber")
    return dedupe.keep_first(li, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"])


def chunk_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dedupe.batches(o, ["o_custkey"], ["o_orderkey"], 4).groupBy("o_custkey", "batch").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("o_orderkey"))[0].alias("first_order"))


def date_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 30 days over each customer's span of orders, the last one cut."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    return ranges.windows(o, "start", "end", 30).select("o_custkey", F.col("window_start").cast("string"), F.col("window_end").cast("string"), ranges.days(F.col("window_start"), F.col("window_end")).alias("days"))


def date_bisect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole span of orders, halved until a window has under 1000 orders or one day."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    out = ranges.split_until(o, "day", 1000)
    return out.select(F.col("window_start").cast("string"), F.col("window_end").cast("string"), "n")


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return c.unionByName(s, allowMissingColumns=True)


def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).exceptAll(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


def catalog_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers over customers by nation: a nation with a rich supplier keeps it, others take the customers' sum."""
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.max("s_acctbal").alias("best"))
    c = table(spark, sf_dir, "customer").where("c_nationkey % 4 <> 1").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n_customers"))
    out = s.where("nation % 5 <> 2").join(c, "nation", "full")
    return out.select("nation", F.when(F.col("best") > 9000, "kept").when(F.col("n_customers").isNotNull(), F.when(F.col("best").isNull(), "added").otherwise("replaced")).otherwise("kept").alias("state"), "n_customers")


QUERIES = {f.__name__: f for f in (
    fixed_width_roundtrip, prefix_semijoin, entity_graph_vertices, entity_graph_kinds, entity_graph_edges, token_subsequence, name_keys, address_keys, typed_values, orphan_customers, candidate_ranking,
    fk_resolution, any_key_link, any_key_anti, hash_guard_upsert, upsert_counters, keep_first, keep_best, chunk_batches, date_windows, date_bisect, union_by_name, set_difference, catalog_merge,
)}

_REG = r"""reg AS (SELECT c_custkey AS k, c_name, ['Fort Myers', 'St. Cape', 'Estero', 'Naples*1', 'Lehigh  Acres'][c_custkey % 5 + 1] AS city,
    lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip, c_custkey || ' North Main Street' AS street FROM customer),
placed AS (SELECT k, 'principal' AS role, street || ' ' || city || ' FL ' || zip || '1234 US' AS line, city, zip || '1234' AS zip FROM reg
    UNION ALL SELECT k, 'mailing', 'PO Box ' || k || ' ' || city || ' FL ' || zip || ' US', city, zip FROM reg
    UNION ALL SELECT k, 'registered_agent', street || ' ' || city || ' FL ' || zip, city, zip FROM reg
    UNION ALL SELECT k, 'officer', street || ' ' || city || ' FL ' || zip, city, zip FROM reg)"""
_NORM = r"trim(regexp_replace(replace(replace(upper({0}), 'NORTH', 'N'), 'STREET', 'ST'), '[^A-Z0-9]+', ' ', 'g'))"
_PLACES = f"""pl AS (SELECT *, printf('P%09d', k) AS doc, 'registry:address:' || substr(sha256('["' || {_NORM.format("line")} || '","FL","' || zip || '","' || CASE WHEN role IN ('principal', 'mailing') THEN 'US' ELSE '' END || '"]'), 1, 24) AS place FROM placed)"""
_EDGES = """r AS (SELECT *, 'registry:' || doc || ':business_registration' AS reg,
    CASE role WHEN 'registered_agent' THEN 'registry:' || doc || ':party:registered_agent:' || substr(sha256('["Agent ' || k || '","P"]'), 1, 24) WHEN 'officer' THEN 'registry:' || doc || ':party:officer:1:' || substr(sha256('["Officer ' || k || '","PRES","P"]'), 1, 24)
        ELSE 'registry:' || doc || ':business_registration_address:' || role END AS own FROM pl),
e AS (SELECT DISTINCT 'company_has_business_registration' AS relationship_type, 'registry:' || doc || ':company' AS from_id, reg AS to_id FROM r
    UNION ALL SELECT CASE WHEN role IN ('principal', 'mailing') THEN 'business_registration_has_address' ELSE 'business_registration_has_party' END, reg, own FROM r
    UNION ALL SELECT CASE WHEN role IN ('principal', 'mailing') THEN 'business_registration_address_has_address' ELSE 'business_registration_party_has_address' END, own, place FROM r)"""
_UPSERT = """t AS (SELECT o_orderkey AS k, sha256(printf('%.2f', o_totalprice)) AS h, o_custkey AS c, o_orderstatus AS st FROM orders WHERE o_orderkey % 3 <> 0),
s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN sha256(CAST(o_orderkey AS VARCHAR)) ELSE sha256(printf('%.2f', o_totalprice)) END AS h,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS c FROM orders WHERE o_orderkey % 2 = 0),
m AS (SELECT t.k AS tk, s.k AS sk, t.h AS th, s.h AS sh, t.c AS tc, s.c AS sc, t.st, t.h IS DISTINCT FROM s.h OR t.c IS DISTINCT FROM s.c AS ch FROM t FULL JOIN s ON t.k = s.k),
r AS (SELECT 'orders' AS source_system, CAST(coalesce(tk, sk) AS VARCHAR) AS source_record_key, CASE WHEN tk IS NULL OR (sk IS NOT NULL AND ch) THEN sh ELSE th END AS source_record_hash,
    CASE WHEN tk IS NULL OR (sk IS NOT NULL AND ch) THEN sc ELSE tc END AS customer_id, CASE WHEN tk IS NULL OR (sk IS NOT NULL AND ch) THEN 'X' ELSE st END AS status,
    CASE WHEN tk IS NULL THEN 'new' ELSE 'old' END AS created_at,
    CASE WHEN tk IS NULL THEN 'insert' WHEN sk IS NULL THEN 'untouched' WHEN ch THEN 'update' ELSE 'unchanged' END AS action FROM m)"""

ORACLE_SQL = {
    "fixed_width_roundtrip": f"""WITH {_REG} SELECT k AS c_custkey, printf('P%09d', k) AS document_number, c_name AS entity_name, CASE WHEN k % 3 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
        {_NORM.format("street || ' ' || city || ' FL ' || zip || '1234 US'")} AS address, zip || '1234' AS zip, CASE WHEN k % 10 = 0 THEN NULL ELSE '1940-01-24' END AS filed_date,
        k % 4 = 0 AS more_than_six_officers, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS n_reports, 1 AS n_officers, 'Officer ' || k AS officer, 1436 AS raw_record_length FROM reg""",
    "prefix_semijoin": f"""WITH {_REG}, p AS (SELECT DISTINCT substr(lpad(CAST(s_suppkey * 97 % 10000 AS VARCHAR), 4, '0'), 1, CAST(2 + s_suppkey % 3 AS INT)) AS prefix FROM supplier)
        SELECT printf('P%09d', k) AS document_number, role, zip, prefix AS matched_prefix FROM placed JOIN p ON starts_with(zip, prefix)""",
    "entity_graph_vertices": f"""WITH {_REG}, {_PLACES} SELECT place AS request_identifier, min(line) AS unnormalized_address, min(trim(regexp_replace(regexp_replace(replace(upper(city), '.', ''), '[^A-Z\\s\\-'']', ' ', 'g'), '\\s+', ' ', 'g'))) AS city_name,
        'FL' AS state_code, min(substr(zip, 1, 5)) AS postal_code, min(CASE WHEN length(zip) >= 9 THEN substr(zip, 6, 4) END) AS plus_four FROM pl GROUP BY place""",
    "entity_graph_kinds": f"""WITH {_REG}, {_PLACES}, {_EDGES}, v AS (SELECT 'company' AS kind, from_id AS id FROM e WHERE relationship_type LIKE 'company%' UNION ALL SELECT 'business_registration', to_id FROM e WHERE relationship_type LIKE 'company%'
            UNION ALL SELECT 'business_registration_address', to_id FROM e WHERE relationship_type = 'business_registration_has_address' UNION ALL SELECT 'business_registration_party', to_id FROM e WHERE relationship_type = 'business_registration_has_party'
            UNION ALL SELECT DISTINCT 'address', place FROM pl)
        SELECT kind, count(*) AS n, count(DISTINCT id) AS n_ids, min(id) AS least_id FROM v GROUP BY kind""",
    "entity_graph_edges": f"WITH {_REG}, {_PLACES}, {_EDGES} SELECT * FROM e",
    "name_keys": r"""SELECT p_partkey, trim(regexp_replace(upper(p_name || ' & Co., ' || p_type), '[^A-Z0-9]+', ' ', 'g')) AS name_key,
        regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
        regexp_replace(p_brand || '-' || p_partkey, '\D', '', 'g') AS parcel_id, regexp_replace(upper(p_brand || '-' || p_partkey), '[^A-Z0-9]', '', 'g') AS search_key FROM part""",
    "address_keys": r"""WITH r AS (SELECT c_custkey, c_custkey || ' Northwest  Harbor Drive, Apt. #' || (c_custkey % 90) || ', Fort Myers, FL ' || lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') || '-0001' AS raw FROM customer)
        SELECT c_custkey, c_custkey || ' NW HARBOR DR APT ' || (c_custkey % 90) || ' FORT MYERS FL ' || lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') || '-0001' AS address_key,
        c_custkey || ' NORTHWEST HARBOR DR APT ' || (c_custkey % 90) || ' FORT MYERS FL ' || lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') || ' 0001' AS registry_key,
        regexp_extract(raw, 'FL\s+(\d{5})', 1) AS zip, 'NORTHWEST HARBOR DRIVE APT FORT MYERS FL -' AS city FROM r""",
    "typed_values": """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey || '500.75' AS DOUBLE) WHEN 3 THEN CAST('-' || o_orderkey || '.9' AS DOUBLE) END AS number,
        CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey || '500' AS BIGINT) WHEN 3 THEN -o_orderkey END AS integer,
        CASE o_orderkey % 4 WHEN 0 THEN true WHEN 2 THEN false WHEN 3 THEN true END AS flag,
        CASE o_orderkey % 3 WHEN 0 THEN '2021-03-07' WHEN 1 THEN '2021-13-45' END AS day, strftime(o_orderdate, '%Y-%m-%d') AS strict_day FROM orders""",
    "orphan_customers": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "candidate_ranking": """WITH o AS (SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS latest FROM orders GROUP BY 1)
        SELECT c_custkey, n_name, coalesce(n_orders, 0) AS n_orders, latest FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        ORDER BY CASE WHEN n_orders IS NULL THEN 0 WHEN n_orders < 8 THEN 1 ELSE 2 END, latest DESC NULLS LAST, c_custkey LIMIT 40 OFFSET 20""",
    "fk_resolution": """SELECT p_brand AS brand, s_nationkey AS nation, count(*) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_partkey % 7 <> 0
        JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "any_key_link": r"""WITH j AS (SELECT c_custkey, s_suppkey, s_acctbal, CASE WHEN s_suppkey = c_custkey * 2 THEN 1
        WHEN CAST(regexp_replace(s_name, '\D', '', 'g') AS BIGINT) = CAST(regexp_replace(c_name, '\D', '', 'g') AS BIGINT) % 500 THEN 2 ELSE 3 END AS key_no
        FROM customer JOIN supplier ON s_suppkey = c_custkey * 2 OR CAST(regexp_replace(s_name, '\D', '', 'g') AS BIGINT) = CAST(regexp_replace(c_name, '\D', '', 'g') AS BIGINT) % 500 OR s_nationkey = c_nationkey)
        SELECT c_custkey, key_no, s_suppkey FROM j QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY key_no, s_acctbal DESC, s_suppkey) = 1""",
    "any_key_anti": """WITH w AS (SELECT p_partkey * 3 AS k FROM part UNION SELECT p_partkey // 2 * 5 FROM part WHERE p_partkey % 2 = 0)
        SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT k FROM w) AND c_custkey * 10 NOT IN (SELECT k FROM w)""",
    "hash_guard_upsert": f"WITH {_UPSERT} SELECT * FROM r",
    "upsert_counters": f"""WITH {_UPSERT} SELECT count(*) FILTER (action <> 'untouched') AS attempted, count(*) FILTER (action IN ('insert', 'update')) AS changed,
        count(*) FILTER (action = 'unchanged') AS unchanged FROM r""",
    "keep_first": "SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) = 1",
    "keep_best": "SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1",
    "chunk_batches": """SELECT o_custkey, batch, count(*) AS n, min(o_orderkey) AS first_order FROM (SELECT o_custkey, o_orderkey,
        (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS batch FROM orders) GROUP BY ALL""",
    "date_windows": """WITH s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1),
        w AS (SELECT o_custkey, b, a + CAST(unnest(range(0, b - a + 1, 30)) AS INT) AS window_start FROM s)
        SELECT o_custkey, CAST(window_start AS VARCHAR) AS window_start, CAST(least(window_start + 29, b) AS VARCHAR) AS window_end, CAST(least(window_start + 29, b) - window_start + 1 AS INT) AS days FROM w""",
    "date_bisect": """WITH RECURSIVE d AS MATERIALIZED (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
        w AS (SELECT min(day) AS a, max(day) AS b, sum(n) AS n FROM d UNION ALL
            SELECT p.a, p.b, coalesce(sum(d.n), 0) FROM (SELECT CASE h WHEN 0 THEN a ELSE a + CAST((b - a) // 2 AS INT) + 1 END AS a, CASE h WHEN 0 THEN a + CAST((b - a) // 2 AS INT) ELSE b END AS b
                FROM w, (VALUES (0), (1)) AS v(h) WHERE b > a AND n >= 1000) AS p LEFT JOIN d ON d.day BETWEEN p.a AND p.b GROUP BY p.a, p.b)
        SELECT CAST(a AS VARCHAR) AS window_start, CAST(b AS VARCHAR) AS window_end, CAST(n AS BIGINT) AS n FROM w WHERE b = a OR n < 1000""",
    "union_by_name": "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
    "set_difference": "SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier",
    "catalog_merge": """WITH s AS (SELECT s_nationkey AS nation, max(s_acctbal) AS best FROM supplier WHERE s_nationkey % 5 <> 2 GROUP BY 1),
        c AS (SELECT c_nationkey AS nation, count(*) AS n_customers FROM customer WHERE c_nationkey % 4 <> 1 GROUP BY 1)
        SELECT nation, CASE WHEN best > 9000 THEN 'kept' WHEN n_customers IS NOT NULL AND best IS NULL THEN 'added' WHEN n_customers IS NOT NULL THEN 'replaced' ELSE 'kept' END AS state, n_customers
        FROM s FULL JOIN c USING (nation)""",
}
