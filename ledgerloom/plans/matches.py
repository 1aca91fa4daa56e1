"""Address inputs against registries, merged details, compound owners, and rows written with their failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_merge, owners
from ..operators.address_match import address_matches
from ..sources.parts import split_write
from ..session import work_folder
from .tables import table

STREETS = ["HARBOR", "OAK", "PALM BAY", "HARBORSIDE", "OLD OAK"]


def address_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's address, with the tests that it states, among those of all customers; three matches at most."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    k, n = F.col("c_custkey"), F.col("s_suppkey")
    street = lambda x: F.element_at(F.array(*map(F.lit, STREETS)), (x % len(STREETS) + 1).cast("int"))
    rows = c.select(k.alias("row_no"), F.when(k % 97 != 0, F.concat((k % 50).cast("string"), F.lit(" N "), street(k), F.lit(" DR"))).alias("address"), F.concat(F.lit("CITY "), (k % 4).cast("string"), F.lit(" BEACH")).alias("city"), F.when(k % 3 == 0, "FL").otherwise("GA").alias("state"), F.concat(F.lit("339"), F.lpad((k % 20).cast("string"), 2, "0"), F.lit("1234")).alias("zip"))
    query = F.when(n % 4 == 0, F.concat((n % 50).cast("string"), F.lit(" "), street(n))).when(n % 4 == 1, street(n)).when(n % 4 == 2, F.concat(F.lit("N "), F.substring(street(n), 1, 3))).otherwise(F.concat((n % 50).cast("string"), F.lit(" DR")))
    inputs = s.select(n.alias("input_id"), F.when(n % 31 != 0, query).alias("query"), F.when(n % 3 == 0, F.concat(F.lit("city "), (n % 4).cast("string"))).alias("city"), F.when(n % 5 == 0, "fl").alias("state"), F.when(n % 7 == 0, F.concat(F.lit("339"), F.lpad((n % 20).cast("string"), 2, "0"), F.lit("-9"))).otherwise("").alias("zip"))
    return address_matches(inputs, rows, 3)


def merged_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of each order's permit merged with its target's: parcel numbers are filled where blank and kept where not."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    own = F.to_json(F.struct(F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("P"), k.cast("string"))).alias("parcel"), F.struct(F.col("o_orderstatus").alias("status"), F.array(F.lit(1)).alias("list")).alias("more")), {"ignoreNullFields": "false"})
    other = F.to_json(F.struct(F.lit("T").alias("parcel"), F.struct(F.lit("F").alias("status"), F.array(F.lit(2)).alias("list"), F.lit(True).alias("new")).alias("more")))
    out = o.select("o_orderkey", json_merge.merged(F.when(k % 7 != 0, own).otherwise("{bad"), other).alias("m"))
    part = lambda path: F.get_json_object("m.merged", path)
    return out.select("o_orderkey", part("$.parcel").alias("parcel"), part("$.more.status").alias("status"), part("$.more.list[0]").alias("first"), part("$.more.new").alias("new"), F.array_join("m.conflicts", ",").alias("conflicts"))


COMPOUNDS = ["john & mary anne SMITH{}", "DOE{}, JANE Q", "ACME{} Holdings LLC; Bob", "al and bo and o'neil-roe{}", "<br>LEE{} III, ann b<BR/>; pat roe{} jr.", "Bank{} street", "x{} & y"]


def compound_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners of every customer's line in the second grammar."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    line = F.replace(F.element_at(F.array(*map(F.lit, COMPOUNDS)), (k % len(COMPOUNDS) + 1).cast("int")), F.lit("{}"), F.concat(F.lit("q"), F.translate(k.cast("string"), "0123456789", "abcdefghij")))
    return c.select("c_custkey", F.posexplode(owners.compound_owners(line)).alias("i", "o")).select("c_custkey", (F.col("i") + 1).alias("ordinal"), "o.kind", "o.first_name", "o.middle_name", "o.last_name", "o.company")


def split_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as good rows and failures with a manifest; its counts beside those of the files."""
    d = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "split-sink")
    manifest = split_write(d.select("doc_id", "lang", F.length("text").alias("size")), F.col("size") >= 200, folder, {"chars": F.col("size")}, records=1000)
    files = spark.read.schema("doc_id long, size long, dataset string").option("basePath", folder).json(f"{folder}/dataset=*")
    counts = files.groupBy("dataset").agg(F.count("*").alias("in_files"), F.sum("size").alias("chars_in_files"))
    stated = F.create_map(*[F.lit(x) for k in ("profiles", "failures") for x in (k, manifest["counts"][k])])
    return counts.select("dataset", "in_files", "chars_in_files", F.try_element_at(stated, F.col("dataset")).cast("long").alias("in_manifest"), F.lit(manifest["counts"]["chars"]).cast("long").alias("chars"))


QUERIES = {f.__name__: f for f in (address_inputs, merged_details, compound_names, split_sink)}


def _street(x: str) -> str:
    return f"{STREETS}[{x} % {len(STREETS)} + 1]"


ORACLE_SQL = {
    "address_inputs": f"""WITH r AS (SELECT c_custkey AS row_no, CASE WHEN c_custkey % 97 <> 0 THEN (c_custkey % 50) || ' N ' || {_street("c_custkey")} || ' DR' END AS address, 'CITY ' || (c_custkey % 4) || ' BEACH' AS city, CASE WHEN c_custkey % 3 = 0 THEN 'FL' ELSE 'GA' END AS state, '339' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS zip FROM customer),
        i AS (SELECT s_suppkey AS input_id, s_suppkey AS n, CASE WHEN s_suppkey % 31 <> 0 THEN CASE s_suppkey % 4 WHEN 0 THEN (s_suppkey % 50) || ' ' || {_street("s_suppkey")} WHEN 1 THEN {_street("s_suppkey")} WHEN 2 THEN 'N ' || substr({_street("s_suppkey")}, 1, 3) ELSE (s_suppkey % 50) || ' DR' END END AS q FROM supplier),
        m AS (SELECT input_id, row_no, row_number() OVER (PARTITION BY input_id ORDER BY row_no) AS r FROM i JOIN r ON (contains(address, q) OR ' ' || address || ' ' LIKE '% ' || replace(q, ' ', ' %') || ' %')
            AND (n % 3 <> 0 OR contains(city, 'CITY ' || (n % 4))) AND (n % 5 <> 0 OR state = 'FL') AND (n % 7 <> 0 OR zip = '339' || lpad(CAST(n % 20 AS VARCHAR), 2, '0'))),
        t AS (SELECT input_id, count(*) >= 3 AND max(row_no) FILTER (r <= 3) < (SELECT max(c_custkey) FROM customer) AS truncated FROM m GROUP BY 1)
        SELECT input_id, row_no, truncated FROM m JOIN t USING (input_id) WHERE r <= 3""",
    "merged_details": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 3 <> 1 THEN 'T' ELSE 'P' || o_orderkey END AS parcel, CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 7 = 0 THEN '2' ELSE '1' END AS first, 'true' AS new,
        CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '$.more.list' || CASE WHEN o_orderstatus <> 'F' THEN ',$.more.status' ELSE '' END || CASE WHEN o_orderkey % 3 = 1 THEN ',$.parcel' ELSE '' END END AS conflicts FROM orders""",
    "compound_names": """WITH c AS (SELECT c_custkey AS k, c_custkey % 7 AS m, 'q' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') AS q FROM customer), t AS (
        SELECT k, 1 AS ordinal, 'person' AS kind, 'John' AS first_name, NULL AS middle_name, 'Smith' || q AS last_name, NULL AS company FROM c WHERE m = 0 UNION ALL SELECT k, 2, 'person', 'Mary', 'Anne', 'Smith' || q, NULL FROM c WHERE m = 0
        UNION ALL SELECT k, 1, 'person', 'Jane', 'Q', 'Doe' || q, NULL FROM c WHERE m = 1
        UNION ALL SELECT k, 1, 'company', NULL, NULL, NULL, 'Acme' || q || ' Holdings Llc' FROM c WHERE m = 2 UNION ALL SELECT k, 2, 'rejected', NULL, NULL, NULL, NULL FROM c WHERE m = 2
        UNION ALL SELECT k, i, 'rejected', NULL, NULL, NULL, NULL FROM c, (SELECT unnest([1, 2, 3]) AS i) WHERE m = 3
        UNION ALL SELECT k, 1, 'person', 'Ann', 'B', 'Lee' || q, NULL FROM c WHERE m = 4 UNION ALL SELECT k, 2, 'rejected', NULL, NULL, NULL, NULL FROM c WHERE m = 4
        UNION ALL SELECT k, 1, 'person', 'Bank' || q, NULL, 'Street', NULL FROM c WHERE m = 5
        UNION ALL SELECT k, i, 'rejected', NULL, NULL, NULL, NULL FROM c, (SELECT unnest([1, 2]) AS i) WHERE m = 6)
        SELECT k AS c_custkey, CAST(ordinal AS INT) AS ordinal, kind, first_name, middle_name, last_name, company FROM t""",
    "split_sink": """WITH d AS (SELECT length(text) AS size, CASE WHEN length(text) >= 200 THEN 'profiles' ELSE 'failures' END AS dataset FROM documents)
        SELECT dataset, count(*) AS in_files, CAST(sum(size) AS BIGINT) AS chars_in_files, count(*) AS in_manifest, (SELECT CAST(sum(size) AS BIGINT) FROM d) AS chars FROM d GROUP BY 1""",
}
