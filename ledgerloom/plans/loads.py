"""Loads of several tables at once, and runs over sources that can stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.snapshots import Snapshots
from ..session import work_folder
from ..sources import seed_feed
from ..streaming import running_totals
from .tables import table


def _prepared(name: str, key: Column, body: Column, refs: Column) -> list[Column]:
    return [F.lit(name).alias("table_name"), key.alias("source_record_key"), F.sha2(body, 256).alias("source_record_hash"), refs.alias("refs"), F.create_map(F.lit("body"), body).alias("values")]


def atomic_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as properties and orders as their improvements in two loads: the first lacks every other customer, the
    second brings them, which heals the references to them, and changes every third order."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    customer = F.concat(F.lit("c:"), F.col("c_custkey").cast("string"))
    property_of = F.create_map(F.lit("property_source_record_key"), F.concat(F.lit("c:"), F.col("o_custkey").cast("string")))
    key = F.concat(F.lit("o:"), F.col("o_orderkey").cast("string"))
    properties = c.select("c_custkey", *_prepared("properties", customer, F.col("c_name"), nothing))
    first = o.select(*_prepared("property_improvements", key, F.col("o_orderstatus"), property_of))
    second = o.select(*_prepared("property_improvements", key, F.concat("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "!").otherwise("")), property_of))
    store = Snapshots(spark, work_folder(spark, "atomic-load"))
    order = ["properties", "property_improvements"]
    loads = [store.load(properties.where("c_custkey % 2 = 0").drop("c_custkey").union(first), order), store.load(properties.drop("c_custkey").union(second), order)]
    counts = loads[0].union(loads[1])
    linked = None
    for t in order:
        for v in (1, 2):
            one = store.table(t, v).agg(F.lit(t).alias("table_name"), F.lit(v).alias("version"), F.sum(F.size("ids")).alias("resolved"))
            linked = one if linked is None else linked.union(one)
    return counts.join(F.broadcast(linked), ["table_name", "version"])


def exact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all users' error events by a stream over the table: codes come again, and purchases remove a code."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 100).parquet(f"{sf_dir}/events.parque[t]")  # a pattern may name one file, too
    code = F.format_string("%05d", F.get_json_object("props", "$.k").cast("int") % 20)
    codes = F.when(F.get_json_object("props", "$.k").isNotNull(), F.when(F.col("event_id") % 3 == 0, F.array(code, code)).otherwise(F.array(code)))
    kind = F.when(F.col("event_type") == "error", running_totals.ERROR).when(F.col("event_type") == "purchase", running_totals.REMOVED)
    changes = e.select(F.col("user_id").cast("string").alias("execution_id"), F.col("event_id").cast("long").alias("pos"), kind.alias("kind"), codes.alias("codes")).where("kind is not null")
    out = running_totals.run_to_end(spark, changes, work_folder(spark, "exact-totals"))
    return out.where("n_events > 0")


def seed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as a CSV seed and fed by its stored state in three batches and what is left: rows without a
    positive balance are invalid, every tenth customer exists already. One row for each state."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("he said \"hi\",\n"), "c_name").alias("name"), "c_acctbal")
    folder = work_folder(spark, "seed-scan")
    c.repartitionByRange(3, "c_custkey").sortWithinPartitions("c_custkey").write.option("header", True).option("escape", '"').csv(f"{folder}/seed")
    feed = seed_feed.SeedFeed(spark, f"{folder}/feed")
    seed_feed.seed_rows(spark, f"{folder}/seed/part-*").write.parquet(f"{folder}/rows")  # numbered once for all steps
    rows = spark.read.parquet(f"{folder}/rows")
    known = c.where("c_custkey % 10 = 0").select(F.col("c_custkey").cast("string").alias("c_custkey"))
    batch = c.count() // 4
    states = []
    while not states or not states[-1].exhausted:
        states.append(feed.step(rows, batch, F.col("c_acctbal").cast("double") > 0, known, ("c_custkey",)))
    out = spark.createDataFrame([(i, s.next_row, s.accepted, s.skipped_existing, s.skipped_invalid, s.exhausted) for i, s in enumerate(states, 1)], "step int, next_row long, accepted long, skipped_existing long, skipped_invalid long, exhausted boolean")
    took = feed.accepted().agg(F.count("*").alias("rows"), F.countDistinct("row_no").alias("distinct_rows"), F.sum(F.length("name")).alias("name_chars"))
    return out.crossJoin(F.broadcast(took))  # one row


QUERIES = {f.__name__: f for f in (atomic_load, exact_totals, seed_scan)}
ORACLE_SQL = {
    "atomic_load": """WITH o AS (SELECT o_custkey % 2 = 0 AS there, o_orderkey % 3 = 0 AS other FROM orders)
        SELECT 'properties' AS table_name, 1 AS version, count(*) AS attempted, count(*) AS changed, CAST(0 AS BIGINT) AS unchanged, count(*) AS total, CAST(0 AS BIGINT) AS resolved FROM customer WHERE c_custkey % 2 = 0
        UNION ALL SELECT 'properties', 2, count(*), count(*) FILTER (c_custkey % 2 <> 0), count(*) FILTER (c_custkey % 2 = 0), count(*), 0 FROM customer
        UNION ALL SELECT 'property_improvements', 1, count(*), count(*), 0, count(*), count(*) FILTER (there) FROM o
        UNION ALL SELECT 'property_improvements', 2, count(*), count(*) FILTER (NOT there OR other), count(*) FILTER (there AND NOT other), count(*), count(*) FROM o""",
    "exact_totals": """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS execution_id, event_id AS pos, event_type = 'error' AS is_error, lpad(CAST(CAST(json_extract_string(props, '$.k') AS INT) % 20 AS VARCHAR), 5, '0') AS code
            FROM events WHERE event_type IN ('error', 'purchase') AND json_extract_string(props, '$.k') IS NOT NULL),
        c AS (SELECT execution_id, code, arg_max(is_error, pos) AS is_open FROM e GROUP BY 1, 2 HAVING bool_or(is_error)),
        u AS (SELECT execution_id, count(*) AS unique_errors, count(*) FILTER (is_open) AS open_errors FROM c GROUP BY 1)
        SELECT execution_id, CAST(sum(CASE WHEN pos % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS total_occurrences, any_value(unique_errors) AS unique_errors, any_value(open_errors) AS open_errors, substr(arg_max(code, pos), 1, 2) AS error_type, count(*) AS n_events
        FROM e JOIN u USING (execution_id) WHERE is_error GROUP BY 1""",
    "seed_scan": """WITH c AS (SELECT row_number() OVER (ORDER BY c_custkey) AS r, CASE WHEN c_acctbal > 0 THEN CASE WHEN c_custkey % 10 = 0 THEN 'existing' ELSE 'accepted' END ELSE 'invalid' END AS kind, c_name FROM customer),
        a AS (SELECT *, sum(CASE WHEN kind = 'accepted' THEN 1 ELSE 0 END) OVER (ORDER BY r) AS n, (SELECT count(*) // 4 FROM customer) AS batch FROM c),
        s AS (SELECT n // batch AS step, min(r) AS last FROM a WHERE kind = 'accepted' AND n % batch = 0 GROUP BY 1 UNION ALL SELECT max(n) // max(batch) + 1, max(r) FROM a),
        k AS (SELECT count(*) AS rows, CAST(sum(length(c_name) + 14) AS BIGINT) AS name_chars FROM c WHERE kind = 'accepted')
        SELECT CAST(step AS INT) AS step, last + 1 AS next_row, count(*) FILTER (kind = 'accepted') AS accepted, count(*) FILTER (kind = 'existing') AS skipped_existing, count(*) FILTER (kind = 'invalid') AS skipped_invalid,
        step = (SELECT max(step) FROM s) AS exhausted, any_value(k.rows) AS rows, any_value(k.rows) AS distinct_rows, any_value(k.name_chars) AS name_chars FROM s JOIN a ON r <= last, k GROUP BY step, last""",
}
