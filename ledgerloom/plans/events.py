"""Event analytics over `events`: an error event is a failed step of its user's execution, props.k its error code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates, dedupe, state, upsert
from .tables import table


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    return e.select(
        F.col("user_id").alias("execution_id"), F.format_string("%05d", F.get_json_object("props", "$.k").cast("int")).alias("code"), F.col("props").alias("details"), F.col("event_id").alias("pos")
    ).where("code is not null")


ERRORS_SQL = """errs AS (SELECT user_id AS execution_id, lpad(json_extract_string(props, '$.k'), 5, '0') AS code, props AS details, event_id AS pos
    FROM events WHERE event_type = 'error' AND json_extract_string(props, '$.k') IS NOT NULL),
occ AS (SELECT execution_id, code, count(*) AS occurrences, arg_min(details, pos) AS details, min(pos) AS first_pos FROM errs GROUP BY ALL)"""


def error_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.error_occurrences(_errors(spark, sf_dir))


def execution_error_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.execution_stats(error_occurrences(spark, sf_dir))


def top_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten executions with the most unique errors; equal ones in descending order of id, as the sort key has it."""
    return execution_error_stats(spark, sf_dir).orderBy(F.desc("unique_errors"), F.desc("execution_id")).limit(10)


def top_error_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of ten codes by total: what follows the tenth one in (count, code) order."""
    totals = aggregates.code_totals(error_occurrences(spark, sf_dir)).select("code", "total_count", "n_executions")
    cursor = totals.orderBy(F.desc("total_count"), F.desc("code")).limit(10).agg(F.min(F.struct("total_count", "code")).alias("c"))
    page = totals.join(F.broadcast(cursor), F.struct("total_count", "code") < F.col("c")).drop("c")
    return page.orderBy(F.desc("total_count"), F.desc("code")).limit(10)


def two_hop_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All executions that share a code with the execution that has the fewest unique errors, and the shared codes."""
    occ = error_occurrences(spark, sf_dir)
    stats = aggregates.execution_stats(occ)
    first = stats.orderBy("unique_errors", "execution_id").limit(1).select("execution_id")
    codes = occ.join(F.broadcast(first), "execution_id", "left_semi").select("code")
    return occ.join(F.broadcast(codes), "code", "left_semi").select("execution_id", "code", "occurrences")


def cdc_decrement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of codes below 30 are removed: counts fall by the removed links, and executions at zero are to restart."""
    occ = error_occurrences(spark, sf_dir)
    state = occ.groupBy("execution_id").agg(F.count("*").alias("open_errors"))
    removed = occ.where("code < '00030'").groupBy("execution_id").agg(F.count("*").alias("n"))
    out = upsert.decrement(state, removed, "execution_id", "open_errors", "n")
    return out.select("execution_id", "open_errors", F.coalesce("success", F.lit(False)).alias("success"), (F.coalesce("success", F.lit(False)) & (F.col("open_errors") == 0)).alias("restart"))


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.create_map(*[F.lit(x) for x in ("click", "IN_PROGRESS", "view", "IN_PROGRESS", "purchase", "SUCCEEDED", "signup", "SUCCEEDED", "error", "FAILED")])
    return table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("phase"), F.try_element_at(status, "event_type").alias("status"), F.lit(1.0).alias("value"))


def in_progress_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge of each of seven phases; phase 3 doesn't subtract failures."""
    return aggregates.in_progress(_statuses(spark, sf_dir), (3,))


def success_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success and failures by county (user id modulo 11), with failed steps named by code range and a residual."""
    e = table(spark, sf_dir, "events").withColumn("county", (F.col("user_id") % 11).cast("string"))
    ok = e.where("event_type = 'purchase'").groupBy("county").agg(F.count("*").alias("succeeded"))
    bad = e.where("event_type = 'error'")
    step = F.when(F.get_json_object("props", "$.k").cast("int") < 30, "low").when(F.get_json_object("props", "$.k").cast("int") < 60, "mid").otherwise("unknown")
    return aggregates.success_report(ok, bad.groupBy("county").agg(F.count("*").alias("failed")), bad.groupBy("county", step.alias("step")).agg(F.count("*").alias("n")))


def phase_metric_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "5 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("decimal(18,6)")), 2).cast("double").alias("total")).select(F.col("w.start").alias("bucket"), "event_type", "n", "total")


def phase_metric_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "30 days").alias("w"), "event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users")).select(F.col("w.start").alias("bucket"), "event_type", "n", "users")


def latest_phase_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user, by time and id."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("at"))


def error_hash_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _errors(spark, sf_dir)
    return aggregates.hashed_errors(e.select(F.concat(F.lit("code "), "code").alias("message"), (F.col("execution_id") % 5).cast("string").alias("path"), F.lit("lee").alias("county"), "pos"))


def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event of each user at the place of the first one."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return dedupe.last_at_first_place(e, ["user_id"], "event_id")


def cap_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return dedupe.capped(e, ["user_id", "event_type"], ["event_id"], 5)


def mark_unrecoverable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links after marking execution 1 and code 00042: the execution's links and codes, and all links of the code."""
    occ = error_occurrences(spark, sf_dir)
    codes = occ.where("execution_id = 1").select("code").unionByName(occ.where("code = '00042'").select("code")).distinct()
    hit = occ.join(F.broadcast(codes.withColumn("hit", F.lit(True))), "code", "left")
    link = (F.col("execution_id") == 1) | (F.col("code") == "00042")
    return hit.select("execution_id", "code", F.when(link, "maybeUnrecoverable").otherwise("failed").alias("link_status"), F.coalesce("hit", F.lit(False)).alias("code_marked"))


def unrecoverable_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions, links and code records after execution 1 is given up, and then code 00042; others share its codes."""
    occ = error_occurrences(spark, sf_dir)
    links = occ.select("execution_id", F.col("code").alias("error_code"), F.when(F.col("occurrences") > 1, "maybeSolved").otherwise("failed").alias("status"))
    executions = aggregates.execution_stats(occ).select("execution_id", F.lit("failed").alias("status"))
    records = aggregates.code_totals(occ).select(F.col("code").alias("error_code"), F.lit("failed").alias("status"))
    tables = state.unrecoverable(*state.unrecoverable(executions, links, records, execution_id="1"), code="00042")
    named = zip(("execution", "link", "record"), tables)
    out = [df.select(F.lit(kind).alias("kind"), *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (("execution_id", "long"), ("error_code", "string"))], "status") for kind, df in named]
    return out[0].union(out[1]).union(out[2])


def extreme_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions with the most and the least unique errors, of all and of a type; many have equal counts."""
    e = execution_error_stats(spark, sf_dir).select("execution_id", "error_type", F.col("unique_errors").alias("open_error_count"), F.when(F.col("execution_id") % 7 == 0, "RESOLVED").otherwise("FAILED").alias("status"))
    asked = [("most", {}), ("least", {"least": True}), ("most of 00", {"kind": "00"}), ("least of 000", {"kind": "000", "least": True})]
    out = None
    for name, how in asked:
        one = state.extremes(e, **how).select(F.lit(name).alias("asked"), "execution_id", "open_error_count")
        out = one if out is None else out.union(one)
    return out


QUERIES = {f.__name__: f for f in (error_occurrences, execution_error_stats, top_executions, top_error_codes, two_hop_resolution, cdc_decrement, in_progress_gauge, success_report, phase_metric_5m, phase_metric_30d, latest_phase_status, error_hash_dedupe, keep_last, cap_per_key, mark_unrecoverable, unrecoverable_tables, extreme_executions)}

_STATS = ERRORS_SQL + """, stats AS (SELECT execution_id, CAST(sum(occurrences) AS BIGINT) AS total_occurrences, count(*) AS unique_errors,
    substr(arg_min(code, first_pos), 1, 2) AS error_type, printf('%010d', count(*)) AS sort_key FROM occ GROUP BY execution_id)"""
_TOTALS = ERRORS_SQL + ", totals AS (SELECT code, CAST(sum(occurrences) AS BIGINT) AS total_count, count(*) AS n_executions FROM occ GROUP BY code)"

ORACLE_SQL = {
    "error_occurrences": f"WITH {ERRORS_SQL} SELECT * FROM occ",
    "execution_error_stats": f"WITH {_STATS} SELECT * FROM stats",
    "top_executions": f"WITH {_STATS} SELECT * FROM stats ORDER BY unique_errors DESC, execution_id DESC LIMIT 10",
    "top_error_codes": f"WITH {_TOTALS} SELECT * FROM totals ORDER BY total_count DESC, code DESC LIMIT 10 OFFSET 10",
    "two_hop_resolution": f"""WITH {_STATS}, one AS (SELECT execution_id FROM stats ORDER BY unique_errors, execution_id LIMIT 1)
        SELECT execution_id, code, occurrences FROM occ WHERE code IN (SELECT code FROM occ WHERE execution_id IN (SELECT * FROM one))""",
    "cdc_decrement": f"""WITH {ERRORS_SQL}, s AS (SELECT execution_id, count(*) AS o, count(*) FILTER (code < '00030') AS n FROM occ GROUP BY ALL)
        SELECT execution_id, o - n AS open_errors, n > 0 AS success, n > 0 AND o = n AS restart FROM s""",
    "in_progress_gauge": """WITH c AS (SELECT user_id % 7 AS phase, count(*) FILTER (event_type IN ('click', 'view')) AS a,
        count(*) FILTER (event_type IN ('purchase', 'signup')) AS b, count(*) FILTER (event_type = 'error') AS f FROM events GROUP BY ALL)
        SELECT phase, CAST(greatest(0, a - b - CASE WHEN phase = 3 THEN 0 ELSE f END) AS DOUBLE) AS in_progress FROM c""",
    "success_report": """WITH e AS (SELECT CAST(user_id % 11 AS VARCHAR) AS county, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
        c AS (SELECT county, count(*) FILTER (event_type = 'purchase') AS succeeded, count(*) FILTER (event_type = 'error') AS failed FROM e GROUP BY ALL),
        s AS (SELECT county, CASE WHEN k < 30 THEN 'low' WHEN k < 60 THEN 'mid' ELSE 'unknown' END AS step, count(*) AS n FROM e WHERE event_type = 'error' GROUP BY ALL)
        SELECT c.county, succeeded, failed, 100.0 * succeeded / (succeeded + failed) AS success_rate, step, n FROM c LEFT JOIN s USING (county)
        WHERE succeeded + failed > 0""",
    "phase_metric_5m": "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, event_type, count(*) AS n, CAST(round(sum(CAST(value AS DECIMAL(18, 6))), 2) AS DOUBLE) AS total FROM events GROUP BY ALL",
    "phase_metric_30d": "SELECT time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') AS bucket, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL",
    "latest_phase_status": "SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS at FROM events GROUP BY user_id",
    "error_hash_dedupe": f"""WITH {ERRORS_SQL}, m AS (SELECT 'code ' || code AS message, CAST(execution_id % 5 AS VARCHAR) AS path, pos FROM errs)
        SELECT sha256(message || '#' || path || '#lee') AS error_hash, count(*) AS occurrences, arg_min(message, pos) AS message, min(pos) AS first_pos FROM m GROUP BY 1""",
    "keep_last": "SELECT user_id, min(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "cap_per_key": """SELECT user_id, event_id, event_type, n > 5 AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r,
        count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) WHERE r <= 5""",
    "mark_unrecoverable": f"""WITH {ERRORS_SQL} SELECT execution_id, code, CASE WHEN execution_id = 1 OR code = '00042' THEN 'maybeUnrecoverable' ELSE 'failed' END AS link_status,
        code = '00042' OR code IN (SELECT code FROM occ WHERE execution_id = 1) AS code_marked FROM occ""",
    "unrecoverable_tables": f"""WITH {ERRORS_SQL}, hit AS (SELECT execution_id, code FROM occ WHERE execution_id = 1 OR code = '00042')
        SELECT 'execution' AS kind, execution_id, NULL AS error_code, CASE WHEN execution_id = 1 OR execution_id IN (SELECT execution_id FROM hit WHERE code = '00042') THEN 'maybeUnrecoverable' ELSE 'failed' END AS status FROM (SELECT DISTINCT execution_id FROM occ)
        UNION ALL SELECT 'link', execution_id, code, CASE WHEN execution_id = 1 OR code = '00042' THEN 'maybeUnrecoverable' WHEN occurrences > 1 THEN 'maybeSolved' ELSE 'failed' END FROM occ
        UNION ALL SELECT 'record', NULL, code, CASE WHEN code IN (SELECT code FROM hit) THEN 'maybeUnrecoverable' ELSE 'failed' END FROM (SELECT DISTINCT code FROM occ)""",
    "extreme_executions": f"""WITH {_STATS}, f AS (SELECT CAST(execution_id AS VARCHAR) AS id, execution_id, error_type, unique_errors AS n FROM stats WHERE execution_id % 7 <> 0)
        SELECT 'most' AS asked, execution_id, n AS open_error_count FROM (SELECT * FROM f ORDER BY n DESC, id DESC LIMIT 1) UNION ALL SELECT 'least', execution_id, n FROM (SELECT * FROM f ORDER BY n, id LIMIT 1)
        UNION ALL SELECT 'most of 00', execution_id, n FROM (SELECT * FROM f WHERE error_type = '00' ORDER BY n DESC, id DESC LIMIT 1)""",
}
