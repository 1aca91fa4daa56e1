"""Pages, links and sections: document extraction with built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import pages, rules, text
from .tables import spread, table


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("body"))
    return p.select("page_id", F.length("body").cast("long").alias("n_chars"), F.sha2("body", 256).alias("body_sha256"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each page in order: the first of each address, numbered."""
    p = table(spark, sf_dir, "pages")
    hrefs = F.array_distinct(F.regexp_extract_all("html", F.lit(r'<a\s+href="([^"]*)"'), F.lit(1)))
    return p.select("page_id", F.posexplode(hrefs).alias("i", "href")).select("page_id", (F.col("i") + 1).cast("long").alias("ordinal"), "href")


def page_links_most(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each host: pages, links, and the page with the most links, the least id on ties."""
    links = page_links(spark, sf_dir).groupBy("page_id").agg(F.count("*").alias("n"))
    p = table(spark, sf_dir, "pages").select("page_id", text.host(F.col("url")).alias("host")).join(links, "page_id", "left").fillna(0, ["n"])
    return p.groupBy("host").agg(F.count("*").alias("pages"), F.sum("n").alias("links"), F.max_by("page_id", F.struct("n", -F.col("page_id"))).alias("most"))


def url_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    host = text.host(F.col("url"))
    number = F.regexp_extract("url", r"[?&]page=(\d+)", 1).try_cast("int")
    status = F.element_at(F.array(*map(F.lit, [200, 301, 403, 503, 404])), (F.col("page_id") % 5 + 1).cast("int"))
    return p.select(
        "page_id", host.alias("host"), rules.external_link_kind(host).alias("kind"), number.alias("page_number"), F.nullif(F.regexp_extract("url", r"#(.*)$", 1), F.lit("")).alias("fragment"),
        rules.by_pattern(F.col("url"), [("blog", r"//blog\."), ("mobile", r"//m\."), ("www", r"//www\.")], "plain").alias("site"), rules.reachability(status, F.col("html"), ("track(1",)).alias("reach"),
    )


def section_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank lines of conversation turns as blocks: the line where each starts and where the next one does."""
    c = table(spark, sf_dir, "conversations")
    lines = c.select("conv_id", "turn", F.size(F.split("text", "\n")).alias("n"), F.posexplode(F.split("text", "\n")).alias("start", "line")).where(F.trim("line") != "")
    after = F.lead("start").over(Window.partitionBy("conv_id", "turn").orderBy("start"))
    return lines.select("conv_id", "turn", "start", F.coalesce(after, "n").alias("next_start"), F.length("line").cast("long").alias("n_chars"))


def label_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels read back from a text block made of an order's fields."""
    o = table(spark, sf_dir, "orders")
    block = F.concat_ws("\n", F.concat(F.lit("Status: "), "o_orderstatus"), F.concat(F.lit("PRIORITY:  "), "o_orderpriority", F.lit(" ")), F.lit("Note:"), F.concat(F.lit("Showing "), F.col("o_orderkey").cast("string"), F.lit("-20 of 1,345")))
    r = r"Showing ([\d,]+)-([\d,]+) of ([\d,]+)"
    return o.select("o_orderkey", text.labelled(block, "status").alias("status"), text.labelled(block, "priority").alias("priority"), text.labelled(block, "note").alias("note"), text.integer(F.regexp_extract(block, r, 1)).alias("first_row"), text.integer(F.regexp_extract(block, r, 3)).alias("total"))


def json_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical hash of every event's JSON: key order and white space don't matter."""
    return table(spark, sf_dir, "events").select("event_id", text.canonical_json_hash(F.col("props")).alias("hash"))


def field_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fnn: value pairs of a text into a map, and one row for each entry."""
    p = table(spark, sf_dir, "part")
    block = F.concat(F.lit("F01: "), "p_brand", F.lit("; F02: "), "p_type", F.lit("; F07: "), F.col("p_size").cast("string"), F.lit(";"))
    m = F.map_from_arrays(F.regexp_extract_all(block, F.lit(r"(F\d\d): ([^;]*);"), F.lit(1)), F.regexp_extract_all(block, F.lit(r"(F\d\d): ([^;]*);"), F.lit(2)))
    return p.select("p_partkey", F.explode(m).alias("field", "value"))


def turn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: turns by role, the first user's words, whether all turns have text and any has a mark."""
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(
        F.count_if(F.col("role") == "user").alias("user_turns"), F.count_if(F.col("role") == "assistant").alias("assistant_turns"), F.coalesce(F.bool_and(F.length("text") > 0), F.lit(True)).alias("all_text"),
        F.coalesce(F.bool_or(F.contains("text", F.lit("?"))), F.lit(False)).alias("any_mark"),
    )


def profile_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles that pages list, from links made of each page's own ones."""
    p = table(spark, sf_dir, "pages")
    found = F.regexp_extract_all("html", F.lit(r'<a\s+href="/([^"/]*)"'), F.lit(1))
    link = lambda name, i: F.struct(F.concat(F.when(i % 3 == 2, F.lit("https://other.example.org/profile/")).otherwise(F.lit("https://www.bbb.org/us/profile/")), name, F.when(i % 2 == 0, "/complaints?x=1").otherwise("/#top")).alias("href"), name.alias("text"))
    return pages.listings(p.select("page_id", F.transform(found, link).alias("links")), "page_id", "links")


def page_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small values read from texts made of parts: currency, names, units, cost cards, tax years, counties, page kinds."""
    p = spread(table(spark, sf_dir, "part"), "p_partkey")
    k = F.col("p_partkey")
    price = F.format_string("%.2f", "p_retailprice")
    card = F.array(F.lit("Land  Value"), F.lit("x"), F.concat(F.lit("$"), price), F.when(k % 2 == 0, "7").otherwise("n/a"), F.lit("MARKET VALUE"), F.lit("99"))
    options = F.array(F.struct(F.lit("Tax 2020 roll").alias("text"), F.lit("").alias("value"), (k % 3 == 1).alias("selected")), F.struct(F.lit("roll").alias("text"), F.lit("/x?TaxYear=2019").alias("value"), (k % 3 == 0).alias("selected")))
    body = F.when(k % 4 == 0, "Loading chunk 12 failed").when(k % 4 == 1, "We are UNABLE to proceed").when(k % 4 == 2, "Just a moment...").otherwise("fine")
    return p.select(
        "p_partkey", pages.currency(F.concat(F.lit(" $ "), price, F.lit(" each"))).alias("currency"), pages.capitalised(F.col("p_type")).alias("name"), pages.unit_bucket(F.when(k % 5 > 0, F.col("p_size") / 2)).alias("units"),
        pages.cost_value(card, "LAND VALUE").alias("land"), pages.cost_value(card, "SALES APPROACH VALUE").alias("sales"), pages.tax_year(options).alias("tax_year"),
        pages.county_of_request(F.concat(F.lit('{"entry_http_request":{"multiValueQueryString":{"App":["'), "p_brand", F.lit('CountyFL"]}}}'))).alias("county"),
        pages.is_error_page(F.lit(""), body).alias("error"), pages.is_unavailable_detail(body).alias("unavailable"), pages.is_challenge(F.lit(None).cast("string"), body).alias("challenge"), F.array_join(pages.portal_candidates(F.concat(F.lit("Cape "), "p_brand")), " ").alias("candidates"),
    )


QUERIES = {f.__name__: f for f in (profile_listings, page_values, html_to_text, page_links, page_links_most, url_classify, section_blocks, label_value, json_hash, field_map, turn_summary)}

_LINKS = """lk AS (SELECT page_id, regexp_extract_all(html, '<a\\s+href="([^"]*)"', 1) AS h FROM pages),
d AS (SELECT page_id, href, min(i) AS i FROM (SELECT page_id, unnest(h) AS href, unnest(range(len(h))) AS i FROM lk) GROUP BY ALL)"""
_HOST = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_BRAND = "lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '-', 'g'))"
_BARE = "lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '', 'g'))"
ORACLE_SQL = {
    "profile_listings": r"""WITH l AS (SELECT page_id, regexp_extract_all(html, '<a\s+href="/([^"/]*)"', 1) AS h FROM pages), e AS (SELECT page_id, unnest(h) AS name, unnest(range(len(h))) AS i FROM l),
        f AS (SELECT page_id, 'https://www.bbb.org/us/profile' || CASE WHEN name = '' THEN '' ELSE '/' || name END AS profile_url, min(i) AS i, arg_min(name, i) AS link_text FROM e WHERE i % 3 <> 2 GROUP BY 1, 2)
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS ordinal, profile_url, link_text FROM f""",
    "page_values": f"""SELECT p_partkey, round(p_retailprice, 2) AS currency, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS name,
        CASE WHEN p_partkey % 5 = 0 OR p_size / 2 = 1 THEN 'One' WHEN p_size / 2 = 2 THEN 'Two' WHEN p_size / 2 = 3 THEN 'Three' WHEN p_size / 2 = 4 THEN 'Four' WHEN p_size / 2 BETWEEN 2 AND 4 THEN 'TwoToFour' WHEN p_size / 2 BETWEEN 1 AND 4 THEN 'OneToFour' END AS units,
        CASE WHEN p_partkey % 2 = 0 THEN 7.0 ELSE CAST(printf('%.2f', p_retailprice) AS DOUBLE) END AS land, CAST(NULL AS DOUBLE) AS sales, CASE WHEN p_partkey % 3 = 0 THEN 2019 ELSE 2020 END AS tax_year, p_brand AS county,
        p_partkey % 4 = 0 AS error, p_partkey % 4 = 1 AS unavailable, p_partkey % 4 = 2 AS challenge,
        'https://cape' || {_BARE} || '-egov.aspgov.com/Click2GovBP/ https://cape-' || {_BRAND} || '-egov.aspgov.com/Click2GovBP/ https://permit-planner.cape' || {_BARE} || '.org/ https://permit-planner.cape' || {_BARE} || '.gov/ https://www.cape' || {_BARE}
            || '.gov/ https://www.cape' || {_BARE} || '.org/ https://cape' || {_BARE} || '.gov/ https://cape' || {_BARE} || 'fl.gov/ https://www.cape' || {_BARE} || '.us/' AS candidates FROM part""",
    "html_to_text": r"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS x FROM pages),
        b AS (SELECT page_id, trim(regexp_replace(x, '[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS body FROM t)
        SELECT page_id, CAST(length(body) AS BIGINT) AS n_chars, sha256(body) AS body_sha256 FROM b""",
    "page_links": f"WITH {_LINKS} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS ordinal, href FROM d",
    "page_links_most": f"""WITH {_LINKS}, n AS (SELECT page_id, count(*) AS n FROM d GROUP BY 1), p AS (SELECT page_id, {_HOST} AS host, coalesce(n, 0) AS n FROM pages LEFT JOIN n USING (page_id))
        SELECT host, count(*) AS pages, CAST(sum(n) AS BIGINT) AS links, arg_max(page_id, (n, -page_id)) AS most FROM p GROUP BY host""",
    "url_classify": rf"""SELECT page_id, {_HOST} AS host, CASE WHEN contains({_HOST}, 'facebook') THEN 'FACEBOOK' WHEN contains({_HOST}, 'linkedin') THEN 'LINKEDIN' WHEN contains({_HOST}, 'instagram') THEN 'INSTAGRAM'
        WHEN contains({_HOST}, 'x.com') OR contains({_HOST}, 'twitter') THEN 'TWITTER' ELSE 'WEBSITE' END AS kind, TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS INT) AS page_number,
        nullif(regexp_extract(url, '#(.*)$', 1), '') AS fragment, CASE WHEN url LIKE '%//blog.%' THEN 'blog' WHEN url LIKE '%//m.%' THEN 'mobile' WHEN url LIKE '%//www.%' THEN 'www' ELSE 'plain' END AS site,
        CASE WHEN page_id % 5 < 2 THEN 'reachable' WHEN page_id % 5 IN (2, 3) AND contains(lower(html), 'track(1') THEN 'challenge' ELSE 'unreachable' END AS reach FROM pages""",
    "section_blocks": """WITH l AS (SELECT conv_id, turn, len(string_split(text, chr(10))) AS n, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS start FROM conversations)
        SELECT conv_id, turn, CAST(start AS INT) AS start, CAST(coalesce(lead(start) OVER (PARTITION BY conv_id, turn ORDER BY start), n) AS INT) AS next_start, CAST(length(line) AS BIGINT) AS n_chars FROM l WHERE trim(line) <> ''""",
    "label_value": "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS note, o_orderkey AS first_row, CAST(1345 AS BIGINT) AS total FROM orders",
    "json_hash": """SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || '}') AS hash FROM events""",
    "field_map": "SELECT p_partkey, unnest(['F01', 'F02', 'F07']) AS field, unnest([p_brand, p_type, CAST(p_size AS VARCHAR)]) AS value FROM part",
    "turn_summary": """SELECT conv_id, count(*) FILTER (role = 'user') AS user_turns, count(*) FILTER (role = 'assistant') AS assistant_turns, bool_and(length(text) > 0) AS all_text,
        bool_or(contains(text, '?')) AS any_mark FROM conversations GROUP BY conv_id""",
}
