"""Parcel and permit pages: tables that counties' pages hold, written into every page and read back from its tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import permit_pages
from ..functions.text import html_to_text
from ..operators import html_rows
from .tables import table


def _k() -> Column:
    return F.col("page_id")


def _key() -> Column:
    return _k().cast("string")


def _t(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _rows(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """The table rows of all pages, each with some markup before its own."""
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(*extra, F.coalesce("html", F.lit(""))).alias("html"))
    return html_rows.with_rows(p)


def _sales() -> Column:
    other = _t('<table class="detailsTable"><tr><td>$9</td><td>1/1/1999</td></tr></table>')
    row = _t("<tr><td>$", (_k() * 1000 + 1).cast("string"), ".50<td><b>1</b>/", (_k() % 28 + 1).cast("string"), "/2020</tr>")
    again = F.when(_k() % 3 == 0, _t("<TR><TD></TD><TD>02/03/2021</TD></TR>")).otherwise("")
    return _t(other, '<div id="SalesDetails"><p><table class="x detailsTable"><tr><th>Price<th>Date</tr>', row, again, "<tr><td>n/a</td><td>soon</td></tr></table></div>", '<div id="SalesDetails2"></div>')


def parcel_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of every page's first sales table; rows without a price and a date are none."""
    rows = _rows(spark, sf_dir, _sales())
    return rows.select("page_id", F.posexplode(html_rows.sales(F.col("rows"))).alias("i", "s")).select("page_id", (F.col("i") + 1).alias("ordinal"), "s.*")


def parcel_improvements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permits of every other page, and the features of the others' attribute tables."""
    permit = _t('<tr><td><a href="/permit?n=', _key(), '&amp;x=1">ROF', _key(), "</a></td><td>Re-roof &amp; more</td><td>7/9/2019</td></tr>")
    table_ = _t('<div id="PermitDetails"><table class="detailsTable"><tr><th>No</th></tr>', permit, permit, "<tr><td></td><td>x</td><td>y</td></tr></table></div>")
    feature = _t("<tr><td>POOL ", _key(), "</td><td>", (_k() + 1750).cast("string"), "</td></tr>")
    features = _t('<table class="appraisalAttributes"><tr><th class="subheader">Land Features</th></tr>', feature, feature, '<tr><td>12</td><td>2000</td></tr><tr><td>gravel</td><td>2001</td></tr></table><table class="appraisalAttributes"><tr><th>Rooms</th></tr><tr><td>bath</td><td>2</td></tr></table>')
    rows = _rows(spark, sf_dir, F.when(_k() % 2 == 0, table_).otherwise(""), features)
    return rows.select("page_id", F.posexplode(html_rows.improvements(F.col("rows"))).alias("i", "s")).select("page_id", (F.col("i") + 1).alias("ordinal"), "s.*")


def parcel_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and values of a two-column table, the place and the flood zone of every page."""
    pairs = _t("<table><tr><th>Built: </th><td>", (_k() % 100 + 1900).cast("string"), "</td></tr><tr><td>Zoning</td><td>R", (_k() % 5).cast("string"), "<br>x</td></tr><tr><td>zoning</td><td>again</td></tr><tr><th>Empty</th><td> </td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>")
    place = F.when(_k() % 4 != 0, _t('<table class="appraisalDetailsLocation"><tr><th>Municipality</th><th>Lat</th><th>Long</th></tr><tr><td>x</td><td>26.', (_k() % 7).cast("string"), "</td><td>-81.5</td></tr></table>")).otherwise("")
    flood = F.when(_k() % 5 == 0, _t('<section id="ElevationDetails"><table class="detailsTable"><tr><td>C</td><td>', _key(), "</td><td>F</td><td>8/28/2008</td><td>A</td></tr></table></section>")).otherwise("")
    rows = _rows(spark, sf_dir, pairs, place, flood)
    said, at, zone = html_rows.label_values(F.filter("rows", lambda r: r["table"] == 0)), html_rows.location(F.col("rows")), html_rows.flood(F.col("rows"))
    return rows.select("page_id", said.alias("m"), at.alias("at"), zone.alias("zone")).select("page_id", F.size("m").alias("n_labels"), F.col("m")["built"].alias("built"), F.col("m")["zoning"].alias("zoning"), "at.latitude", "at.longitude", "zone.panel_number", "zone.effective_date")


def search_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permit links of a search result with named and with unnamed columns, and how many related records it left out."""
    link = lambda n: _t('<a href="/Cap/CapDetail.aspx?id=', n, '">x</a>')
    named = _t("<table><tr><th>Action</th><th>Record Number</th><th>Status</th></tr><tr><td>", link(_key()), "</td><td>rof", _key(), "</td><td>Issued</td></tr></table>")
    plain = _t("<table><tr><td>", link(_t(_key(), "b")), "</td><td>mec", _key(), "</td><td>1 Oak St</td><td>work</td><td>Open</td></tr><tr><td>", link(_t(_key(), "c")), "</td><td></td></tr></table>")
    tree = F.when(_k() % 3 == 0, _t('<table id="ctl_tableCapTREEList"><tr><td>', link("t"), link("u"), "</td></tr></table>")).when(_k() % 3 == 1, _t("<table><caption> Related  Records</caption><tr><td>", link("v"), "</td></tr></table>")).otherwise("")
    rows = _rows(spark, sf_dir, named, tree, plain)
    links, filtered = html_rows.permit_links(F.col("rows"), "https://aca.example.org")
    return rows.select("page_id", filtered.alias("n_filtered"), F.posexplode(links).alias("i", "x")).select("page_id", "n_filtered", (F.col("i") + 1).alias("ordinal"), "x.record_number", "x.url", "x.address", "x.status", "x.action")


def permit_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A permit record from the text of every page, and a placeholder where the page is an error."""
    body = _t(
        "<p>Record ROF2024-", F.format_string("%05d", _k()), " : Roof Permit <br> Record Status: Issued Record Info</p><div>Work Location ", _key(), " OAK ST * Record Details Applicant: Ann <i>Lee</i> Licensed Professional: none Project Description: New &amp; old More Details Type : Re-Roof Lot Type B ",
        "Is this for Site Lighting? No Parcel Number: P", _key(), " Block Lot 7 <b>Fees</b> *Fee Reductions Inspections none yet Digital Projects Processing Status Done</div>",
    )
    p = table(spark, sf_dir, "pages").select("page_id", html_to_text(F.concat(body, F.coalesce("html", F.lit("")))).alias("text"))
    d = p.select("page_id", permit_pages.permit_detail(F.col("text"), F.lit("none")).alias("d"))
    missing = permit_pages.unavailable_detail(_t("ROF", _key()), F.lit("Open  Record Info"), F.when(_k() % 2 == 0, "1 Elm"), F.lit(None).cast("string"), F.lit("timeout"))
    d = d.withColumn("u", missing)
    return d.select(
        "page_id", "d.record_number", "d.record_type", "d.record_status", "d.work_location", "d.applicant", "d.project_description", "d.parcel_identifier", F.array_join(F.transform(F.map_entries("d.more_details"), lambda e: F.concat_ws("=", e["key"], e["value"])), "|").alias("details"), F.col("d.inspections_text").alias("inspections"),
        F.col("u.record_type").alias("implied_type"), F.col("u.raw_text").alias("placeholder"),
    )


QUERIES = {f.__name__: f for f in (parcel_sales, parcel_improvements, parcel_facts, search_links, permit_details)}
ORACLE_SQL = {
    "parcel_sales": """SELECT page_id, 1 AS ordinal, page_id * 1000 + 1.5 AS purchase_price_amount, '2020-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS ownership_transfer_date FROM pages
        UNION ALL SELECT page_id, 2, NULL, '2021-02-03' FROM pages WHERE page_id % 3 = 0""",
    "parcel_improvements": """SELECT page_id, 1 AS ordinal, 'Roofing' AS type, '2019-07-09' AS completion_date, 'ROF' || page_id AS permit_number, 'Re-roof & more' AS description, 'https://www.leepa.org/permit?n=' || page_id || '&x=1' AS url FROM pages WHERE page_id % 2 = 0
        UNION ALL SELECT page_id, 1, 'PoolSpaInstallation', CASE WHEN page_id BETWEEN 50 AND 350 THEN (page_id + 1750) || '-01-01' END, NULL, 'POOL ' || page_id, NULL FROM pages WHERE page_id % 2 = 1
        UNION ALL SELECT page_id, 2, 'LandscapeIrrigation', '2001-01-01', NULL, 'gravel', NULL FROM pages WHERE page_id % 2 = 1""",
    "parcel_facts": """SELECT page_id, 2 AS n_labels, CAST(page_id % 100 + 1900 AS VARCHAR) AS built, 'R' || (page_id % 5) || ' x' AS zoning, CASE WHEN page_id % 4 <> 0 THEN CAST('26.' || (page_id % 7) AS DOUBLE) END AS latitude, CASE WHEN page_id % 4 <> 0 THEN -81.5 END AS longitude,
        CASE WHEN page_id % 5 = 0 THEN CAST(page_id AS VARCHAR) END AS panel_number, CASE WHEN page_id % 5 = 0 THEN '2008-08-28' END AS effective_date FROM pages""",
    "search_links": """WITH p AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_filtered, 'https://aca.example.org/Cap/CapDetail.aspx?id=' || page_id AS u FROM pages)
        SELECT page_id, n_filtered, 1 AS ordinal, 'ROF' || page_id AS record_number, u AS url, 'Issued' AS address, 'Issued' AS status, 'x' AS action FROM p
        UNION ALL SELECT page_id, n_filtered, 2, 'MEC' || page_id, u || 'b', '1 Oak St', 'Open', NULL FROM p UNION ALL SELECT page_id, n_filtered, 3, 'X', u || 'c', NULL, NULL, NULL FROM p""",
    "permit_details": """SELECT page_id, 'ROF2024-' || printf('%05d', page_id) AS record_number, 'Roof Permit' AS record_type, 'Issued' AS record_status, page_id || ' OAK ST' AS work_location, 'Ann Lee' AS applicant, 'New &amp; old' AS project_description, 'P' || page_id AS parcel_identifier,
        'Type=Re-Roof|Lot=Type B|Is this for Site Lighting?=No|Parcel Number=P' || page_id || '|Block=Lot 7' AS details, 'none yet' AS inspections, 'Roof' AS implied_type,
        'Record ROF' || page_id || chr(10) || 'Record Type: Roof' || chr(10) || 'Record Status: Open  Record Info' || CASE WHEN page_id % 2 = 0 THEN chr(10) || 'Work Location: 1 Elm' ELSE '' END || chr(10) || 'Accela detail capture status: unavailable_error_page' || chr(10) || 'Accela detail capture error: timeout' AS placeholder FROM pages""",
}
