"""Tag reader on broken and nested markup, records of pages, known labels."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import permit_pages
from ledgerloom.operators import html_rows


@pytest.mark.parametrize(
    "page, cells",
    [
        ("<table><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c"]]),
        ("<table><tr><td><table><tr><td>in</td></tr></table>out</td><td>z</td></tr></table>", [["inout", "z"], ["in"]]),
        ("<script>'<table><tr><td>no'</script><table><!-- <tr><td>no --><tr><td title='>'>a &lt;b&gt; &amp; c", [["a <b> & c"]]),
        ("<TABLE><TBODY><TR><TH>h</TH><TD>a<br/>b</TD></TR></TBODY></TABLE></td></tr>", [["a b"]]),
        ("<table><tr><td>a</div></td><td><p>b<p>c</td></tr></table>", [["a", "bc"]]),
        ("<td>loose</td><tr><td>x</tr>", []),
        ("<table><tr><td>unclosed <a href=x>l", [["unclosed l"]]),
        ("", []),
        ("<table", []),
        ("< table><tr></table>", []),
    ],
)
def test_reader(page, cells):
    assert [r["cells"] for r in html_rows.page_rows(page)] == cells


def test_deep_and_long_pages(spark):
    deep = "<div id=d>" * 3000 + "<table id=t><tr><td>x</td></tr></table>" + "</div>" * 3000
    long = "<table>" + "<tr><td>1</td><td>v</td></tr>" * 20_000 + "</table>"
    df = spark.createDataFrame([(1, deep, "r"), (2, long, "r"), (3, None, "r"), (4, "", "r"), (None, "<table><tr><td>a", "r")], "page_id long, html string, Rows string")
    out = html_rows.with_rows(df)
    assert out.columns == ["page_id", "rows"]
    assert {r.page_id: r.n for r in out.select("page_id", F.size("rows").alias("n")).collect()} == {1: 1, 2: 20_000, 3: 0, 4: 0, None: 1}
    assert html_rows.with_rows(df.limit(0)).count() == 0


def test_records_of_pages_without_them(spark):
    rows = html_rows.with_rows(spark.createDataFrame([("<p>none",), (None,)], "html string"))
    links, filtered = html_rows.permit_links(F.col("rows"), "https://x")
    got = rows.select(html_rows.sales(F.col("rows")).alias("s"), html_rows.improvements(F.col("rows")).alias("i"), html_rows.location(F.col("rows")).alias("l"), html_rows.flood(F.col("rows")).alias("f"), html_rows.label_values(F.col("rows")).alias("m"), links.alias("p"), filtered.alias("n")).collect()
    for r in got:
        assert r.s == [] and r.i == [] and r.m == {} and r.p == [] and r.n == 0 and tuple(r.l) == (None, None) and set(r.f) == {None}


@pytest.mark.parametrize(
    "text, want",
    [
        ("Type: Roof Lot 7 Block", {"Type": "Roof", "Lot": "7"}),
        ("before Parcel Number: 1-2 TYPE b Subtype c type d", {"Parcel Number": "1-2", "Type": "b Subtype c type d"}),
        ("Is this for Site Lighting? : No Data x", {"Is this for Site Lighting?": "No", "Data": "x"}),
        ("Commercial Permit Number 5 Comm/Res R", {"Commercial Permit Number": "5", "Comm/Res": "R"}),
        ("", {}),
        ("no label", {}),
        (None, None),
    ],
)
def test_known_labels(spark, text, want):
    assert spark.createDataFrame([(text,)], "c string").select(permit_pages.known_labels(F.col("c")).alias("m")).first().m == want


def test_labels_inside_labels(spark):
    labels = ["Permit", "Permit Number", "Number"]
    got = spark.createDataFrame([("Permit Number 5 Permit x Number y",)], "c string").select(permit_pages.known_labels(F.col("c"), labels).alias("m")).first().m
    assert got == {"Permit Number": "5", "Permit": "x", "Number": "y"}
