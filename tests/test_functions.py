"""Text rules on the shapes that sources really have."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import rules, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "f, value, want",
    [
        (text.string, "  x\t", "x"), (text.string, " \n", None), (text.collapse, "a  \n b", "a b"),
        (text.number, "$1,234.5", 1234.5), (text.number, "5f", None), (text.number, "NaN", None), (text.number, "1e999", None), (text.number, ".5", 0.5), (text.number, "", None),
        (text.integer, "-3.9", -3), (text.boolean, " YES ", True), (text.boolean, "t", None), (text.boolean, "0", False),
        (text.lenient_date, "3/7/2021", "2021-03-07"), (text.lenient_date, "2021-13-45T1", "2021-13-45"), (text.lenient_date, "x", None),
        (text.strict_date, "20240231", None), (text.strict_date, "19400124", dt.date(1940, 1, 24)),
        (text.name_key, " O'Neil  & Co. ", "O NEIL CO"), (text.parcel_id, "29-46-A", "2946"), (text.parcel_id, "ab c", "ABC"), (text.parcel_search_key, "--", None),
        (text.zip5, "3390", None), (text.zip5, "33901-1234", "33901"), (text.zip_of_address, "12345 Main St, FL 33901-0001", "33901"), (text.zip_of_address, "9 Elm 33902 USA", "33902"), (text.zip_of_address, "12345 Main", None),
        (text.address_key, "12 Northwest Harbor Drive, #4", "12 NW HARBOR DR 4"), (text.registry_address, "4980 Bayline Drive, North Fort Myers FL", "4980 BAYLINE DR N FORT MYERS FL"), (text.registry_address, None, ""),
        (text.city_name, "St. Cape-2", "ST CAPE-"), (text.slug, " A--b! ", "a-b"), (text.slug, "!!", "unknown"), (text.escape_html, "<a & 'b'>", "&lt;a &amp; &#39;b&#39;&gt;"),
        (text.html_to_text, "<p>a<script>x</script>b</p>\n c", "a b c"), (text.host, "https://u@Ex.com:80/p", "ex.com"),
    ],
)
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_canonical_json(spark):
    a, b = (one(spark, v, text.canonical_json_hash) for v in ('{"b": 1, "a": [1, 2]}', '{"a":[1,2],"b":1}'))
    assert a == b and one(spark, "{", text.canonical_json_hash) is None


def test_sort_key_never_cuts(spark):
    assert [r[0] for r in spark.sql("select * from values (5L), (12345678901L) t(n)").select(text.sort_key(F.col("n"))).collect()] == ["0000000005", "12345678901"]


def test_tokens_in_order(spark):
    df = spark.createDataFrame([(["a", "c"], ["a", "b", "c"]), (["c", "a"], ["a", "b", "c"]), ([], ["x"]), (["a"], [])], "q array<string>, t array<string>")
    assert [r[0] for r in df.select(text.tokens_in_order(F.col("q"), F.col("t"))).collect()] == [True, False, True, False]


def test_rules(spark):
    df = spark.createDataFrame([("dropbox.com",), ("a.linkedin.com",), ("b.org",)], "h string")
    assert [r[0] for r in df.select(rules.external_link_kind(F.col("h"))).collect()] == ["TWITTER", "LINKEDIN", "WEBSITE"]
    df = spark.createDataFrame([(None,), ("mint",), ("x",)], "b string")
    assert [r[0] for r in df.select(rules.workflow_branch(F.col("b"))).collect()] == ["structured_archive", "mint", None]


@pytest.mark.parametrize(
    "line, want",
    [
        ("Mary Smith", [("person", "Mary", None, "Smith")]),
        ("SMITH JOHN A & MARY ANN LEE", [("person", "JOHN", "A", "SMITH"), ("person", "MARY", "ANN LEE", "SMITH")]),
        ("SMITH JOHN & JONES MARY ANN LEE and Bob", [("person", "JOHN", None, "SMITH"), ("person", "MARY", "ANN LEE", "JONES"), ("person", "Bob", None, "JONES")]),
        ("DOE, JANE Q./ACME HOLDINGS LLC", [("person", "JANE", "Q", "DOE"), ("company", None, None, None)]),
        ("ET AL and Solo", [("rejected", None, None, None), ("rejected", None, None, None)]),
        ("Sandy Anderson & Rob R. Roe Jr", [("person", "Sandy", None, "Anderson"), ("person", "Rob", "R Roe", "Jr")]),
        ("First Bank, N.A.", [("company", None, None, None)]), ("Cotton Patrick", [("person", "Cotton", None, "Patrick")]), (None, []),
    ],
)
def test_owner_lines(spark, line, want):
    from ledgerloom.functions import owners

    rows = owners.owners(spark.createDataFrame([(1, line)], "k int, l string"), "l", ["k"]).orderBy("ordinal").collect()
    assert [(r.kind, r.first_name, r.middle_name, r.last_name) for r in rows] == want


def test_equal_owners_come_once(spark):
    from ledgerloom.functions import owners

    df = spark.createDataFrame([(1, "SMITH JOHN & Smith, John / ACME LLC & Acme LLC & X Y & ESTATE")], "k int, l string")
    got = owners.owners(df, "l", ["k"], distinct=True).orderBy("ordinal").collect()
    assert [(r.ordinal, r.kind) for r in got] == [(1, "person"), (3, "company"), (5, "person")]


def test_permit_parsers(spark):
    from ledgerloom.functions import permits

    page = "Fees Outstanding: 3/7/2021 INV-1 $1,000.50 View Details " + "x " * 150 + "4/7/2021 INV-2 5 View Details Paid Fees 12/25/2020 P9 7.00 View Details"
    c = F.lit(page)
    rows = spark.range(1).select(permits.fees(c).alias("f")).first().f
    assert [tuple(r) for r in rows] == [("2021-03-07", "INV-1", 1000.5, "OUTSTANDING"), ("2021-04-07", "INV-2", 5.0, "UNKNOWN"), ("2020-12-25", "P9", 7.0, "PAID_OR_DISCOUNTED")]
    total = lambda a: spark.range(1).select(permits.fee_total(F.expr(a))).first()[0]
    assert total("array(1.005D, null, 2D)") in (3.0, 3.01) and total("array(cast(null as double))") is None and total("cast(array() as array<double>)") is None
    done = spark.range(1).select(permits.events(F.lit("Marked as  Approved on 1/2/2021 by Ann Lee\nDue on Review on 3/4/2021 by TBD\nnoise"))).first()[0]
    assert [tuple(r) for r in done] == [("MARKED_AS", "Approved", "2021-01-02", "Ann Lee"), ("DUE_ON", "Review", "2021-03-04", "TBD")]
