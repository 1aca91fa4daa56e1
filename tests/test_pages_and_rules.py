"""Page rules, profile texts, property codes and small state operators on the shapes that sources have."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import pages, profiles, property_codes, text, vendors
from ledgerloom.operators import aggregates, routing, state, table_rows


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c"))).first()[0]


def test_links_of_a_profile(spark):
    links = [("https://www.bbb.org/us/x", "a"), ("https://www.facebook.com/BetterBusinessBureau", "b"), ("https://facebook.com/sharer?u=1", "c"), ("https://acme.example.org/", "Our Partners"), ("https://acme.example.org/home", "site"), ("mailto:x", "m"), ("https://w.example.net", "Visit Website")]
    df = spark.createDataFrame([(links,), ([("https://x.com/acme", "t"), ("https://y.org/1", "y"), ("https://www.bbb.org/email-this-business", "e")],), ([],)], "links array<struct<href:string,text:string>>")
    got = [tuple(r) for r in df.select(pages.first_website(F.col("links")), pages.first_email(F.col("links"))).collect()]
    assert got == [("https://w.example.net", None), ("https://y.org/1", "https://www.bbb.org/email-this-business"), (None, None)]


@pytest.mark.parametrize("url, want", [("https://www.bbb.org/us/fl/profile/roofing/acme-1/complaints?x#y", "https://www.bbb.org/us/fl/profile/roofing/acme-1"), ("https://www.bbb.org/complaints/a/", "https://www.bbb.org/complaints/a"), ("https://www.bbb.org", "https://www.bbb.org")])
def test_profile_base(spark, url, want):
    assert one(spark, url, pages.profile_base) == want


def test_discovery(spark):
    rows = [("a", 1, 404, "https://x.accela.com/", "permit"), ("a", 2, 200, "https://y.accela.com/", "permit search"), ("a", 3, 200, "https://z.iworq.net", "permit"), ("b", 1, 200, "https://b.opengov.com", "budget"), ("c", 1, 200, "https://c.org", "permit")]
    got = pages.discovered(spark.createDataFrame(rows, "jurisdiction string, place int, status int, final_url string, html string"))
    assert {tuple(r) for r in got.collect()} == {("a", "https://y.accela.com/", "Accela Citizen Access", "discovered"), ("b", None, "unknown", "needs-review"), ("c", None, "unknown", "needs-review")}
    assert one(spark, "CentralSquare / eHub", vendors.stated_keys) == ["centralsquare", "click2gov"] and one(spark, None, vendors.stated_keys) == []


@pytest.mark.parametrize("value, want", [("$1,234.567", 1234.57), ("12abc", 12.0), ("abc", None), ("", None), (None, None), (".5", 0.5)])
def test_currency(spark, value, want):
    assert one(spark, value, pages.currency) == want


@pytest.mark.parametrize(
    "value, want",
    [("WD", "Warranty Deed"), ("07 sheriff", "Sheriff's Deed"), ("14, 01", "Special Warranty Deed"), ("XX", "Miscellaneous"), ("QCD", "Quitclaim Deed"), ("certificate of title", "Quiet Title Deed"), ("fee simple", "Quitclaim Deed"), ("notice", "Tenancy in Common Deed"), ("n/a", "Miscellaneous"), ("special warranty", "Special Warranty Deed"), ("--", "Miscellaneous")],
)
def test_deed_types(spark, value, want):
    assert one(spark, value, property_codes.deed_type) == want


def test_complaints_and_reviews(spark):
    page = "x\nFilter and sort by\nInitial Complaint\nDate: 01/02/2024\nType: Order Issues\nStatus: Answered\nMore info\nNever came.\nBusiness Response\nDate: 01/03/2024\nWe are sorry.\nCustomer Answer\nDate: 01/04/2024\nFine.\nInitial Complaint\nDate: 02/02/2024\nBBB Business Profiles are provided"
    c = one(spark, page, profiles.complaints)
    assert [(x.ordinal, x.day, x.type, x.status, x.body) for x in c] == [(1, "01/02/2024", "Order Issues", "Answered", "Never came."), (2, "02/02/2024", None, None, None)]
    assert [(e.type, e.actor, e.day, e.text) for e in c[0].events] == [("BUSINESS_RESPONSE", "BUSINESS", "01/03/2024", "We are sorry."), ("CUSTOMER_ANSWER", "CUSTOMER", "01/04/2024", "Fine.")] and c[1].events == []
    assert one(spark, "no such list", profiles.complaints) == []
    assert one(spark, "Reviews\nThis business has 0 reviews\nReview from A\nDate: 1\n", profiles.reviews) == []
    r = one(spark, "Reviews\nCustomer Review\n4.5 out of 5 stars\nGood.\nReview from Bo L.\nDate: 03/04/2024\n\nAcme is BBB Accredited.\n This business has committed to", profiles.reviews)
    assert [(x.ordinal, x.day, x.rating, x.reviewer, x.body) for x in r] == [(1, None, 4.5, None, "Good."), (2, "03/04/2024", None, "Bo L.", None)]


def test_state_of_errors(spark):
    links = spark.createDataFrame([("e1", "c1", "failed"), ("e1", "c2", "maybeSolved"), ("e2", "c1", "failed"), ("e2", "c3", "failed"), (None, "c1", "failed")], "execution_id string, error_code string, status string")
    executions = spark.createDataFrame([("e1", "failed", 1), ("e2", "failed", 2), (None, "failed", 3)], "execution_id string, status string, n int")
    records = spark.createDataFrame([("c1", "failed"), ("c2", "failed"), ("c3", "failed"), (None, "failed")], "error_code string, status string")
    given_up = lambda df, *keys: {tuple(r[k] for k in keys) for r in df.where("status = 'maybeUnrecoverable'").collect()}
    e, k, r = state.unrecoverable(executions, links, records, execution_id="e1")
    assert given_up(e, "execution_id") == {("e1",)} and given_up(k, "execution_id", "error_code") == {("e1", "c1"), ("e1", "c2")} and given_up(r, "error_code") == {("c1",), ("c2",)}
    assert e.columns == executions.columns and (e.count(), k.count(), r.count()) == (3, 5, 4)
    e, k, r = state.unrecoverable(executions, links, records, code="c1")
    assert given_up(e, "execution_id") == {("e1",), ("e2",)} and given_up(k, "execution_id", "error_code") == {("e1", "c1"), ("e2", "c1"), (None, "c1")} and given_up(r, "error_code") == {("c1",)}
    assert all(not given_up(df, "status") for df in state.unrecoverable(executions, links, records, execution_id="e9"))
    with pytest.raises(ValueError):
        state.unrecoverable(executions, links, records)
    e = spark.createDataFrame([("a", 3, "10", "FAILED"), ("b", 9, "20", "FAILED"), ("c", 9, "10", "FAILED"), ("d", 99, "10", "DONE"), ("z", 0, "10", "FAILED"), ("y", 0, "20", "FAILED"), ("x", None, "10", "FAILED"), (None, 99, "10", "FAILED")], "execution_id string, open_error_count int, error_type string, status string")
    assert [state.extremes(e, **k).first().execution_id for k in ({}, {"kind": "1"}, {"least": True})] == ["c", "c", "y"]
    assert sorted(r.sort_key for r in state.remaining(e, "open_error_count").where("status = 'FAILED'").collect()) == ["0000000003", "0000000009", "0000000009", "0000000099"]
    assert tuple(state.verified(e, F.col("open_error_count") > 50).first()) == (2, False)


def test_reports_and_queues(spark):
    q = spark.createDataFrame([("w-1", "3", "x"), ("w-2", None, "4"), ("v-1", "9", "9")], "name string, visible string, in_flight string")
    assert aggregates.queue_backlog(q, "w-").first().backlog == 7 and aggregates.queue_backlog(q, "none").first().backlog == 0
    r = spark.createDataFrame([("lee", 3, 2, 60.0, "load", 1), ("lee", 3, 2, 60.0, "hash", 2), ("bay", 0, 0, None, None, None)], "county string, succeeded long, failed long, success_rate double, step string, n long")
    assert [x.line for x in aggregates.report_lines(r).orderBy("county").collect()] == ["bay | ok 0 | failed 0 | n/a", "lee | ok 3 | failed 2 | 60.0% | hash=2, load=1"]


def test_routing_and_rows(spark):
    rows = spark.createDataFrame([("files", 1), ("odd", 2), ("properties", 3), ("files", 0)], "table_name string, n int")
    order = routing.joined_order(routing.APPRAISAL_ORDER, routing.PERMIT_ORDER)
    assert [(r.table_name, r.n) for r in routing.in_table_order(rows, order, place="n").collect()] == [("properties", 3), ("files", 0), ("files", 1), ("odd", 2)] and order.count("addresses") == 1
    assert {r.n: r.branch for r in routing.branches(rows, {"low": F.col("n") < 1, "mid": F.col("n") < 3}, "high").collect()} == {0: "low", 1: "mid", 2: "mid", 3: "high"}
    empty = spark.createDataFrame([], "record string, artifact_uri string")
    assert all(df.count() == 0 for df in table_rows.permit_rows(empty))
    none = spark.createDataFrame([(None, "u"), ("", "u"), ("{}", "u")], "record string, artifact_uri string")
    good, bad = table_rows.permit_rows(none)
    assert good.count() == 0 and sorted(r.reason for r in bad.collect()) == ["neither recordNumber nor idempotencyKey", "not a JSON object", "not a JSON object"]


@pytest.mark.parametrize("value, want", [("12 Main St Unit 4", "12 MAIN ST"), ("12 Main#5 x", "12 MAIN"), ("12 Main # 5", "12 MAIN # 5"), (None, None)])
def test_address_base(spark, value, want):
    assert one(spark, value, text.address_base) == want


def test_reviews_keep_what_isnt_theirs(spark):
    page = "Reviews\nReview from Al\nDate: 1/2/2024\n2 stars\nOthers give 1 stars but I give all 5 stars.\ndate: it was late\nBye\nCustomer Review\n4.5 out of 5 stars stellar\nReview from\n"
    got = one(spark, page, profiles.reviews)
    assert [(r.ordinal, r.day, r.rating, r.reviewer, r.body) for r in got] == [(1, "1/2/2024", 2.0, "Al", "Others give 1 stars but I give all 5 stars.\ndate: it was late\nBye"), (2, None, 4.5, None, "stellar\nReview from")]
    assert one(spark, None, profiles.reviews) == [] and one(spark, "", profiles.reviews) == []
    assert one(spark, "a\nTM\nFor Consumers\nb", profiles.truncated) == "a" and one(spark, "a\nX is BBB Accredited.\n\n This business has committed to\nb", profiles.truncated) == "a" and one(spark, "a BBB Business Profiles are provided b", profiles.truncated) == "a"


def test_objects_of_any_depth(spark):
    deep = '{"@type":"Leaf","name":"x"}'
    for k in range(12):
        deep = f'[{{"@type":"T{k}","@graph":[{deep}, 5]}}]'
    html = f'<script type="application/ld+json">{deep}</script><script type="application/ld+json">{{bad</script><script type="application/ld+json">{{"a":NaN}}</script>'
    df = spark.createDataFrame([(html,), (None,), ("no",)], "c string").select(F.transform(profiles.json_ld(F.col("c")), lambda o: F.try_variant_get(o, '$["@type"]', "string")).alias("t"))
    assert [r.t for r in df.collect()] == [[f"T{k}" for k in range(11, -1, -1)] + ["Leaf"], None, []]


def test_appraisal_bundles_stay_apart(spark):
    rows = [(None, "property.json", '{"request_identifier":"A","zoning":"R1","n":2}'), (None, "property.json", '{"request_identifier":"B","zoning":{"x":1}}'), ("C", "b/property.json", '{"zoning":null}'), (None, "property.json", "{}"), ("C", "relationship_x.json", "{}"), ("C", "tax_1.json", '{"request_identifier":" ","tax_year":2024}'), ("C", "odd.json", "{}"), ("C", "property.json", "[]")]
    good, bad = table_rows.appraisal_rows(spark.createDataFrame(rows, "request_identifier string, file_name string, value string"))
    got = {r.source_record_key: r["values"] for r in good.collect()}
    assert set(got) == {"appraisal:A:properties:property", "appraisal:B:properties:property", "appraisal:C:properties:property", "appraisal:C:taxes:tax_1"}
    assert got["appraisal:A:properties:property"]["zoning"] == "R1" and got["appraisal:B:properties:property"]["zoning"] == '{"x":1}' and "zoning" not in got["appraisal:C:properties:property"] and got["appraisal:A:properties:property"]["source_payload"]
    assert sorted(r.reason for r in bad.collect()) == sorted([table_rows.NO_REQUEST, table_rows.IS_LINK, "no table for odd.json", "not a JSON object"])


def test_parsers_of_permit_texts(spark):
    from ledgerloom.functions import permits

    f = one(spark, "A General Contractor none Certified Electrical Cntr EC 1234 then general contractor CGC123 INACTIVE", permits.licence)
    assert (f.kind, f.number, f.before) == ("general contractor", "CGC123", "A General Contractor none Certified Electrical Cntr EC 1234 then")
    assert one(spark, "General Contractor only", permits.licence) is None and one(spark, None, permits.licence) is None
    place = lambda t: tuple(one(spark, t, permits.split_address))
    assert place("ACME INC P.O. BOX 9, ESTERO,FL 33928-1234 x") == ("ACME INC", "P.O. BOX 9, ESTERO,FL 33928-1234")
    assert place("JO 12 OAK ST, NAPLES, Florida, 34102.") == ("JO", "12 OAK ST, NAPLES, Florida, 34102") and place("JO 12 OAK FL 34102") == ("JO 12 OAK FL 34102", None) and place(None) == (None, None)
    assert one(spark, "a Fax:239-1 2 b primary phone: (239) 555 c", permits.without_phones) == "a b c"
    assert one(spark, "x 1) Al 2) Bo 3 Cy", permits.numbered) == ["Al", "Bo 3 Cy"]
    text = "Completed (3) (x) Partial Pass B1 Roof Pass Check (7) Result by: Ann on Lee on 1/2/2021 Fail 2 Slab (8) Result by: Bo on 3/4/2021 Pass 3 No (nine) Result by: C on 1/1/2020"
    assert [tuple(r) for r in one(spark, text, permits.inspections)] == [("Partial Pass", "B1", "Roof Pass Check", "7", "Ann on Lee", "1/2/2021"), ("Fail", "2", "Slab", "8", "Bo", "3/4/2021")]
    assert one(spark, "paid fees 1/2/2020 A-1 $5 View Details 13 B View Details 2/3/2021 C 6.5 view details 9", permits.fees)[1].amount == 6.5 and one(spark, None, permits.fees) is None


def test_profile_records(spark):
    from ledgerloom.functions import profile_record

    none = F.lit(None).cast("string")
    html = '<script type="application/ld+json">{"@type":"LocalBusiness","employee":{"name":":"},"image":{"contentUrl":"c.png"},"logo":5}</script>'
    text_ = "x\nBBB Rating\nnr\nNot BBB Accredited\nPrincipal Contacts\nBo, Boss\nbo, BOSS\n\nCustomer Contacts\nBo, Boss\nSocial Media"
    links = [("https://www.bbb.org/us/fl/profile/r/a-0653-1/addressId/7", " "), ("https://www.bbb.org/us/fl/profile/r/a-0653-1", "self"), ("https://fb.example.org", "x"), ("https://fb.example.org", "y")]
    df = spark.createDataFrame([(html, text_, links), (None, None, None), ("", "", [])], "html string, text string, links array<struct<href:string,text:string>>")
    reviews_ = F.lit("Reviews\nThis business has 3 reviews\nReview from Al\n5 stars\nFine\n")
    got = [r.r for r in df.withColumn("o", profiles.json_ld(F.col("html"))).select(profile_record.record(F.col("o"), F.col("text"), F.col("links"), F.lit("https://www.bbb.org/us/fl/profile/r/a-0653-1"), none, reviews_, none, none).alias("r")).collect()]
    r = got[0]
    assert (r.name, r.name_source, r.rating, r.accredited) == (None, None, "nr", False)
    assert [(c.name, c.title, c.role) for c in r.contacts] == [("Bo", "Boss", "PRINCIPAL"), ("Bo", "Boss", "CUSTOMER")]
    assert [(i.type, i.url) for i in r.images] == [("IMAGE", "c.png")] and [x.name for x in r.locations] == [None] and [x.label for x in r.links] == ["y"]
    assert [x.body for x in r.reviews] == ["Fine"] and (r.summary.reviews_total, r.summary.average) == (3, 5.0) and r.complaints == []
    for r in got[1:]:
        assert r.accredited is None and all(r[c] == [] for c in ("contacts", "categories", "locations", "images", "links", "alternate_names", "licences", "service_areas", "rating_reasons", "complaints"))
