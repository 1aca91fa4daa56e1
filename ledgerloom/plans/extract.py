"""Codes, vendors, profiles and record routing over texts made of the standard tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import permits, profile_record, profiles, property_codes, text, vendors
from ..operators import aggregates, joins, routing, state
from ..streaming import event_state
from .tables import table

#: Descriptions that parts are given, one for each key modulo their number.
USES = ["Single Family Residence", "VACANT RESIDENTIAL platted", "Manufactured Home", "manufactured home sub lot", "Multi Family >9", "multi family <5 units", "CONDOMINIUM unit", "Half-Duplex", "Garden Apartments", "Time Share", "PUD common elements", "store, one story", "Retirement home"]
BUILDS = ["Wood frame, hip & gable, shingle", "CB STUCCO ASPH SHNGL", "Brick veneer flat TPO", "Concrete block metal roof", "Steel vinyl shed", "ARCH SHINGLE gable", "poured hardi slate", "stone clay tile hip", "none"]
DEEDS = ["WD", "Special Warranty Deed", "QUIT CLAIM", "01 - Some text", "14", "XX", "xx. other", "Sheriff Deed", "tax deed", "Trustees", "n/a", "unknown", "certificate of title", "deed", "fee simple", "Lady Bird", "Corrective Deed", "Personal Rep", "77 / Gift", "Right of Way", "Zzz", "life estate deed"]
WORKS = ["Install irrigation system", "New POOL and spa", "Re-roof shingle", "Fence with gate", "seawall repair", "hvac changeout", "Electrical service", "add-on room", "demo garage", "Demolition", "interior remodel", "screen lanai", "sidewalk", "gas line", "solar panels"]
HOSTS = ["aca-prod.accela.com/LEE/", "city.energovweb.com/apps", "www.aspgov.com/x", "x.viewpoint.opengov.com/", "town.esuite.com/", "permits.example.org/", "permits.example.net/"]
BODIES = ["Permit search by Tyler Technologies", "Budget of the town", "CityView inspections", "Building division - iWorQ", ""]
STATED = ["Accela", "Tyler EPL / Civic Access", "CentralSquare / eHub", "GovAccess and CityView", "none", ""]


def pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def use_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property types and building parts of every part's description."""
    p = table(spark, sf_dir, "part")
    use, build = pick(USES, F.col("p_partkey")), pick(BUILDS, F.col("p_size"))
    code = property_codes.by_texts
    return p.select(
        "p_partkey", code(use, property_codes.BREVARD_USES).alias("use_a"), code(use, property_codes.LAKE_USES).alias("use_b"), code(build, property_codes.EXTERIORS).alias("exterior"), code(build, property_codes.FRAMES).alias("frame"),
        code(build, property_codes.ROOF_DESIGNS).alias("roof_design"),
        code(build, property_codes.ROOF_MATERIALS).alias("roof_material"), code(build, property_codes.ROOF_COVERINGS).alias("roof_covering"), property_codes.unit_count(F.col("p_size")).alias("units"),
        property_codes.building_value(F.col("p_retailprice"), F.lit(1000.0) + F.col("p_size")).alias("building_value"), property_codes.year_start((F.col("p_size") * 60).cast("string")).alias("built"),
    )


def deed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    stated = pick(DEEDS, F.col("o_orderkey"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    number = F.concat(pick(["ROF", "com", "ZZZ", "mec"], F.col("o_orderkey")), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", property_codes.deed_type(stated).alias("deed_type"), property_codes.us_date(day).alias("us_day"), property_codes.window_key(day, F.lit("2024-01-31")).alias("window_key"), property_codes.record_type(number).alias("record_type"))


def improvement_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of described works, whole documents among them, by language."""
    d = table(spark, sf_dir, "documents")
    described = F.concat(pick([*WORKS, ""], F.col("doc_id")), F.lit(". "), F.coalesce("text", F.lit("")))
    context = F.when(F.col("doc_id") % 3 == 0, F.lit("Land features"))
    return d.groupBy("lang", property_codes.improvement_type(described, context).alias("type")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


def _portals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    url = F.concat(F.lit("https://"), pick(HOSTS, F.col("page_id")), F.col("page_id").cast("string"))
    html = F.concat(pick(BODIES, F.col("page_id") * 3), F.lit(" "), F.coalesce("html", F.lit("")))
    return p.select("page_id", url.alias("url"), html.alias("html"), pick(STATED, F.col("page_id") * 5).alias("stated"))


def vendor_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor of every page's portal, the keys that its catalog row states, and the verdict."""
    rows = _portals(spark, sf_dir).withColumn("v", vendors.vendor(F.col("url"), F.col("html")))
    return rows.select("page_id", "v.key", "v.confidence", F.array_join(vendors.stated_keys(F.col("stated")), ",").alias("stated_keys"), vendors.has_evidence(F.col("html")).alias("evidence"), vendors.verdict(F.col("v.key"), F.col("stated"), F.col("html")).alias("verdict"))


def verdict_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.verdict_summary(vendor_classes(spark, sf_dir))


def profile_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-LD objects of pages with a plain block, a graph and a malformed one."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id").cast("string")
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    one = F.concat(F.lit('{"@type":"Organization","name":"Org '), k, F.lit('"}'))
    graph = F.concat(F.lit('[{"@type":"WebPage"},{"@graph":[{"@type":["Thing","LocalBusiness"],"name":" Shop '), k, F.lit(' ","areaServed":["Estero",{"name":"Naples"},"Estero"]},5]}]'))
    html = F.concat("html", block(one), block(F.lit("{broken")), F.when(F.col("page_id") % 2 == 0, block(graph)).otherwise(""))
    rows = p.select("page_id", profiles.json_ld(html).alias("objects")).withColumn("shop", profiles.of_type(F.col("objects"), "LocalBusiness"))
    areas = profiles.service_areas(F.try_variant_get("shop", "$.areaServed", "variant"), F.lit("Service Area\nNaples\nBonita\nBBB Business Profiles"))
    return rows.select("page_id", F.size("objects").alias("n_objects"), profiles.property_of(profiles.of_type(F.col("objects"), "Organization"), "name").alias("organization"), profiles.property_of(F.col("shop"), "name").alias("shop"), F.array_join(F.transform(areas, lambda a: F.concat_ws(":", a["name"], a["source"])), "|").alias("areas"))


def profile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile record from the objects, text and links written into every page: sources by precedence, children once."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    key = k.cast("string")
    t = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    business = t('<script type="application/ld+json">{"@type":"LocalBusiness"', F.when(k % 2 == 0, t(',"name":"Shop ', key, '"')).otherwise(""), ',"employee":[{"givenName":"Ann","familyName":"Lee ', key, '","jobTitle":"CEO"}],"logo":"l.png","image":["i.png","l.png"]}</script>')
    said = F.when(k % 3 == 0, "Shop is BBB Accredited.").when(k % 3 == 1, "Not BBB Accredited").otherwise("-")
    text_ = t("BUSINESS PROFILE\nRoofs\nSigned ", key, "\nA+\nRated by BBB\n", said, "\nAlternate Names:\nOld\nOlder\nBusiness Management:\nann lee ", key, ", ceo\nMr Bo, Boss\nAdditional Contact Information")
    link = lambda href, label: F.struct(t(*href).alias("href"), t(*label).alias("text"))
    links = F.array(link(["https://www.bbb.org/us/category/roofs?", key], ["Roofs"]), link(["https://www.bbb.org/us/category/roofs"], ["Roofing"]), link(["https://www.bbb.org/us/fl/profile/r/acme-0653-", key, "/addressId/7"], ["Branch"]), link(["https://a.example.org/", key], ["Visit Website"]))
    none = F.lit(None).cast("string")
    url = t("https://www.bbb.org/us/fl/profile/r/acme-0653-", key)
    more = F.when(k % 4 == 0, "Reasons for BBB Rating\nold\nlarge\nBBB Business Profiles")
    rows = p.select("page_id", profiles.json_ld(F.concat(business, "html")).alias("objects"), text_.alias("text"), links.alias("links"), url.alias("url"), more.alias("more"), F.when(k % 5 != 0, t("Listed ", key)).alias("listed"))
    r = rows.select("page_id", profile_record.record(F.col("objects"), F.col("text"), F.col("links"), F.col("url"), F.col("listed"), none, none, F.col("more")).alias("r"))
    names = lambda c, f: F.array_join(F.transform(c, f), "|")
    return r.select(
        "page_id", "r.name", "r.name_source", "r.accredited", "r.rating", "r.website", "r.business_id", names("r.contacts", lambda x: F.concat_ws(":", x["name"], x["title"], x["source"])).alias("contacts"), names("r.categories", lambda x: x["name"]).alias("categories"), names("r.images", lambda x: F.concat_ws(":", x["type"], x["url"])).alias("images"),
        names("r.alternate_names", lambda x: x["name"]).alias("alternate_names"), F.size("r.locations").alias("n_locations"), F.size("r.rating_reasons").alias("n_reasons"), F.size("r.reviews").alias("n_reviews"),
    )


def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews read back from a page text made of each conversation's turns."""
    c = table(spark, sf_dir, "conversations").where("text is not null")
    body = F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), r"(?i)date:|stars?|review", "_")
    one = F.concat(F.lit("Review from "), "role", F.lit("\nDate: 2024-01-"), F.format_string("%02d", F.col("turn") % 28 + 1), F.lit("\n"), (F.col("turn") % 5 + 1).cast("string"), F.lit(" stars\n"), body)
    page = c.groupBy("conv_id").agg(F.concat(F.lit("Reviews\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("one")))), lambda x: x["one"]), "\n"), F.lit("\nBBB Business Profiles are provided to you")).alias("page"))
    rows = page.select("conv_id", F.explode(profiles.reviews(F.col("page"))).alias("r"))
    return rows.select("conv_id", "r.ordinal", "r.day", "r.rating", "r.reviewer", F.length("r.body").cast("long").alias("n_chars"))


def profile_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities of profile and media addresses made of page keys."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id").cast("string")
    profile = F.concat(F.lit("https://www.example.org/us/fl/estero/profile/roofing/acme-roofing-0653-"), k, F.when(F.col("page_id") % 2 == 0, "/addressId/77?x=1").otherwise(""))
    media = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://a.example.org/Dotnet/Photo/photo.aspx?id="), k, F.lit("&width=400"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://a.example.org/dotnet/FloorPlan/FloorPlanGenerator.aspx?FolioID="), k, F.lit("&FloorNo=2"))).otherwise(F.lit("https://a.example.org/x.PDF"))
    rows = p.select("page_id", profiles.profile_identity(profile).alias("i"), profiles.media_link(media).alias("m"), profiles.media_extension(F.when(F.col("page_id") % 4 == 0, "image/PNG; q=1"), media).alias("extension"))
    return rows.select("page_id", "i.slug", "i.business", "i.address_id", "m.kind", "m.identity", "m.width", "extension")


def fee_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of each order's fees: the prices of its returned items, null where it has none."""
    li = table(spark, sf_dir, "lineitem")
    fees = li.groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("fees"))
    return fees.select("l_orderkey", permits.fee_total(F.col("fees")).alias("fee"))


def folder_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as folders: those with a first item's output, without a transformed second one, and not of a done customer."""
    li = table(spark, sf_dir, "lineitem")
    files = li.select(F.col("l_orderkey").alias("folder"), F.when(F.col("l_linestatus") == "F", "output.zip").when(F.col("l_linenumber") == 2, "transformed.zip").otherwise("other").alias("name"))
    done = table(spark, sf_dir, "orders").where("o_custkey % 5 = 0").select(F.col("o_orderkey").alias("folder"))
    return aggregates.folder_flags(files, done)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(pick(["Prepare", "Transform", "Upload", "Hash", "AutoRepair", "Submit"], k).alias("phase"), pick(["FAILED", "SUCCEEDED", "IN_PROGRESS", "PARKED"], F.floor(k / 6)).alias("status"), (k % 7).alias("value"), k.alias("event_id"), F.col("user_id").alias("execution_id"), F.col("ts"))


def failed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.failed_total(_metrics(spark, sf_dir), ["Prepare", "Transform", "Upload", "Hash", "AutoRepair"])


def phase_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest status of each user's phases, by event number."""
    return event_state.phase_states(_metrics(spark, sf_dir).drop("ts"), "event_id")


def job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _metrics(spark, sf_dir)
    tests = {"n_failed": F.col("status") == "FAILED", "n_parked": F.col("status") == "PARKED", "n_submit": F.col("phase") == "Submit", "n_zero": F.col("value") == 0, "n_large": F.col("value") > 4}
    return aggregates.job_counters(m, tests)


def unmatched_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of entities that only one side of a comparison has."""
    n = table(spark, sf_dir, "nation")
    item = lambda c: F.struct(F.array(F.struct(c.alias("source"))).alias("unmatched_from_a"))
    rows = n.select(item(F.concat(F.lit(" "), "n_name", F.lit(" "))).alias("QUANTITY"), item(F.substring("n_name", 1, 2)).alias("DATE"), item(F.lit("  ")).alias("ORGANIZATION"), item(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))).alias("LOCATION"))
    return aggregates.unmatched_sources(rows)


def queue_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    q = s.select(k.alias("queue"), k.cast("string").alias("visible"), F.when(k % 3 == 0, "x").otherwise((k % 7).cast("string")).alias("in_flight"), F.lit(None).cast("string").alias("delayed"), F.lit(50).alias("limit"))
    return aggregates.queue_depths(q).select("queue", "total", "blocked")


def join_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers linked to parts by their key or its double; how many were matched and how many changed, by nation."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey")).alias("part_id"), F.when(F.col("c_custkey") % 4 == 0, "high").alias("confidence"))
    p = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("part_id"))
    out = joins.join_update(c, p, [F.col("c_custkey"), F.col("c_custkey") * 2], F.col("part_id"), ["part_id"], {"confidence": "high"}, row_id=["c_custkey"])
    return out.groupBy("c_nationkey").agg(F.count_if("matched").alias("matched"), F.count_if("changed").alias("changed"), F.sum("part_id").alias("sum_part_id"))


def alternate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that know their part by key, or else by size and a brand that others share."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 2 == 0, F.col("l_partkey") + F.when(F.col("l_orderkey") % 4 == 0, 0).otherwise(10**9)).alias("part_key"), (F.col("l_partkey") % 50 + 1).cast("int").alias("size"), F.lit("Brand#11").alias("brand"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("int").alias("p_size"), "p_brand", F.col("p_partkey").alias("id"))
    out = joins.resolve_or_alternate(li, part, ("part_key", "p_partkey"), [("size", "p_size"), ("brand", "p_brand")], "id", "part_id")
    return out.groupBy(F.col("part_key").isNull().alias("by_alternate")).agg(F.count("*").alias("n"), F.count("part_id").alias("found"), F.sum("part_id").alias("sum_id"))


def routed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of bundles by file name into tables, in table order, and what can't be placed."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("data/"), pick(["property.json", "tax_1.json", "sales_history_2.json", "person_3.json", "deed_x.json", "lot.json", "mailing_address_1.json", "readme.md", "person_x.json"], k))
    body = F.when(k % 11 == 0, "[1]").when(k % 13 == 0, "{bad").otherwise(F.concat(F.lit('{"k":'), k.cast("string"), F.lit("}")))
    good, bad = routing.dispatched(o.select("o_orderkey", name.alias("file_name"), body.alias("value")))
    order = routing.joined_order(routing.APPRAISAL_ORDER, routing.PERMIT_ORDER)
    counts = good.groupBy("table_name").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order")).withColumn("place", routing.order_number(F.col("table_name"), order))
    lost = bad.groupBy(F.col("reason").alias("table_name")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order")).withColumn("place", routing.order_number(F.col("table_name"), order))
    return counts.unionByName(lost)


def deleted_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as executions, hashes of event kinds and days: what stays and what is lost when user 1 goes."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("execution_id"), F.concat_ws("#", "event_type", F.dayofyear("ts")).alias("error_hash"))
    stay, gone = state.delete_execution(e, "1")
    return stay.agg(F.count("*").alias("n"), F.countDistinct("error_hash").alias("hashes")).withColumn("what", F.lit("stays")).unionByName(gone.agg(F.count("*").alias("n"), F.countDistinct("error_hash").alias("hashes")).withColumn("what", F.lit("lost")))


def state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status with a status value migrated and sort keys derived anew."""
    o = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    m = state.migrated(o, "o_orderstatus", "P", "partial")
    return state.sort_keys(m, "n", "o_orderstatus", "o_orderpriority")


def solved_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions with links that left `failed`, from changes made of line items."""
    li = table(spark, sf_dir, "lineitem")
    image = lambda status: F.struct(F.lit("ExecutionError").alias("entity_type"), (F.col("l_orderkey") % 500).cast("string").alias("execution_id"), status.alias("status"))
    to = pick(["maybeSolved", "maybeUnrecoverable", "failed", "solved"], F.col("l_linenumber"))
    changes = li.select(F.when(F.col("l_returnflag") == "R", "REMOVE").otherwise("MODIFY").alias("event_name"), image(F.when(F.col("l_linestatus") == "F", "failed").otherwise("maybeSolved")).alias("old"), image(to).alias("new"))
    return event_state.solved_transitions(changes)


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address bases, county keys, object keys and entities of customers' texts."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    address = F.concat(k.cast("string"), F.lit(" Harbor Dr"), pick([" Unit 4", " ste 9 rear", " # 5", " Apartment 3", ""], k))
    uri = F.when(k % 3 == 0, F.concat(F.lit("s3://bucket-"), (k % 5).cast("string"), F.lit("/a/b/"), k.cast("string"))).otherwise(F.lit("s3://only"))
    return c.select(
        "c_custkey", text.address_base(address).alias("base"), text.county_key(F.concat(F.lit(" Palm   Beach "), k.cast("string"))).alias("county"), text.store_uri(uri)["bucket"].alias("bucket"), text.store_uri(uri)["key"].alias("object"),
        text.store_key(F.concat("c_name", F.lit(" a/b"))).alias("store_key"), text.unescape_html(text.escape_html(F.concat(F.lit("<a & 'b'> "), "c_name"))).alias("plain"), text.csv_line(F.col("c_name"), F.lit('q "x", y'), k).alias("csv"),
    )


def sale_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and deeds of one part side by side by ordinal: returned and kept items."""
    li = table(spark, sf_dir, "lineitem")
    sales = li.where("l_returnflag = 'R'").groupBy("l_orderkey", F.col("l_linenumber").alias("ordinal")).agg(F.max("l_extendedprice").alias("price"))
    deeds = li.where("l_linestatus = 'F'").groupBy("l_orderkey", F.col("l_linenumber").alias("ordinal")).agg(F.max("l_partkey").alias("part"))
    return aggregates.aligned(("sale", sales), ("deed", deeds), keys=["l_orderkey"])


QUERIES = {f.__name__: f for f in (
    use_codes, deed_types, improvement_types, vendor_classes, verdict_summary, profile_objects, profile_records, review_rows, profile_links, fee_totals, folder_flags, failed_total, phase_states, job_counters, unmatched_sources, queue_depths,
    join_update, alternate_keys, routed_files, deleted_execution, state_keys, solved_transitions, text_keys, sale_alignment,
)}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pick(values: list[str], number: str) -> str:
    return f"[{', '.join(map(_q, values))}][CAST(({number}) % {len(values)} + 1 AS INT)]"


def _texts(c: str, rules) -> str:
    """CASE of first-match text rules over a text in upper case."""
    whens = []
    for value, some, none in rules:
        hit = " OR ".join("(" + " AND ".join(f"contains({c}, {_q(t)})" for t in one.split("&")) + ")" for one in some)
        whens.append(f"WHEN ({hit})" + "".join(f" AND NOT contains({c}, {_q(t)})" for t in none) + f" THEN {_q(value)}")
    return f"CASE {' '.join(whens)} END"


def _deed_sql() -> str:
    codes = " ".join(f"WHEN list_contains(codes, {_q(c)}) THEN {_q(v)}" for c, v in property_codes.DEED_CODES)
    letters = " ".join("WHEN " + " OR ".join("(" + " AND ".join([f"contains(letters, {_q(t)})" for t in every] + [f"NOT contains(letters, {_q(t)})" for t in no]) + ")" for every, no in some) + f" THEN {_q(v)}" for v, some in property_codes.DEED_LETTERS)
    names = " ".join("WHEN " + " OR ".join(f"contains(low, {_q(n)}) OR contains({_q(n)}, low)" for n in some) + f" THEN {_q(v)}" for v, some in property_codes.DEED_NAMES)
    none = " OR ".join(f"contains(low, {_q(t)})" for t in property_codes.NO_DEED)
    return rf"""WITH t AS (SELECT o_orderkey, o_orderdate, {_pick(DEEDS, "o_orderkey")} AS s FROM orders),
        u AS (SELECT *, list_transform(list_filter(string_split_regex(s, '[^0-9A-Za-z]+'), lambda x: regexp_full_match(x, '\d{{1,2}}')), lambda x: lpad(x, 2, '0')) AS codes, coalesce(nullif(regexp_extract(s, '^\d+\s*[-–:/]\s*(.+)$', 1), ''), s) AS named FROM t),
        v AS (SELECT *, lower(named) AS low, regexp_replace(upper(named), '[^A-Z0-9]+', '', 'g') AS letters FROM u)
        SELECT o_orderkey, CASE WHEN regexp_matches(upper(s), '^XX(\.?$| )') THEN 'Miscellaneous' {codes} WHEN NOT regexp_matches(named, '[a-zA-Z]') OR low IN ('n/a', 'na') OR {none} THEN 'Miscellaneous' {letters} {names} ELSE 'Miscellaneous' END AS deed_type,
        strftime(o_orderdate, '%m/%d/%Y') AS us_day, strftime(o_orderdate, '%Y%m%d') || '_20240131' AS window_key, CASE o_orderkey % 4 WHEN 0 THEN 'Roof' WHEN 1 THEN 'Commercial' WHEN 3 THEN 'Mechanical' END AS record_type FROM v"""


EVIDENCE = "(?i)" + chr(92) + "b(" + "|".join(vendors.EVIDENCE) + ")" + chr(92) + "b"


def _vendor_sql() -> str:
    urls = " ".join(f"WHEN regexp_matches(url, {_q('(?i)' + '|'.join(f'(?:{p})' for p in patterns))}) THEN {_q(key)}" for key, _, patterns, _ in vendors.VENDORS)
    pages = " ".join("WHEN " + " OR ".join(f"contains(lower(html), {_q(m.lower())})" for m in markers) + f" THEN {_q(key)}" for key, _, _, markers in vendors.VENDORS)
    named = ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(stated), {_q(t.lower())})" for t in (key, name, *markers)) + f" THEN [{', '.join(map(_q, [key, *vendors.FAMILIES.get(key, [])]))}] ELSE [] END" for key, name, _, markers in vendors.VENDORS)
    return rf"""p AS (SELECT page_id, 'https://' || {_pick(HOSTS, "page_id")} || page_id AS url, {_pick(BODIES, "page_id * 3")} || ' ' || coalesce(html, '') AS html, {_pick(STATED, "page_id * 5")} AS stated FROM pages),
        v AS (SELECT *, CASE {urls} END AS by_url, CASE {pages} END AS by_page, flatten([{named}]) AS keys, regexp_matches(html, {_q(EVIDENCE)}) AS evidence FROM p),
        d AS (SELECT *, coalesce(by_url, by_page, 'unknown') AS key, list_filter(keys, lambda x, i: list_position(keys, x) = i) AS k FROM v),
        r AS (SELECT page_id, key, CASE WHEN by_url IS NOT NULL THEN 'url' WHEN by_page IS NOT NULL THEN 'html' ELSE 'none' END AS confidence, array_to_string(k, ',') AS stated_keys, evidence,
            CASE WHEN list_contains(k, key) AND evidence THEN 'PASS' ELSE 'REVIEW' END AS verdict FROM d)"""


def _improvement_sql() -> str:
    whens = " ".join("WHEN " + " OR ".join(f"regexp_matches(t, {_q(w)})" if "\\" in w else f"contains(t, {_q(w)})" for w in words) + f" THEN {_q(value)}" for value, words in property_codes.IMPROVEMENTS)
    return f"""WITH d AS (SELECT doc_id, lang, lower({_pick([*WORKS, ""], "doc_id")} || '. ' || coalesce(text, '')) AS t FROM documents)
        SELECT lang, CASE {whens} WHEN doc_id % 3 = 0 THEN 'LandscapeIrrigation' ELSE 'GeneralBuilding' END AS type, count(*) AS n, min(doc_id) AS first_doc FROM d GROUP BY ALL"""


_METRICS = f"""m AS (SELECT event_id, user_id AS execution_id, {_pick(["Prepare", "Transform", "Upload", "Hash", "AutoRepair", "Submit"], "event_id")} AS phase,
    {_pick(["FAILED", "SUCCEEDED", "IN_PROGRESS", "PARKED"], "event_id // 6")} AS status, event_id % 7 AS value FROM events)"""
_PART = f"p AS (SELECT *, upper({_pick(USES, 'p_partkey')}) AS u, upper({_pick(BUILDS, 'p_size')}) AS b FROM part)"
ORACLE_SQL = {
    "use_codes": f"""WITH {_PART} SELECT p_partkey, {_texts("u", property_codes.BREVARD_USES)} AS use_a, {_texts("u", property_codes.LAKE_USES)} AS use_b, {_texts("b", property_codes.EXTERIORS)} AS exterior, {_texts("b", property_codes.FRAMES)} AS frame,
        CASE WHEN b LIKE '%HIP%' AND b LIKE '%GABLE%' THEN 'Combination' WHEN b LIKE '%HIP%' THEN 'Hip' WHEN b LIKE '%GABLE%' THEN 'Gable' WHEN b LIKE '%FLAT%' THEN 'Flat' WHEN b LIKE '%SHED%' THEN 'Shed' END AS roof_design,
        {_texts("b", property_codes.ROOF_MATERIALS)} AS roof_material, {_texts("b", property_codes.ROOF_COVERINGS)} AS roof_covering, CASE p_size WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three' WHEN 4 THEN 'Four' END AS units,
        CASE WHEN p_retailprice - (1000.0 + p_size) > 0 THEN round(p_retailprice - (1000.0 + p_size), 2) END AS building_value, CASE WHEN p_size * 60 BETWEEN 1800 AND 2100 THEN (p_size * 60) || '-01-01' END AS built FROM p""",
    "deed_types": _deed_sql(),
    "improvement_types": _improvement_sql(),
    "vendor_classes": f"WITH {_vendor_sql()} SELECT * FROM r",
    "verdict_summary": f"WITH {_vendor_sql()} SELECT count(*) AS total, count(*) FILTER (verdict = 'PASS') AS passed, count(*) FILTER (verdict = 'REVIEW') AS review, CAST(0 AS BIGINT) AS other FROM r",
    "profile_objects": """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 4 ELSE 1 END AS n_objects, 'Org ' || page_id AS organization, CASE WHEN page_id % 2 = 0 THEN 'Shop ' || page_id END AS shop,
        CASE WHEN page_id % 2 = 0 THEN 'Estero:json_ld|Naples:json_ld|Bonita:visible_text' ELSE 'Naples:visible_text|Bonita:visible_text' END AS areas FROM pages""",
    "review_rows": r"""WITH c AS (SELECT conv_id, turn, role, regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '(?i)date:|stars?|review', '_', 'g') AS body FROM conversations WHERE text IS NOT NULL)
        SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INT) AS ordinal, '2024-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') AS day, CAST(turn % 5 + 1 AS DOUBLE) AS rating, role AS reviewer, nullif(CAST(length(trim(body)) AS BIGINT), 0) AS n_chars FROM c""",
    "profile_records": """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Shop ' || page_id WHEN page_id % 5 <> 0 THEN 'Listed ' || page_id ELSE 'Signed ' || page_id END AS name, CASE WHEN page_id % 2 = 0 THEN 'json_ld' WHEN page_id % 5 <> 0 THEN 'listing' ELSE 'visible_text' END AS name_source,
        CASE page_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS accredited, 'A+' AS rating, 'https://a.example.org/' || page_id AS website, CAST(page_id AS VARCHAR) AS business_id, 'Ann Lee ' || page_id || ':CEO:json_ld|Mr Bo:Boss:visible_text' AS contacts, 'Roofing' AS categories, 'IMAGE:l.png|IMAGE:i.png' AS images,
        'Old|Older' AS alternate_names, 1 AS n_locations, CASE WHEN page_id % 4 = 0 THEN 2 ELSE 0 END AS n_reasons, 0 AS n_reviews FROM pages""",
    "profile_links": """SELECT page_id, 'acme-roofing' AS slug, CAST(page_id AS VARCHAR) AS business, CASE WHEN page_id % 2 = 0 THEN '77' END AS address_id,
        CASE page_id % 3 WHEN 0 THEN 'APPRAISAL_PHOTO' WHEN 1 THEN 'APPRAISAL_FLOOR_PLAN' END AS kind, CASE page_id % 3 WHEN 0 THEN 'photo:' || page_id WHEN 1 THEN 'floorplan:' || page_id || ':unknown:2:current' END AS identity,
        CASE WHEN page_id % 3 = 0 THEN 400 END AS width, CASE WHEN page_id % 4 = 0 THEN '.png' WHEN page_id % 3 = 2 THEN '.pdf' ELSE '.aspx' END AS extension FROM pages""",
    "fee_totals": "SELECT l_orderkey, round(sum(l_extendedprice) FILTER (l_returnflag = 'R'), 2) AS fee FROM lineitem GROUP BY 1",
    "folder_flags": """SELECT l_orderkey AS folder, count(*) AS n_files FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 5 = 0) GROUP BY 1
        HAVING bool_or(l_linestatus = 'F') AND NOT bool_or(l_linestatus <> 'F' AND l_linenumber = 2)""",
    "failed_total": f"""WITH {_METRICS}, f AS (SELECT phase, value FROM m WHERE status = 'FAILED') SELECT CAST(coalesce(sum(value) FILTER (phase <> 'Submit'), 0) AS BIGINT) AS total_failed,
        {", ".join(f"CAST(coalesce(sum(value) FILTER (phase = '{p}'), 0) AS BIGINT) AS {p}" for p in ("Prepare", "Transform", "Upload", "Hash", "AutoRepair"))} FROM f""",
    "phase_states": f"WITH {_METRICS} SELECT execution_id, phase, arg_max(status, event_id) AS status, max(event_id) AS event_id, count(*) AS n_events FROM m GROUP BY 1, 2",
    "job_counters": f"""WITH {_METRICS} SELECT count(*) FILTER (status = 'FAILED') AS n_failed, count(*) FILTER (status = 'PARKED') AS n_parked, count(*) FILTER (phase = 'Submit') AS n_submit,
        count(*) FILTER (value = 0) AS n_zero, count(*) FILTER (value > 4) AS n_large FROM m""",
    "unmatched_sources": "SELECT n_name AS source FROM nation UNION SELECT substr(n_name, 1, 2) FROM nation",
    "queue_depths": """SELECT s_suppkey AS queue, s_suppkey + CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey % 7 END AS total, s_suppkey + CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey % 7 END >= 50 AS blocked FROM supplier""",
    "join_update": """WITH p AS (SELECT p_partkey FROM part WHERE p_partkey % 3 = 0), j AS (SELECT c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN c_custkey END AS old, coalesce(a.p_partkey, b.p_partkey) AS new
        FROM customer LEFT JOIN p a ON a.p_partkey = c_custkey LEFT JOIN p b ON b.p_partkey = c_custkey * 2)
        SELECT c_nationkey, count(new) AS matched, count(*) FILTER (new IS NOT NULL AND old IS DISTINCT FROM new) AS changed, CAST(sum(coalesce(new, old)) AS BIGINT) AS sum_part_id FROM j GROUP BY 1""",
    "alternate_keys": """WITH li AS (SELECT CASE WHEN l_orderkey % 4 = 0 THEN l_partkey WHEN l_orderkey % 2 = 0 THEN l_partkey + 1000000000 END AS k, l_partkey % 50 + 1 AS size FROM lineitem),
        a AS (SELECT p_size, min(p_partkey) AS id FROM part WHERE p_brand = 'Brand#11' GROUP BY 1),
        j AS (SELECT k, CASE WHEN k IS NULL THEN a.id ELSE p_partkey END AS id FROM li LEFT JOIN part ON k = p_partkey LEFT JOIN a ON size = p_size_a)
        SELECT k IS NULL AS by_alternate, count(*) AS n, count(id) AS found, CAST(sum(id) AS BIGINT) AS sum_id FROM j GROUP BY 1""".replace("SELECT p_size, min", "SELECT p_size AS p_size_a, min"),
    "routed_files": f"""WITH f AS (SELECT o_orderkey AS k, {_pick(["property.json", "tax_1.json", "sales_history_2.json", "person_3.json", "deed_x.json", "lot.json", "mailing_address_1.json", "readme.md", "person_x.json"], "o_orderkey")} AS name FROM orders),
        t AS (SELECT k, unnest(CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN ['not a JSON object'] ELSE CASE k % 9 WHEN 0 THEN ['properties'] WHEN 1 THEN ['taxes', 'property_valuations'] WHEN 2 THEN ['sales_histories'] WHEN 3 THEN ['people', 'ownerships']
            WHEN 4 THEN ['deeds'] WHEN 5 THEN ['lots'] WHEN 6 THEN ['addresses'] ELSE ['no table for data/' || name] END END) AS table_name FROM f)
        SELECT table_name, count(*) AS n, min(k) AS first_order, coalesce(list_position({[*routing.APPRAISAL_ORDER]}, table_name), {len(routing.joined_order(routing.APPRAISAL_ORDER, routing.PERMIT_ORDER)) + 1}) AS place FROM t GROUP BY 1""",
    "deleted_execution": """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS x, event_type || '#' || dayofyear(ts) AS h FROM events)
        SELECT count(*) AS n, count(DISTINCT h) AS hashes, 'stays' AS what FROM e WHERE x IS DISTINCT FROM '1'
        UNION ALL SELECT count(DISTINCT h), count(DISTINCT h), 'lost' FROM e WHERE x = '1' AND h NOT IN (SELECT h FROM e WHERE x IS DISTINCT FROM '1')""",
    "state_keys": """WITH o AS (SELECT o_orderstatus AS s, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2), m AS (SELECT CASE WHEN s = 'P' THEN 'partial' ELSE s END AS o_orderstatus, o_orderpriority, n, s = 'P' AS changed, lpad(CAST(n AS VARCHAR), 10, '0') AS pad FROM o)
        SELECT o_orderstatus, o_orderpriority, n, changed, pad AS count_key, upper(o_orderstatus) || '#' || pad AS status_key, o_orderpriority || '#' || pad AS kind_key FROM m""",
    "solved_transitions": f"""WITH c AS (SELECT CAST(l_orderkey % 500 AS VARCHAR) AS execution_id, {_pick(["maybeSolved", "maybeUnrecoverable", "failed", "solved"], "l_linenumber")} AS t FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus = 'F')
        SELECT execution_id, count(*) FILTER (t = 'maybeSolved') AS solved, count(*) FILTER (t = 'maybeUnrecoverable') AS unrecoverable FROM c WHERE t LIKE 'maybe%' GROUP BY 1""",
    "text_keys": r"""SELECT c_custkey, c_custkey || ' HARBOR DR' || CASE c_custkey % 5 WHEN 2 THEN ' # 5' WHEN 3 THEN ' APARTMENT 3' ELSE '' END AS base, 'palm-beach-' || c_custkey AS county, CASE WHEN c_custkey % 3 = 0 THEN 'bucket-' || (c_custkey % 5) END AS bucket,
        CASE WHEN c_custkey % 3 = 0 THEN 'a/b/' || c_custkey END AS object, regexp_replace(c_name || ' a/b', '[^A-Za-z0-9._-]+', '_', 'g') AS store_key, '<a & ''b''> ' || c_name AS plain, c_name || ',"q ""x"", y",' || c_custkey AS csv FROM customer""",
    "sale_alignment": """WITH li AS (SELECT * FROM lineitem), s AS (SELECT l_orderkey, l_linenumber AS ordinal, max(l_extendedprice) AS sale_price FROM li WHERE l_returnflag = 'R' GROUP BY 1, 2),
        d AS (SELECT l_orderkey, l_linenumber AS ordinal, max(l_partkey) AS deed_part FROM li WHERE l_linestatus = 'F' GROUP BY 1, 2) SELECT l_orderkey, ordinal, sale_price, deed_part FROM s FULL JOIN d USING (l_orderkey, ordinal)""",
}
