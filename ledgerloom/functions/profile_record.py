"""One record of a business profile from its pages: fields by precedence of sources, and child rows that are each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .pages import first_email, first_website, is_external, is_own_link, is_profile_url, profile_base
from .profiles import complaints, first_integer, first_number, let, of_type, profile_identity, property_of, reviews, section, service_areas
from .rules import external_link_kind
from .text import host, labelled

#: Sections of contacts with their roles, and the headings that end them.
CONTACTS = [("Business Management", None, ["Additional Contact Information"]), ("Principal Contacts", "PRINCIPAL", ["Customer Contacts"]), ("Customer Contacts", "CUSTOMER", ["Additional Email Addresses", "Additional Websites", "Social Media", "Additional Information", "Business Categories"])]
#: What a page says of an accredited business, and of another one.
ACCREDITED, NOT_ACCREDITED = ["bbb accredited business", "is bbb accredited"], ["not bbb accredited", "is not bbb accredited"]
#: Parts of a person's name in JSON-LD, in order.
NAME_PARTS = ["honorificPrefix", "givenName", "additionalName", "familyName", "honorificSuffix"]
#: A number of closed complaints, and of all, in a page's words.
COMPLAINT_COUNTS = {"closed_three_years": [r"(?i)(\d+) complaints? closed in (?:the )?last (?:3|three) years"], "closed_twelve_months": [r"(?i)(\d+) complaints? closed in (?:the )?last (?:12|twelve) months"], "total": [r"(?i)Customer Complaints\s*(\d+)", r"(?i)This business has (\d+) complaints?"]}
CONTACT = "struct<name:string,title:string,role:string,source:string>"


def once(rows: Column, key: Callable[[Column], Column], last: bool = False) -> Column:
    """The first row of each key (null keys are rows each), or with last=True the last one at the first one's place."""

    def pick(pairs: Column) -> Column:
        def is_first(p: Column, i: Column) -> Column:
            return p["key"].isNull() | (F.array_position(F.transform(pairs, lambda x: x["key"]), p["key"]) == i + 1)

        def value(p: Column) -> Column:
            return F.get(F.reverse(F.filter(pairs, lambda x: x["key"] == p["key"])), F.lit(0))["row"] if last else p["row"]

        return F.transform(F.filter(pairs, is_first), lambda p: F.coalesce(value(p), p["row"]))

    return let(F.transform(rows, lambda r: F.struct(key(r).alias("key"), r.alias("row"))), pick)


def _lines(c: Column) -> Column:
    """Lines of a section with anything in them, trimmed; none of a null one."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), F.trim), lambda x: x != "")


def accreditation(text: Column) -> Column:
    """True or false as the page says, null if it says nothing."""
    low = F.lower(text)
    holds = lambda texts: F.greatest(*[F.contains(low, F.lit(t)) for t in texts])
    return F.when(holds(ACCREDITED), True).when(holds(NOT_ACCREDITED), False)


def rating(text: Column) -> Column:
    """A letter from A to F with a sign, or NR: the line before "Rated by BBB", or the one after "BBB Rating"."""
    marks = lambda x: F.upper(x).rlike(r"^([A-F][+-]?|NR)$")

    def read(ls: Column) -> Column:
        before = F.filter(F.transform(ls, lambda x, i: F.when(marks(x) & F.startswith(F.lower(F.get(ls, i + 1)), F.lit("rated by bbb")), x)), lambda x: x.isNotNull())
        after = F.filter(F.transform(ls, lambda x, i: F.when(F.endswith(F.lower(x), F.lit("bbb rating")) & marks(F.get(ls, i + 1)), F.get(ls, i + 1))), lambda x: x.isNotNull())
        return F.coalesce(F.get(before, F.lit(0)), F.get(after, F.lit(0)))

    return let(_lines(text), read)


def _items(v: Column) -> Column:
    """A variant's items: those of an array, or itself; none of a null."""
    return F.filter(F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)), lambda x: x.isNotNull())


def contacts(business: Column, text: Column) -> Column:
    """array<CONTACT>: employees of the JSON-LD object, then lines of the page's three sections; equal ones, by name,
    title and role without regard to case, come once. A name of JSON-LD may be in parts; a line is a name and a title."""
    part = lambda e, n: property_of(e, n)
    joined = lambda e: F.nullif(F.concat_ws(" ", *[part(e, n) for n in NAME_PARTS]), F.lit(""))
    employees = F.transform(F.filter(_items(F.try_variant_get(business, "$.employee", "variant")), lambda e: F.startswith(F.schema_of_variant(e), F.lit("OBJECT"))), lambda e: F.struct(F.coalesce(part(e, "name"), joined(e)).alias("name"), F.coalesce(part(e, "title"), part(e, "jobTitle")).alias("title"), part(e, "role").alias("role"), F.lit("json_ld").alias("source")))
    rows = [F.coalesce(employees, F.array().cast(f"array<{CONTACT}>")).cast(f"array<{CONTACT}>")]

    def of_section(start: str, role: str | None, ends: list[str]) -> Column:
        line = lambda x: F.struct(F.trim(F.substring_index(x, ",", 1)).alias("name"), F.nullif(F.trim(F.when(F.contains(x, F.lit(",")), F.substring(x, F.locate(",", x) + 1, F.length(x)))), F.lit("")).alias("title"), F.lit(role).cast("string").alias("role"), F.lit("visible_text").alias("source"))
        return F.transform(_lines(section(text, start, *ends)), line).cast(f"array<{CONTACT}>")

    rows += [of_section(*c) for c in CONTACTS]
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    named = F.filter(F.concat(*rows), lambda r: r["name"].isNotNull() & ~r["name"].isin("", ":"))
    return once(named, lambda r: F.concat_ws("|", low(r["name"]), low(r["title"]), low(r["role"])))


def images(business: Column) -> Column:
    """array<struct(type, url, source)>: the logo, then the images; an address comes once, as what it is last."""
    url = lambda v: F.coalesce(F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")), property_of(v, "url"), property_of(v, "contentUrl"))
    row = lambda kind: lambda v: F.struct(F.lit(kind).alias("type"), url(v).alias("url"), F.lit("json_ld").alias("source"))
    every = F.concat(*[F.transform(_items(F.try_variant_get(business, f"$.{name}", "variant")), row(kind)) for name, kind in (("logo", "LOGO"), ("image", "IMAGE"))])
    return once(F.filter(F.coalesce(every, F.array().cast("array<struct<type:string,url:string,source:string>>")), lambda r: r["url"].isNotNull()), lambda r: r["url"], last=True)


def record(objects: Column, text: Column, links: Column, own_url: Column, listed_name: Column, reviews_text: Column, complaints_text: Column, more_text: Column) -> Column:
    """struct of a profile: objects are its JSON-LD ones, links array<struct(href, text)>, and the texts those of its pages
    (null: no such page). name_source says where the name is from; child arrays may be empty, never null."""
    business = of_type(objects, "LocalBusiness")

    def of(b: Column) -> Column:
        lines = _lines(text)
        heading = let(lines, lambda ls: F.get(ls, F.array_position(ls, F.lit("BUSINESS PROFILE")).cast("int") + 1))
        heading = F.when(F.array_contains(lines, "BUSINESS PROFILE"), heading)
        stated = [("json_ld", property_of(b, "name")), ("listing", listed_name), ("visible_text", heading)]
        identity = profile_identity(own_url)
        links_ = F.coalesce(links, F.array().cast("array<struct<href:string,text:string>>"))
        label = lambda x: F.nullif(F.trim(x["text"]), F.lit(""))
        categories = once(F.transform(F.filter(links_, lambda x: (F.contains(x["href"], F.lit("/category/")) | F.contains(x["href"], F.lit("/category-"))) & label(x).isNotNull()), lambda x: F.struct(label(x).alias("name"), profile_base(x["href"]).alias("url"))), lambda r: r["url"], last=True)
        branches = F.filter(links_, lambda x: is_profile_url(x["href"]) & F.contains(x["href"], F.lit("/addressId/")))
        locations = once(F.filter(F.transform(branches, lambda x: F.struct(F.lit("BRANCH").alias("relationship"), label(x).alias("name"), profile_base(x["href"]).alias("url"), profile_identity(x["href"])["business"].alias("business"))), lambda r: r["url"] != own_url), lambda r: r["url"], last=True)
        outside = once(F.transform(F.filter(links_, lambda x: is_external(x["href"]) & ~is_own_link(x["href"], x["text"])), lambda x: F.struct(external_link_kind(host(x["href"])).alias("kind"), x["href"].alias("url"), label(x).alias("label"))), lambda r: r["url"], last=True)
        licence = section(text, "Licensing information", "Additional Information")
        reasons = F.coalesce(section(more_text, "Reasons for BBB Rating", "BBB Business Profiles"), section(more_text, "Factors that affect", "BBB Business Profiles"))
        visible = lambda x: F.struct(x.alias("name"), F.lit("visible_text").alias("source"))
        return F.struct(
            F.coalesce(*[v for _, v in stated]).alias("name"), F.coalesce(*[F.when(v.isNotNull(), F.lit(s)) for s, v in stated]).alias("name_source"), property_of(b, "legalName").alias("legal_name"),
            F.coalesce(property_of(b, "description"), section(text, "About This Business", "BBB Accredited Since")).alias("description"), property_of(b, "telephone").alias("phone"), first_website(links_).alias("website"), first_email(links_).alias("email_url"),
            identity["slug"].alias("slug"), identity["business"].alias("business_id"), accreditation(text).alias("accredited"), labelled(text, "BBB Accredited Since").alias("accredited_since"), rating(text).alias("rating"), labelled(text, "Business Started").alias("started"),
            first_integer(text, [r"Years in Business:\s*(\d+)"]).alias("years"), labelled(text, "Type of Entity").alias("entity_type"),
            F.transform(_lines(section(text, "Alternate Names:", "Business Management:")), visible).alias("alternate_names"), contacts(b, text).alias("contacts"), categories.alias("categories"), locations.alias("locations"),
            F.filter(F.array(licence), lambda x: x.isNotNull()).alias("licences"), F.coalesce(service_areas(F.try_variant_get(b, "$.areaServed", "variant"), F.coalesce(more_text, text)), F.array().cast("array<struct<name:string,source:string>>")).alias("service_areas"),
            images(b).alias("images"), outside.alias("links"), F.coalesce(F.transform(_lines(reasons), lambda x, i: F.struct((i + 1).alias("ordinal"), x.alias("text"))), F.array().cast("array<struct<ordinal:int,text:string>>")).alias("rating_reasons"),
            reviews(F.coalesce(reviews_text, F.lit(""))).alias("reviews"), complaints(F.coalesce(complaints_text, F.lit(""))).alias("complaints"),
            F.struct(first_integer(reviews_text, [r"(?i)This business has\s+(\d+)\s+reviews?", r"(?i)(\d+)\s+Customer Reviews?"]).alias("reviews_total"), first_number(reviews_text, [r"(?i)Average of\s+([\d.]+)", r"(?i)([\d.]+)\s+stars?"]).alias("average"), *[first_integer(complaints_text, p).alias(n) for n, p in COMPLAINT_COUNTS.items()]).alias("summary"),
        )

    return of(business)
