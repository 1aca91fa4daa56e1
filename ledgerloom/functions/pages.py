"""Fetched pages and their links: error and challenge pages, profile listings, portal candidates, small value rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vendors
from .profiles import let
from .rules import external_link_kind
from .text import host, number, slug

#: Texts of error pages of two sites, and of a bot challenge.
DETAIL_ERRORS = ["unable to proceed", "technical difficulties", "object reference not set", "string was not recognized"]
PROFILE_ERRORS = ["oops! we'll be right back"]
CHALLENGE = "just a moment"
#: Pages below a profile.
SUBPAGES = ["complaints", "customer-reviews", "details", "email-this-business", "leave-a-review", "more-info"]
#: The profile site's own host, and hosts, accounts and link texts that belong to it.
PROFILE_HOST = "bbb.org"
OWN_HOSTS = ["bbbmarketplacetrust.org", "give.org", "bbbprograms.org"]
OWN_ACCOUNTS = [("facebook.com", "betterbusinessbureau"), ("twitter.com", "bbb_us"), ("linkedin.com", "better-business-bureau"), ("instagram.com", "betterbusinessbureau")]
OWN_TEXTS = ["bbb institute", "bbb wise giving", "bbb national programs", "scam survival kit"]
SHARE_LINKS = ["facebook.com/sharer", "twitter.com/intent", "linkedin.com/sharearticle"]
#: Addresses that a jurisdiction's portal may have; {slug} with dashes, {name} without.
PORTALS = [
    "https://{name}-egov.aspgov.com/Click2GovBP/", "https://{slug}-egov.aspgov.com/Click2GovBP/", "https://permit-planner.{name}.org/", "https://permit-planner.{name}.gov/", "https://www.{name}.gov/", "https://www.{name}.org/",
    "https://{name}.gov/", "https://{name}fl.gov/", "https://www.{name}.us/",
]
#: Labels of a cost card; each ends the values of the one before.
COST_LABELS = ["BUILDING COST VALUE", "BUILDING EXTRA FEATURES", "LAND EXTRA FEATURES", "LAND VALUE", "COST APPROACH VALUE", "INCOME APPROACH VALUE", "SALES APPROACH VALUE", "MARKET VALUE"]


def _any(c: Column, texts: list[str]) -> Column:
    low, out = F.lower(F.coalesce(c, F.lit(""))), F.lit(False)
    for t in texts:
        out = out | F.contains(low, F.lit(t))
    return out


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def is_challenge(title: Column, body: Column) -> Column:
    return _any(title, [CHALLENGE]) | _any(body, [f"{CHALLENGE}..."])


def is_error_page(title: Column, body: Column) -> Column:
    return _any(title, ["error | better business bureau"]) | _any(body, PROFILE_ERRORS) | F.coalesce(body.rlike(r"(?i)Loading chunk \d+ failed"), F.lit(False))


def is_unavailable_detail(body: Column) -> Column:
    return _any(body, DETAIL_ERRORS)


def is_profile_url(url: Column) -> Column:
    return F.coalesce(F.endswith(host(url), F.lit(PROFILE_HOST)) & F.contains(_path(url), F.lit("/profile/")), F.lit(False))


def profile_base(url: Column) -> Column:
    """A profile's own address: without query, fragment, closing slash and subpage."""
    head = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    parts = F.filter(F.split(_path(url), "/"), lambda p: p != "")
    places = F.transform(parts, lambda p, i: F.when((i > 0) & p.isin(*SUBPAGES), i))
    stop = F.array_min(F.filter(places, lambda i: i.isNotNull()))
    kept = F.when(stop.isNull(), parts).otherwise(F.slice(parts, F.lit(1), stop))
    return F.when(F.size(kept) > 0, F.concat(head, F.lit("/"), F.array_join(kept, "/"))).otherwise(head)


def is_external(url: Column) -> Column:
    """A web address outside the profile site that isn't a share button."""
    return F.coalesce(url.rlike("(?i)^https?://") & ~F.endswith(host(url), F.lit(PROFILE_HOST)), F.lit(False)) & ~_any(url, SHARE_LINKS)


def is_own_link(url: Column, label: Column) -> Column:
    """An outside link of the profile site itself: its hosts, its accounts, its link texts."""
    name, path = host(url), F.lower(_path(url))
    out = F.coalesce(label.rlike(r"(?i)^our\s+"), F.lit(False)) | _any(label, OWN_TEXTS)
    for h in OWN_HOSTS:
        out = out | F.endswith(name, F.lit(h))
    for site, account in OWN_ACCOUNTS:
        at = F.contains(name, F.lit(site)) | ((name == "x.com") if site == "twitter.com" else F.lit(False))
        out = out | (at & F.contains(path, F.lit(account)))
    return F.coalesce(out, F.lit(False))


def first_website(links: Column) -> Column:
    """The business's own site from array<struct(href, text)>: the link that says so, else the first outside website."""
    fine = F.filter(links, lambda x: is_external(x["href"]) & ~is_own_link(x["href"], x["text"]))
    stated = F.filter(fine, lambda x: F.lower(x["text"]) == "visit website")
    sites = F.filter(fine, lambda x: external_link_kind(host(x["href"])) == "WEBSITE")
    return F.coalesce(F.get(stated, F.lit(0))["href"], F.get(sites, F.lit(0))["href"])


def first_email(links: Column) -> Column:
    hit = F.filter(links, lambda x: F.contains(F.lower(x["href"]), F.lit("email-this-business")) | F.coalesce(x["text"].rlike(r"(?i)^Email (?:this )?Business$"), F.lit(False)))
    return F.get(hit, F.lit(0))["href"]


def listings(pages: DataFrame, page: str, links: str) -> DataFrame:
    """(page, ordinal, profile_url, link_text): profiles that a page lists, each once at its first place, numbered."""
    each = pages.select(page, F.posexplode(links).alias("i", "x")).where(is_profile_url(F.col("x.href")))
    first = each.groupBy(page, profile_base(F.col("x.href")).alias("profile_url")).agg(F.min(F.struct("i", F.col("x.text").alias("text"))).alias("m"))
    number_ = F.row_number().over(Window.partitionBy(page).orderBy("m.i"))
    return first.select(page, number_.cast("long").alias("ordinal"), "profile_url", F.col("m.text").alias("link_text"))


def portal_candidates(jurisdiction: Column) -> Column:
    """array of distinct addresses to try, in order."""

    def filled(dashed: Column) -> Column:
        name = F.translate(dashed, "-", "")
        return F.array_distinct(F.array(*[F.replace(F.replace(F.lit(p), F.lit("{slug}"), dashed), F.lit("{name}"), name) for p in PORTALS]))

    return let(slug(jurisdiction), filled)


def discovered(tries: DataFrame, jurisdiction: str = "jurisdiction") -> DataFrame:
    """(jurisdiction, portal, vendor, state) of tried candidates (place, status, final_url, html).

    The first candidate with status 200, that speaks of permits and is of a known vendor is discovered; a jurisdiction
    without one needs review.
    """
    v = tries.withColumn("v", vendors.vendor(F.col("final_url"), F.col("html")))
    good = (F.col("status") == 200) & vendors.has_evidence(F.col("html")) & (F.col("v.key") != "unknown")
    out = v.groupBy(jurisdiction).agg(F.min(F.when(good, F.struct("place", F.col("final_url").alias("portal"), F.col("v.name").alias("vendor")))).alias("m"))
    return out.select(jurisdiction, F.col("m.portal").alias("portal"), F.coalesce("m.vendor", F.lit("unknown")).alias("vendor"), F.when(F.col("m").isNotNull(), "discovered").otherwise("needs-review").alias("state"))


def currency(c: Column) -> Column:
    """The number that a text begins with, after $, commas and white space are dropped, to two decimals."""
    return F.round(F.nullif(F.regexp_extract(F.regexp_replace(c, r"[$,\s]", ""), r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1), F.lit("")).try_cast("double"), 2)


def capitalised(c: Column) -> Column:
    low = F.lower(c)
    return F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, F.lit(2), F.length(low)))


def unit_bucket(n: Column) -> Column:
    """One for null, zero and one; Two to Four by name; other numbers between one and four as a range; null beyond."""
    return (
        F.when(n.isNull() | (n == 0) | (n == 1), "One").when(n == 2, "Two").when(n == 3, "Three").when(n == 4, "Four").when(n.between(2, 4), "TwoToFour").when(n.between(1, 4), "OneToFour")
    )


def county_of_request(record: Column) -> Column:
    """County name of a record's request (its first App value without the ending CountyFL); null without one."""
    name = F.trim(F.get_json_object(record, "$.entry_http_request.multiValueQueryString.App[0]"))
    return F.regexp_replace(F.nullif(name, F.lit("")), "(?i)CountyFL$", "")


def cost_value(lines: Column, label: str) -> Column:
    """The last number between a cost card's label and the next label; null without the label or a number."""
    is_label = lambda x: F.upper(F.regexp_replace(F.trim(x), r"\s+", " "))

    def value(known: Column, at: Column) -> Column:
        n = F.greatest(F.size(lines) - at, F.lit(0))
        later = F.transform(F.slice(known, at + 1, n), lambda x, i: F.when(x.isin(*COST_LABELS), i))
        stop = F.coalesce(F.array_min(F.filter(later, lambda i: i.isNotNull())), n)
        numbers = F.filter(F.transform(F.slice(lines, at + 1, stop), number), lambda n: n.isNotNull())
        return F.when(at > 0, let(numbers, lambda x: F.get(x, F.size(x) - 1)))

    return let(F.transform(lines, is_label), lambda known: let(F.array_position(known, F.lit(label)).cast("int"), lambda at: value(known, at)))


def tax_year(options: Column) -> Column:
    """Year of the selected option of array<struct(text, value, selected)>, else of the first: by text, then by address."""
    chosen = F.coalesce(F.get(F.filter(options, lambda o: o["selected"]), F.lit(0)), F.get(options, F.lit(0)))
    by_text = F.nullif(F.regexp_extract(chosen["text"], r"\b((?:19|20)\d{2})\b", 1), F.lit(""))
    by_value = F.nullif(F.regexp_extract(chosen["value"], r"(?i)[?&]TaxYear=((?:19|20)\d{2})\b", 1), F.lit(""))
    return F.coalesce(by_text, by_value).cast("int")
