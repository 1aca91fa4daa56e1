"""Text, number and date rules of public-record loaders, as Column -> Column functions.

White space means Unicode white space, NBSP included; blank strings are null; casts never fail, they give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Street words and their short forms for address keys.
DIRECTIONS = {
    "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W",
    "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW",
}
SUFFIXES = {
    "AVENUE": "AVE", "BOULEVARD": "BLVD", "CIRCLE": "CIR", "COURT": "CT", "DRIVE": "DR", "HIGHWAY": "HWY", "LANE": "LN",
    "PARKWAY": "PKWY", "PLACE": "PL", "ROAD": "RD", "STREET": "ST", "TERRACE": "TER", "TRAIL": "TRL", "WAY": "WAY",
}
#: The shorter list that registry addresses use.
REGISTRY_WORDS = {
    "STREET": "ST", "AVENUE": "AVE", "DRIVE": "DR", "ROAD": "RD", "BOULEVARD": "BLVD", "PARKWAY": "PKWY", "LANE": "LN",
    "COURT": "CT", "PLACE": "PL", "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W",
}
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def trim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def string(c: Column) -> Column:
    """Trimmed; null if nothing is left."""
    return F.nullif(trim(c), F.lit(""))


def number(c: Column) -> Column:
    """A finite double after dropping $ and commas; anything else is null."""
    bare = trim(F.regexp_replace(c, r"[$,]", ""))
    value = F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def integer(c: Column) -> Column:
    """number, cut toward zero."""
    return number(c).try_cast("bigint")


def boolean(c: Column) -> Column:
    word = F.lower(trim(c))
    return F.when(word.isin("true", "yes", "y", "1"), True).when(word.isin("false", "no", "n", "0"), False)


def lenient_date(c: Column) -> Column:
    """ISO beginnings as they are, M/D/YYYY padded; text, not checked against the calendar."""
    t = string(c)
    iso = F.nullif(F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    us = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    padded = F.concat_ws("-", F.regexp_extract(t, us, 3), F.lpad(F.regexp_extract(t, us, 1), 2, "0"), F.lpad(F.regexp_extract(t, us, 2), 2, "0"))
    return F.coalesce(iso, F.when(t.rlike(us), padded))


def strict_date(c: Column) -> Column:
    """YYYYMMDD as a date; null if the calendar has no such day."""
    t = trim(c)
    return F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd"))


def name_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.upper(string(c)), r"[^A-Z0-9]+", " "))


def parcel_id(c: Column) -> Column:
    """Its digits, or without any the text in upper case without white space."""
    t = string(c)
    return F.coalesce(F.nullif(F.regexp_replace(t, r"\D", ""), F.lit("")), F.regexp_replace(F.upper(t), r"(?U)\s+", ""))


def parcel_search_key(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.upper(trim(c)), r"[^A-Z0-9]", ""), F.lit(""))


def zip5(c: Column) -> Column:
    digits = F.regexp_replace(string(c), r"\D", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5))


def zip_parts(c: Column) -> Column:
    """struct(zip5, plus_four)."""
    digits = F.coalesce(F.regexp_replace(string(c), r"\D", ""), F.lit(""))
    return F.struct(
        F.when(F.length(digits) >= 5, F.substring(digits, 1, 5)).alias("zip5"),
        F.when(F.length(digits) >= 9, F.substring(digits, 6, 4)).alias("plus_four"),
    )


def zip_of_address(c: Column) -> Column:
    """The ZIP that follows the state, or else stands at the end."""
    t = string(c)
    after_state = F.regexp_extract(t, r"(?i)\b(?:FL|FLORIDA)\s+(\d{5})(?:-\d{4})?\b", 1)
    trailing = F.regexp_extract(t, r"(?i)(?:^|\D)(\d{5})(?:-\d{4})?\s*(?:US|USA)?\s*$", 1)
    return F.coalesce(F.nullif(after_state, F.lit("")), F.nullif(trailing, F.lit("")))


def address_key(c: Column) -> Column:
    """Upper case, # . , as spaces, direction and suffix words in their short forms, word by word."""
    short = F.create_map(*[F.lit(x) for pair in (DIRECTIONS | SUFFIXES).items() for x in pair])
    words = F.split(collapse(F.regexp_replace(F.upper(string(c)), r"[#.,]", " ")), " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def registry_address(c: Column) -> Column:
    """Key for matching registry addresses; null counts as empty. Words are replaced before punctuation goes.

    Two spaces stand between words while they are replaced, so that neighbours don't share one; no function here needs a
    lambda, so all of it is compiled.
    """
    text = F.concat(F.lit(" "), F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9_]+", "  "), F.lit(" "))
    for word, short in REGISTRY_WORDS.items():
        text = F.replace(text, F.lit(f" {word} "), F.lit(f" {short} "))
    return F.trim(F.regexp_replace(text, "[_ ]+", " "))


def city_name(c: Column) -> Column:
    t = F.regexp_replace(F.upper(string(c)), r"\.", "")
    return F.nullif(collapse(F.regexp_replace(t, r"(?U)[^A-Z\s\-']", " ")), F.lit(""))


def slug(c: Column, joiner: str = "-") -> Column:
    """Lower-case letters and digits, runs of others as one joiner; unknown if nothing is left."""
    s = F.regexp_replace(F.lower(trim(c)), r"[^a-z0-9]+", joiner)
    return F.coalesce(F.nullif(F.regexp_replace(s, rf"^{joiner}+|{joiner}+$", ""), F.lit("")), F.lit("unknown"))


def short_hash(*parts: Column, length: int = 24) -> Column:
    """First hex digits of the SHA-256 of a JSON array of the parts."""
    return F.substring(F.sha2(F.to_json(F.array(*parts)), 256), 1, length)


def canonical_json_hash(c: Column) -> Column:
    """SHA-256 of the JSON text with keys sorted at every level and no white space; null if it doesn't parse."""
    return F.sha2(F.to_json(F.try_parse_json(c)), 256)


def is_json_object(c: Column) -> Column:
    """Whether a text is a JSON object; false for null."""
    return F.coalesce(c.rlike(r"^[ \t\r\n]*\{") & F.try_parse_json(c).isNotNull(), F.lit(False))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def html_to_text(c: Column) -> Column:
    """Visible text: scripts, styles and tags as spaces, white space collapsed."""
    for tag in ("script", "style"):
        c = F.regexp_replace(c, rf"(?is)<{tag}.*?</{tag}>", " ")
    return collapse(F.regexp_replace(c, r"<[^>]+>", " "))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def labelled(c: Column, label: str) -> Column:
    """What stands after `label:` on its line."""
    return F.nullif(trim(F.regexp_extract(c, rf"(?i){label}:[ \t]*([^\n]+)", 1)), F.lit(""))


def error_type(code: Column) -> Column:
    return F.substring(code, 1, 2)


def sort_key(n: Column) -> Column:
    """At least ten digits; longer numbers keep all of theirs."""
    return F.format_string("%010d", n)


def tokens_in_order(query: Column, candidate: Column) -> Column:
    """Whether all query tokens occur in the candidate's tokens, in order; always for an empty query."""

    def held(q: Column) -> Column:
        step = F.aggregate(candidate, F.lit(0), lambda i, t: i + F.when(t.eqNullSafe(F.get(q, i)) & (i < F.size(q)), 1).otherwise(0))
        return step == F.size(q)

    # the query's tokens are made once, not for each token of the candidate
    return F.get(F.transform(F.array(query), held), F.lit(0))


def address_base(c: Column) -> Column:
    """An address up to its unit: UNIT, STE, SUITE, APT, or a # between word characters."""
    return F.nullif(F.trim(F.regexp_replace(F.upper(c), r"\b(?:UNIT|STE|SUITE|APT|#)\b.*$", "")), F.lit(""))


def county_key(c: Column) -> Column:
    """Lower case, white space as dashes."""
    return F.regexp_replace(F.lower(trim(c)), r"\s+", "-")


def store_key(c: Column) -> Column:
    """A text as part of an object's key: letters, digits, dot, dash and underscore stay, runs of others are one underscore."""
    return F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")


def store_uri(c: Column) -> Column:
    """struct(bucket, key) of s3://bucket/key; null for other texts."""
    shape = "^s3://([^/]+)/(.+)$"
    return F.when(c.rlike(shape), F.struct(F.regexp_extract(c, shape, 1).alias("bucket"), F.regexp_extract(c, shape, 2).alias("key")))


def unescape_html(c: Column) -> Column:
    """The five entities that escape_html makes, and the non-breaking space, as characters; &amp; last."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def csv_line(*columns: Column) -> Column:
    """One CSV line of the columns in their order; quotes only where needed."""
    return F.to_csv(F.struct(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)]), {"emptyValue": "", "escape": '"'})
