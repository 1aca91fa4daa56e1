"""A permit's page text as one record: known labels with their values, named parts, and a placeholder without a page."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .permits import status
from .profiles import let
from .property_codes import record_type
from .text import collapse, string

#: Labels of a permit's details.
DETAIL_LABELS = [
    "Is the permit being pulled as Owner-Builder?", "Is the proposed work a result of hurricane damage?", "Type", "Comm/Res", "Private Provider Plan Review?", "Private Provider Inspections?", "Estimated Job Value", "Estimated Sq. Ft.", "Volts",
    "Is this for Site Lighting?", "Is Low Voltage work included under an active COM Permit?", "Commercial Permit Number", "Is this a Mobile Home Park?", "Will there be an Access Control System installed?", "Data", "Parcel Number", "Block", "Lot",
    "Subdivision", "PLANNINGCOMMUNITY", "MUNICODE", "HISTORIC", "FIREDISTRICT",
]
#: Fixed values: (field, words before it, words of which one must follow) of a page's text.
PARTS = [
    ("work_location", "Work Location", ["* Record Details"]), ("applicant", "Applicant:", ["Licensed Professional:"]), ("licensed_professional", "Licensed Professional:", ["Project Description:"]), ("project_description", "Project Description:", ["More Details"]),
    ("more_details_text", "More Details", ["Fees *Fee Reductions"]), ("inspections_text", "Inspections", ["Digital Projects"]), ("processing_text", "Processing Status", ["Related Records", ""]),
]
#: Fixed value: how a placeholder says that a page was an error.
UNAVAILABLE = "unavailable_error_page"


def known_labels(c: Column, labels: list[str] = DETAIL_LABELS) -> Column:
    """map of label to value: all labels are found in one pass over the text, and a value ends where the next begins.

    Of labels that begin at one place the longest is meant. A label counts at its first place only; later it is a part of
    a value. Labels without a value are left out; text before the first label belongs to none.
    """
    longest = sorted(labels, key=len, reverse=True)
    pattern = r"(?i)(?<![^\s])(" + "|".join(re.escape(x) for x in longest) + r")(?=[\s:]|$)\s*:?"
    low = F.array(*[F.lit(x.lower()) for x in labels])
    names = F.array(*map(F.lit, labels))
    empty = F.array().cast("array<struct<label:string,value:string>>")

    def fold(parts: Column) -> Column:
        def step(state: Column, part: Column) -> Column:
            name = F.get(names, F.array_position(low, F.lower(part["label"])).cast("int") - 1)
            seen = F.exists(state, lambda s: s["label"] == name)
            last = F.get(state, F.size(state) - 1)
            longer = F.struct(last["label"].alias("label"), F.trim(F.concat_ws(" ", last["value"], part["label"], part["value"])).alias("value"))
            return F.when(seen, F.concat(F.slice(state, F.lit(1), F.size(state) - 1), F.array(longer))).otherwise(F.concat(state, F.array(F.struct(name.alias("label"), part["value"].alias("value")))))

        return F.aggregate(parts, empty, step)

    text = collapse(c)
    found = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.slice(F.split(text, pattern), F.lit(2), F.lit(1_000_000)), lambda a, b: F.struct(a.alias("label"), F.trim(b).alias("value")))
    return F.map_from_entries(F.filter(fold(found), lambda s: s["value"] != ""))


def between(c: Column, start: str, ends: list[str]) -> Column:
    """Text after the first `start` (in any case) up to the first of `ends` behind it; null if blank or without an end. An
    empty end is the end of the text, for texts without the others."""
    low = F.lower(c)
    at = F.locate(start.lower(), low)

    def cut(rest: Column) -> Column:
        stops = [F.nullif(F.locate(e.lower(), F.lower(rest)), F.lit(0)) if e else F.length(rest) + 1 for e in ends]
        return F.substring(rest, F.lit(1), F.coalesce(*stops) - 1)

    return F.when(at > 0, string(collapse(let(F.substring(c, at + len(start), F.length(c)), cut))))


def permit_detail(text: Column, fallback_number: Column) -> Column:
    """struct of a permit page's fields from its text; the number is the page's own, or else the search result's."""

    def read(c: Column) -> Column:
        head = F.substring_index(F.when(F.contains(c, F.lit("Record Status:")), F.substring_index(c, "Record Status:", 1)), "Record ", -1)
        own = F.trim(F.substring_index(head, ":", 1))
        shaped = own.rlike(r"^[A-Za-z]{2,4}[0-9]{4}-[0-9]{5}") & F.contains(head, F.lit(":"))
        kind = string(F.substring(head, F.locate(":", head) + 1, F.length(head)))
        stated = F.when(F.contains(c, F.lit("Record Status:")), status(F.substring(c, F.locate("Record Status:", c) + len("Record Status:"), F.length(c))))
        parts = [between(c, start, ends).alias(name) for name, start, ends in PARTS]
        return F.struct(F.when(shaped, own).otherwise(fallback_number).alias("record_number"), F.when(shaped, kind).alias("record_type"), stated.alias("record_status"), *parts)

    def with_map(d: Column) -> Column:
        fields = [d[n].alias(n) for n in ("record_number", "record_type", "record_status", *[p[0] for p in PARTS])]
        details = known_labels(d["more_details_text"])
        parcel = F.coalesce(F.try_element_at(details, F.lit("Parcel Number")), F.nullif(F.regexp_extract(text, r"(?i)Parcel Information\s+Parcel Number:\s*([A-Z0-9]+)", 1), F.lit("")))
        return F.struct(*fields, details.alias("more_details"), parcel.alias("parcel_identifier"))

    return let(let(collapse(text), read), with_map)


def unavailable_detail(number: Column, stated: Column, address: Column, description: Column, error: Column) -> Column:
    """struct of a permit whose page was an error: what the search result said, the type that its number implies, and a
    text that says so."""
    kind = record_type(number)
    lines = F.concat_ws(
        "\n", F.concat(F.lit("Record "), number), F.concat(F.lit("Record Type: "), kind), F.concat(F.lit("Record Status: "), stated), F.concat(F.lit("Work Location: "), address), F.concat(F.lit("Project Description: "), description),
        F.lit(f"Accela detail capture status: {UNAVAILABLE}"), F.concat(F.lit("Accela detail capture error: "), error),
    )
    return F.struct(number.alias("record_number"), kind.alias("record_type"), status(stated).alias("record_status"), address.alias("work_location"), description.alias("project_description"), F.lit(UNAVAILABLE).alias("capture_status"), error.alias("capture_error"), lines.alias("raw_text"))
