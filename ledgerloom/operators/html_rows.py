"""Table rows of HTML pages, read by one pass over their tags, and the records that county pages hold in them.

The reader runs in Arrow batches: it keeps a stack of open elements and gives every page its table rows, each with what
its table is called, the ids that it lies within, its header and value cells as texts, and its links. Everything after
that is Spark expressions over these rows: a layout says where a county puts what.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.profiles import let
from ..functions.property_codes import improvement_type, year_start
from ..functions.text import lenient_date, number, string
from ..session import ship

ROW = "struct<table:int,row:int,within:array<string>,table_id:string,table_class:string,caption:string,heads:array<string>,cells:array<string>,links:array<struct<href:string,text:string>>>"
ARROW_ROW = pa.struct([
    ("table", pa.int32()), ("row", pa.int32()), ("within", pa.list_(pa.string())), ("table_id", pa.string()), ("table_class", pa.string()), ("caption", pa.string()), ("heads", pa.list_(pa.string())), ("cells", pa.list_(pa.string())),
    ("links", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))),
])
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
#: Fixed values of HTML: elements without an end, and those whose content isn't markup.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title"}
#: Fixed values of HTML: which open elements a new one ends, up to the table that it stands in.
ENDS = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "thead": {"td", "th", "tr", "tbody"}, "tfoot": {"td", "th", "tr", "tbody", "thead"}}


def page_rows(page: str) -> list[dict]:
    """The rows of all tables of a page in the order of their first tags; a nested table's text is also its cell's."""
    stack: list[dict] = []
    rows: list[dict] = []
    tables = 0
    raw_end = 0

    def text(piece: str) -> None:
        for e in stack:
            if "text" in e:
                e["text"].append(piece)

    def close(e: dict) -> None:
        words = " ".join(entities.unescape("".join(e.get("text", ()))).split())
        if e["tag"] in ("td", "th") and e["row"] is not None:
            e["row"]["cells" if e["tag"] == "td" else "heads"].append(words)
        elif e["tag"] == "a" and e["row"] is not None and e["href"] is not None:
            e["row"]["links"].append({"href": e["href"], "text": words})
        elif e["tag"] == "caption" and e["table"] is not None and e["table"]["caption"] is None:
            e["table"]["caption"] = words

    at = 0
    for m in TAG.finditer(page):
        if m.start() < raw_end:
            continue
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        table = next((e for e in reversed(stack) if e["tag"] == "table"), None)
        if m[1]:
            own = next((i for i in range(len(stack) - 1, -1, -1) if stack[i]["tag"] == tag), None)
            inside = stack.index(table) if table is not None else -1
            if own is not None and (own >= inside or tag == "table"):
                for e in reversed(stack[own:]):
                    close(e)
                del stack[own:]
            continue
        attributes = {k.lower(): entities.unescape(a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(m[3])} if m[3] else {}
        if tag in ENDS and table is not None:
            low = stack.index(table) + 1
            first = next((i for i in range(low, len(stack)) if stack[i]["tag"] in ENDS[tag]), None)
            if first is not None:
                for e in reversed(stack[first:]):
                    close(e)
                del stack[first:]
        if tag in VOID:
            text(" ")
            continue
        e = {"tag": tag, "id": attributes.get("id"), "table": table, "row": next((x["own_row"] for x in reversed(stack) if x["tag"] == "tr"), None)}
        if tag == "table":
            e |= {"no": tables, "caption": None, "class": attributes.get("class"), "rows": 0}
            tables += 1
        elif tag == "tr" and table is not None:
            e["own_row"] = {"table": table["no"], "row": table["rows"], "within": [x["id"] for x in stack if x["id"]], "of": table, "heads": [], "cells": [], "links": []}
            table["rows"] += 1
            rows.append(e["own_row"])
        elif tag == "tr":
            e["own_row"] = None
        if tag in ("td", "th", "a", "caption"):
            e |= {"text": [], "href": attributes.get("href")}
        stack.append(e)
        if tag in RAW:
            end = re.compile(rf"</{tag}", re.IGNORECASE).search(page, at)
            raw_end = at = end.start() if end else len(page)
    text(page[at:])
    for e in reversed(stack):
        close(e)
    return [{"table": r["table"], "row": r["row"], "within": r["within"], "table_id": r["of"]["id"], "table_class": r["of"]["class"], "caption": r["of"]["caption"], "heads": r["heads"], "cells": r["cells"], "links": r["links"]} for r in rows]


def with_rows(pages: DataFrame, html: str = "html", into: str = "rows") -> DataFrame:
    """pages without `html` and with its table rows (array of ROW) as `into`; null and empty pages have none.

    Broken markup is read as far as it goes: unclosed elements end with their parent or with the page. A column named
    `into` is replaced; all others pass through.
    """
    ship(pages.sparkSession)
    keep = [c for c in pages.columns if c.lower() not in (html.lower(), into.lower())]
    base = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # rows of some pages at a time
                part = batch.slice(lo, 256)
                found = [page_rows(t) if t else [] for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.list_(ARROW_ROW))], names=[*keep, into])

    return base.mapInArrow(run, T.StructType([*base.schema.fields[:-1], T.StructField(into, T.ArrayType(T._parse_datatype_string(ROW)))]))


@dataclass(frozen=True)
class Layout:
    """Where a county's parcel page has its records: ids of sections, classes of tables, words of headers."""

    sales: tuple[str, str]
    permits: tuple[str, str]
    flood: tuple[str, str]
    features: tuple[str, tuple[str, ...]]
    location: tuple[str, str]
    site: str


#: The layout of one county's pages.
LEE = Layout(sales=("SalesDetails", "detailsTable"), permits=("PermitDetails", "detailsTable"), flood=("ElevationDetails", "detailsTable"), features=("appraisalAttributes", ("features", "improvement")), location=("appraisalDetailsLocation", "municipality"), site="https://www.leepa.org")


def of_table(rows: Column, table_class: str | None = None, section: str | None = None) -> Column:
    """Rows of the tables of a class, below an element with an id."""

    def test(r: Column) -> Column:
        named = F.array_contains(F.split(F.coalesce(r["table_class"], F.lit("")), r"\s+"), F.lit(table_class)) if table_class else F.lit(True)
        return named & (F.array_contains(r["within"], F.lit(section)) if section else F.lit(True))

    return F.filter(rows, test)


def first_table(rows: Column) -> Column:
    """The rows of the first of several tables."""
    return let(rows, lambda rs: F.filter(rs, lambda r: r["table"] == F.get(rs, F.lit(0))["table"]))


def cell(row: Column, i: int) -> Column:
    """Text of a value cell; null if absent or blank."""
    return F.nullif(F.get(row["cells"], F.lit(i)), F.lit(""))


def label_values(rows: Column) -> Column:
    """map of label to value from rows of two columns: a header or first cell, without a colon at its end, and one value.

    Labels are in lower case; of equal ones the first counts; rows without a label or value say nothing.
    """
    pair = lambda r: F.when((F.size(r["heads"]) == 1) & (F.size(r["cells"]) == 1), F.struct(r["heads"][0].alias("k"), r["cells"][0].alias("v"))).when((F.size(r["heads"]) == 0) & (F.size(r["cells"]) == 2), F.struct(r["cells"][0].alias("k"), r["cells"][1].alias("v")))
    read = F.transform(rows, lambda r: let(pair(r), lambda p: F.struct(F.lower(F.regexp_replace(p["k"], r"\s*:\s*$", "")).alias("k"), string(p["v"]).alias("v"))))
    said = F.filter(read, lambda p: (p["k"] != "") & p["v"].isNotNull())
    once = let(said, lambda ps: F.filter(ps, lambda p, i: F.array_position(F.transform(ps, lambda x: x["k"]), p["k"]) == i + 1))
    return F.map_from_entries(once)


def sales(rows: Column, layout: Layout = LEE) -> Column:
    """array<struct(purchase_price_amount, ownership_transfer_date)>: rows below the header with a price or a date."""
    own = first_table(of_table(rows, layout.sales[1], layout.sales[0]))
    read = F.transform(F.filter(own, lambda r: (r["row"] > 0) & (F.size(r["cells"]) > 0)), lambda r: F.struct(number(cell(r, 0)).alias("purchase_price_amount"), lenient_date(cell(r, 1)).alias("ownership_transfer_date")))
    return F.filter(read, lambda s: s["purchase_price_amount"].isNotNull() | s["ownership_transfer_date"].isNotNull())


def absolute(url: Column, site: str) -> Column:
    """A link's address, relative to the site's root."""
    return F.when(F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://")), url).when(F.startswith(url, F.lit("/")), F.concat(F.lit(site), url)).otherwise(F.concat(F.lit(f"{site}/"), F.regexp_replace(url, r"^\./", "")))


def improvements(rows: Column, layout: Layout = LEE) -> Column:
    """array<struct(type, completion_date, permit_number, description, url)>: permits, each number once; on a page without
    any, the features of its attribute tables, each description once a header and year."""
    permits = F.filter(of_table(rows, layout.permits[1], layout.permits[0]), lambda r: (r["row"] > 0) & (F.size(r["cells"]) >= 3) & (r["cells"][0] != ""))
    by_number = let(permits, lambda ps: F.filter(ps, lambda p, i: F.array_position(F.transform(ps, lambda x: x["cells"][0]), p["cells"][0]) == i + 1))
    none = F.lit(None).cast("string")
    permit = lambda r: F.struct(improvement_type(r["cells"][1], F.lit("Permit")).alias("type"), lenient_date(cell(r, 2)).alias("completion_date"), r["cells"][0].alias("permit_number"), r["cells"][1].alias("description"), F.when(F.size(r["links"]) > 0, absolute(r["links"][0]["href"], layout.site)).alias("url"))
    attributes = of_table(rows, layout.features[0])
    headed = let(attributes, lambda rs: F.transform(rs, lambda r: F.struct(r.alias("r"), F.get(F.filter(rs, lambda x: (x["table"] == r["table"]) & (F.size(x["heads"]) > 0)), F.lit(0))["heads"][0].alias("header"))))
    wanted = F.filter(headed, lambda h: F.exists(F.array(*map(F.lit, layout.features[1])), lambda w: F.contains(F.lower(h["header"]), w)) & (F.size(h["r"]["cells"]) >= 2) & h["r"]["cells"][0].rlike("[a-zA-Z]"))
    keyed = F.transform(wanted, lambda h: F.struct(h["r"].alias("r"), h["header"].alias("header"), F.concat_ws("|", h["header"], h["r"]["cells"][0], h["r"]["cells"][1]).alias("key")))
    once = let(keyed, lambda ks: F.filter(ks, lambda k, i: F.array_position(F.transform(ks, lambda x: x["key"]), k["key"]) == i + 1))
    feature = lambda k: F.struct(improvement_type(k["r"]["cells"][0], k["header"]).alias("type"), year_start(k["r"]["cells"][1]).alias("completion_date"), none.alias("permit_number"), k["r"]["cells"][0].alias("description"), none.alias("url"))
    return let(F.transform(by_number, permit), lambda ps: F.when(F.size(ps) > 0, ps).otherwise(F.transform(once, feature)))


def location(rows: Column, layout: Layout = LEE) -> Column:
    """struct(latitude, longitude): second and third value of the row after the one whose first header names the place;
    the last such row of a page counts. Null values where a page has none."""
    table, word = layout.location
    own = of_table(rows, table)
    read = let(own, lambda rs: F.transform(F.filter(rs, lambda r: (F.size(r["heads"]) >= 3) & F.contains(F.lower(r["heads"][0]), F.lit(word))), lambda h: F.get(F.filter(rs, lambda r: (r["table"] == h["table"]) & (r["row"] == h["row"] + 1) & (F.size(r["cells"]) >= 3)), F.lit(0))))
    last = F.get(F.reverse(F.filter(read, lambda r: r.isNotNull())), F.lit(0))
    return F.struct(number(cell(last, 1)).alias("latitude"), number(cell(last, 2)).alias("longitude"))


def flood(rows: Column, layout: Layout = LEE) -> Column:
    """struct of a flood table's last row of five cells; null values where a page has none."""
    five = F.get(F.reverse(F.filter(of_table(rows, layout.flood[1], layout.flood[0]), lambda r: F.size(r["cells"]) == 5)), F.lit(0))
    return F.struct(*[(lenient_date(cell(five, i)) if name == "effective_date" else cell(five, i)).alias(name) for i, name in enumerate(("community_id", "panel_number", "map_version", "effective_date", "evacuation_zone"))])


#: Headers of permit search results with the places that they have where no header names them.
RESULT_COLUMNS = [("address", ["address"], 2), ("description", ["description", "project name"], 3), ("status", ["status", "record type"], 4), ("action", ["action"], 5), ("related_records", ["related records"], 6), ("submittal_type", ["submittal type"], 7)]


def permit_links(rows: Column, site: str) -> tuple[Column, Column]:
    """(array of permit links of a search result, how many links to details were left out as related records).

    Trees of related records are known by their table's id or caption. A row's values go by the headers of its table,
    else by their usual places; a row without a record number gives no link.
    """
    detail = lambda x: F.contains(x["href"], F.lit("CapDetail.aspx"))
    related = lambda r: F.contains(F.lower(F.coalesce(r["table_id"], F.lit(""))), F.lit("tablecaptreelist")) | F.lower(F.coalesce(r["caption"], F.lit(""))).eqNullSafe(F.lit("related records"))
    filtered = F.aggregate(F.filter(rows, related), F.lit(0), lambda n, r: n + F.size(F.filter(r["links"], detail)))

    def read(rs: Column) -> Column:
        def of_row(r: Column) -> Column:
            heads = F.transform(F.flatten(F.transform(F.filter(rs, lambda x: x["table"] == r["table"]), lambda x: x["heads"])), lambda h: F.lower(h))

            def links(names: Column) -> Column:
                def value(header: str, place: int) -> Column:
                    at = F.array_position(names, F.lit(header)).cast("int")
                    return F.nullif(F.get(r["cells"], F.when(at > 0, at - 1).otherwise(place)), F.lit(""))

                stated = [F.coalesce(*[value(h, place) for h in headers]).alias(name) for name, headers, place in RESULT_COLUMNS]
                one = lambda x: F.struct(F.upper(string(F.coalesce(value("record number", 1), x["text"]))).alias("record_number"), absolute(x["href"], site).alias("url"), *stated)
                return F.transform(F.filter(r["links"], detail), one)

            return let(heads, links)

        return F.flatten(F.transform(F.filter(rs, lambda r: ~related(r) & F.exists(r["links"], detail)), of_row))

    return F.filter(let(rows, read), lambda x: x["record_number"].isNotNull()), filtered
