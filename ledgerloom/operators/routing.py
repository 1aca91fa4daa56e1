"""Records to tables: dispatch by file name, table order, branches, and records that can't be placed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_json_object

#: Fixed values: (pattern of a file's name, tables that its record goes to) of extracted appraisal bundles, in order.
APPRAISAL_FILES = [
    (r"^property_seed\.json$", ["parcels"]), (r"^property\.json$", ["properties"]), (r"^unnormalized_address\.json$", ["unnormalized_addresses"]), (r"^(address|mailing_address_\d+)\.json$", ["addresses"]),
    (r"^person_\d+\.json$", ["people", "ownerships"]), (r"^company_\d+\.json$", ["companies", "ownerships"]), (r"^tax_", ["taxes", "property_valuations"]), (r"^property_valuation_", ["property_valuations"]),
    (r"^sales_", ["sales_histories"]), (r"^property_improvement_", ["property_improvements"]), (r"^structure_", ["structures"]), (r"^utility_", ["utilities"]), (r"^layout_", ["layouts"]), (r"^lot(_|\.json$)", ["lots"]),
    (r"^flood_storm_information", ["flood_storm_information"]), (r"^fact_sheet\.json$", ["fact_sheets"]), (r"^geometry\.json$", ["geometries"]), (r"^deed_", ["deeds"]), (r"^file_", ["files"]),
]
#: Tables in the order in which their rows refer to each other; those of permits follow.
APPRAISAL_ORDER = [
    "unnormalized_addresses", "addresses", "parcels", "properties", "property_improvements", "people", "companies", "deeds", "fact_sheets", "geometries", "sales_histories", "taxes", "property_valuations", "structures",
    "utilities", "layouts", "lots", "flood_storm_information", "files", "ownerships",
]
PERMIT_ORDER = ["addresses", "people", "companies", "property_improvements", "permit_contacts", "inspections", "permit_events", "permit_fees", "permit_links", "permit_custom_fields", "permit_list_windows"]


def joined_order(first: Sequence[str], *others: Sequence[str]) -> list[str]:
    """Names of all lists in order, each at its first place."""
    return list(dict.fromkeys([*first, *(n for names in others for n in names)]))


def order_number(table: Column, order: Sequence[str]) -> Column:
    """Place of a table in its order; unknown ones come last."""
    at = F.array_position(F.array(*map(F.lit, order)), table)
    return F.when(at > 0, at).otherwise(len(order) + 1)


def in_table_order(rows: DataFrame, order: Sequence[str], table: str = "table_name", place: str | None = None) -> DataFrame:
    """rows sorted so that tables come after those that they refer to; rows of a table keep the order of `place`."""
    return rows.orderBy(order_number(F.col(table), order), *([place] if place else []))


def dispatched(records: DataFrame, name: str = "file_name", body: str = "value", routes: Sequence[tuple[str, Sequence[str]]] = APPRAISAL_FILES) -> tuple[DataFrame, DataFrame]:
    """(records with table_name, one row for each table of the first route that fits; quarantined records with a reason).

    Bodies that are no JSON object and names without a route are quarantined.
    """
    short = F.element_at(F.split(F.col(name), "/"), -1)
    tables = F.coalesce(*[F.when(short.rlike(pattern), F.array(*map(F.lit, to))) for pattern, to in routes])
    marked = records.withColumn("__tables", tables).withColumn("__fine", is_json_object(F.col(body)))
    good = marked.where("__fine and __tables is not null").withColumn("table_name", F.explode("__tables")).drop("__tables", "__fine")
    reason = F.when(~F.col("__fine"), F.lit("not a JSON object")).otherwise(F.concat(F.lit("no table for "), F.coalesce(F.col(name), F.lit("null"))))
    return good, marked.where("not __fine or __tables is null").withColumn("reason", reason).drop("__tables", "__fine")


def branches(rows: DataFrame, tests: Mapping[str, Column], otherwise: str) -> DataFrame:
    """rows with branch: the first test that holds, else `otherwise`."""
    out = None
    for name, test in tests.items():
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return rows.withColumn("branch", out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise))
