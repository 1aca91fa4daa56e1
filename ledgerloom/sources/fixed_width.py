"""Fixed-width registry lines -> nested entities, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import registry_address, strict_date

#: Fixed values: (name, first character from 1, length) of a registry line.
HEADER = [
    ("document_number", 1, 12), ("entity_name", 13, 192), ("status_code", 205, 1), ("filing_type_code", 206, 15),
    ("address1", 221, 42), ("address2", 263, 42), ("city", 305, 28), ("state", 333, 2), ("zip", 335, 10), ("country", 345, 2),
    ("mail_address1", 347, 42), ("mail_address2", 389, 42), ("mail_city", 431, 28), ("mail_state", 459, 2), ("mail_zip", 461, 10), ("mail_country", 471, 2),
    ("filed_date", 473, 8), ("fei_number", 481, 14), ("more_than_six", 495, 1), ("last_transaction_date", 496, 8), ("state_country", 504, 2),
    ("report_year1", 506, 4), ("report_date1", 511, 8), ("report_year2", 519, 4), ("report_date2", 524, 8), ("report_year3", 532, 4), ("report_date3", 537, 8),
    ("agent_name", 545, 42), ("agent_type", 587, 1), ("agent_address", 588, 42), ("agent_city", 630, 28), ("agent_state", 658, 2), ("agent_zip", 660, 9),
]
#: An officer's fields from the start of its group; six groups follow each other.
OFFICER = [("title", 0, 4), ("type", 4, 1), ("name", 5, 42), ("address", 47, 42), ("city", 89, 28), ("state", 117, 2), ("zip", 119, 9)]
FIRST_OFFICER, OFFICER_WIDTH, OFFICERS = 669, 128, 6
#: Characters of a piece of the header, and how many more it has for a field that begins in it.
PIECE, MARGIN = 64, 192
#: Labels of status codes.
STATUS = {"A": "ACTIVE", "I": "INACTIVE"}


def field(line: Column, start: int, length: int) -> Column:
    """Trimmed characters from `start` (1-based); null if blank or beyond the line."""
    return F.nullif(F.trim(F.substring(line, start, length)), F.lit(""))


def _address(line1: Column, line2: Column, city: Column, state: Column, zip_: Column, country: Column) -> Column:
    one_line = F.nullif(F.concat_ws(" ", line1, line2, city, state, zip_, country), F.lit(""))
    return F.struct(
        line1.alias("line1"), line2.alias("line2"), city.alias("city"), state.alias("state"), zip_.alias("zip"), country.alias("country"), one_line.alias("single_line"), registry_address(one_line).alias("normalized")
    )


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """One entity for each line, other columns kept; valid is false without a document number.

    Three addresses, up to six officers (those with a name) and three yearly reports are nested. Short lines give nulls.
    """
    # the fields first, each once; what is made of them refers to columns
    keep = [c for c in lines.columns if c != value]
    v = F.col(value)
    # characters are counted from the start of a text, so a line is cut into pieces before it is cut into fields
    ends = [*range(1, FIRST_OFFICER, PIECE), FIRST_OFFICER]
    pieces = [F.substring(v, a, b - a + MARGIN).alias(f"__h{k}") for k, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]
    pieces += [F.substring(v, FIRST_OFFICER + i * OFFICER_WIDTH, OFFICER_WIDTH).alias(f"__o{i}") for i in range(OFFICERS)]
    held = lines.select(*keep, *pieces, F.length(v).alias("__length"))
    cut = [field(F.col(f"__h{(s - 1) // PIECE}"), (s - 1) % PIECE + 1, w).alias(f"__{n}") for n, s, w in HEADER]
    cut += [field(F.col(f"__o{i}"), s + 1, w).alias(f"__o{i}_{n}") for i in range(OFFICERS) for n, s, w in OFFICER]
    fields = held.select(*keep, *cut, "__length")
    f = {n: F.col(f"__{n}") for n, _, _ in HEADER}
    none = F.lit(None).cast("string")

    def date(c: Column) -> Column:
        return F.date_format(strict_date(c), "yyyy-MM-dd")

    officers = []
    for i in range(OFFICERS):
        o = {n: F.col(f"__o{i}_{n}") for n, _, _ in OFFICER}
        # only named officers get an address, which costs more than all their fields
        officers.append(F.when(o["name"].isNotNull(), F.struct(F.lit(i + 1).alias("ordinal"), *[o[n].alias(n) for n in ("title", "type", "name")], _address(o["address"], none, o["city"], o["state"], o["zip"], none).alias("address"))))
    reports = F.array(*[F.struct(f[f"report_year{i}"].alias("year"), date(f[f"report_date{i}"]).alias("date")) for i in (1, 2, 3)])
    labels = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    return fields.select(
        *keep,
        f["document_number"].alias("document_number"),
        f["entity_name"].alias("entity_name"),
        f["status_code"].alias("status_code"),
        F.try_element_at(labels, f["status_code"]).alias("status"),
        f["filing_type_code"].alias("filing_type_code"),
        _address(f["address1"], f["address2"], f["city"], f["state"], f["zip"], f["country"]).alias("principal_address"),
        _address(f["mail_address1"], f["mail_address2"], f["mail_city"], f["mail_state"], f["mail_zip"], f["mail_country"]).alias("mailing_address"),
        date(f["filed_date"]).alias("filed_date"),
        f["fei_number"].alias("fei_number"),
        F.coalesce(f["more_than_six"] == "Y", F.lit(False)).alias("more_than_six_officers"),
        date(f["last_transaction_date"]).alias("last_transaction_date"),
        f["state_country"].alias("state_country"),
        F.filter(reports, lambda r: r["year"].isNotNull()).alias("annual_reports"),
        F.struct(f["agent_name"].alias("name"), f["agent_type"].alias("type"), _address(f["agent_address"], none, f["agent_city"], f["agent_state"], f["agent_zip"], none).alias("address")).alias("registered_agent"),
        F.filter(F.array(*officers), lambda o: o.isNotNull()).alias("officers"),
        F.col("__length").alias("raw_record_length"),
        f["document_number"].isNotNull().alias("valid"),
    )


def read_lines(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """(source_file_name, line_no from 1, value) of the non-blank lines of text files or of zip archives' members.

    kind is "text" or "zip"; without it the suffix .zip decides.
    """
    from .archives import text_lines, zip_lines

    zipped = kind == "zip" or (kind is None and path.lower().endswith(".zip"))
    lines = zip_lines(spark, path).withColumnRenamed("member", "source_file_name") if zipped else text_lines(spark, path).withColumn("source_file_name", F.element_at(F.split("path", "/"), -1))
    return lines.select("source_file_name", "line_no", "value").where("value <> ''")


def role_addresses(entities: DataFrame) -> DataFrame:
    """(document_number, role, ordinal, address): principal, mailing, agent and each officer's address that has a zip."""
    fixed = [("principal", F.col("principal_address")), ("mailing", F.col("mailing_address")), ("registered_agent", F.col("registered_agent.address"))]
    one = [F.struct(F.lit(r).alias("role"), F.lit(None).cast("int").alias("ordinal"), a.alias("address")) for r, a in fixed]
    many = F.transform("officers", lambda o: F.struct(F.lit("officer").alias("role"), o["ordinal"].alias("ordinal"), o["address"].alias("address")))
    return entities.select("document_number", F.explode(F.concat(F.array(*one), many)).alias("x")).select("document_number", "x.role", "x.ordinal", "x.address").where("address.zip is not null")
