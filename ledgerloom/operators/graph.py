"""Registry entities -> vertices and edges of a property graph: five kinds of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import city_name, short_hash, zip_parts

REGISTRATION_ROLES = {"principal": "PRINCIPAL", "mailing": "MAILING"}


def address_id(address: Column) -> Column:
    """Stable identifier from the normalised text, state, zip and country."""
    blank = F.lit("")
    parts = (F.coalesce(address["normalized"], F.upper(address["single_line"]), blank), F.coalesce(F.upper(address["state"]), blank), F.coalesce(address["zip"], blank), F.coalesce(F.upper(address["country"]), blank))
    return F.concat(F.lit("registry:address:"), short_hash(*parts))


def _id(*parts: Column | str) -> Column:
    return F.concat_ws(":", F.lit("registry"), *[F.lit(p) if isinstance(p, str) else p for p in parts])


def companies(entities: DataFrame) -> DataFrame:
    return entities.select(_id(F.col("document_number"), "company").alias("request_identifier"), F.coalesce("entity_name", "document_number").alias("name"))


def registrations(entities: DataFrame) -> DataFrame:
    """One vertex for each entity, with its dates and yearly reports side by side."""
    report = lambda i, f: F.get("annual_reports", F.lit(i - 1))[f].alias(f"annual_report_{i}_{f}")
    return entities.select(
        _id(F.col("document_number"), "business_registration").alias("request_identifier"), "document_number", "entity_name", "status", "filing_type_code", "filed_date", "fei_number", "last_transaction_date", "state_country",
        *[report(i, f) for i in (1, 2, 3) for f in ("year", "date")], "more_than_six_officers", "raw_record_length",
    )


def _named(address: Column) -> Column:
    return address["single_line"].isNotNull()


def _registration_addresses() -> Column:
    """array of an entity's principal and mailing address, those that it has."""
    doc = F.col("document_number")
    rows = F.array(*[F.struct(_id(doc, "business_registration_address", role.lower()).alias("request_identifier"), F.lit(role).alias("address_role"), F.col(f"{name}_address").alias("address")) for name, role in REGISTRATION_ROLES.items()])
    return F.filter(rows, lambda r: _named(r["address"]))


def _parties() -> Column:
    """array of an entity's registered agent and officers, those with a name."""
    doc, blank, none, agent = F.col("document_number"), F.lit(""), F.lit(None).cast("string"), F.col("registered_agent")
    fields = lambda own, role, name, kind, title, ordinal, address: F.struct(own.alias("request_identifier"), F.lit(role).alias("party_role"), name.alias("name"), kind.alias("party_type_code"), title.alias("title"), ordinal.cast("int").alias("officer_ordinal"), address.alias("address"))
    agent_id = _id(doc, "party", "registered_agent", short_hash(agent["name"], F.coalesce(agent["type"], blank)))
    own = F.array(fields(agent_id, "REGISTERED_AGENT", agent["name"], agent["type"], none, F.lit(None), agent["address"]))
    officer_id = lambda o: _id(doc, "party", "officer", o["ordinal"].cast("string"), short_hash(o["name"], F.coalesce(o["title"], blank), F.coalesce(o["type"], blank)))
    officers = F.transform("officers", lambda o: fields(officer_id(o), "OFFICER", o["name"], o["type"], o["title"], o["ordinal"], o["address"]))
    return F.filter(F.concat(own, officers), lambda p: p["name"].isNotNull())


def registration_addresses(entities: DataFrame) -> DataFrame:
    """The principal and the mailing address of each registration, as vertices between it and the address itself."""
    return entities.select("document_number", F.explode(_registration_addresses()).alias("r")).select("r.request_identifier", "document_number", "r.address_role", "r.address")


def parties(entities: DataFrame) -> DataFrame:
    """The registered agent and the officers that have a name; identifiers hash what tells equal roles apart."""
    each = entities.select("document_number", F.explode(_parties()).alias("p"))
    return each.select("p.request_identifier", "document_number", *[f"p.{c}" for c in ("party_role", "name", "party_type_code", "title", "officer_ordinal", "address")])


def addresses(placed: DataFrame) -> DataFrame:
    """Distinct addresses of rows with an address; equal identifiers are one vertex."""
    a = F.col("address")
    zp = zip_parts(a["zip"])
    out = placed.select(
        address_id(a).alias("request_identifier"), a["single_line"].alias("unnormalized_address"), city_name(a["city"]).alias("city_name"), F.upper(a["state"]).alias("state_code"), zp["zip5"].alias("postal_code"), zp["plus_four"].alias("plus_four")
    )
    return out.groupBy("request_identifier").agg(*[F.min(c).alias(c) for c in out.columns if c != "request_identifier"])


def vertices(entities: DataFrame) -> dict[str, DataFrame]:
    """All five kinds; only addresses are equal across entities and come once."""
    ra, p = registration_addresses(entities), parties(entities)
    placed = ra.select("address").unionByName(p.where(_named(F.col("address"))).select("address"))
    return {"company": companies(entities), "business_registration": registrations(entities), "business_registration_address": ra.drop("address"), "business_registration_party": p.drop("address"), "address": addresses(placed)}


def edges(entities: DataFrame) -> DataFrame:
    """(relationship_type, from_id, to_id): company to registration, on to its addresses and parties, and to their places.

    Entities are read once: each becomes an array of all its edges."""
    doc = F.col("document_number")
    registration = _id(doc, "business_registration")
    edge = lambda kind, a, b: F.struct(F.lit(kind).alias("relationship_type"), a.alias("from_id"), b.alias("to_id"))
    own = F.array(edge("company_has_business_registration", _id(doc, "company"), registration))
    # an address's identifier is worked out once for each row that has it
    placed = lambda rows: F.transform(rows, lambda r: F.struct(r["request_identifier"].alias("id"), F.when(_named(r["address"]), address_id(r["address"])).alias("place")))
    out = entities.select(doc.alias("document_number"), own.alias("own"), placed(_registration_addresses()).alias("ra"), placed(_parties()).alias("p"))
    kinds = [("ra", "business_registration_has_address", "business_registration_address_has_address"), ("p", "business_registration_has_party", "business_registration_party_has_address")]

    def of(column: str, has: str, at: str) -> list[Column]:
        return [F.transform(column, lambda r: edge(has, registration, r["id"])), F.transform(F.filter(column, lambda r: r["place"].isNotNull()), lambda r: edge(at, r["id"], r["place"]))]

    every = F.concat(F.col("own"), *[part for kind in kinds for part in of(*kind)])
    return out.select(F.explode(every).alias("e")).select("e.*")
