"""Joins that Catalyst would plan as nested loops, rewritten as equi-joins, and foreign-key resolution."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens_in_order


def any_key_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[Column, Column]], left_id: Sequence[str], recency: Sequence[Column] = ()) -> DataFrame:
    """For each left row the best right row that shares any of the keys: earlier keys first, then `recency`.

    One equi-join: each side becomes a row for every non-null key, tagged with the key's number, instead of an OR of
    equalities. left_id names columns that identify a left row; `recency` orders right columns. Adds key_no (from 1).
    """

    def tagged(df: DataFrame, side: int) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(i + 1).alias("key_no"), k[side].cast("string").alias("key")) for i, k in enumerate(keys)])
        return df.withColumn("__key", F.explode(F.filter(pairs, lambda p: p["key"].isNotNull()))).select("*", "__key.key_no", "__key.key").drop("__key")

    # the best right row of each key is all that a left row can take from it: the join stays linear
    first = Window.partitionBy("key_no", "key").orderBy(*(recency or [F.lit(0)]))
    right_best = tagged(right, 1).withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    both = tagged(left, 0).join(right_best, ["key_no", "key"])
    best = Window.partitionBy(*left_id).orderBy("key_no", *recency)
    return both.withColumn("__n", F.row_number().over(best)).where("__n = 1").drop("__n", "key")


def any_key_semi(left: DataFrame, left_keys: Sequence[Column], right: DataFrame, right_keys: Sequence[Column], left_id: Sequence[str], anti: bool = False) -> DataFrame:
    """Left rows that share (anti: don't share) any key with any right row; all keys are one namespace."""
    wanted = right.select(F.explode(F.array_distinct(F.array(*right_keys))).alias("__key")).where("__key is not null").distinct()
    hit = left.select(*left_id, F.explode(F.array_distinct(F.array(*left_keys))).alias("__key")).join(wanted, "__key", "left_semi").select(*left_id).distinct()
    return left.join(hit, list(left_id), "left_anti" if anti else "left_semi")


def resolve_keys(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], take: str, into: str, missing: str = "omit") -> DataFrame:
    """child with column `into` = the parent's `take` where the key columns agree.

    missing: "omit" leaves null, to be healed by a later load; "throw" raises at run time for a child with a key but no
    parent. Parent keys must be unique.
    """
    keys = parent.select(*[F.col(p).alias(f"__p_{i}") for i, (_, p) in enumerate(on)], F.col(take).alias(into))
    out = child.join(keys, [F.col(c) == F.col(f"__p_{i}") for i, (c, _) in enumerate(on)], "left").drop(*[f"__p_{i}" for i in range(len(on))])
    if missing == "throw":
        has = F.lit(True)
        for c, _ in on:
            has = has & F.col(c).isNotNull()
        checked = F.when(has & F.col(into).isNull(), F.raise_error(F.concat(F.lit(f"no parent for {into}: "), F.concat_ws("/", *[F.col(c).cast("string") for c, _ in on]))).cast(dict(out.dtypes)[into])).otherwise(F.col(into))
        out = out.withColumn(into, checked)
    return out


def prefix_join(rows: DataFrame, text: Column, prefixes: DataFrame, prefix: str) -> DataFrame:
    """rows with each prefix that their text starts with: one equi-join for every length that occurs among prefixes.

    The few distinct lengths are read first; the text is cut to each of them and compared as a whole key.
    """
    lengths = sorted(r[0] for r in prefixes.select(F.length(prefix)).distinct().collect() if r[0])
    cuts = F.array(*[F.when(F.length(text) >= n, F.substring(text, 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    tagged = rows.withColumn("__cut", F.explode(F.filter(cuts, lambda c: c.isNotNull())))
    own = prefixes.select(F.col(prefix).alias("__cut"), F.col(prefix).alias("matched_prefix")).distinct()
    return tagged.join(own, "__cut").drop("__cut")


def token_block_join(queries: DataFrame, query_id: str, query_text: str, rows: DataFrame, row_id: str, row_text: str) -> DataFrame:
    """(query_id, row_id) of rows whose text has the query text in it, or all its tokens in order.

    Both texts are normalised, single-spaced. Candidates share the query's rarest token, counted over all rows, so
    frequent words never open a block. Tokens travel with ids only; texts join the candidate pairs in the end.
    """
    asked = queries.select(F.col(query_id).alias("__q"), F.col(query_text).alias("__query"))
    own = rows.select(F.col(row_id).alias("__r"), F.col(row_text).alias("__text"))
    named = asked.select("__q", "__query", F.explode(F.array_distinct(F.split("__query", " "))).alias("__token"))
    each = own.select("__r", F.explode(F.array_distinct(F.split("__text", " "))).alias("__token")).join(named.select("__token").distinct(), "__token", "left_semi")
    counts = each.groupBy("__token").count()
    rarest = named.join(counts, "__token", "left").fillna({"count": 0}).groupBy("__q", "__query").agg(F.min_by("__token", F.struct("count", "__token")).alias("__token"))
    pairs = rarest.join(each, "__token").select("__q", "__query", "__r").distinct()
    held = F.contains("__text", "__query") | tokens_in_order(F.split("__query", " "), F.split("__text", " "))
    return pairs.join(own, "__r").where(held).select(F.col("__q").alias(query_id), F.col("__r").alias(row_id))


#: Kinds of references between loaded tables: (key column of the child, table of the parent, its id column).
REFERENCES = {
    "property": ("property_source_record_key", "properties", "property_id"),
    "parcel": ("parcel_source_record_key", "parcels", "parcel_id"),
    "address": ("address_source_record_key", "addresses", "address_id"),
    "person": ("person_source_record_key", "people", "person_id"),
    "company": ("company_source_record_key", "companies", "company_id"),
    "deed": ("deed_source_record_key", "deeds", "deed_id"),
    "file": ("file_source_record_key", "files", "file_id"),
    "layout": ("layout_source_record_key", "layouts", "layout_id"),
    "property_improvement": ("property_improvement_source_record_key", "property_improvements", "property_improvement_id"),
    "business_profile": ("business_reputation_profile_source_record_key", "business_reputation_profiles", "business_reputation_profile_id"),
    "business_complaint": ("business_reputation_complaint_source_record_key", "business_reputation_complaints", "business_reputation_complaint_id"),
    "business_registration": ("business_registration_source_record_key", "business_registrations", "business_registration_id"),
}


def resolve_references(child: DataFrame, parents: Mapping[str, DataFrame], missing: str = "omit") -> DataFrame:
    """child with the id column of every kind of REFERENCES whose key column it has, looked up by source_record_key."""
    for column, table, id_ in REFERENCES.values():
        if column in child.columns and table in parents:
            child = resolve_keys(child.drop(id_), parents[table], [(column, "source_record_key")], id_, id_, missing)
    return child


def resolve_or_alternate(child: DataFrame, parent: DataFrame, key: tuple[str, str], alternate: Sequence[tuple[str, str]], take: str, into: str, missing: str = "omit") -> DataFrame:
    """resolve_keys by `key`; rows whose key is null (not those that find nothing) go by the alternate columns instead."""
    by_key = child.where(F.col(key[0]).isNotNull())
    by_other = child.where(F.col(key[0]).isNull())
    ranked = Window.partitionBy(*[p for _, p in alternate]).orderBy(take)
    one = parent.withColumn("__n", F.row_number().over(ranked)).where("__n = 1").drop("__n")
    return resolve_keys(by_key, parent, [key], take, into, missing).unionByName(resolve_keys(by_other, one, alternate, take, into, missing))


def join_update(target: DataFrame, source: DataFrame, target_keys: Sequence[Column], source_key: Column, take: Sequence[str], literals: Mapping[str, str] = {}, row_id: Sequence[str] = ()) -> DataFrame:
    """target with the columns `take` of the source row that any of its keys names, and the literals; rows without one stay.

    row_id names the columns that tell target rows apart; without them each key is joined on its own. Adds matched, and changed: whether any of these columns is distinct from before. Of several source rows of one key
    the least (by `take`) counts; earlier target keys go first. One equi-join of exploded keys.
    """
    new = source.select(source_key.cast("string").alias("__key"), F.struct(*take).alias("__new")).where("__key is not null").groupBy("__key").agg(F.min("__new").alias("__new"))
    if row_id:
        keys = F.filter(F.array(*[F.struct(F.lit(i).alias("no"), k.cast("string").alias("key")) for i, k in enumerate(target_keys)]), lambda k: k["key"].isNotNull())
        hit = target.select(*row_id, F.explode(keys).alias("__k")).select(*row_id, F.col("__k.no").alias("__no"), F.col("__k.key").alias("__key")).join(new, "__key")
        best = hit.groupBy(*row_id).agg(F.min_by("__new", "__no").alias("__new"))
        out = target.join(best, list(row_id), "left").select(*target.columns, "__new")
    else:
        out = target.select(*target.columns, *[k.cast("string").alias(f"__k{i}") for i, k in enumerate(target_keys)])
        for i in range(len(target_keys)):
            out = out.join(new.select(F.col("__key").alias(f"__k{i}"), F.col("__new").alias(f"__new{i}")), f"__k{i}", "left")
        out = out.select(*target.columns, F.coalesce(*[F.col(f"__new{i}") for i in range(len(target_keys))]).alias("__new"))
    out = out.withColumn("matched", F.col("__new").isNotNull())
    fresh = {**{c: F.col("__new")[c] for c in take}, **{c: F.lit(v) for c, v in literals.items()}}
    differs = F.lit(False)
    for c, v in fresh.items():
        differs = differs | ~F.col(c).eqNullSafe(v)
    out = out.withColumn("changed", F.col("matched") & differs)
    return out.withColumns({c: F.when(F.col("matched"), v).otherwise(F.col(c)) for c, v in fresh.items()}).drop("__new")


def address_candidates(rows: DataFrame, state: str | None = None, city: str | None = None, zip_prefix: str | None = None, most: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Rows that pass the optional tests: city holds the text, state equals it (both without regard to case), zip begins
    with the first five digits; at most `most` of them, in order."""
    if state:
        rows = rows.where(F.upper("state") == state.strip().upper())
    if city:
        rows = rows.where(F.contains(F.upper("city"), F.lit(city.strip().upper())))
    if zip_prefix:
        rows = rows.where(F.startswith("zip", F.lit(re.sub(r"\D", "", zip_prefix)[:5])))
    return rows.orderBy(*order).limit(most) if most is not None else rows
