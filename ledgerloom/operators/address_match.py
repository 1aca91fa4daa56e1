"""A table of address inputs matched against a table of addresses, with optional tests and a cap for each input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens_in_order

KEYS = "array<string>"


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def _pieces(c: Column, n: int, tag: str) -> Column:
    """Distinct tagged substrings of n characters."""
    starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.concat(F.lit(tag), F.substring(c, i, F.lit(n)))))


def _tagged(tokens: Column, tag: str = "t:") -> Column:
    return F.array_distinct(F.transform(tokens, lambda t: F.concat(F.lit(tag), t)))


def _same(*columns: Column) -> Column:
    """One text for each combination of texts and nulls."""
    return F.to_json(F.struct(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)]))


def address_matches(inputs: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    """(input_id, row_no, truncated): for each input the first `most` rows, by row_no, whose address has its query in it, or
    all its words in order, and which pass its own tests.

    inputs: input_id, query, city, state, zip; rows: row_no (each once), address, city, state, zip; all texts normalised,
    with single spaces. A null or empty test isn't asked: city must be held by the row's, state equal it, the first five
    characters of zip begin the row's. An input without a word and a row without an address match nothing. truncated says
    that rows come after an input's last match once it has `most`. Repeated inputs share their id's matches.

    Inputs that ask the same and rows that say the same are matched once, as places and questions; of the rows of a place
    the first `most` are all that an input can take. Places are found by equal keys, never by comparing all: whole words
    for words in order, and what must be in the row for a held query: a word between its first and last one, or three (of
    shorter queries, all) of its characters. For each question, and each of the two ways, the key with the fewest places
    is taken, its zip among them.
    """
    words = _tokens(F.col("query"))
    asks = inputs.where((F.size(words) > 0) & F.col("input_id").isNotNull()).groupBy("input_id").agg(F.min(F.struct("query", F.upper("city").alias("city"), F.upper("state").alias("state"), "zip")).alias("q"))
    named = asks.select("input_id", "q.*").withColumn("question", _same(*[F.col(c) for c in ("query", "city", "state", "zip")]))
    asked_once = named.groupBy("question").agg(*[F.min(c).alias(c) for c in ("query", "city", "state", "zip")])
    located = rows.where(F.length("address") > 0).select("row_no", "address", "city", "state", "zip").withColumn("place", _same(*[F.col(c) for c in ("address", "city", "state", "zip")]))
    places = located.groupBy("place").agg(*[F.min(c).alias(c) for c in ("address", "city", "state", "zip")])
    pairs = _matching(asked_once, places)
    heads = located.select("place", "row_no").withColumn("__n", F.row_number().over(Window.partitionBy("place").orderBy("row_no"))).where(F.col("__n") <= most).drop("__n")
    per_question = Window.partitionBy("question")
    first = pairs.join(heads, "place").withColumn("__n", F.row_number().over(per_question.orderBy("row_no"))).where(F.col("__n") <= most)
    last = rows.agg(F.max("row_no").alias("__last"))
    capped = first.crossJoin(F.broadcast(last))  # one row
    found = capped.select("question", "row_no", ((F.count("*").over(per_question) == most) & (F.max("row_no").over(per_question) < F.col("__last"))).alias("truncated"))
    return named.select("input_id", "question").join(found, "question").select("input_id", "row_no", "truncated")


def _matching(asked: DataFrame, places: DataFrame) -> DataFrame:
    """(question, place) of places that a question's query and tests fit."""
    q = F.col("query")
    words = _tokens(q)
    zip5 = F.when(F.length("zip") >= 5, F.array(F.concat(F.lit("z:"), F.substring("zip", 1, 5)))).otherwise(F.array().cast(KEYS))
    held = F.when(F.size(words) >= 3, _tagged(F.slice(words, F.lit(2), F.size(words) - 2))).when(F.length(q) >= 3, _pieces(q, 3, "3:")).when(F.length(q) == 2, F.array(F.concat(F.lit("2:"), q))).otherwise(F.array(F.concat(F.lit("1:"), q)))
    asked = asked.select("question", q.alias("__query"), F.col("city").alias("__city"), F.col("state").alias("__state"), F.col("zip").alias("__zip"), F.concat(_tagged(words), zip5).alias("__in_order"), F.concat(held, zip5).alias("__held"))
    ways = asked.select("question", F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("__in_order").alias("keys")), F.struct(F.lit(1).alias("way"), F.col("__held").alias("keys")))).alias("w")).select("question", "w.way", F.explode("w.keys").alias("key"))
    kinds = {r[0] for r in ways.select(F.substring("key", 1, 1)).distinct().collect()}  # five at most
    a = F.col("address")
    made = {"t": _tagged(_tokens(a)), "3": _pieces(a, 3, "3:"), "2": _pieces(a, 2, "2:"), "1": _pieces(a, 1, "1:"), "z": zip5}
    each = places.select("place", F.explode(F.concat(*[made[k] for k in sorted(kinds)]) if kinds else F.array().cast(KEYS)).alias("key")).join(ways.select("key").distinct(), "key", "left_semi")
    counts = each.groupBy("key").count()
    rarest = ways.join(counts, "key", "left").groupBy("question", "way").agg(F.min_by("key", F.struct(F.coalesce("count", F.lit(0)), "key")).alias("key"))
    pairs = rarest.select("question", "key").distinct().join(each, "key").select("question", "place").distinct()
    full = pairs.join(asked.drop("__in_order", "__held"), "question").join(places, "place")
    test = lambda c, ok: F.coalesce(F.length(c) == 0, F.lit(True)) | F.coalesce(ok, F.lit(False))
    passed = test("__city", F.contains(F.upper("city"), F.col("__city"))) & test("__state", F.upper("state") == F.col("__state")) & test("__zip", F.startswith("zip", F.substring("__zip", 1, 5)))
    fits = F.contains("address", F.col("__query")) | tokens_in_order(_tokens(F.col("__query")), _tokens(F.col("address")))
    return full.where(passed & fits).select("question", "place")
