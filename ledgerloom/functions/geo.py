"""Polygons in GeoJSON or as bare coordinate arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<array<double>>"
LEAST_POINTS = 3


def polygons(c: Column) -> Column:
    """array of polygons (rings of [lon, lat]) from GeoJSON, or from coordinates nested two to four deep.

    A polygon gives one element, a multipolygon all of its own; text of another shape gives null.
    """
    v = F.try_parse_json(c)
    kind = F.try_variant_get(v, "$.type", "string")
    body = F.when(kind.isin("Polygon", "MultiPolygon"), F.to_json(F.try_variant_get(v, "$.coordinates", "variant"))).otherwise(F.to_json(v))
    depth = F.length(F.regexp_extract(body, r"^(\[*)", 1))
    many = F.from_json(F.when(depth == 4, body), f"array<array<{RING}>>")
    one = F.array(F.from_json(F.when(depth == 3, body), f"array<{RING}>"))
    ring = F.array(F.array(F.from_json(F.when(depth == 2, body), RING)))
    return F.when(depth == 4, many).when(depth == 3, one).when(depth == 2, ring)


def exterior(polygon: Column) -> Column:
    """Points struct(latitude, longitude) of the first ring; null with fewer than three."""
    points = F.transform(F.filter(F.get(polygon, F.lit(0)), lambda p: F.size(p) >= 2), lambda p: F.struct(p[1].alias("latitude"), p[0].alias("longitude")))
    return F.when(F.size(points) >= LEAST_POINTS, points)


def split_id(identifier: Column, position: Column, count: Column) -> Column:
    """identifier#1, #2, .. for the parts of a multipolygon; a single part keeps the identifier."""
    return F.when(count > 1, F.concat(identifier, F.lit("#"), (position + 1).cast("string"))).otherwise(identifier)
