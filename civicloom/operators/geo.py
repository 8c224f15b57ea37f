"""Boundaries kept as GeoJSON text, and their union per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.operators import noding, rings

RING = "array<array<double>>"


def geometry_text(kind: Column, coordinates: Column) -> Column:
    """GeoJSON text of a geometry type and its coordinate arrays."""
    return F.to_json(F.struct(kind.alias("type"), coordinates.alias("coordinates")))


def polygons_of(geometry: Column | str) -> Column:
    """GeoJSON Polygon or MultiPolygon text to ``array<polygon>`` of rings of points.

    No text gives NULL; other geometry types and text that cannot be read are an error.
    """
    text = F.col(geometry) if isinstance(geometry, str) else geometry
    head = F.from_json(text, "type string, coordinates string")
    body = head["coordinates"]
    single = F.from_json(body, f"array<{RING}>")
    several = F.from_json(body, f"array<array<{RING}>>")
    found = F.when((head["type"] == "Polygon") & single.isNotNull(), F.array(single)).when(
        head["type"] == "MultiPolygon", several
    )
    why = F.concat(F.lit("no polygon: "), F.substring(text, 1, 80))
    # What is found stands here once: text is read as often as its expression occurs.
    return F.coalesce(found, F.when(text.isNotNull(), F.raise_error(why).cast(f"array<array<{RING}>>")))


def _twice_area(ring: Column) -> Column:
    """Twice the signed area of a closed ring; positive when counter-clockwise."""
    steps = F.arrays_zip(ring.alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))
    return F.aggregate(
        F.slice(steps, 1, F.size(ring) - 1),
        F.lit(0.0),
        lambda acc, s: acc + s["a"][0] * s["b"][1] - s["b"][0] * s["a"][1],
    )


def member_edges(df: DataFrame, group: str, geometry: str) -> DataFrame:
    """Directed edges (group, x1, y1, x2, y2) with the interior on the left."""
    rings = (
        noding.spread(df.select(group, geometry)).select(group, F.explode(polygons_of(geometry)).alias("__polygon"))
        .select(group, F.posexplode("__polygon").alias("__nth", "__ring"))
        .where(F.size("__ring") > 3)
    )
    counter_clockwise = _twice_area(F.col("__ring")) > 0
    outer = F.col("__nth") == 0
    facing = F.when(counter_clockwise == outer, F.col("__ring")).otherwise(F.reverse("__ring"))
    oriented = rings.select(group, facing.alias("r"))
    starts = F.slice("r", 1, F.size("r") - 1)
    ends = F.slice("r", 2, F.size("r") - 1)
    steps = oriented.select(group, F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("s"))
    return steps.select(
        group,
        F.col("s.a")[0].alias("x1"),
        F.col("s.a")[1].alias("y1"),
        F.col("s.b")[0].alias("x2"),
        F.col("s.b")[1].alias("y2"),
    ).where("x1 != x2 OR y1 != y2")


def _outline(df: DataFrame, group: str, geometry: str, noded: bool) -> DataFrame:
    """Outline edges under ``g``, a struct of the group: it is equal to itself when its field is NULL."""
    edges = member_edges(df, group, geometry)
    ends = [noding.rounded(F.col(c)).alias(c) for c in ("x1", "y1", "x2", "y2")]
    signed = noding.undirected(edges.select(F.struct(group).alias("g"), *ends))
    return noding.one_sided(signed) if noded else noding.outside(noding.noded(signed))


def outline_edges(df: DataFrame, group: str, geometry: str, noded: bool = False) -> DataFrame:
    """Edges of the outline of each group's union, with the inside on the left.

    Members may overlap, touch or share borders without common vertices: edges are cut
    where they meet and stay where one side alone is covered.  A member listed twice changes
    nothing.  Shared borders cancel in a map-side aggregation keyed by the edge itself before
    anything else, so members that tile the plane leave only their outline to be cut.

    ``noded`` says that the members do not overlap and share the vertices of their common
    borders; then what does not cancel is the outline, and nothing is cut.
    """
    outline = _outline(df, group, geometry, noded)
    return outline.select(F.col("g")[group].alias(group), "x1", "y1", "x2", "y2")


def outline_measures(df: DataFrame, group: str, geometry: str, noded: bool = False) -> DataFrame:
    """Area, perimeter and edge count of each group's outline, without assembling it."""
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    doubled = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return (
        outline_edges(df, group, geometry, noded)
        .groupBy(group)
        .agg(
            (F.sum(doubled) / 2).alias("area"),
            F.sum(length).alias("perimeter"),
            F.count(F.lit(1)).alias("edges"),
        )
    )


def dissolve(df: DataFrame, group: str, geometry: str, name: str = "geometry", noded: bool = False) -> DataFrame:
    """Union of member polygons per group as GeoJSON text.

    The rings of a group meet only in the text itself, its one output cell.  ``noded`` as
    for ``outline_edges``.
    """
    shapes = rings.polygons(_outline(df, group, geometry, noded))
    single = geometry_text(F.lit("Polygon"), F.col("polygons")[0])
    several = geometry_text(F.lit("MultiPolygon"), F.col("polygons"))
    return shapes.select(F.col("g")[group].alias(group), F.when(F.size("polygons") == 1, single).otherwise(several).alias(name))
