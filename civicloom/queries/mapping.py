"""Boundaries built from customer keys, and their union."""

from pyspark.sql import functions as F

from civicloom.operators import geo
from civicloom.queries.registry import query

# Customers sit on a grid 40 cells wide; a cell is one unit square.
CELLS_SQL = """
    cells AS (SELECT c_custkey, c_custkey % 40 AS x, c_custkey // 40 AS y, r_name AS region FROM customer
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

OUTLINE_SQL = f"""
    WITH {CELLS_SQL},
    shared AS (SELECT a.region, count(*) AS n FROM cells a JOIN cells b ON a.region = b.region AND
      ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY 1)
    SELECT c.region, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - 2 * coalesce(max(s.n), 0) AS DOUBLE) AS perimeter
    FROM cells c LEFT JOIN shared s ON c.region = s.region GROUP BY 1"""


def cell_shapes(t):
    """(region, geometry) squares; every other row is drawn clockwise or as a MultiPolygon."""
    x, y = F.col("x"), F.col("y")
    ring = F.array(F.array(x, y), F.array(x + 1, y), F.array(x + 1, y + 1), F.array(x, y + 1), F.array(x, y))
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    regions = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    cells = (
        t.customer.select(
            "c_nationkey",
            (F.col("c_custkey") % 40).cast("double").alias("x"),
            F.floor(F.col("c_custkey") / 40).cast("double").alias("y"),
        )
        .join(nations, "c_nationkey")
        .join(regions, "n_regionkey")
    )
    backwards = F.col("x") % 2 == 0
    drawn = cells.withColumn("ring", F.when(backwards, F.reverse(ring)).otherwise(ring))
    single = geo.geometry_text(F.lit("Polygon"), F.array("ring"))
    several = geo.geometry_text(F.lit("MultiPolygon"), F.array(F.array("ring")))
    return drawn.select("region", F.when(F.col("y") % 2 == 0, single).otherwise(several).alias("geometry"))


@query(OUTLINE_SQL)
def outline_measures(t):
    """Area and perimeter of each region straight from the surviving edges."""
    return geo.outline_measures(cell_shapes(t), "region", "geometry", noded=True).select(
        "region", "area", "perimeter"
    )


@query(OUTLINE_SQL)
def dissolve_polygons(t):
    """Union per region as GeoJSON text, measured again from that text."""
    union = geo.dissolve(cell_shapes(t), "region", "geometry", noded=True)
    return geo.outline_measures(union, "region", "geometry", noded=True).select("region", "area", "perimeter")


# Bricks three wide and two apart, odd rows moved by one: neighbours in a row overlap, and
# corners of a row lie on the sides of the rows above and below.
BRICKS_SQL = f"""
    WITH {CELLS_SQL},
    covered AS (SELECT DISTINCT region, 2 * x + y % 2 + dx AS x, y FROM cells, (VALUES (0), (1), (2)) d(dx)),
    shared AS (SELECT a.region, count(*) AS n FROM covered a JOIN covered b ON a.region = b.region AND
      ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY 1)
    SELECT c.region, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - 2 * coalesce(max(s.n), 0) AS DOUBLE) AS perimeter
    FROM covered c LEFT JOIN shared s ON c.region = s.region GROUP BY 1"""


def bricks(t):
    """(region, geometry) overlapping bricks without common vertices."""
    square = F.from_json(F.regexp_replace("geometry", "^.*?(\\[\\[[0-9].*?\\]\\]).*$", "$1"), geo.RING)
    corner = cell_shapes(t).select("region", F.array_min(F.transform(square, lambda p: p[0])).alias("x"), F.array_min(F.transform(square, lambda p: p[1])).alias("y"))
    left = 2 * F.col("x") + F.col("y") % 2
    sides = corner.select("region", left.alias("x"), "y")
    x, y = F.col("x"), F.col("y")
    ring = F.array(F.array(x, y), F.array(x + 3, y), F.array(x + 3, y + 1), F.array(x, y + 1), F.array(x, y))
    return sides.select("region", geo.geometry_text(F.lit("Polygon"), F.array(ring)).alias("geometry"))


@query(BRICKS_SQL)
def overlapping_outline(t):
    """Area and perimeter of the union of overlapping members, straight from the noded edges."""
    return geo.outline_measures(bricks(t), "region", "geometry").select("region", "area", "perimeter")


@query(BRICKS_SQL)
def dissolve_overlapping(t):
    """Union of overlapping members as GeoJSON text, measured again from that text."""
    union = geo.dissolve(bricks(t), "region", "geometry")
    return geo.outline_measures(union, "region", "geometry").select("region", "area", "perimeter")


@query(
    """
    SELECT CAST(o_custkey AS VARCHAR) AS bg, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE '[' || c_custkey || ']' END AS geometry
    FROM (SELECT DISTINCT o_custkey FROM orders) a JOIN customer ON o_custkey = c_custkey"""
)
def geometry_attach(t):
    """Areas keep their row when their boundary is retired."""
    areas = t.orders.select(F.col("o_custkey").cast("string").alias("bg")).distinct()
    shapes = t.customer.where("c_mktsegment != 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("bg"),
        F.to_json(F.array("c_custkey")).alias("geometry"),
    )
    return areas.join(shapes, "bg", "left")
