"""Edges of overlapping shapes cut where they meet, and what lies on either side of them.

All steps are joins and aggregations keyed by (group, grid cell), so a hot group spreads
over as many tasks as it has cells, and the number of pairs grows with the edges of a
cell, not of a group.  Coordinates are rounded to ``DIGITS`` decimals first, so that a
point that two edges share is one value on both; a vertex closer to an edge than that
counts as on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicloom.session import stored, stored_with

#: Decimals that tell points apart: a tenth of a millimetre in degrees.
DIGITS = 9
NEAR = 2 * 10.0**-DIGITS
EDGE = ["ax", "ay", "bx", "by"]
#: Cells of a row whose borders one task sums up.
BLOCK = 1 << 12


def rounded(value: Column) -> Column:
    return F.round(value, DIGITS) + F.lit(0.0)


def undirected(edges: DataFrame, times: Column | int = 1) -> DataFrame:
    """(g, ax, ay, bx, by, times) of directed edges (g, x1, y1, x2, y2): each once, from its smaller end.

    ``times`` is how often it runs that way, less how often it runs back.  With the inside
    on the left of every edge, it is what the number of shapes over a point gains from the
    right of a -> b to the left.  Edges that gain nothing are left out.
    """
    ahead = F.struct("x1", "y1") < F.struct("x2", "y2")
    ends = [F.when(ahead, F.col(p)).otherwise(F.col(q)).alias(n) for n, p, q in zip(EDGE, ("x1", "y1", "x2", "y2"), ("x2", "y2", "x1", "y1"))]
    counted = times if isinstance(times, Column) else F.lit(times)
    seen = edges.where("x1 != x2 OR y1 != y2").select("g", *ends, F.when(ahead, counted).otherwise(-counted).alias("t"))
    return seen.groupBy("g", *EDGE).agg(F.sum("t").alias("times")).where("times != 0")


def grid(edges: DataFrame) -> DataFrame:
    """(g, x0, y0, side): square cells, about as many as a group has edges, off any round number.

    Where a group is long and thin, or mostly empty, that many cells of its box hold more edges
    the larger it is; cells are then twice as wide as an edge is long on average, so that
    the edges still pass through no more than three each on average.

    A sum of lengths may differ in its last digits when taken again, so it is stored where
    several steps use it.
    """
    low_y, high_y = F.least("ay", "by"), F.greatest("ay", "by")
    reach = (F.col("bx") - F.col("ax") + high_y - low_y).alias("reach")
    box = edges.select("*", reach).groupBy("g").agg(F.min("ax").alias("left"), F.max("bx").alias("right"), F.min(low_y).alias("down"), F.max(high_y).alias("up"), F.count("*").alias("n"), F.avg("reach").alias("mean"))
    side = F.least(F.greatest(F.col("right") - F.col("left"), F.col("up") - F.col("down")) / F.ceil(F.sqrt("n")), 2 * F.col("mean"))
    sized = box.withColumn("side", F.greatest(side, F.lit(1024 * NEAR)))
    return sized.select("g", (F.col("left") - F.col("side") * 0.381966).alias("x0"), (F.col("down") - F.col("side") * 0.236068).alias("y0"), "side")


def _column(x: Column) -> Column:
    return F.floor((x - F.col("x0")) / F.col("side"))


def _row(y: Column) -> Column:
    return F.floor((y - F.col("y0")) / F.col("side"))


def _cell() -> Column:
    """One number to join on for (g, col, row); those decide where two cells share it."""
    return F.xxhash64("g", "col", "row")


def celled(placed: DataFrame) -> DataFrame:
    """Edges with their grid (x0, y0, side), once for every cell (col, row) they pass through."""
    ax, ay, bx, by, side = (F.col(c) for c in (*EDGE, "side"))
    spread = placed.withColumn("col", F.explode(F.sequence(_column(ax - NEAR), _column(bx + NEAR))))
    slope = F.when(bx > ax, (by - ay) / (bx - ax))
    left = F.greatest(ax, F.col("x0") + F.col("col") * side - NEAR)
    right = F.least(bx, F.col("x0") + (F.col("col") + 1) * side + NEAR)

    def height(x: Column, upright: Column) -> Column:
        """The edge's y at x; a steep edge stays inside its own height."""
        y = ay + (x - ax) * slope
        return F.when(slope.isNull(), upright).otherwise(F.least(F.greatest(y, F.least(ay, by)), F.greatest(ay, by)))

    one, two = height(left, ay), height(right, by)
    pad = NEAR + side * 1e-9
    rows = F.sequence(_row(F.least(one, two) - pad), _row(F.greatest(one, two) + pad))
    return spread.withColumn("row", F.explode(rows)).withColumn("cell", _cell())


def tasks(df: DataFrame) -> int:
    """As many tasks as run side by side."""
    session = df.sparkSession
    return max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as run side by side.

    The rows of a cell are few bytes and much arithmetic, so partitions sized by bytes would
    leave most of a cluster idle.
    """
    return df.repartition(tasks(df), *keys)


CELL = ["cell", "g", "col", "row"]


def _other(df: DataFrame) -> DataFrame:
    """``df`` with the columns of its cell, but for the join key, under other names."""
    return df.withColumnsRenamed({c: f"o_{c}" for c in CELL[1:]})


def _one_cell() -> Column:
    """The rest of the join: written so that rows are sorted by the key alone."""
    return F.array_contains(F.array("o_g"), F.col("g")) & (F.col("o_col") - F.col("col") == 0) & (F.col("o_row") - F.col("row") == 0)


def _touching(edges: DataFrame, sized: DataFrame, cells: DataFrame) -> DataFrame:
    """(g, ax, ay, bx, by, x, y): ends of other edges that lie on an edge between its own ends."""
    ends = edges.select("g", F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))).alias("s"))
    points = ends.select("g", "s.x", "s.y").join(sized, "g")
    points = points.select("g", _column(F.col("x")).alias("col"), _row(F.col("y")).alias("row"), "x", "y").withColumn("cell", _cell())
    met = _other(spread(points, "cell")).join(cells, "cell").where(_one_cell())
    x, y, ax, ay, bx, by = (F.col(c) for c in ("x", "y", *EDGE))
    dx, dy = bx - ax, by - ay
    along = (x - ax) * dx + (y - ay) * dy
    off = F.abs((x - ax) * dy - (y - ay) * dx)
    inside = (along > 0) & (along < dx * dx + dy * dy) & (off * off <= (dx * dx + dy * dy) * NEAR**2)
    near = (x >= ax - NEAR) & (x <= bx + NEAR) & (y >= F.least(ay, by) - NEAR) & (y <= F.greatest(ay, by) + NEAR)
    apart = ((x != ax) | (y != ay)) & ((x != bx) | (y != by))
    return met.where(near & apart & inside).select("g", *EDGE, "x", "y")


def _crossing(cells: DataFrame) -> DataFrame:
    """(g, ax, ay, bx, by, x, y): where two edges cross, away from the ends of both."""
    p = _other(cells.select(*CELL, *[F.col(c).alias(f"p{c}") for c in EDGE]))
    q = cells.select(*CELL, *[F.col(c).alias(f"q{c}") for c in EDGE])
    pax, pay, pbx, pby, qax, qay, qbx, qby = (F.col(f"{e}{c}") for e in "pq" for c in EDGE)
    # Each pair once; a pair whose boxes are apart, or touch, does not cross.
    first = (pax < qax) | ((pax == qax) & (F.struct(pay, pbx, pby) < F.struct(qay, qbx, qby)))
    near = (pbx > qax) & (F.greatest(pay, pby) > F.least(qay, qby)) & (F.greatest(qay, qby) > F.least(pay, pby))
    pairs = p.join(q, "cell").where(first & near & _one_cell())
    ux, uy, vx, vy, wx, wy = pbx - pax, pby - pay, qbx - qax, qby - qay, qax - pax, qay - pay
    pairs = pairs.select("g", *[f"{e}{c}" for e in "pq" for c in EDGE], (ux * vy - uy * vx).alias("cross"), (wx * vy - wy * vx).alias("along"), (wx * uy - wy * ux).alias("other"))
    cross, along, other = F.col("cross"), F.col("along"), F.col("other")
    inner = (cross != 0) & (along * cross > 0) & (F.abs(along) < F.abs(cross)) & (other * cross > 0) & (F.abs(other) < F.abs(cross))
    step = along / F.when(cross != 0, cross)
    found = pairs.where(inner).select("g", *[f"{e}{c}" for e in "pq" for c in EDGE], rounded(pax + step * (pbx - pax)).alias("x"), rounded(pay + step * (pby - pay)).alias("y"))
    for end in ("pa", "pb", "qa", "qb"):  # else an end touches the other edge
        found = found.where((F.abs(F.col("x") - F.col(f"{end}x")) > NEAR) | (F.abs(F.col("y") - F.col(f"{end}y")) > NEAR))
    both = F.array(*[F.struct(*[F.col(f"{e}{c}").alias(c) for c in EDGE]) for e in "pq"])
    return found.select("g", F.explode(both).alias("e"), "x", "y").select("g", "e.*", "x", "y")


def _meetings(edges: DataFrame) -> DataFrame:
    """(g, ax, ay, bx, by, x, y): points between the ends of an edge where another edge meets it."""
    sized = stored(grid(edges), "grid")
    cells = spread(celled(edges.join(sized, "g")).select(*CELL, *EDGE), "cell")
    # The same point may come from several cells and edges; pieces without length are left out later.
    return _touching(edges, sized, cells).union(_crossing(cells))


def noded(edges: DataFrame) -> DataFrame:
    """``edges`` (g, ax, ay, bx, by, times) cut until none meets another between its ends."""
    edges = stored(edges)
    while True:
        meetings, found = stored_with(_meetings(edges), F.count(F.lit(1)))
        if not found:
            return edges
        cut = edges.join(meetings.select("g", *EDGE).distinct(), ["g", *EDGE])
        whole = edges.join(meetings.select("g", *EDGE).distinct(), ["g", *EDGE], "left_anti")
        ends = cut.select("g", *EDGE, "times", F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))).alias("s"))
        points = ends.select("g", *EDGE, "times", "s.x", "s.y").union(cut.join(meetings, ["g", *EDGE]).select("g", *EDGE, "times", "x", "y"))
        along = (F.col("x") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("y") - F.col("ay")) * (F.col("by") - F.col("ay"))
        order = Window.partitionBy("g", *EDGE).orderBy(along, "x", "y")
        parts = points.select("g", "times", F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(order).alias("x2"), F.lead("y").over(order).alias("y2"))
        kept = whole.select("g", "times", *[F.col(c).alias(n) for c, n in zip(EDGE, ("x1", "y1", "x2", "y2"))])
        edges = stored(undirected(parts.where("x2 IS NOT NULL").union(kept), F.col("times")))


def one_sided(edges: DataFrame) -> DataFrame:
    """Edges (g, x1, y1, x2, y2) of shapes that do not overlap, with the inside on the left."""
    ahead = F.col("times") > 0
    ends = [F.when(ahead, F.col(p)).otherwise(F.col(q)).alias(n) for n, p, q in zip(("x1", "y1", "x2", "y2"), EDGE, ("bx", "by", "ax", "ay"))]
    return edges.select("g", *ends)


def outside(edges: DataFrame) -> DataFrame:
    """Of noded edges, those with a shape on one side only, as (g, x1, y1, x2, y2) with it on the left.

    The number of shapes over a point is counted along a path: in from the left on the lower
    border of its row of cells to the corner of its cell, along that border to its x, and up to
    it.  The first leg is a running sum over the crossings of a border, the rest meets the
    edges of one cell only.
    """
    ax, ay, bx, by, side = (F.col(c) for c in (*EDGE, "side"))
    placed = edges.join(stored(grid(edges), "grid"), "g")
    floor_y = F.col("y0") + F.col("row") * side
    crosses = (ay <= floor_y) != (by <= floor_y)
    at = ax + (floor_y - ay) * (bx - ax) / F.when(by != ay, by - ay)
    gain = F.when(by > ay, -F.col("times")).otherwise(F.col("times"))  # left to right

    rows = F.sequence(_row(F.least(ay, by)), _row(F.greatest(ay, by)) + 1)
    borders = placed.withColumn("row", F.explode(rows)).where(crosses).withColumn("col", _column(at))
    borders = borders.groupBy("g", "row", "col").agg(F.sum(gain).alias("gain"))
    middle = [((ax + bx) / 2).alias("mx"), ((ay + by) / 2).alias("my")]
    mids = placed.select("g", "x0", "y0", "side", *[F.col(c).alias(f"m_{c}") for c in (*EDGE, "times")], *middle)
    mids = mids.select("*", _column(F.col("mx")).alias("col"), _row(F.col("my")).alias("row")).withColumn("cell", _cell())
    asked = mids.select("g", "row", "col").distinct()
    # Summed inside blocks of a row, and over its blocks, so that no task sorts the whole of a long row.
    along = Window.partitionBy("g", "row", "block").orderBy("col").rangeBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("g", "row").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    both = borders.withColumn("asked", F.lit(False)).unionByName(asked.select("*", F.lit(0).cast("long").alias("gain"), F.lit(True).alias("asked")))
    both = both.withColumn("block", F.floor(F.col("col") / BLOCK))
    blocks = both.groupBy("g", "row", "block").agg(F.sum("gain").alias("gain"))
    blocks = blocks.select("g", "row", "block", F.coalesce(F.sum("gain").over(over), F.lit(0)).alias("before"))
    inner = both.withColumn("inner", F.coalesce(F.sum("gain").over(along), F.lit(0))).where("asked")
    corners = inner.join(blocks, ["g", "row", "block"]).select("g", "row", "col", (F.col("before") + F.col("inner")).alias("corner"))

    local = spread(celled(placed).select(*CELL, *EDGE, "times"), "cell")
    met = spread(mids, "cell").join(_other(local), "cell").where(_one_cell())
    mx, my = F.col("mx"), F.col("my")
    in_border = F.coalesce(crosses & (_column(at) == F.col("col")) & (at <= mx), F.lit(False))
    upward = ay + (mx - ax) * (by - ay) / F.when(bx != ax, bx - ax)
    own = F.lit(True)
    for c in EDGE:
        own &= F.col(c) == F.col(f"m_{c}")
    above = F.coalesce(((ax <= mx) != (bx <= mx)) & (upward > floor_y) & (upward < my) & ~own, F.lit(False))
    step = F.when(in_border, gain).otherwise(0) + F.when(above, F.col("times")).otherwise(0)
    key = [*CELL, *[f"m_{c}" for c in (*EDGE, "times")]]
    right = met.groupBy(*key).agg(F.sum(step).alias("step")).join(corners, ["g", "row", "col"])
    shapes = F.col("corner") + F.col("step")  # to the right of a -> b
    left = shapes + F.col("m_times")
    outer = right.where((shapes > 0) != (left > 0))
    ends = [F.when(left > 0, F.col(f"m_{p}")).otherwise(F.col(f"m_{q}")).alias(n) for n, p, q in zip(("x1", "y1", "x2", "y2"), EDGE, ("bx", "by", "ax", "ay"))]
    return outer.select("g", *ends)
