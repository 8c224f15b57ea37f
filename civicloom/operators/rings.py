"""Rings of directed outline edges, and polygons of rings, without a task that holds a group.

Every edge knows the one that follows it.  Chains are walked inside bounded tiles; what
crosses tiles is ranked by pointer doubling, whose rounds grow with the logarithm of the
longest ring.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicloom.operators.noding import spread, tasks
from civicloom.session import stored, stored_with

#: Edges that one task walks at a time; larger groups are cut into tiles of as many, wherever they lie.
TILE = 1 << 16


def following(edges: DataFrame) -> DataFrame:
    """(id, next) of edges (g, id, x1, y1, x2, y2): at a vertex, the edge that bounds the same inside.

    Counter-clockwise around a vertex, edges that leave it and edges that come in take
    turns; the inside lies between one that leaves and the next that comes in.
    """
    def ray(x: str, y: str, to_x: str, to_y: str, comes: bool) -> DataFrame:
        angle = F.atan2(F.col(to_y) - F.col(y), F.col(to_x) - F.col(x))
        return edges.select("g", F.col(x).alias("x"), F.col(y).alias("y"), angle.alias("angle"), "id", F.lit(comes).alias("comes"))

    rays = spread(ray("x1", "y1", "x2", "y2", False).union(ray("x2", "y2", "x1", "y1", True)), "g", "x", "y")
    around = Window.partitionBy("g", "x", "y").orderBy("angle", "comes")
    last = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.struct("id", "comes")
    before = F.coalesce(F.lag(turn).over(around), F.last(turn).over(last))
    paired = rays.withColumn("before", before).where("comes")
    wrong = F.raise_error(F.lit("edges do not close: the members are no simple polygons")).cast("long")
    return paired.select("id", F.when(F.col("before.comes"), wrong).otherwise(F.col("before.id")).alias("next"))


def _tiles(parts: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Sorted edges, at most ``size`` of them at a time; a group that is no larger stays in one tile."""
    held: pd.DataFrame | None = None
    for part in parts:
        held = part if held is None else pd.concat([held, part], ignore_index=True)
        while len(held) > size:
            of = held["of"].to_numpy()[: size + 1]
            starts = (of[1:] != of[:-1]).nonzero()[0] + 1
            cut = int(starts[-1]) if len(starts) else size
            yield held.iloc[:cut]
            held = held.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _walked(part: pd.DataFrame) -> pd.DataFrame:
    """Chains of a tile: every edge with the first of its chain and its place; where the chain goes on, if it is open.

    A chain that closes inside the tile is cut into rings that visit no vertex twice.
    """
    ids = part["id"].tolist()
    follows = dict(zip(ids, part["next"].tolist()))
    start = dict(zip(ids, zip(part["x1"].tolist(), part["y1"].tolist())))
    out: list[tuple[int, int, int, int | None, int]] = []

    def put(chain: list[int], on: int | None) -> None:
        first = chain[0] if on is not None else min(chain)
        out.extend((edge, first, n, on, len(chain)) for n, edge in enumerate(chain))

    seen: set[int] = set()
    for head in sorted(set(ids) - set(follows.values())):
        chain, at = [], head
        while at in follows:
            chain.append(at)
            at = follows[at]
        seen.update(chain)
        put(chain, at)
    for head in sorted(ids):
        path: list[int] = []
        place: dict[tuple[float, float], int] = {}
        at = head
        while at not in seen:
            seen.add(at)
            corner = start[at]
            if corner in place:
                loop = path[place[corner] :]
                del path[place[corner] :]
                for edge in loop:
                    del place[start[edge]]
                put(loop, None)
            place[corner] = len(path)
            path.append(at)
            at = follows[at]
        if path:
            put(path, None)
    made = pd.DataFrame(out, columns=["id", "head", "place", "goes_on", "size"])
    return made.astype({"goes_on": "Int64"})


def ranked(edges: DataFrame, after: DataFrame) -> tuple[DataFrame, bool]:
    """(id, ring, turn, place) of edges (g, id, x1, y1, ...): order by turn, then place, goes round a ring once.

    And whether every ring closed inside its tile, where it was cut to simple ones.
    """
    x, y, n = F.col("x1"), F.col("y1"), F.col("n")
    spans = [(F.max(c) - F.min(c)).alias(f"{c}_span") for c in ("x1", "y1")]
    sizes = edges.groupBy("g").agg(F.count("*").alias("n"), F.min("x1").alias("left"), F.min("y1").alias("down"), *spans)
    # Bands across the longer side of a group, as high as a tile of an even spread.
    wide = F.col("x1_span") > F.col("y1_span")
    long, short = F.greatest("x1_span", "y1_span"), F.least("x1_span", "y1_span")
    high = F.greatest(F.sqrt(long * short * TILE / n), long * TILE / n, F.lit(1e-300))
    band = F.floor(F.when(wide, x - F.col("left")).otherwise(y - F.col("down")) / high)
    large = n > TILE
    place = [F.xxhash64("g").alias("of"), F.when(large, band).otherwise(0).alias("band"), F.when(large, F.when(wide, y).otherwise(x)).otherwise(0.0).alias("along")]
    order = ["of", "band", "along"]
    tiled = edges.join(sizes, "g").select("id", *place, "x1", "y1").join(after, "id").select("id", "next", *order, "x1", "y1")
    size = TILE

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tile in _tiles(parts, size):
            yield _walked(tile)

    ordered = tiled.repartitionByRange(tasks(edges), *order).sortWithinPartitions(*order)
    walked = ordered.mapInPandas(walk, "id long, head long, place long, goes_on long, size long")
    walked, leave = stored_with(walked, F.count("goes_on"))
    chains = walked.where("place = 0 AND goes_on IS NOT NULL").select("head", "goes_on", "size")
    if not leave:  # no ring leaves its tile
        return walked.select("id", F.col("head").alias("ring"), F.lit(None).cast("long").alias("turn"), "place"), True
    state = stored(chains.select("head", F.col("goes_on").alias("next"), F.col("head").alias("low"), F.lit(0).cast("long").alias("ahead"), F.col("size").alias("span")))
    # low: the least chain among the next 2**k, ahead: edges to its start, span: edges of all of them.
    while True:
        then = state.select(F.col("head").alias("next"), F.col("next").alias("next2"), F.col("low").alias("low2"), F.col("ahead").alias("ahead2"), F.col("span").alias("span2"))
        joined = state.join(then, "next")
        less = F.col("low2") < F.col("low")
        state, moved = stored_with(
            joined.select(
                "head",
                F.col("next2").alias("next"),
                F.least("low", "low2").alias("low"),
                F.when(less, F.col("span") + F.col("ahead2")).otherwise(F.col("ahead")).alias("ahead"),
                (F.col("span") + F.col("span2")).alias("span"),
                less.alias("less"),
            ),
            F.count(F.when(F.col("less"), 1)),
        )
        if not moved:
            break
    places = state.select("head", F.col("low").alias("ring"), F.when(F.col("ahead") == 0, F.lit(None).cast("long")).otherwise(-F.col("ahead")).alias("turn"))
    return walked.join(places, "head", "left").select("id", F.coalesce("ring", "head").alias("ring"), "turn", "place"), False


def simple(edges: DataFrame) -> DataFrame:
    """``edges`` (g, id, x1, y1, x2, y2) with ring, turn and place of rings that visit no vertex twice."""
    after = following(edges)
    turns, closed = ranked(edges, after)
    placed = stored(edges.join(turns, "id"))
    if closed:
        return placed
    order = Window.partitionBy("g", "ring", "x1", "y1").orderBy("turn", "place")
    again = placed.groupBy("g", "ring", "x1", "y1").count().where("count > 1")
    if again.isEmpty():
        return placed
    # Where a ring comes back to a vertex, each visit goes on where the one before left.
    came = after.select(F.col("id").alias("came"), F.col("next").alias("id"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    visits = placed.join(came, "id").select("id", F.coalesce(F.lead("came").over(order), F.first("came").over(whole)).alias("came"))
    again = visits.select(F.col("came").alias("id"), F.col("id").alias("next"))
    turns, _ = ranked(edges, stored(again))
    return stored(edges.join(turns, "id"))


def _closed(points: Column) -> Column:
    """A ring from its smallest point around to it again."""
    first = F.array_position(points, F.array_min(points)).cast("int")
    turned = F.concat(F.slice(points, first, F.size(points)), F.slice(points, 1, first - 1))
    return F.concat(turned, F.slice(turned, 1, 1))


def polygons(edges: DataFrame) -> DataFrame:
    """(g, polygons array<array<ring>>) of outline edges (g, x1, y1, x2, y2) with the inside on the left.

    A ring is one array, as it is in the text that it ends up in; nothing else gathers a group
    before that text.  A hole belongs to the smallest ring around it, found by counting the
    edges to the right of one of its points that its row of a grid holds.
    """
    edges = stored(edges.withColumn("id", F.monotonically_increasing_id()))
    placed = simple(edges)
    doubled = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    spot = F.min(F.struct("x1", "y1", "x2", "y2")).alias("spot")
    points = F.transform(F.sort_array(F.collect_list(F.struct("turn", "place", "x1", "y1"))), lambda s: F.array(s["x1"], s["y1"]))
    rings = placed.groupBy("g", "ring").agg(doubled.alias("doubled"), spot, points.alias("points")).withColumn("points", _closed(F.col("points")))
    rings, n_holes = stored_with(rings, F.count(F.when(F.col("doubled") < 0, 1)))
    outers = rings.where("doubled > 0")
    listed = F.sort_array(F.collect_list(F.struct("doubled", "shape")))
    if not n_holes:
        shapes = outers.select("g", "doubled", F.array("points").alias("shape"))
        return shapes.groupBy("g").agg(F.transform(listed, lambda s: s["shape"]).alias("polygons"))
    holes = rings.where("doubled < 0")

    # Rows no higher than twice the mean height of an edge, so that a tall group's hold no more the taller it is.
    even, mean = (F.max("y1") - F.min("y1")) / F.ceil(F.sqrt(F.count("*"))), F.avg(F.abs(F.col("y2") - F.col("y1")))
    reach = edges.groupBy("g").agg(F.min("y1").alias("down"), F.least(even, 2 * mean).alias("side"))

    def row(y: Column) -> Column:
        return F.floor((y - F.col("down")) / F.col("side"))

    spots = holes.join(reach, "g").select("g", F.col("ring").alias("hole"), ((F.col("spot.x1") + F.col("spot.x2")) / 2).alias("x"), ((F.col("spot.y1") + F.col("spot.y2")) / 2).alias("y"), "down", "side")
    spots = spots.select("g", "hole", "x", "y", row(F.col("y")).alias("row"))
    walls = placed.where("y1 != y2").join(outers.select("g", "ring", "doubled"), ["g", "ring"]).join(reach, "g")
    walls = walls.withColumn("row", F.explode(F.sequence(row(F.least("y1", "y2")), row(F.greatest("y1", "y2")))))
    cuts = (F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))
    right = F.col("x1") + (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1")) > F.col("x")
    met = spots.join(walls, ["g", "row"]).where(cuts & right).groupBy("g", "hole", "ring", "doubled").count()
    owners = met.where("count % 2 = 1").groupBy("g", "hole").agg(F.min(F.struct("doubled", "ring")).getField("ring").alias("owner"))
    owned = holes.join(owners.select(F.col("hole").alias("ring"), "owner"), "ring", "left")
    lost = F.raise_error(F.lit("hole outside every ring: the members are no simple polygons")).cast("long")
    owned = owned.select(F.coalesce("owner", lost).alias("ring"), F.col("points").alias("hole")).groupBy("ring").agg(F.sort_array(F.collect_list("hole")).alias("holes"))
    shapes = outers.join(owned, "ring", "left").select("g", "doubled", F.concat(F.array("points"), F.coalesce("holes", F.array().cast("array<array<array<double>>>"))).alias("shape"))
    return shapes.groupBy("g").agg(F.transform(listed, lambda s: s["shape"]).alias("polygons"))
