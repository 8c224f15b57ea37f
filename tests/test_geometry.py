"""Unions of overlapping, touching and unevenly cut members against plain geometry."""

import json
import math
import random

import pandas as pd
import pytest

from civicloom.operators import geo, noding, rings
from tests.test_operators import square


def shape(*corners, holes=()):
    return {"type": "Polygon", "coordinates": [[list(c) for c in (*ring, ring[0])] for ring in (corners, *holes)]}


def walls(shapes):
    """Edges of each shape with the inside on the left."""
    out = []
    for s in shapes:
        own = []
        for k, ring in enumerate(s["coordinates"]):
            area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))
            own += list(zip(ring, ring[1:])) if (area > 0) == (k == 0) else list(zip(ring[1:], ring))
        out.append(own)
    return out


def inside(edges, x, y):
    n = 0
    for (ax, ay), (bx, by) in edges:
        if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) > x:
            n += 1
    return n % 2 == 1


def plain_union(shapes):
    """(area, perimeter) by slabs between all vertices and crossings, and by probing both sides of every piece of edge."""
    members = walls(shapes)
    edges = [e for own in members for e in own]
    cuts = [{0.0, 1.0} for _ in edges]
    xs = {p[0] for e in edges for p in e}
    for i, ((ax, ay), (bx, by)) in enumerate(edges):
        dx, dy = bx - ax, by - ay
        for j, ((cx, cy), (ex, ey)) in enumerate(edges):
            den = dx * (ey - cy) - dy * (ex - cx)
            if abs(den) > 1e-12:
                t, u = ((cx - ax) * (ey - cy) - (cy - ay) * (ex - cx)) / den, ((cx - ax) * dy - (cy - ay) * dx) / den
                if -1e-12 <= t <= 1 + 1e-12 and -1e-12 <= u <= 1 + 1e-12:
                    cuts[i].add(min(max(t, 0.0), 1.0))
                    xs.add(ax + t * dx)
            else:
                for px, py in ((cx, cy), (ex, ey)):
                    t = ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)
                    if 0 < t < 1 and abs((px - ax) * dy - (py - ay) * dx) < 1e-9:
                        cuts[i].add(t)
    xs = sorted(xs)
    area = 0.0
    for left, right in zip(xs, xs[1:]):
        if right - left < 1e-12:
            continue
        mid, spans = (left + right) / 2, []
        for own in members:
            ys = sorted(ay + (mid - ax) * (by - ay) / (bx - ax) for (ax, ay), (bx, by) in own if (ax <= mid) != (bx <= mid))
            spans += list(zip(ys[::2], ys[1::2]))
        reach = -math.inf
        for lo, hi in sorted(spans):
            area += (right - left) * max(0.0, hi - max(lo, reach))
            reach = max(reach, hi)
    pieces, eps = set(), 1e-7
    for ((ax, ay), (bx, by)), own in zip(edges, cuts):
        dx, dy = bx - ax, by - ay
        size = math.hypot(dx, dy)
        own = sorted(own)
        for t, u in zip(own, own[1:]):
            if (u - t) * size < 1e-9:
                continue
            m = (t + u) / 2
            x, y = ax + m * dx, ay + m * dy
            sides = [any(inside(w, x - s * dy / size * eps, y + s * dx / size * eps) for w in members) for s in (1, -1)]
            if sides[0] != sides[1]:
                ends = sorted((round(ax + k * dx, 6), round(ay + k * dy, 6)) for k in (t, u))
                pieces.add((*ends, round((u - t) * size, 7)))
    return area, sum(p[2] for p in pieces)


def measured(spark, *shapes):
    """Area and perimeter of the union, straight from the edges and again from the text."""
    df = spark.createDataFrame([("g", json.dumps(s)) for s in shapes], "g string, geometry string")
    union = geo.dissolve(df, "g", "geometry")
    text = union.first().geometry
    area = length = 0.0
    loaded = json.loads(text)
    for member in [loaded["coordinates"]] if loaded["type"] == "Polygon" else loaded["coordinates"]:
        for k, ring in enumerate(member):
            signed = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2
            assert ring[0] == ring[-1] and (signed > 0) == (k == 0)
            assert len({tuple(p) for p in ring}) == len(ring) - 1
            area += signed
            length += sum(math.dist(a, b) for a, b in zip(ring, ring[1:]))
    edges = geo.outline_measures(df, "g", "geometry").first()
    assert (edges.area, edges.perimeter) == (pytest.approx(area), pytest.approx(length))
    return area, length, loaded


def test_overlapping_squares(spark):
    area, length, union = measured(spark, square(0, 0, 2), square(1, 1, 2))
    assert (area, length) == (7.0, 12.0) and union["type"] == "Polygon" and len(union["coordinates"][0]) == 9


def test_border_without_common_vertices(spark):
    area, length, union = measured(spark, shape((0, 0), (2, 0), (2, 3), (0, 3)), square(2, 1))
    assert (area, length) == (7.0, 12.0) and union["type"] == "Polygon"
    area, length, _ = measured(spark, square(0, 0, 3), square(3, 0), square(3, 1), square(3, 2))
    assert (area, length) == (12.0, 14.0)


def test_member_inside_another(spark):
    assert measured(spark, square(0, 0, 5), square(1, 1))[:2] == (25.0, 20.0)


def test_overlap_closes_a_hole(spark):
    ring = shape((0, 0), (6, 0), (6, 6), (0, 6), holes=[((2, 2), (2, 4), (4, 4), (4, 2))])
    area, length, union = measured(spark, ring, square(3, 3, 2))
    assert (area, length) == (33.0, 32.0) and len(union["coordinates"]) == 2
    area, length, union = measured(spark, ring, square(2, 2, 2))
    assert (area, length) == (36.0, 24.0) and len(union["coordinates"]) == 1


def test_crossing_bars(spark):
    bars = [shape((0, k), (7, k), (7, k + 1), (0, k + 1)) for k in (1, 3, 5)] + [shape((k, 0), (k + 1, 0), (k + 1, 7), (k, 7)) for k in (1, 3, 5)]
    area, length, union = measured(spark, *bars)
    assert (area, length) == (33.0, 60.0) and len(union["coordinates"]) == 5


def test_tilted_polygons(spark):
    rng = random.Random(4)
    for n, corners in ((6, 3), (9, 5), (14, 4)):
        shapes = []
        for _ in range(n):
            x, y, size = rng.uniform(0, 6), rng.uniform(0, 6), rng.uniform(0.5, 2.5)
            angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
            shapes.append(shape(*[(x + size * math.cos(a), y + size * math.sin(a)) for a in angles]))
        area, length, _ = measured(spark, *shapes)
        assert (area, length) == (pytest.approx(plain_union(shapes)[0], abs=1e-6), pytest.approx(plain_union(shapes)[1], abs=1e-5))


def test_groups_stay_apart_and_no_name_is_a_group(spark):
    rows = [(None, json.dumps(square(0, 0, 2))), (None, json.dumps(square(1, 1, 2))), ("a", json.dumps(square(0, 0, 2))), ("b", None)]
    df = spark.createDataFrame(rows, "g string, geometry string")
    assert {r.g: r.area for r in geo.outline_measures(df, "g", "geometry").collect()} == {None: 7.0, "a": 4.0}
    assert {r.g for r in geo.dissolve(df, "g", "geometry").collect()} == {None, "a"}
    assert geo.dissolve(df.where("g = 'b'"), "g", "geometry").collect() == []


def test_rings_over_many_tiles(spark, monkeypatch):
    """A spiral of cells, walked in tiles of a few edges and ranked by doubling."""
    monkeypatch.setattr(rings, "TILE", 4)
    cells, at, step = {(0, 0)}, (0, 0), 1
    for turn in range(14):
        dx, dy = ((1, 0), (0, 1), (-1, 0), (0, -1))[turn % 4]
        for _ in range(step):
            at = (at[0] + dx, at[1] + dy)
            cells.add(at)
        step += 1 + turn % 2
    shared = sum(((x + 1, y) in cells) + ((x, y + 1) in cells) for x, y in cells)
    area, length, union = measured(spark, *[square(x, y) for x, y in sorted(cells)])
    assert (area, length) == (len(cells), 4 * len(cells) - 2 * shared)
    lake = [square(x, y) for x in range(8) for y in range(8) if (x, y) not in ((2, 2), (3, 3), (5, 5))]
    area, _, union = measured(spark, *lake)
    assert area == 61.0 and len(union["coordinates"]) == 4


def test_cells_of_a_thin_group_hold_few_edges(spark):
    """A strip four wide: its cells hold no more edges the longer it is."""
    most = []
    for n in (1000, 16000):
        strip = spark.range(n).selectExpr("struct('g' AS g) AS g", "id % 4 + 0.0D AS ax", "id DIV 4 + 0.0D AS ay", "id % 4 + 1.0D AS bx", "id DIV 4 + 0.0D AS by")
        cells = noding.celled(strip.join(noding.grid(strip), "g"))
        most.append(cells.groupBy("cell").count().agg({"count": "max"}).first()[0])
    assert most[1] <= most[0] <= 16


def test_rows_summed_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(noding, "BLOCK", 2)
    bars = [shape((3 * k, 0), (3 * k + 4, 0), (3 * k + 4, 5), (3 * k, 5)) for k in range(9)]
    assert measured(spark, *bars, square(2, 2), shape((40, 1), (41, 1), (41, 2), (40, 2)))[:2] == (28 * 5 + 1, 66 + 4)


def test_tiles_are_bounded_wherever_edges_lie():
    """No tile is larger than asked for, and a group that fits stays whole."""
    sizes = [3, 25, 4, 4, 1, 10, 2]
    of = [g for g, n in enumerate(sizes) for _ in range(n)]
    whole = pd.DataFrame({"of": of, "id": range(len(of))})
    tiles = list(rings._tiles((whole.iloc[k : k + 7] for k in range(0, len(of), 7)), 10))
    assert pd.concat(tiles)["id"].tolist() == list(range(len(of)))
    assert max(len(t) for t in tiles) <= 10
    for g in (0, 2, 3, 4, 5, 6):
        assert sum(g in set(t["of"]) for t in tiles) == 1
