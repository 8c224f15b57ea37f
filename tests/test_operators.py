import json
import random

import pytest
from pyspark.sql import functions as F

from civicloom.operators import geo, groups, joins, metrics, model, reshape


def test_melt_measures_keeps_missing_cells(spark, rows):
    wide = spark.createDataFrame([("g", "n", "5", None, "x")], "GEOID string, NAME string, A_1E string, A_1M string, A_2E string")
    assert rows(reshape.melt_measures(wide, ["GEOID", "NAME"])) == [
        ("g", "n", "A_1", 5.0, None),
        ("g", "n", "A_2", None, None),
    ]
    plain = reshape.melt_measures(wide, ["GEOID"], with_moe=False)
    assert plain.schema["moe"].dataType.simpleString() == "double"


def test_pivot_puts_estimates_before_margins(spark):
    long = spark.createDataFrame(
        [("g", 1, "b", 1.0, 0.1), ("g", 1, "a", 2.0, 0.2), ("h", 1, "a", None, 0.3)],
        "geo string, year int, label string, estimate double, moe double",
    )
    wide = reshape.pivot_labels(long, ["geo", "year"], "label", {"estimate": "", "moe": "_moe"})
    assert wide.columns == ["geo", "year", "a", "b", "a_moe", "b_moe"]
    assert tuple(wide.where("geo = 'h'").first()) == ("h", 1, None, None, 0.3, None)


def test_wide_and_narrow_paths_agree(spark, rows, monkeypatch):
    rng = random.Random(9)
    data = [
        (f"g{rng.randint(0, 9)}", f"c{rng.randint(0, 6)}", None if rng.random() < 0.3 else rng.random(), rng.random())
        for _ in range(200)
    ]
    long = spark.createDataFrame(data, "geo string, code string, a double, b double")
    cells = {"one": ["c1"], "both": ["c2", "c3"], "none": ["c9"], "dot.ted": ["c4"]}
    for measures in ({"a": ""}, {"a": "", "b": "_moe"}):
        narrow = reshape.widen(long, ["geo"], "code", cells, measures)
        want = narrow.columns, rows(narrow, *[f"`{c}`" for c in narrow.columns])
        with monkeypatch.context() as patch:
            patch.setattr(reshape, "NARROW", 0)
            wide = reshape.widen(long, ["geo"], "code", cells, measures)
        assert (wide.columns, rows(wide, *[f"`{c}`" for c in wide.columns])) == want


def test_too_many_labels_is_an_error(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError, match="more than 3"):
            reshape.distinct_labels(spark.range(5).select(F.col("id").cast("string").alias("l")), "l")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_fan_out_names_tables_and_reports_empty_ones(spark, rows, tmp_path):
    observations = spark.createDataFrame(
        [("g", 1, "A_1", 1.0, 0.1), ("g", 1, "A_2", 2.0, 0.2), ("g", 2, "B_1", 3.0, 0.3), ("g", 2, "Z_9", 9.0, 0.9)],
        "geo string, year int, variable string, estimate double, moe double",
    )
    crosswalk = spark.createDataFrame(
        [("A_1", "total", "fact_a"), ("A_2", "male", "fact_a"), ("B_1", "total", "fact_b"), ("C_1", "x", "fact_c")],
        "variable string, label string, table_name string",
    )
    keys = ["geo", "year"]
    for made in (
        reshape.fan_out(observations, crosswalk, keys),
        reshape.fan_out(observations, crosswalk, keys, stage_to=str(tmp_path / "stage")),
        reshape.fan_out_at_once(observations, crosswalk, keys, str(tmp_path / "wide")),
    ):
        assert sorted(made.tables) == ["fact_a", "fact_b"] and made.skipped == ["fact_c"]
        assert made.tables["fact_a"].columns == ["geo", "year", "male", "total", "male_moe", "total_moe"]
        assert rows(made.tables["fact_a"]) == [("g", 1, 2.0, 1.0, 0.2, 0.1)]
        assert rows(made.tables["fact_b"]) == [("g", 2, 3.0, 0.3)]


def test_fan_out_takes_as_many_jobs_for_any_number_of_concepts(spark, tmp_path):
    jobs, counts = spark.sparkContext.statusTracker(), []
    for n in (2, 12):
        codes = [(f"C{k}_{i}", f"line {i}", f"fact_{k}") for k in range(n) for i in range(1 + k % 3)]
        crosswalk = spark.createDataFrame(codes, "variable string, label string, table_name string")
        seen = [(f"g{g}", y, c, float(g * y), None) for g in range(3) for y in (1, 2) for c, *_ in codes]
        observations = spark.createDataFrame(seen, "geo string, year int, variable string, estimate double, moe double")
        spark.sparkContext.setJobGroup(f"fan-{n}", "")
        made = reshape.fan_out_at_once(observations, crosswalk, ["geo", "year"], str(tmp_path / f"w{n}"))
        counts.append(len(jobs.getJobIdsForGroup(f"fan-{n}")))
        spark.sparkContext.setJobGroup("rest", "")
        assert len(made.tables) == n and all(df.count() == 6 for df in made.tables.values())
        assert made.tables["fact_1"].columns == ["geo", "year", "line 0", "line 1", "line 0_moe", "line 1_moe"]
    assert counts[0] == counts[1]


def test_constant_dimension_checks_for_one_row(spark, rows):
    fact = spark.range(2)
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, name string")
    assert rows(joins.attach_constant(fact, dim, F.col("name") == "a", ["k"])) == [(0, 1), (1, 1)]
    assert rows(joins.attach_constant(fact, dim, F.col("name") == "none", ["k"])) == []
    with pytest.raises(Exception, match="(?i)more than one row"):
        joins.attach_constant(fact, dim, F.col("name") == "b", ["k"]).collect()


def test_left_joins_keep_every_row_once(spark):
    base = spark.range(100).select(F.col("id").alias("k"))
    fact = spark.range(0, 100, 3).select(F.col("id").alias("k"), F.lit("x").alias("role"), F.lit(1).alias("v"))
    joined = joins.role_join(base, fact, ["k"], F.col("role") == "x", {"v": "x_v"})
    assert joined.count() == 100 and joined.where("x_v is not null").count() == 34


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_surrogate_key_equals_row_number(spark, coalesce):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, coalesce)
    try:
        _check_surrogate_key(spark)
    finally:
        spark.conf.set(name, "true")


def _check_surrogate_key(spark):
    rng = random.Random(3)
    keys = [(None if rng.random() < 0.001 else rng.randint(0, 10**6), i) for i in range(5000)]
    df = spark.createDataFrame(keys, "a int, b int").repartition(7)
    keyed = {(r.a, r.b): r.k for r in model.surrogate_key(df, "k", ["a", "b"]).collect()}
    ordered = sorted(keys, key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    assert keyed == {pair: n for n, pair in enumerate(ordered, 1)}


def test_surrogate_key_of_nothing(spark):
    df = spark.createDataFrame([], "a int")
    assert model.surrogate_key(df, "k", ["a"]).count() == 0


def test_key_reports(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    assert rows(model.key_violations(fact, ["k", "v"])) == [
        (1, "a", 2, "duplicate key"),
        (2, None, 1, "null key"),
    ]
    dim = spark.createDataFrame([("a",)], "name string")
    assert rows(model.orphan_keys(fact, dim, ["v"], ["name"])) == [("c", 1)]


def test_append_missing_is_repeatable(spark, rows):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(model.append_missing(old, new, ["k"])) == [(1, "old"), (2, "a")]


def test_gap_long_keeps_rows_with_missing_values(spark, rows):
    fact = spark.createDataFrame(
        [("s", "W", 50.0), ("s", "B", None), ("s", "H", 20.04), ("t", "B", 1.0)],
        "school string, code string, pct double",
    )
    gaps = metrics.gap_long(fact, ["school"], "code", "pct", ("W", "white"), ["B", "H", "A"])
    assert rows(gaps, "school", "code", "white", "comparison_pct", "gap") == [
        ("s", "B", 50.0, None, None),
        ("s", "H", 50.0, 20.04, 30.0),
    ]


def test_previous_event_equals_a_plain_window(spark):
    rng = random.Random(11)
    data = [
        ("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 3)}", rng.randint(0, 400_000), i, None if rng.random() < 0.1 else rng.random())
        for i in range(4000)
    ]
    df = spark.createDataFrame(data, "k string, secs int, id int, v double").withColumn(
        "at", F.timestamp_seconds("secs")
    )
    got = {r.id: r.p for r in metrics.previous_event(df, ["k"], ["at", "id"], "v", "p").collect()}
    want, last = {}, {}
    for k, _, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        want[i], last[k] = last.get(k), v
    assert got == want


@pytest.mark.parametrize("narrow", [0, 80])
def test_indicators_equal_the_join_of_wide_facts(spark, monkeypatch, narrow):
    monkeypatch.setattr(metrics, "NARROW", narrow)
    rng = random.Random(7)
    data = [
        (f"g{g}", y, f"{t}_{n:03d}", None if rng.random() < 0.1 else float(rng.randint(0, 50)))
        for g in range(20) for y in range(3) for t in ("B1", "B2") for n in (1, 2) if rng.random() < 0.8
    ]
    observations = spark.createDataFrame(data, "geo string, year int, variable string, estimate double")
    measures = [metrics.total("sum", *metrics.lines("B1", 1, 2)), metrics.percent("pct", metrics.lines("B2", 1), metrics.lines("B1", 1))]
    got = metrics.indicators(observations, measures, ["B1", "B2"], "geo", "year")
    facts = [
        reshape.pivot_labels(observations.where(F.col("variable").startswith(t)), ["geo", "year"], "variable", {"estimate": ""}, metrics.lines(t, 1, 2))
        for t in ("B1", "B2")
    ]
    want = joins.join_facts(facts, ["geo", "year"]).select("geo", "year", *[m.column() for m in measures])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 10
    with pytest.raises(ValueError, match="B2"):
        metrics.indicators(observations, measures, ["B1"], "geo", "year")


def test_overlap_report(spark, rows):
    members = groups.membership(spark, {"A": [1, 2], "B": [2, 3], "C": [2]}, "m", "g")
    assert rows(groups.overlap_report(members, "m", "g")) == [(2, 3, "A, B, C")]


# -- boundaries --------------------------------------------------------------


def square(x, y, w=1, clockwise=False):
    ring = [[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]
    return {"type": "Polygon", "coordinates": [ring[::-1] if clockwise else ring]}


def union_of(spark, *shapes):
    df = spark.createDataFrame([("g", json.dumps(shape)) for shape in shapes], "g string, geometry string")
    measured = geo.outline_measures(df, "g", "geometry").first()
    return measured, json.loads(geo.dissolve(df, "g", "geometry").first().geometry)


def rings(shape):
    return [shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]


def test_dissolve_two_blocks(spark):
    shapes = [("a" if x < 2 else "b", json.dumps(square(x, y))) for x in range(4) for y in range(3)]
    df = spark.createDataFrame(shapes, "g string, geometry string")
    measured = {r.g: (r.area, r.perimeter, r.edges) for r in geo.outline_measures(df, "g", "geometry").collect()}
    assert measured == {"a": (6.0, 10.0, 10), "b": (6.0, 10.0, 10)}


def test_dissolve_leaves_a_hole(spark):
    shapes = [square(x, y, clockwise=(x + y) % 2 == 0) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    measured, shape = union_of(spark, *shapes)
    assert (measured.area, measured.edges) == (8.0, 16)
    assert shape["type"] == "Polygon" and [len(r) for r in shape["coordinates"]] == [13, 5]


def test_cells_touching_at_a_corner_stay_two_polygons(spark):
    measured, shape = union_of(spark, square(0, 0), square(1, 1))
    assert measured.area == 2.0 and shape["type"] == "MultiPolygon"
    assert [[len(r) for r in member] for member in shape["coordinates"]] == [[5], [5]]


def test_holes_touching_at_a_corner_stay_two_holes(spark):
    cells = [square(x, y) for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (2, 2))]
    _, shape = union_of(spark, *cells)
    assert shape["type"] == "Polygon" and sorted(len(r) for r in shape["coordinates"]) == [5, 5, 17]


def test_island_in_a_lake(spark):
    cells = [square(x, y) for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)] + [square(2, 2)]
    measured, shape = union_of(spark, *cells)
    assert measured.area == 17.0 and shape["type"] == "MultiPolygon"
    assert sorted(len(member) for member in rings(shape)) == [1, 2]


def test_a_member_listed_twice_changes_nothing(spark):
    once, _ = union_of(spark, square(0, 0), square(1, 0))
    twice, _ = union_of(spark, square(0, 0), square(0, 0, clockwise=True), square(1, 0))
    assert once == twice


def test_dissolve_again_gives_the_same(spark):
    cells = [square(x, y) for x in range(6) for y in range(6) if (x * 7 + y * 5) % 3]
    first, shape = union_of(spark, *cells)
    second, again = union_of(spark, shape)
    assert first == second and shape == again


def test_random_unions_keep_area_and_perimeter(spark):
    rng = random.Random(2)
    for _ in range(3):
        picked = {(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(60)}
        shared = sum(((x + 1, y) in picked) + ((x, y + 1) in picked) for x, y in picked)
        measured, shape = union_of(spark, *[square(x, y) for x, y in sorted(picked)])
        assert (measured.area, measured.perimeter) == (len(picked), 4 * len(picked) - 2 * shared)
        again, _ = union_of(spark, shape)
        assert (again.area, again.perimeter) == (measured.area, measured.perimeter)
