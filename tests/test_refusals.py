"""Input that used to lose rows or values without a word."""

import pytest

from civicloom.functions import semantics
from civicloom.operators import geo, metrics, reshape
from civicloom.plans import survey
from civicloom.sources import boundaries, files, payloads


@pytest.mark.parametrize("body", ['[["NAME"],["x"', '{"error": "limit"}', "not json"])
def test_broken_payload_is_refused(spark, body):
    df = spark.createDataFrame([(body,)], "body string")
    with pytest.raises(Exception, match="array of arrays"):
        payloads.payload_rows(df, "body").collect()


def test_blank_and_empty_payloads_give_no_rows(spark):
    df = spark.createDataFrame([(None,), ("",), ("[]",), ('[["NAME"]]',)], "body string")
    assert payloads.payload_rows(df, "body").count() == 0


def test_broken_dictionary_is_refused(spark):
    df = spark.createDataFrame([('{"error": 1}',)], "body string")
    with pytest.raises(Exception, match="no variables"):
        payloads.dictionary_rows(df, "body").collect()


def test_vintage(spark):
    df = spark.createDataFrame([("load=2026-01-03/2023/acs.json",), ("a/acs_2019.json",), ("y=2020/x",)], "path string")
    assert [r[0] for r in df.select(payloads.vintage_from_path("path")).collect()] == [2023, 2019, 2020]
    with pytest.raises(Exception, match="no vintage"):
        spark.createDataFrame([("a/b.json",)], "path string").select(payloads.vintage_from_path("path")).collect()


def test_other_header_order_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,Value\nx,1\n")
    (tmp_path / "b.csv").write_text("Value,Name\n2,y\n")
    with pytest.raises(Exception):
        files.read_csv_text(spark, str(tmp_path)).collect()


def test_previous_event_of_a_null_key(spark):
    rows = [(None, "2024-01-01 00:10:00", 1.0), (None, "2024-01-01 01:10:00", 2.0), ("a", "2024-01-01 00:10:00", 5.0)]
    df = spark.createDataFrame(rows, "k string, t string, v double").selectExpr("k", "CAST(t AS timestamp) t", "v")
    got = {(r["k"], r["v"]): r["p"] for r in metrics.previous_event(df, ["k"], ["t"], "v", "p").collect()}
    assert got == {(None, 1.0): None, (None, 2.0): 1.0, ("a", 5.0): None}


def test_variables_with_one_label_keep_a_column_each(spark, rows, tmp_path):
    seen = [("g", 1, "A_1", 10.0, 0.1), ("g", 1, "A_2", 99.0, 0.2), ("g", 1, "A_3", None, None), ("g", 1, "A_3", 5.0, None)]
    observations = spark.createDataFrame(seen, "geo string, year int, variable string, estimate double, moe double")
    named = [("A_1", "total", "fact_a"), ("A_2", "total", "fact_a"), ("A_3", "male", "fact_a")]
    crosswalk = spark.createDataFrame(named, "variable string, label string, table_name string")
    for stage in (None, str(tmp_path / "stage")):
        made = reshape.fan_out(observations, crosswalk, ["geo", "year"], stage_to=stage)
        assert made.shared_labels == {"fact_a": ["total"]}
        fact = made.tables["fact_a"]
        assert fact.columns[2:5] == ["male", "total_a_1", "total_a_2"]
        assert rows(fact) == [("g", 1, 5.0, 10.0, 99.0, None, 0.1, 0.2)]


def test_concepts_that_share_a_table_name_are_refused(spark):
    long = "x" * 250
    metadata = spark.createDataFrame(
        [(2024, "A_1E", "Estimate!!Total", long + " one"), (2024, "B_1E", "Estimate!!Total", long + " two")],
        "year int, name string, label string, concept string",
    )
    used = spark.createDataFrame([("A_1",), ("B_1",)], "variable string")
    assert survey.crosswalk(metadata, [used.limit(1)]).count() == 1
    with pytest.raises(Exception, match="share the table name"):
        survey.crosswalk(metadata, [used]).collect()


def test_wide_and_narrow_plans_agree(spark, rows, monkeypatch):
    seen = [("g", "a", 1.0), ("g", "a", 7.0), ("g", "b", None), ("h", "b", 2.0), ("h", "c", 3.0), (None, "a", 4.0), ("i", None, 1.0)]
    df = spark.createDataFrame(seen, "k string, label string, v double")
    cells = {"one": ["a"], "rest": ["b", "c"]}
    narrow = rows(reshape.widen(df, ["k"], "label", cells, {"v": "", "label": "_l"}))
    monkeypatch.setattr(reshape, "NARROW", 0)
    assert rows(reshape.widen(df, ["k"], "label", cells, {"v": "", "label": "_l"})) == narrow
    assert len(narrow) == 3


def test_halves(spark):
    df = spark.sql("SELECT * FROM VALUES (2.5D, '2.5'), (4.5D, '4.5'), (-0.5D, '-0.5'), (3.5D, '3.5') t(d, s)")
    got = df.select(semantics.whole_number("d"), semantics.strict_int("s")).collect()
    assert [tuple(r) for r in got] == [(2, 3), (4, 5), (0, -1), (4, 4)]


@pytest.mark.parametrize("text", ["shape", '{"type": "Point", "coordinates": [1, 2]}', '{"type": "Polygon"}'])
def test_other_geometry_is_refused(spark, text):
    df = spark.createDataFrame([("g", text), ("h", None)], "g string, geometry string")
    with pytest.raises(Exception, match="no polygon"):
        geo.outline_measures(df, "g", "geometry").collect()
    assert geo.outline_measures(df.where("g = 'h'"), "g", "geometry").count() == 0


def test_a_report_filters_in_the_reader(spark, rows, tmp_path):
    seen = [("g", 2024, "B1_001", 4.0), ("g", 2024, "B2_002", 1.0), ("h", 2024, "B1_001", 3.0), ("g", 2024, "B11_001", 9.0)]
    path = str(tmp_path / "observations")
    spark.createDataFrame(seen, "GEOID string, year int, variable string, estimate double").write.parquet(path)
    wanted = [metrics.total("people", "B1_001")]
    table = metrics.indicators(spark.read.parquet(path), wanted, ["B1", "B2"], "GEOID", "year")
    plan = table._jdf.queryExecution().toString()
    assert "StringStartsWith(variable,B1_)" in plan and "StringStartsWith(variable,B2_)" in plan
    assert rows(table) == [("g", 2024, 4.0)]


def test_lines_that_are_no_feature(spark, tmp_path):
    lines = ['{"type":"Feature","properties":{"GEOID":"1"},"geometry":{"type":"Point"}}', "", '{"properties":{"GEOID":"2"},"geometry":null}']
    broken = ['{"properties":{"GEOID":"3"},"geom', "[1, 2]", '{"type":"Feature"}', '{"properties":null}', "GEOID,3"]
    (tmp_path / "good.jsonl").write_text("\n".join(lines))
    good = boundaries.read_features(spark, str(tmp_path / "good.jsonl"), {"GEOID": "id"})
    assert sorted(map(tuple, good.collect())) == [("1", '{"type":"Point"}'), ("2", None)]
    (tmp_path / "bad.jsonl").write_text("\n".join([*lines, *broken]))
    path = str(tmp_path / "bad.jsonl")
    with pytest.raises(Exception, match="no feature"):
        boundaries.read_features(spark, path, {"GEOID": "id"}).collect()
    found = {r.line: r.why for r in boundaries.read_rejected(spark, path).collect()}
    assert set(found) == set(broken) and found[broken[0]] == "no JSON object" and found[broken[2]] == "no properties"
    kept = boundaries.features(boundaries.accepted(boundaries.read_lines(spark, path), "line"), "line", {"GEOID": "id"})
    assert sorted(r.id for r in kept.collect()) == ["1", "2"]


def test_payload_cells_by_position(spark):
    body = '[["state","B1M","B1E","B1E","NAME","B2E"],["37","2","1.5","9","x",null],["37",null,"N/A","9","y",7]]'
    df = spark.createDataFrame([(body,)], "body string")
    got = sorted(tuple(r) for r in payloads.tidy_observations(df, "body", ["state"]).select("NAME", "variable", "estimate", "moe").collect())
    assert got == [("x", "B1", 1.5, 2.0), ("x", "B2", None, None), ("y", "B1", None, None), ("y", "B2", 7.0, None)]
    plan = payloads.tidy_observations(df, "body", ["state"])._jdf.queryExecution().executedPlan().toString()
    assert "variant_explode" in plan and "map_from_arrays" not in plan and "from_json" not in plan
    for uneven in ('[["a","b"],["c"]]', '[["a"],null]', "5", '["a"]'):
        with pytest.raises(Exception, match="no array of arrays"):
            payloads.payload_rows(spark.createDataFrame([(uneven,)], "body string"), "body").collect()


def test_a_dictionary_that_names_a_variable_twice(spark):
    df = spark.createDataFrame([('{"variables":{"B1E":{"label":"x"},"B1E":{"label":"y"}}}',)], "body string")
    with pytest.raises(Exception, match="no variables"):
        payloads.dictionary_rows(df, "body").collect()
