import math
import random

import duckdb
from pyspark.sql import functions as F

from civicloom.functions import parse, semantics as s


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_rounding_uses_the_binary_value(spark):
    values = [1.005, 0.285, 2.675, 2.5, -2.5, 0.5, -0.5, 1.5]
    twos = one(spark, *[s.round_binary(F.lit(v), 2) for v in values[:3]])
    assert twos == (1.0, 0.28, 2.68)
    wholes = one(spark, *[s.round_binary(F.lit(v), 0) for v in values[3:]])
    assert wholes == (3.0, -3.0, 1.0, -1.0, 2.0)


def test_rounding_agrees_with_sql_on_random_values(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1e6, 1e6) for _ in range(4000)]
    values += [rng.randint(-10**7, 10**7) / 1000 for _ in range(4000)]
    values += [rng.randint(-999, 999) + 0.5 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [tuple(r) for r in df.select(*[s.round_binary("v", k) for k in (0, 1, 2)]).collect()]
    con = duckdb.connect()
    for value, have in zip(values, got):
        want = con.execute("SELECT round(?::DOUBLE, 0), round(?::DOUBLE, 1), round(?::DOUBLE, 2)", [value] * 3)
        assert have == want.fetchone()


def test_rounding_keeps_missing_and_special_values(spark):
    none, inf, nan = one(
        spark,
        s.round_binary(F.lit(None).cast("double"), 2),
        s.round_binary(F.lit(math.inf), 2),
        s.round_binary(F.lit(math.nan), 2),
    )
    assert none is None and inf == math.inf and math.isnan(nan)


def test_division_by_zero(spark):
    zero, n = F.lit(0.0), F.lit(3.0)
    assert one(spark, s.safe_ratio(n, zero), s.safe_percent(n, zero)) == (None, None)
    up, down, undefined, none = one(
        spark,
        s.ieee_ratio(n, zero),
        s.ieee_ratio(-n, zero),
        s.ieee_ratio(zero, zero),
        s.ieee_ratio(F.lit(None).cast("double"), zero),
    )
    assert (up, down, none) == (math.inf, -math.inf, None) and math.isnan(undefined)


def test_bracket_total_is_null_when_a_bracket_is(spark):
    assert one(spark, s.bracket_total([F.lit(1), F.lit(2)]), s.bracket_total([F.lit(1), F.lit(None)])) == (3, None)


def test_tolerant_numbers(spark):
    texts = ["12.7", "NA", ">95", " 12 ", "1e3", "", "5d", "-12.5", "12.5", None]
    ints = one(spark, *[s.tolerant_int(F.lit(t).cast("string")) for t in texts])
    assert ints == (13, None, None, 12, 1000, None, None, -13, 13, None)
    doubles = one(spark, *[s.tolerant_double(F.lit(t).cast("string")) for t in ["12.7", "5d", "5.f", " 5 ", "*"]])
    assert doubles == (12.7, None, None, 5.0, None)
    con = duckdb.connect()
    for text, value in zip(texts, ints):
        assert con.execute("SELECT TRY_CAST(? AS INTEGER)", [text]).fetchone()[0] == value


def test_sentinels_and_status(spark):
    marked = F.lit(-666666666.0)
    assert one(spark, s.null_if_sentinel(marked), s.null_if_sentinel(F.lit(4.0))) == (None, 4.0)
    assert one(spark, s.null_if_sentinel(F.lit(-9.0), [-9.0, -8.0])) == (None,)
    below = s.at_least(F.lit(None).cast("int"), 0, "yes", "no")
    assert one(spark, s.at_least(F.lit(0), 0, "yes", "no"), below) == ("yes", "no")


def test_units_round_trip(spark):
    assert one(spark, s.units(F.lit(0.07)), s.units(F.lit(1863.84)), s.from_units(F.lit(186384))) == (7, 186384, 1863.84)


def test_code_labels(spark):
    known = {"MH": "Mental Health"}
    code = F.lit("XX")
    assert one(spark, s.code_label(code, known), s.code_label(code, known, passthrough=True)) == (None, "XX")


def test_grade_bounds(spark):
    cases = {
        "3-8": (3, 8, False),
        "5&8": (5, 8, False),
        "EOC (9-12)": (9, 12, True),
        "All": (None, None, False),
        "3": (3, 3, False),
        None: (None, None, None),
    }
    for scope, expected in cases.items():
        assert one(spark, *parse.grade_bounds(F.lit(scope).cast("string"))) == expected


def test_area_hierarchy(spark):
    geoid = F.lit("371190064111")
    name = F.lit("Block Group 1, Census Tract 64.11, Mecklenburg County, North Carolina")
    expected = ("371190064111", "Block Group 1", "37119006411", "Census Tract 64.11", "37119", "Mecklenburg County")
    assert one(spark, *parse.area_hierarchy(geoid, name)) == expected
    assert one(spark, *parse.area_hierarchy(geoid, name, "Union County"))[5] == ""


def test_ascending_sort_puts_nulls_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    assert [r.v for r in df.orderBy(*s.nulls_last("v")).collect()] == [1, 2, None]
    assert [r.v for r in df.orderBy(*s.nulls_last("-v")).collect()] == [2, 1, None]
