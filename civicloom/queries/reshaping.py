"""Long and wide, and tables named by metadata."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.functions import names, semantics as s
from civicloom.operators import reshape
from civicloom.queries.registry import query
from civicloom.session import scratch_path

# Published form of the order statistics: code, label, concept.
DICTIONARY = [
    ("P01_001", "Estimate!!Total:", "Orders by Priority"),
    ("P01_002", "Estimate!!Total:!!Urgent", "Orders by Priority"),
    ("P01_003", "Estimate!!Total:!!High", "Orders by Priority"),
    ("P02_001", "Estimate!!Total:!!Filled", "Order Status (in 2001 Inflation-Adjusted Dollars)"),
    ("P02_002", "Estimate!!Total:!!Open", "Order Status (in 2001 Inflation-Adjusted Dollars)"),
    ("P03_001", "Estimate!!Median", "Never Published"),
]


def order_observations(t):
    """Observations (geoid, vintage_year, variable, estimate, moe) of order counts.

    One pass: an order counts under each variable it belongs to.
    """
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    per_customer = (
        t.orders.groupBy(
            "o_custkey", F.year("o_orderdate").alias("vintage_year"), "o_orderpriority", "o_orderstatus"
        )
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
        .join(people, "o_custkey")
    )
    variable = F.explode(
        F.array_compact(
            F.array(
                F.lit("P01_001"),
                F.when(F.col("o_orderpriority") == "1-URGENT", "P01_002"),
                F.when(F.col("o_orderpriority") == "2-HIGH", "P01_003"),
                F.when(F.col("o_orderstatus") == "F", "P02_001"),
                F.when(F.col("o_orderstatus") == "O", "P02_002"),
            )
        )
    )
    coded = per_customer.select("c_nationkey", "vintage_year", variable.alias("variable"), "n", "top")
    return coded.groupBy(
        F.col("c_nationkey").cast("string").alias("geoid"), "vintage_year", "variable"
    ).agg(F.sum("n").cast("double").alias("estimate"), F.max("top").alias("moe"))


OBSERVATIONS_SQL = """
    coded AS (SELECT CAST(c_nationkey AS VARCHAR) AS geoid, CAST(year(o_orderdate) AS INTEGER) AS vintage_year, o_totalprice,
        unnest([CASE WHEN o_orderpriority = '1-URGENT' THEN 'P01_002' WHEN o_orderpriority = '2-HIGH' THEN 'P01_003' END,
          'P01_001', CASE o_orderstatus WHEN 'F' THEN 'P02_001' WHEN 'O' THEN 'P02_002' END]) AS variable
      FROM orders JOIN customer ON o_custkey = c_custkey),
    observations AS (SELECT geoid, vintage_year, variable, CAST(count(*) AS DOUBLE) AS estimate, max(o_totalprice) AS moe
      FROM coded WHERE variable IS NOT NULL GROUP BY 1, 2, 3)"""


@query(
    f"""
    WITH {OBSERVATIONS_SQL}
    SELECT geoid, vintage_year, max(CASE WHEN variable = 'P01_001' THEN estimate END) AS "P01_001",
           max(CASE WHEN variable = 'P01_002' THEN estimate END) AS "P01_002", max(CASE WHEN variable = 'P01_003' THEN estimate END) AS "P01_003",
           max(CASE WHEN variable = 'P01_001' THEN moe END) AS "P01_001_moe", max(CASE WHEN variable = 'P01_002' THEN moe END) AS "P01_002_moe",
           max(CASE WHEN variable = 'P01_003' THEN moe END) AS "P01_003_moe"
    FROM observations WHERE variable LIKE 'P01%' GROUP BY 1, 2"""
)
def concept_pivot(t):
    """Estimates and margins of one concept widened in one aggregation, columns discovered."""
    rows = order_observations(t).where(F.col("variable").startswith("P01"))
    return reshape.pivot_labels(
        rows, ["geoid", "vintage_year"], "variable", {"estimate": "", "moe": "_moe"}
    )


def _naming(t):
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.lit(l).alias("raw"), F.lit(k).alias("concept"))
            for c, l, k in DICTIONARY
        ]
    )
    dictionary = t.spark.range(1).select(F.inline(entries))
    return dictionary.select(
        "variable",
        names.label_slug("raw").alias("label"),
        names.table_slug(names.concept_title("concept")).alias("table_name"),
    )


FAN_OUT_SQL = f"""
    WITH {OBSERVATIONS_SQL},
    named AS (SELECT geoid, vintage_year, estimate, moe, CASE variable WHEN 'P01_001' THEN 'total' WHEN 'P01_002' THEN 'total_urgent'
        WHEN 'P01_003' THEN 'total_high' WHEN 'P02_001' THEN 'total_filled' ELSE 'total_open' END AS label,
        CASE WHEN variable LIKE 'P01%' THEN 'fact_orders_by_priority' ELSE 'fact_order_status' END AS table_name FROM observations)
    SELECT table_name, label || suffix AS column_name, count(DISTINCT geoid || '/' || vintage_year) AS cells,
           CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM (SELECT table_name, label, '' AS suffix, geoid, vintage_year, estimate AS v FROM named
          UNION ALL SELECT table_name, label, '_moe', geoid, vintage_year, moe FROM named) x GROUP BY ALL"""


def _described(tables):
    """(table, column, filled cells, total) of every emitted table, for comparison."""
    parts = []
    for name, wide in tables.items():
        columns = [c for c in wide.columns if c not in ("geoid", "vintage_year")]
        long = reshape.melt_columns(wide, ["geoid", "vintage_year"], columns, "column_name", "v")
        parts.append(
            long.where(F.col("v").isNotNull())
            .groupBy("column_name")
            .agg(
                F.count(F.lit(1)).alias("cells"), F.sum(s.exact("v")).cast("double").alias("total")
            )
            .select(F.lit(name).alias("table_name"), "column_name", "cells", "total")
        )
    return reduce(DataFrame.unionByName, parts)


@query(FAN_OUT_SQL)
def concept_fan_out(t):
    """One wide table per concept; the concept without rows is skipped."""
    made = reshape.fan_out(order_observations(t), _naming(t), ["geoid", "vintage_year"])
    if made.skipped != ["fact_never_published"]:
        raise AssertionError(f"unexpected empty concepts: {made.skipped}")
    return _described(made.tables)


@query(FAN_OUT_SQL)
def concept_fan_out_staged(t):
    """The same from observations staged once, one folder per concept."""
    made = reshape.fan_out(
        order_observations(t),
        _naming(t),
        ["geoid", "vintage_year"],
        stage_to=scratch_path(t.spark, "staged"),
    )
    return _described(made.tables)


@query(FAN_OUT_SQL)
def concept_fan_out_at_once(t):
    """All wide tables by one aggregation and one write."""
    made = reshape.fan_out_at_once(order_observations(t), _naming(t), ["geoid", "vintage_year"], scratch_path(t.spark, "wide"))
    if made.skipped != ["fact_never_published"]:
        raise AssertionError(f"unexpected empty concepts: {made.skipped}")
    return _described(made.tables)


@query(
    """
    SELECT user_id, CAST(max(ts) AS DATE) AS last_day, max(CASE WHEN event_type = 'click' THEN value END) AS click_top,
           max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase_top, max(CASE WHEN event_type = 'view' THEN value END) AS view_top
    FROM events GROUP BY 1"""
)
def category_pivot(t):
    """Explicit-group pivot: category values become columns beside a plain aggregate."""
    cells = {k: [k] for k in ("click", "purchase", "view")}
    wide = reshape.widen(t.events, ["user_id"], "event_type", cells, {"value": "_top"})
    days = t.events.groupBy("user_id").agg(F.to_date(F.max("ts")).alias("last_day"))
    return wide.join(days, "user_id")


WIDE_SQL = """
    wide AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || c_custkey AS geoid, c_name AS "NAME",
      CAST(c_acctbal AS VARCHAR) AS "B01_001E", CASE WHEN c_mktsegment = 'BUILDING' THEN '***' ELSE '1.5' END AS "B01_001M",
      CAST(c_nationkey AS VARCHAR) AS "B01_002E" FROM customer)"""


@query(
    f"""
    WITH {WIDE_SQL}
    SELECT geoid AS "GEOID", "NAME", 'B01_001' AS variable, TRY_CAST("B01_001E" AS DOUBLE) AS estimate, TRY_CAST("B01_001M" AS DOUBLE) AS moe FROM wide
    UNION ALL SELECT geoid, "NAME", 'B01_002', TRY_CAST("B01_002E" AS DOUBLE), NULL FROM wide"""
)
def tidy_unpivot(t):
    """Suffix-typed wide columns to tidy rows, with a composite identifier."""
    geoid = reshape.composite_id(
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.col("c_custkey").cast("string")
    )
    wide = t.customer.select(
        geoid.alias("GEOID"),
        F.col("c_name").alias("NAME"),
        F.col("c_acctbal").cast("string").alias("B01_001E"),
        F.when(F.col("c_mktsegment") == "BUILDING", "***").otherwise("1.5").alias("B01_001M"),
        F.col("c_nationkey").cast("string").alias("B01_002E"),
    )
    return reshape.melt_measures(wide, ["GEOID", "NAME"])


@query(
    f"""
    WITH {OBSERVATIONS_SQL}
    SELECT g.geoid, g.vintage_year, v.variable, o.estimate FROM (SELECT DISTINCT geoid, vintage_year FROM observations) g
    JOIN (SELECT DISTINCT variable FROM observations) v ON TRUE
    LEFT JOIN observations o ON o.geoid = g.geoid AND o.vintage_year = g.vintage_year AND o.variable = v.variable"""
)
def pivot_roundtrip(t):
    """Widen, then unpivot: every cell comes back, empty ones included."""
    labels = [c for c, _, _ in DICTIONARY if c != "P03_001"]
    wide = reshape.pivot_labels(
        order_observations(t), ["geoid", "vintage_year"], "variable", {"estimate": ""}, labels
    )
    return reshape.melt_columns(wide, ["geoid", "vintage_year"], labels, "variable", "estimate")


@query(
    """
    SELECT c_mktsegment, max(CASE WHEN c_acctbal < 0 THEN c_acctbal END) AS least_debt,
           max(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) AS best FROM customer GROUP BY 1"""
)
def conditional_pivot(t):
    cells = {"least_debt": F.col("c_acctbal") < 0, "best": F.col("c_acctbal") >= 0}
    return reshape.pick_columns(t.customer, ["c_mktsegment"], cells, {"c_acctbal": ""})


@query(
    f"""
    WITH {OBSERVATIONS_SQL}
    SELECT geoid, vintage_year, variable, regexp_replace(variable || 'E', '[EM]$', '') AS base FROM observations"""
)
def suffix_strip(t):
    coded = order_observations(t).select("geoid", "vintage_year", "variable")
    return coded.withColumn("base", reshape.base_code(F.concat("variable", F.lit("E"))))
