"""Town and neighbourhood reports on observations derived from order lines.

Every order line counts towards one published variable, chosen by its part,
supplier and line number, in the region or nation of its customer and the year
of its order.  The report code is the warehouse's own.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.operators import joins
from civicloom.operators.reshape import melt_columns, widen
from civicloom.plans import reports, survey
from civicloom.queries.joining import placed_orders
from civicloom.queries.registry import QUERIES, query
from civicloom.session import durable, scratch_path

AREAS = {"place": ("r_regionkey", "37"), "block group": ("n_nationkey", "37119")}


def _codes(report):
    """Variables the report can meet: its own, and the first line of each required table."""
    used = {c for m in report.measures for c in m.codes}
    firsts = {f"{t}_{n:03d}" for t in report.requires for n in (1, 9) if not t.startswith("S")}
    return sorted(used | firsts)


def line_observations(t, codes, geography):
    """Raw observations; an estimate of few lines is marked as not estimated."""
    area, prefix = AREAS[geography]
    slot = F.pmod(F.col("l_partkey") * 7 + F.col("l_suppkey") * 3 + F.col("l_linenumber"), F.lit(len(codes)))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), slot.alias("slot"), "l_quantity"
    )
    orders = placed_orders(t).withColumnRenamed("yr", "vintage_year")
    if area == "r_regionkey":
        regions = t.nation.select("n_nationkey", F.col("n_regionkey").alias(area))
        orders = orders.join(regions, "n_nationkey")
    cells = (
        lines.join(orders.select("o_orderkey", "vintage_year", area), "o_orderkey")
        .groupBy(area, "vintage_year", "slot")
        .agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("top"))
    )
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("slot") + 1).cast("int"))
    estimate = F.when(F.col("top") < 9, float(survey.NOT_ESTIMATED)).otherwise(F.col("n").cast("double"))
    return cells.select(
        F.concat(F.lit(prefix), F.col(area).cast("string")).alias("GEOID"),
        F.concat(F.lit(" place "), F.col(area).cast("string")).alias("NAME"),
        F.concat(code, F.lit("E")).alias("variable"),
        estimate.alias("estimate"),
        F.col("top").alias("moe"),
        "vintage_year",
    )


def observations_sql(codes, geography):
    area, prefix = AREAS[geography]
    listed = "[" + ", ".join(f"'{c}'" for c in codes) + "]"
    return f"""
    WITH obs AS (SELECT '{prefix}' || {area} AS geoid, CAST(year(o_orderdate) AS INTEGER) AS yr,
        list_extract({listed}, CAST((l_partkey * 7 + l_suppkey * 3 + l_linenumber) % {len(codes)} AS INTEGER) + 1) AS variable,
        CASE WHEN max(l_quantity) < 9 THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS estimate, max(l_quantity) AS moe
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)"""


def measure_sql(m):
    def add(codes):
        return "(" + " + ".join(f'"{c}"' for c in codes) + ")"

    if not m.bottom:
        return f'{add(m.top)} AS "{m.name}"'
    base = f"nullif({add(m.bottom)}, 0)" if m.guarded else add(m.bottom)
    value = f"{add(m.top)} / {base}"
    if m.scale != 1.0:
        value = f"({value}) * {m.scale:g}"
    return f'round({value}, {m.digits}) AS "{m.name}"'


def wide_sql(report):
    """Join of one wide table per published table, as a star schema would hold them."""
    codes = sorted({c for m in report.measures for c in m.codes})
    facts = []
    for table in report.requires:
        own = [c for c in codes if c.split("_")[0] == table]
        columns = "".join(f", max(CASE WHEN variable = '{c}' THEN estimate END) AS \"{c}\"" for c in own)
        facts.append(f"(SELECT geoid, yr{columns} FROM obs WHERE variable LIKE '{table}\\_%' ESCAPE '\\' GROUP BY 1, 2)")
    first, *rest = facts
    joined = f"{first} f0" + "".join(f" JOIN {f} f{i} USING (geoid, yr)" for i, f in enumerate(rest, 1))
    return joined, ", ".join(measure_sql(m) for m in report.measures)


def _town(name, report):
    codes = _codes(report)
    source, measures = wide_sql(report)
    sql = f"""{observations_sql(codes, "place")}
    SELECT geoid AS "GEOID", r_name AS town, yr AS year, {measures} FROM {source} JOIN region ON geoid = '37' || r_regionkey"""

    def build(t):
        raw = line_observations(t, codes, "place")
        towns = t.region.select(
            F.concat(F.lit("37"), F.col("r_regionkey").cast("string")).alias("place_GEOID"),
            F.col("r_name").alias("town_name"),
        )
        # Stored, as a report of the warehouse finds them.
        observations = durable(survey.clean_observations(raw, places="place"))
        return reports.town_report(name, observations, towns)

    query(sql, name=name)(build)


# Neighbourhoods over nations; nation 4 is claimed by two.
HOODS = {"Harbour": ["371191"], "Mill": ["371192", "371193"], "Oak": ["371194"],
         "Ridge": ["371194", "371195", "371196", "3711911", "3711912"]}

HOOD_NOTES = {"Harbour": "one", "Mill": "two together", "Oak": "claimed by Ridge as well", "Ridge": "five, one of them claimed by Oak"}


def _hood(name, report):
    codes = _codes(report)
    source, measures = wide_sql(report)
    notes = name == "agg_neighborhood_demographics"
    members = ", ".join(
        f"('{g}', '{n}', '{HOOD_NOTES[n]}')" for n, gs in HOODS.items() for g in gs
    )
    sql = f"""{observations_sql(codes, "block group")}
    SELECT hood AS neighborhood_name, {"note AS disclaimer, " if notes else ""}geoid AS "GEOID", yr AS year, {measures}
    FROM {source} JOIN (VALUES {members}) m(geoid, hood, note) USING (geoid)"""

    def build(t):
        observations = durable(survey.clean_observations(line_observations(t, codes, "block group")))
        members = reports.neighborhood_members(t.spark, HOODS, "GEOID", HOOD_NOTES)
        return reports.neighborhood_report(name, observations, members)

    query(sql, name=name)(build)


for _name, _report in reports.TOWN_REPORTS.items():
    _town(_name, _report)
for _name, _report in reports.NEIGHBORHOOD_REPORTS.items():
    _hood(_name, _report)


_TRENDS = reports.TOWN_REPORTS["agg_town_economic_trends"]


@query(QUERIES["agg_town_economic_trends"].sql, name="town_trends_by_fact_join")
def town_trends_by_fact_join(t):
    """The same report by widening each published table and joining the facts."""
    observations = durable(survey.clean_observations(line_observations(t, _codes(_TRENDS), "place")))
    keyed = observations.withColumnRenamed("vintage_year", "year")
    facts = []
    for table in _TRENDS.requires:
        own = {m.name: m.top for m in _TRENDS.measures if m.top[0].startswith(table)}
        rows = keyed.where(F.col("variable").startswith(f"{table}_"))
        others = rows.select("GEOID", "year").distinct()
        facts.append(others.join(widen(rows, ["GEOID", "year"], "variable", own, {"estimate": ""}), ["GEOID", "year"], "left"))
    towns = t.region.select(
        F.concat(F.lit("37"), F.col("r_regionkey").cast("string")).alias("GEOID"),
        F.col("r_name").alias("town"),
    )
    return joins.attach(joins.join_facts(facts, ["GEOID", "year"]), towns, "GEOID")


# -- silver and gold steps on the same observations ---------------------------

_CODES = _codes(reports.TOWN_REPORTS["agg_town_housing_stability"])


@query(
    f"""{observations_sql(_CODES, "place")}
    SELECT geoid AS "GEOID", 'place ' || substr(geoid, 3) AS "NAME", variable, yr AS vintage_year, estimate, moe FROM obs WHERE geoid IN ('371', '373')"""
)
def clean_place_observations(t):
    """Silver: typed codes, no sentinels, only the wanted place names."""
    raw = line_observations(t, _CODES, "place")
    return survey.clean_observations(raw, places="place 1|place 3")


@query(
    f"""{observations_sql(_CODES, "place")},
    named AS (SELECT geoid, yr, estimate, 'fact_concept_' || lower(split_part(variable, '_', 1)) AS table_name, 'total_line_' || lower(variable) AS column_name FROM obs
      WHERE variable NOT LIKE 'B25004%')
    SELECT table_name, column_name, count(DISTINCT geoid || '/' || yr) AS area_years, count(estimate) AS cells, CAST(sum(estimate) AS DOUBLE) AS total
    FROM named GROUP BY 1, 2"""
)
def concept_facts(t):
    """Gold: dictionaries of two vintages to a crosswalk to one wide fact per concept.

    The newest dictionary lacks one table, whose observations then have no fact.
    """
    observations = durable(survey.clean_observations(line_observations(t, _CODES, "place")))
    entries = [
        F.struct(
            F.lit(year).alias("year"),
            F.lit(f"{code}E").alias("name"),
            F.lit(f"Estimate!!Total:!!Line {code}:").alias("label"),
            F.lit(f"Concept {code.split('_')[0]} (in {year} Inflation-Adjusted Dollars)").alias("concept"),
        )
        for year in (2023, 2024)
        for code in _CODES
        if year == 2023 or not code.startswith("B25004")
    ]
    metadata = t.spark.range(1).select(F.inline(F.array(*entries)))
    cross = survey.crosswalk(metadata, [observations])
    made = survey.concept_facts(observations, cross, "place_GEOID", scratch_path(t.spark, "concepts"))
    parts = []
    for name, fact in made.tables.items():
        keys = ["place_GEOID", "year_key"]
        columns = [c for c in fact.columns if c not in keys and not c.endswith("_moe")]
        long = melt_columns(fact, keys, columns, "column_name", "v")
        with_margin = [c for c in columns if f"{c}_moe" in fact.columns]
        if with_margin != columns:
            raise AssertionError(f"{name} lacks margins")
        moes = melt_columns(fact, keys, [f"{c}_moe" for c in columns], "column_name", "m")
        present = moes.where(F.col("m").isNotNull()).groupBy(
            F.regexp_replace("column_name", "_moe$", "").alias("column_name")
        ).agg(F.count(F.lit(1)).alias("area_years"))
        values = long.groupBy("column_name").agg(F.count("v").alias("cells"), F.sum("v").alias("total"))
        joined = present.join(values, "column_name")
        parts.append(joined.select(F.lit(name).alias("table_name"), "column_name", "area_years", "cells", "total"))
    return reduce(DataFrame.unionByName, parts)


@query(
    """SELECT DISTINCT '37' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS "place_GEOID",
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Davidson' WHEN 'BUILDING' THEN 'Cornelius' WHEN 'FURNITURE' THEN 'Huntersville' ELSE 'Other' END AS town_name
    FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def dim_town(t):
    """Gold: standard town names from raw place names."""
    spelled = {"AUTOMOBILE": "DAVIDSON town", "BUILDING": "Cornelius town", "FURNITURE": "huntersville Town"}
    name = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for p in spelled.items() for v in p]), F.col("c_mktsegment")), F.lit("Matthews town"))
    used = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    places = t.customer.join(used, "c_custkey", "left_semi").select(
        F.concat(F.lit("37"), F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("GEOID"), name.alias("NAME")
    )
    return survey.town_dimension(places)
