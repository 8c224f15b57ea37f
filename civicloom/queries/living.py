"""Housing, hardship, facility, health and boundary tables on derived raw text."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.functions import semantics as s
from civicloom.operators import geo, groups, reshape
from civicloom.plans import health, housing, places, reports
from civicloom.queries.mapping import cell_shapes
from civicloom.queries.registry import query
from civicloom.queries.townships import HOODS
from civicloom.session import durable


def towns(t):
    """Regions as towns: place identifier and name."""
    return t.region.select(
        F.concat(F.lit("37"), F.col("r_regionkey").cast("string")).alias("place_GEOID"),
        F.col("r_name").alias("town_name"),
    )


def customer_towns(t):
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return people.join(nations, "c_nationkey").join(t.region, "r_regionkey").select(
        "o_custkey", "c_mktsegment", "r_name"
    )


def cents(total, count):
    """Mean of a total in cents as text with two decimals."""
    mean = s.safe_ratio(s.from_units(total), count)
    return s.round_binary(mean, 2).cast("decimal(12,2)").cast("string")


# -- home values and rents ---------------------------------------------------

MEAN = "CAST(CAST(round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS DECIMAL(12,2)) AS VARCHAR)"
TOWN_ORDERS = """orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
VALUES_SQL = f"""
    home_values AS (SELECT '37' || r_regionkey AS place, r_name AS town, c_mktsegment AS kind, CAST(date_trunc('month', o_orderdate) AS DATE) AS day,
      TRY_CAST(CASE WHEN count(*) < 3 THEN 'NA' ELSE {MEAN} END AS DOUBLE) AS v FROM {TOWN_ORDERS} GROUP BY 1, 2, 3, 4)"""
RENTS_SQL = f"""
    rents AS (SELECT '37' || r_regionkey AS place, r_name AS town, CAST(date_trunc('month', o_orderdate) AS DATE) AS day,
      TRY_CAST(CASE WHEN count(*) < 20 THEN 'NA' ELSE {MEAN} END AS DOUBLE) AS v FROM {TOWN_ORDERS} WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3)"""


def monthly(t, *by, orders=None):
    month = F.date_trunc("month", "o_orderdate").alias("month")
    per_customer = (t.orders if orders is None else orders).groupBy("o_custkey", month).agg(
        F.sum(s.units("o_totalprice")).alias("spent"), F.count(F.lit(1)).alias("n")
    )
    joined = per_customer.join(customer_towns(t), "o_custkey")
    return joined.groupBy("r_name", "month", *by).agg(F.sum("spent").alias("spent"), F.sum("n").alias("n"))


def home_value_fact(t):
    raw = monthly(t, "c_mktsegment").select(
        F.concat(F.lit(" "), F.col("r_name")).alias("town"),
        F.col("c_mktsegment").alias("housing_type"),
        F.date_format("month", "M/d/yy").alias("date"),
        F.when(F.col("n") < 3, "NA").otherwise(cents("spent", "n")).alias("home_value"),
    )
    return housing.home_value_fact(housing.clean_home_values(raw), towns(t))


def rent_fact(t):
    raw = monthly(t, orders=t.orders.where("o_orderstatus = 'F'")).select(
        F.col("r_name").alias("RegionName"),
        F.date_format("month", "yyyy-MM-dd").alias("date"),
        F.when(F.col("n") < 20, "NA").otherwise(cents("spent", "n")).alias("rent_index"),
    )
    return housing.rent_fact(housing.clean_rents(raw), towns(t))


@query(
    f"""WITH {VALUES_SQL} SELECT town, day AS date, kind AS housing_type, v AS home_value,
      lag(v) OVER (PARTITION BY town, kind ORDER BY day) AS prev_home_value FROM home_values"""
)
def agg_town_home_value_trends(t):
    return housing.home_value_trends(home_value_fact(t), towns(t))


@query(
    f"WITH {RENTS_SQL} SELECT town, day AS date, v AS rent_value, lag(v) OVER (PARTITION BY town ORDER BY day) AS prev_rent_value FROM rents"
)
def agg_town_rent_trends(t):
    return housing.rent_trends(rent_fact(t), towns(t))


INCOME_SQL = f"income AS (SELECT '37' || r_regionkey AS place, r_name AS town, CAST(year(o_orderdate) + 1 AS INTEGER) AS year, max(o_totalprice) AS median_income FROM {TOWN_ORDERS} GROUP BY 1, 2, 3)"


@query(
    f"""WITH {VALUES_SQL}, {RENTS_SQL}, {INCOME_SQL}
    SELECT i.town, i.year, round(a.v, 4) AS avg_home_val, round(r.v, 4) AS avg_rent, median_income, round(a.v / nullif(median_income, 0), 2) AS price_to_income_ratio
    FROM income i LEFT JOIN (SELECT place, year(day) AS year, avg(v) AS v FROM home_values GROUP BY 1, 2) a ON a.place = i.place AND a.year = i.year
    LEFT JOIN (SELECT place, year(day) AS year, avg(v) AS v FROM rents GROUP BY 1, 2) r ON r.place = i.place AND r.year = i.year"""
)
def zillow_market_affordability_index(t):
    """Incomes are published a year late, so the last one has neither values nor rents."""
    peak = t.orders.groupBy("o_custkey", (F.year("o_orderdate") + 1).alias("vintage_year")).agg(
        F.max("o_totalprice").alias("top")
    )
    named = peak.join(customer_towns(t), "o_custkey").groupBy("r_name", "vintage_year")
    observations = (
        named.agg(F.max("top").alias("estimate"))
        .join(towns(t), F.col("r_name") == F.col("town_name"))
        .select(F.col("place_GEOID").alias("GEOID"), "vintage_year", F.lit("B19013_001").alias("variable"), "estimate")
    )
    table = housing.market_affordability(observations, home_value_fact(t), rent_fact(t), towns(t))
    return table.withColumns({c: s.round_binary(c, 4) for c in ("avg_home_val", "avg_rent")})


# -- household hardship ------------------------------------------------------

HARDSHIP_SQL = f"""
    hardship AS (SELECT '37' || r_regionkey AS place, r_name AS town, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(count(*) AS INTEGER) AS total_households,
      CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS INTEGER) AS poverty_households, CAST(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS INTEGER) AS alice_households,
      CAST(count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS INTEGER) AS above_alice_households FROM {TOWN_ORDERS} GROUP BY 1, 2, 3)"""


def raw_hardship(t, place):
    status = {"poverty_households": "F", "alice_households": "O", "above_alice_households": "P"}
    counted = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("string").alias("year")).agg(
        F.count(F.lit(1)).alias("total_households"),
        *[F.count(F.when(F.col("o_orderstatus") == v, 1)).alias(n) for n, v in status.items()],
    )
    summed = counted.join(customer_towns(t), "o_custkey").groupBy(F.lower("r_name").alias(place), "year")
    return summed.agg(*[F.sum(c).cast("string").alias(c) for c in housing.HOUSEHOLD_COUNTS])


@query(
    f"""WITH {HARDSHIP_SQL} SELECT place AS "GEOID", town, yr AS year, total_households, poverty_households, alice_households, above_alice_households FROM hardship"""
)
def agg_town_alice_household(t):
    """Town names arrive in lower case and still match."""
    clean = housing.clean_town_hardship(raw_hardship(t, "town"))
    return housing.town_hardship(housing.town_hardship_fact(clean, towns(t)), towns(t))


@query(
    f"""WITH {HARDSHIP_SQL} SELECT '37119' AS "GEOID", 'Asia County' AS county, yr AS year, total_households, poverty_households, alice_households, above_alice_households
    FROM hardship WHERE town = 'ASIA'"""
)
def agg_county_alice_household(t):
    raw = raw_hardship(t, "county").where("county = 'asia'").withColumn("county", F.initcap("county"))
    clean = durable(housing.clean_county_hardship(raw))
    counties = clean.select("county_GEOID", "county_name").distinct()
    return housing.county_hardship(housing.county_hardship_fact(clean), counties)


# -- regional affordability --------------------------------------------------

# The largest parts are a kind of their own, which no market has; it ties with another in size.
SIZES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6, "JUMBO": 6}
KIND_SQL = "CASE WHEN p_size > 48 THEN 'JUMBO' ELSE p_type END"
SIZE_SQL = f"CASE {KIND_SQL} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SIZES.items()) + " END"
GAP_SQL = f"""
    gap AS (SELECT {KIND_SQL} AS bedrooms, CAST({SIZE_SQL} AS INTEGER) AS household_size, (p_size % 5 + 1) * 20 || '% AMI' AS ami_level, CAST((p_size % 5 + 1) * 20 AS INTEGER) AS pct,
      CAST(sum(p_size) AS INTEGER) AS annual_income, CAST(count(*) AS INTEGER) AS max_rent, CAST(sum(p_size) - 30 * count(*) AS INTEGER) AS monthly_gap FROM part GROUP BY ALL),
    market AS (SELECT r_name AS region, CAST(year(l_shipdate) AS INTEGER) AS yr, p_type AS bedrooms, CAST(count(*) AS INTEGER) AS fmr FROM lineitem
      JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY 1, 2, 3)"""


def clean_gap(t):
    kind = F.when(F.col("p_size") > 48, "JUMBO").otherwise(F.col("p_type"))
    size = F.create_map(*[F.lit(v) for p in SIZES.items() for v in p])[kind]
    level = ((F.col("p_size") % 5 + 1) * 20).cast("string")
    grouped = t.part.groupBy(
        F.concat(F.lit(" "), kind).alias("bedrooms"),
        size.cast("string").alias("household_size"),
        F.concat(level, F.lit("% AMI")).alias("ami_level"),
    ).agg(F.sum("p_size").alias("income"), F.count(F.lit(1)).alias("n"))
    raw = grouped.select(
        "bedrooms", "household_size", "ami_level",
        F.col("income").cast("string").alias("annual_income"),
        F.col("n").cast("string").alias("max_affordable_rent"),
        F.lit("0").alias("fmr"),
        (F.col("income") - 30 * F.col("n")).cast("string").alias("monthly_gap"),
    )
    return housing.clean_affordability(raw)


def clean_market(t):
    """Lines per supplier region, ship year and part type.

    Lines meet their part first, are combined to (supplier, year, type), and only those
    few rows meet the suppliers.
    """
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("bedrooms"))
    lines = t.lineitem.select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("year"))
    counted = lines.join(kinds, "l_partkey").groupBy("l_suppkey", "year", "bedrooms").agg(
        F.count(F.lit(1)).alias("n")
    )
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    places_of = sellers.join(nations, "s_nationkey").join(t.region, "r_regionkey").select(
        "l_suppkey", F.col("r_name").alias("region")
    )
    joined = counted.join(places_of, "l_suppkey")
    raw = joined.groupBy("region", "year", "bedrooms").agg(F.sum("n").cast("string").alias("fmr"))
    return housing.clean_market_rents(raw)


@query(
    f"""WITH {GAP_SQL} SELECT region AS region_name, yr AS year, m.bedrooms AS bedroom_label, household_size AS assumed_household_size, fmr
    FROM market m JOIN (SELECT DISTINCT bedrooms, household_size FROM gap) b ON m.bedrooms = b.bedrooms"""
)
def agg_charlotte_fair_market_rent(t):
    market = durable(clean_market(t))
    regions, bedrooms = housing.region_dimension(market), housing.bedroom_dimension(clean_gap(t))
    return housing.market_rents(housing.market_rent_fact(market, regions, bedrooms), regions, bedrooms)


@query(
    f"""WITH {GAP_SQL} SELECT 'ASIA' AS region_name, 1999 AS year, g.bedrooms AS bedroom_label, household_size AS assumed_household_size, ami_level AS ami_level_label,
      pct AS ami_pct, annual_income, max_rent AS max_affordable_rent, m.fmr, monthly_gap, CASE WHEN monthly_gap >= 0 THEN 'Affordable' ELSE 'Unaffordable' END AS affordability_status
    FROM gap g LEFT JOIN market m ON m.region = 'ASIA' AND m.yr = 1999 AND m.bedrooms = g.bedrooms"""
)
def agg_charlotte_ami_affordability_gap(t):
    """Gaps of one region and year; a type without market rent keeps its row."""
    market, gap = durable(clean_market(t)), durable(clean_gap(t))
    regions = housing.region_dimension(market)
    bedrooms, levels = housing.bedroom_dimension(gap), housing.income_level_dimension(gap)
    fact = housing.affordability_fact(gap, regions, bedrooms, levels, "ASIA", 1999)
    rent = housing.market_rent_fact(market, regions, bedrooms)
    return housing.affordability_gap(fact, rent, regions, bedrooms, levels)


def clean_jobs(t):
    widget = F.col("p_name").endswith("widget")
    raw = t.part.groupBy("p_name").agg(
        F.min(s.exact("p_retailprice", 12)).cast("string").alias("hourly_wage"),
        F.count(F.lit(1)).cast("string").alias("n"),
    ).select(
        F.col("p_name").alias("occupation"),
        "hourly_wage",
        F.when(widget, "NA").otherwise(F.col("n")).alias("employment"),
        F.when(widget, " Benchmark").otherwise("Occupation").alias("category"),
    )
    return housing.clean_wages(raw)


@query(
    """SELECT 'ASIA' AS region_name, 1999 AS year, p_name AS occupation_name, CASE WHEN p_name LIKE '%widget' THEN 'Benchmark' ELSE 'Occupation' END AS category,
      CAST(min(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS hourly_wage, CASE WHEN p_name LIKE '%widget' THEN NULL ELSE CAST(count(*) AS INTEGER) END AS employment
    FROM part GROUP BY p_name"""
)
def agg_charlotte_occupation_housing_wage(t):
    wages = clean_jobs(t)
    regions = housing.region_dimension(t.region.select(F.col("r_name").alias("region")))
    occupations = housing.occupation_dimension(wages)
    fact = housing.wage_fact(wages, regions, occupations, "ASIA", 1999)
    return housing.occupation_wages(fact, regions, occupations)


# -- keys of the star schema ---------------------------------------------------

KEYED_SQL = f"""{GAP_SQL},
    regions AS (SELECT row_number() OVER (ORDER BY region) AS region_key, region AS region_name FROM (SELECT DISTINCT region FROM market) m),
    rooms AS (SELECT row_number() OVER (ORDER BY household_size, bedrooms) AS bedroom_key, bedrooms, household_size
      FROM (SELECT DISTINCT bedrooms, household_size FROM gap) g),
    levels AS (SELECT row_number() OVER (ORDER BY pct) AS ami_level_key, ami_level, pct FROM (SELECT DISTINCT ami_level, pct FROM gap) g)"""
JOBS_SQL = """jobs AS (SELECT row_number() OVER (ORDER BY name, category) AS occupation_key, * FROM (
      SELECT p_name AS name, CASE WHEN p_name LIKE '%widget' THEN 'Benchmark' ELSE 'Occupation' END AS category,
        CAST(min(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS wage, CAST(count(*) AS INTEGER) AS n FROM part GROUP BY 1, 2) p)"""


@query(f"WITH {KEYED_SQL} SELECT region_key, region_name FROM regions")
def dim_region(t):
    return housing.region_dimension(clean_market(t))


@query(f"WITH {KEYED_SQL} SELECT bedroom_key, bedrooms AS bedroom_label, household_size AS assumed_household_size FROM rooms")
def dim_bedrooms(t):
    """Keys by size; of two kinds of one size the label decides."""
    return housing.bedroom_dimension(clean_gap(t))


@query(f"WITH {KEYED_SQL} SELECT ami_level_key, ami_level AS ami_level_label, pct AS ami_pct FROM levels")
def dim_ami_level(t):
    """Keys by percentage: 100 comes after 20."""
    return housing.income_level_dimension(clean_gap(t))


@query(f"WITH {JOBS_SQL} SELECT occupation_key, name AS occupation_name, category FROM jobs")
def dim_occupation(t):
    return housing.occupation_dimension(clean_jobs(t))


@query(
    f"""WITH {KEYED_SQL} SELECT region_key, yr AS year_key, bedroom_key, fmr FROM market
    JOIN regions ON region_name = region JOIN rooms USING (bedrooms)"""
)
def fact_fair_market_rent(t):
    market = durable(clean_market(t))
    return housing.market_rent_fact(market, housing.region_dimension(market), housing.bedroom_dimension(clean_gap(t)))


@query(
    f"""WITH {KEYED_SQL} SELECT (SELECT region_key FROM regions WHERE region_name = 'EUROPE') AS region_key, 1999 AS year_key, bedroom_key, ami_level_key,
      annual_income, max_rent AS max_affordable_rent, monthly_gap, CASE WHEN monthly_gap >= 0 THEN 'Affordable' ELSE 'Unaffordable' END AS affordability_status
    FROM gap JOIN rooms USING (bedrooms, household_size) JOIN levels USING (ami_level)"""
)
def fact_ami_affordability_gap(t):
    gap = durable(clean_gap(t))
    regions = housing.region_dimension(clean_market(t))
    bedrooms, levels = housing.bedroom_dimension(gap), housing.income_level_dimension(gap)
    return housing.affordability_fact(gap, regions, bedrooms, levels, "EUROPE", 1999)


@query(
    f"""WITH {JOBS_SQL} SELECT (SELECT count(*) FROM region WHERE r_name <= 'ASIA') AS region_key, 1999 AS year_key, occupation_key, wage AS hourly_wage,
      CASE WHEN category = 'Occupation' THEN n END AS employment FROM jobs"""
)
def fact_occupation_housing_wage(t):
    wages = durable(clean_jobs(t))
    regions = housing.region_dimension(t.region.select(F.col("r_name").alias("region")))
    return housing.wage_fact(wages, regions, housing.occupation_dimension(wages), "ASIA", 1999)


@query(
    f"""WITH {HARDSHIP_SQL} SELECT place AS "place_GEOID", yr AS year_key, total_households, poverty_households, alice_households, above_alice_households FROM hardship"""
)
def fact_alice_town_household(t):
    return housing.town_hardship_fact(housing.clean_town_hardship(raw_hardship(t, "town")), towns(t))


@query(
    f"""WITH {HARDSHIP_SQL} SELECT '37119' AS "county_GEOID", yr AS year_key, total_households, poverty_households, alice_households, above_alice_households FROM hardship"""
)
def fact_alice_county(t):
    return housing.county_hardship_fact(housing.clean_county_hardship(raw_hardship(t, "county")))


@query(f"""WITH {VALUES_SQL} SELECT place AS "place_GEOID", day AS date_key, kind AS housing_type, v AS home_value FROM home_values""")
def fact_zillow_home_value(t):
    return home_value_fact(t)


@query(f"""WITH {RENTS_SQL} SELECT place AS "place_GEOID", day AS date_key, v AS rent_value FROM rents""")
def fact_zillow_rent(t):
    return rent_fact(t)


# -- facilities and health measures ------------------------------------------

# Labels of the facility types.
FACILITIES_SQL = """
    facilities AS (SELECT s_name AS facility_name, 'Street ' || s_suppkey AS street1, NULL::VARCHAR AS street2, n_name AS city, 'NC' AS state, CAST(28000 + s_nationkey AS VARCHAR) AS zip,
      CASE WHEN s_nationkey = 3 THEN 'Unknown' WHEN s_nationkey < 9 THEN 'Mecklenburg' ELSE n_name END AS county, '704' AS phone, 'http://x' AS website,
      CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS latitude, NULL::DOUBLE AS longitude, CASE n_regionkey WHEN 0 THEN 'MH' WHEN 1 THEN 'SU' WHEN 2 THEN 'OTP' WHEN 3 THEN 'HRSA' ELSE 'VA' END AS type_facility,
      CASE n_regionkey WHEN 0 THEN 'Mental Health' WHEN 1 THEN 'Substance Use' WHEN 2 THEN 'Opioid Treatment Program' WHEN 3 THEN 'HRSA Health Center' ELSE 'VA' END AS facility_type_label,
      (s_nationkey < 9 AND s_nationkey <> 3) AS is_mecklenburg FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def facilities(t):
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    near = (F.col("s_nationkey") < 9) & (F.col("s_nationkey") != 3)
    kind = F.element_at(F.array(*[F.lit(k) for k in ("MH", "SU", "OTP ", "HRSA", "VA")]), F.col("n_regionkey") + 1)
    empty = F.lit(None).cast("string")
    raw = t.supplier.join(nations, "s_nationkey").select(
        F.concat(F.col("s_name"), F.lit(" ")).alias("name1"),
        F.concat(F.lit(" Street "), F.col("s_suppkey").cast("string")).alias("street1"),
        empty.alias("street2"),
        F.col("n_name").alias("city"),
        F.lit("NC").alias("state"),
        (F.col("s_nationkey") + 28000).cast("string").alias("zip"),
        F.when(near, "Mecklenburg ").when(F.col("s_nationkey") != 3, F.col("n_name")).alias("county"),
        F.lit("704").alias("phone"),
        F.lit("http://x").alias("website"),
        s.exact("s_acctbal", 12).cast("string").alias("latitude"),
        F.lit("west").alias("longitude"),
        kind.alias("type_facility"),
        F.lit("cash").alias("payment_accepted"),
        empty.alias("services"),
    )
    return health.clean_facilities(raw)


@query(
    f"""WITH {FACILITIES_SQL} SELECT county, state, facility_type_label, type_facility, count(*) AS facility_count, is_mecklenburg
    FROM facilities GROUP BY ALL"""
)
def agg_mhsu_facility_summary(t):
    return health.facility_summary(facilities(t))


@query(f"WITH {FACILITIES_SQL} SELECT * FROM facilities")
def agg_mhsu_facility_detail(t):
    return health.facility_detail(facilities(t))


CATEGORIES = ["HLTHOUT", "HLTHSTAT", "PREVENT", "DISABLT", "RISKBEH", "SOCLNEED", "OTHER"]


@query(
    f"""
    WITH raw AS (SELECT '37' || r_regionkey AS place, CAST(2018 + day(ts) // 7 AS INTEGER) AS yr,
        list_extract(['HLTHOUT', 'HLTHSTAT', 'PREVENT', 'DISABLT', 'RISKBEH', 'SOCLNEED', 'OTHER'], CAST(user_id % 7 AS INTEGER) + 1) AS category,
        lower(c_mktsegment) || '_' || CASE WHEN hour(ts) < 8 THEN 'ageadjprv' ELSE 'crdprv' END AS col_name, max(value) AS v
      FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      WHERE hour(ts) < 16 GROUP BY 1, 2, 3, 4)
    SELECT CASE category WHEN 'HLTHOUT' THEN 'fact_health_outcomes_town' WHEN 'HLTHSTAT' THEN 'fact_health_status_town'
        WHEN 'PREVENT' THEN 'fact_prevention_town' WHEN 'DISABLT' THEN 'fact_disability_town'
        WHEN 'RISKBEH' THEN 'fact_risk_behaviors_town' ELSE 'fact_social_needs_town' END AS table_name, col_name AS column_name, count(*) AS cells, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM raw WHERE category <> 'OTHER' GROUP BY 1, 2"""
)
def agg_town_cdc_measures(t):
    """Category tables of health measures; other value types and categories drop out."""
    people = customer_towns(t).withColumnRenamed("o_custkey", "user_id")
    slot = (F.col("user_id") % len(CATEGORIES) + 1).cast("int")
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), slot).alias("category")
    hour = F.hour("ts")
    kind = F.when(hour < 8, "AgeAdjPrv").when(hour < 16, "CrdPrv").otherwise("Other").alias("kind")
    per_user = t.events.groupBy(
        "user_id", category, kind, F.floor(F.dayofmonth("ts") / 7).cast("int").alias("week")
    ).agg(F.max("value").alias("value"))
    grouped = per_user.join(people, "user_id").groupBy("r_name", "c_mktsegment", "category", "kind", "week")
    named = grouped.agg(F.max("value").alias("value")).join(towns(t), F.col("r_name") == F.col("town_name"))
    blank = F.lit("x")
    raw = named.select(
        (F.col("week") + 2018).cast("string").alias("Year"),
        F.lit("NC").alias("StateAbbr"),
        F.col("town_name").alias("LocationName"),
        F.col("place_GEOID").alias("LocationID"),
        blank.alias("DataSource"),
        F.col("category").alias("CategoryID"),
        F.col("c_mktsegment").alias("MeasureID"),
        F.col("kind").alias("DataValueTypeID"),
        blank.alias("Measure"),
        blank.alias("Short_Question_Text"),
        s.exact("value", 12).cast("string").alias("Data_Value"),
        blank.alias("Low_Confidence_Limit"),
        blank.alias("High_Confidence_Limit"),
        F.lit("12,345").alias("TotalPopulation"),
    )
    facts = health.category_facts(durable(health.clean_measures(raw)), towns(t))
    parts = []
    for name, fact in facts.items():
        keys = ["place_GEOID", "town_name", "year_key"]
        long = reshape.melt_columns(fact, keys, [c for c in fact.columns if c not in keys], "column_name", "v")
        filled = long.where(F.col("v").isNotNull()).groupBy("column_name")
        parts.append(
            filled.agg(F.count(F.lit(1)).alias("cells"), F.sum(s.exact("v")).cast("double").alias("total")).select(
                F.lit(name).alias("table_name"), "column_name", "cells", "total"
            )
        )
    return reduce(DataFrame.unionByName, parts)


# -- places ------------------------------------------------------------------


@query(
    """
    SELECT DISTINCT '37119' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS "block_group_GEOID", 'Block Group ' || (c_nationkey + 1) AS block_group_name,
      substr('37119' || lpad(CAST(o_custkey AS VARCHAR), 7, '0'), 1, 11) AS "census_tract_GEOID", 'Census Tract ' || o_custkey || '.01' AS census_tract_name,
      '37119' AS "county_GEOID", 'Mecklenburg County' AS county_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'shape ' || c_custkey END AS geometry
    FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def dim_bg(t):
    """Areas that occur in the observations; a retired boundary is NULL."""
    geoid = F.concat(F.lit("37119"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("GEOID")
    name = F.concat(
        F.lit("Block Group "), (F.col("c_nationkey") + 1).cast("string"), F.lit(", Census Tract "),
        F.col("c_custkey").cast("string"), F.lit(".01, Mecklenburg County"),
    ).alias("NAME")
    used = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    observations = t.customer.join(used, "c_custkey").select(geoid, name)
    features = t.customer.where("c_mktsegment <> 'BUILDING'").select(
        geoid, F.lit("119").alias("COUNTYFP"), F.concat(F.lit("shape "), F.col("c_custkey").cast("string")).alias("geometry")
    )
    return places.block_group_dimension(observations, places.clean_block_groups(features))


@query(
    f"""
    SELECT hood AS neighborhood_name, CAST(c_custkey AS VARCHAR) AS "block_GEOID", c_name AS block_name, 'shape ' || c_custkey AS geometry
    FROM customer JOIN (VALUES {", ".join(f"('{g}', '{n}')" for n, gs in HOODS.items() for g in gs)}) m(area, hood) ON '37119' || c_nationkey = area
    WHERE c_acctbal >= 0"""
)
def agg_neighborhood_blocks(t):
    """Blocks of each neighbourhood; a shared area lists its blocks twice."""
    key = F.col("c_custkey").cast("string")
    features = t.customer.select(
        key.alias("GEOID20"),
        F.col("c_name").alias("NAME20"),
        F.when(F.col("c_acctbal") >= 0, "119").otherwise("025").alias("COUNTYFP20"),
        F.concat(F.lit("shape "), key).alias("geometry"),
    )
    blocks = places.block_dimension(places.clean_blocks(features))
    areas = t.customer.select(key.alias("block_GEOID"), F.concat(F.lit("37119"), F.col("c_nationkey").cast("string")).alias("GEOID"))
    claimed = reports.neighborhood_members(t.spark, HOODS, "GEOID")
    members = areas.join(claimed, "GEOID").select("block_GEOID", "neighborhood_name")
    return places.neighborhood_blocks(members, blocks)


DISTRICTS_OF_REGION = {"West": ["AFRICA", "AMERICA", "EUROPE"], "East": ["ASIA", "MIDDLE EAST", "EUROPE"]}


@query(
    f"""
    WITH cells AS (SELECT c_custkey % 40 AS x, c_custkey // 40 AS y, district FROM customer JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey JOIN (VALUES {", ".join(f"('{r}', '{d}')" for d, rs in DISTRICTS_OF_REGION.items() for r in rs)}) m(region, district) ON r_name = region),
    shared AS (SELECT a.district, count(*) AS n FROM cells a JOIN cells b ON a.district = b.district AND
      ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY 1)
    SELECT c.district, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - 2 * coalesce(max(s.n), 0) AS DOUBLE) AS perimeter
    FROM cells c LEFT JOIN shared s ON c.district = s.district GROUP BY 1"""
)
def agg_neighborhood_geometry(t):
    """Boundary of overlapping districts, each the union of all cells of its regions."""
    members = groups.membership(t.spark, DISTRICTS_OF_REGION, "region", "neighborhood_name")
    areas = groups.by_group(cell_shapes(t), members, "region").select("neighborhood_name", "geometry")
    boundary = places.neighborhood_boundary(areas)
    measured = geo.outline_measures(boundary, "neighborhood_name", "geometry")
    return measured.select(F.col("neighborhood_name").alias("district"), "area", "perimeter")
