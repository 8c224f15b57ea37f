"""Clean tables and school facts one by one, on raw text made of lines, orders and people.

The SQL is written out: it shares no map or list with the plans, so a wrong code or a
column taken from the wrong place cannot agree with it.
"""

from pyspark.sql import functions as F

from civicloom.plans import health, housing, places, schools
from civicloom.queries.registry import query

WORDINGS = ["All Students", "Not Economically Disadvantaged", "All English Learners", "English Learner", "Two or More Races", "Nobody"]
WORDING_SQL = """CASE l_partkey % 6 WHEN 0 THEN 'All Students' WHEN 1 THEN 'Not Economically Disadvantaged' WHEN 2 THEN 'All English Learners'
      WHEN 3 THEN 'English Learner' WHEN 4 THEN 'Two or More Races' ELSE 'Nobody' END"""
CODE_SQL = "CASE l_partkey % 6 WHEN 0 THEN 'ALL' WHEN 1 THEN 'NEDS' WHEN 2 THEN 'ELS' WHEN 3 THEN 'ELS' WHEN 4 THEN 'MULT' END"


def picked(labels, index):
    return F.element_at(F.array(*[F.lit(v) for v in labels]), (index + 1).cast("int"))


def figure(k):
    """Every fourth figure is starred, every fourth is cut off at 95."""
    turn = (F.col("l_linenumber") + k) % 4
    return F.when(turn == 0, "*").when(turn == 1, ">95").otherwise((F.col("l_quantity") + k).cast("int").cast("string"))


def figure_sql(k):
    return f"CASE (l_linenumber + {k}) % 4 WHEN 0 THEN '*' WHEN 1 THEN '>95' ELSE CAST(CAST(l_quantity + {k} AS INTEGER) AS VARCHAR) END"


def number_sql(k):
    return f"CASE WHEN (l_linenumber + {k}) % 4 > 1 THEN CAST(CAST(l_quantity + {k} AS INTEGER) AS DOUBLE) END"


def identity():
    key = F.col("l_suppkey").cast("string")
    return [
        F.concat(F.lit(" S"), key).alias("school_code"),
        F.concat(F.lit("School "), key, F.lit(" ")).alias("school_name"),
        F.concat(F.lit(" District "), F.col("l_linestatus")).alias("district_name"),
        F.lit(" K-12").alias("grade_span"),
        picked(WORDINGS, F.col("l_partkey") % 6).alias("subgroup"),
    ]


IDENTITY_SQL = f"""'S' || l_suppkey AS school_code, 'School ' || l_suppkey AS school_name, 'District ' || l_linestatus AS district_name,
      'K-12' AS grade_span, {WORDING_SQL} AS subgroup"""
FACT_SQL = f"'S' || l_suppkey AS school_code, 2025 AS year_key, {CODE_SQL} AS subgroup_code"


def pair_sql(k, raw, number):
    return f"{figure_sql(k)} AS {raw}, {number_sql(k)} AS {number}"


# -- results by grade scope --------------------------------------------------

SCOPE_SQL = """CASE l_linenumber WHEN 1 THEN 'All' WHEN 2 THEN '3-8' WHEN 3 THEN '9-12' WHEN 4 THEN '3' WHEN 5 THEN '8' END"""


def raw_results(t):
    labels = ["All Subjects", "Grade 3-8", "Grade 9-12", "Grade 3", "Grade 8", "Grade 2", "unknown"]
    return t.lineitem.select(
        *identity(),
        F.concat(picked(labels, F.col("l_linenumber") - 1), F.lit(" ")).alias("subject"),
        figure(0).alias("percent_level_3_and_above_glp"),
        figure(1).alias("percent_level_4_and_above_ccr"),
        F.when(F.col("l_returnflag") == "R", "NA").otherwise(F.col("l_linenumber").cast("string")).alias("number_of_days_missed_due_to_hurricane_helene"),
    )


@query(
    f"""SELECT {IDENTITY_SQL}, {SCOPE_SQL} AS grade_scope, {pair_sql(0, "glp_raw", "glp_pct")}, {pair_sql(1, "ccr_raw", "ccr_pct")},
      CASE WHEN l_returnflag <> 'R' THEN CAST(l_linenumber AS INTEGER) END AS missed_days_helene FROM lineitem"""
)
def clean_school_results(t):
    return schools.clean_results(raw_results(t))


@query(f"SELECT {FACT_SQL}, {SCOPE_SQL} AS grade_scope, {pair_sql(0, 'glp_raw', 'glp_pct')}, {pair_sql(1, 'ccr_raw', 'ccr_pct')} FROM lineitem")
def fact_school_test_results(t):
    return schools.school_fact("fact_school_test_results", schools.clean_results(raw_results(t)))


# -- growth ------------------------------------------------------------------


def raw_growth(t):
    return t.lineitem.select(
        *identity(),
        F.concat(F.lit(" "), F.col("l_returnflag")).alias("school_growth_type"),
        F.concat(F.col("l_linestatus"), F.lit(" ")).alias("school_growth_status"),
        figure(2).alias("school_growth_index_score"),
    )


GROWTH_SQL = f"l_returnflag AS growth_type, l_linestatus AS growth_status, {number_sql(2)} AS growth_index_score FROM lineitem"


@query(f"SELECT {IDENTITY_SQL}, {GROWTH_SQL}")
def clean_school_growth(t):
    return schools.clean_growth(raw_growth(t))


@query(f"SELECT {FACT_SQL}, {GROWTH_SQL}")
def fact_school_growth(t):
    return schools.school_fact("fact_school_growth", schools.clean_growth(raw_growth(t)))


# -- high-school indicators --------------------------------------------------


def raw_high_school(t):
    names = ["actworkkeys_assessments_indicator_percent", "passing_nc_math_3_percent", "fouryear_cohort_graduation_rate_percent", "fiveyear_cohort_graduation_rate_percent"]
    return t.lineitem.select(*identity(), *[figure(k).alias(n) for k, n in enumerate(names)])


HIGH_SCHOOL_SQL = ", ".join(
    pair_sql(k, f"{n}_raw", f"{n}_pct") for k, n in enumerate(("act_workkeys_indicator", "passing_math3", "grad_4yr", "grad_5yr"))
)


@query(f"SELECT {IDENTITY_SQL}, {HIGH_SCHOOL_SQL} FROM lineitem")
def clean_school_hs_indicators(t):
    return schools.clean_high_school(raw_high_school(t))


@query(f"SELECT {FACT_SQL}, {HIGH_SCHOOL_SQL} FROM lineitem")
def fact_school_hs_indicators(t):
    return schools.school_fact("fact_school_hs_indicators", schools.clean_high_school(raw_high_school(t)))


# -- the master data set -----------------------------------------------------


def raw_master(t):
    figures = ["total_pct", "notprof_pct", "lev3_pct", "lev4_pct", "lev5_pct", "glp_pct", "ccr_pct"]
    return t.lineitem.select(
        F.concat(F.lit("20"), F.lpad((F.col("l_linenumber") + 20).cast("string"), 2, "0")).alias("reporting_year"),
        *identity()[:2],
        F.concat(F.lit(" District "), F.col("l_linestatus")).alias("lea_name"),
        F.lit(" K-12").alias("grade_span"),
        figure(9).alias("missed_days"),
        F.when(F.col("l_returnflag") == "R", " Y").when(F.col("l_returnflag") == "N", "N").alias("title_1"),
        F.concat(F.col("l_returnflag"), F.lit(" ")).alias("subgroup"),
        F.concat(F.lit(" M"), F.col("l_linenumber").cast("string")).alias("subject"),
        figure(8).alias("den"),
        *[figure(k).alias(n) for k, n in enumerate(figures)],
    )


MASTER_SQL = f"""{number_sql(0)} AS total_pct, {number_sql(1)} AS notprof_pct, {number_sql(2)} AS lev3_pct, {number_sql(3)} AS lev4_pct, {number_sql(4)} AS lev5_pct,
      {number_sql(5)} AS glp_pct, {number_sql(6)} AS ccr_pct"""
TITLE_SQL = "CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS is_title_1"


@query(
    f"""SELECT CAST(2020 + l_linenumber AS INTEGER) AS reporting_year, 'S' || l_suppkey AS school_code, 'School ' || l_suppkey AS school_name,
      'District ' || l_linestatus AS district_name, 'K-12' AS grade_span, CAST({number_sql(9)} AS INTEGER) AS missed_days_helene, {TITLE_SQL},
      l_returnflag AS subgroup_code, 'M' || l_linenumber AS subject_code, CAST({number_sql(8)} AS INTEGER) AS denominator,
      {figure_sql(0)} AS total_pct_raw, {figure_sql(5)} AS glp_pct_raw, {figure_sql(6)} AS ccr_pct_raw, {MASTER_SQL} FROM lineitem"""
)
def clean_school_master(t):
    return schools.clean_master(raw_master(t))


@query(
    f"""SELECT 'S' || l_suppkey AS school_code, CAST(2020 + l_linenumber AS INTEGER) AS year_key, l_returnflag AS subgroup_code, 'M' || l_linenumber AS subject_code,
      {TITLE_SQL}, CAST({number_sql(8)} AS INTEGER) AS denominator, {MASTER_SQL} FROM lineitem"""
)
def fact_school_assessment_master(t):
    return schools.master_fact(schools.clean_master(raw_master(t)))


# -- results by subject ------------------------------------------------------


def raw_subjects(t):
    labels = ["Biology", "NC Math 1 (9-12)", "Reading Grade 3-8", "Math Grade 8", "Science Grade 5&8", "English II", "Art"]
    return t.lineitem.select(
        *identity(),
        F.concat(F.lit(" "), picked(labels, F.col("l_linenumber") - 1)).alias("subject"),
        *[figure(k).alias(n) for k, n in enumerate(("not_proficient", "percent_level_3", "percent_level_4", "percent_level_5", "percent_level_3_and_above_glp", "percent_level_4_and_above_ccr"))],
    )


SUBJECT_SQL = """CASE l_linenumber WHEN 1 THEN 'Science' WHEN 2 THEN 'Math' WHEN 3 THEN 'Reading' WHEN 4 THEN 'Math' WHEN 5 THEN 'Science' WHEN 6 THEN 'English' END AS subject_area,
      CASE l_linenumber WHEN 1 THEN 'EOC (9-12)' WHEN 2 THEN 'EOC (9-12)' WHEN 3 THEN '3-8' WHEN 4 THEN '8' WHEN 5 THEN '5&8' WHEN 6 THEN 'EOC (9-12)' END AS grade_scope,
      CASE l_linenumber WHEN 1 THEN 'Biology' WHEN 2 THEN 'NC Math 1 (9-12)' WHEN 3 THEN 'Reading Grade 3-8' WHEN 4 THEN 'Math Grade 8' WHEN 5 THEN 'Science Grade 5&8'
        WHEN 6 THEN 'English II' ELSE 'Art' END AS original_subject_label"""
LEVEL_SQL = f"{number_sql(1)} AS level_3_pct, {number_sql(2)} AS level_4_pct, {number_sql(3)} AS level_5_pct"


@query(
    f"""SELECT {IDENTITY_SQL}, {SUBJECT_SQL}, {pair_sql(0, "not_proficient_raw", "not_proficient_pct")}, {LEVEL_SQL},
      {pair_sql(4, "glp_raw", "glp_pct")}, {pair_sql(5, "ccr_raw", "ccr_pct")} FROM lineitem"""
)
def clean_school_eog_eoc(t):
    return schools.clean_subjects(raw_subjects(t))


@query(f"SELECT {FACT_SQL}, {SUBJECT_SQL}, {number_sql(0)} AS not_proficient_pct, {LEVEL_SQL}, {number_sql(4)} AS glp_pct, {number_sql(5)} AS ccr_pct FROM lineitem")
def fact_school_eog_eoc(t):
    return schools.school_fact("fact_school_eog_eoc", schools.clean_subjects(raw_subjects(t)))


# -- ACT, WorkKeys and English learners --------------------------------------


def raw_act(t):
    measure = F.concat(F.lit(" ACT "), F.col("l_linenumber").cast("string"))
    return t.lineitem.select(*identity(), measure.alias("the_act_subtest_or_composite"), figure(3).alias("percent_meeting_benchmark_or_standard"))


@query(f"SELECT {IDENTITY_SQL}, 'ACT ' || l_linenumber AS act_measure, {pair_sql(3, 'pct_meeting_benchmark_raw', 'pct_meeting_benchmark')} FROM lineitem")
def clean_school_act(t):
    return schools.clean_act(raw_act(t))


@query(f"SELECT {FACT_SQL}, 'ACT ' || l_linenumber AS act_measure, {number_sql(3)} AS pct_meeting_benchmark FROM lineitem")
def fact_school_act(t):
    return schools.school_fact("fact_school_act", schools.clean_act(raw_act(t)))


def raw_workkeys(t):
    return t.lineitem.select(*identity(), figure(4).alias("percent_silver_or_higher"))


@query(f"SELECT {IDENTITY_SQL}, {pair_sql(4, 'pct_silver_or_higher_raw', 'pct_silver_or_higher')} FROM lineitem")
def clean_school_workkeys(t):
    return schools.clean_workkeys(raw_workkeys(t))


@query(f"SELECT {FACT_SQL}, {number_sql(4)} AS pct_silver_or_higher FROM lineitem")
def fact_school_workkeys(t):
    return schools.school_fact("fact_school_workkeys", schools.clean_workkeys(raw_workkeys(t)))


def raw_learners(t):
    names = ["total_el_progress_exited_plus_annual_progress", "percent_exiting_el_status", "percent_meeting_annual_progress_toward_exiting"]
    return t.lineitem.select(*identity(), *[figure(k).alias(n) for k, n in enumerate(names)])


@query(
    f"""SELECT {IDENTITY_SQL}, {pair_sql(0, "total_el_progress_raw", "total_el_progress_pct")}, {pair_sql(1, "pct_exiting_el_status_raw", "pct_exiting_el_status")},
      {pair_sql(2, "pct_meeting_annual_progress_raw", "pct_meeting_annual_progress")} FROM lineitem"""
)
def clean_school_english_learner(t):
    return schools.clean_learners(raw_learners(t))


@query(
    f"SELECT {FACT_SQL}, {number_sql(0)} AS total_el_progress_pct, {number_sql(1)} AS pct_exiting_el_status, {number_sql(2)} AS pct_meeting_annual_progress FROM lineitem"
)
def fact_school_english_learner(t):
    return schools.school_fact("fact_school_english_learner", schools.clean_learners(raw_learners(t)))


@query("SELECT 'N' || n_nationkey AS subgroup_code, n_name AS subgroup_label FROM nation")
def clean_school_subgroup_format(t):
    raw = t.nation.select(F.concat(F.lit(" N"), F.col("n_nationkey").cast("string")).alias("subgroup_code"), F.concat("n_name", F.lit("  ")).alias("subgroup_label"))
    return schools.clean_code_list(raw, "subgroup_code", "subgroup_label")


# -- housing -----------------------------------------------------------------

PRICE_SQL = "CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) END"


def raw_prices(t, town, value):
    """Days as 1998-01-31 or 1/31/98; the price of partly filled orders is not known."""
    price = F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
    long = F.col("o_orderkey") % 2 == 0
    day = F.when(long, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "M/d/yy"))
    named = F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit(" "), F.col("o_orderpriority")))
    return t.orders.select(named.alias(town), F.concat(F.col("o_orderstatus"), F.lit(" ")).alias("housing_type"), day.alias("date"), price.alias(value))


@query(
    f"""SELECT o_orderpriority AS town_name, o_orderstatus AS housing_type, CAST(o_orderdate AS DATE) AS date_key, {PRICE_SQL} AS home_value
    FROM orders WHERE o_custkey % 10 <> 0"""
)
def clean_zillow_zhvi(t):
    return housing.clean_home_values(raw_prices(t, "town", "home_value"))


@query(f"SELECT o_orderpriority AS town_name, CAST(o_orderdate AS DATE) AS date_key, {PRICE_SQL} AS rent_value FROM orders WHERE o_custkey % 10 <> 0")
def clean_zillow_zori(t):
    return housing.clean_rents(raw_prices(t, "RegionName", "rent_index"))


def raw_households(t, place):
    counts = ["total_households", "poverty_households", "alice_households", "above_alice_households"]
    named = F.when(F.col("c_nationkey") != 3, F.concat(F.col("c_name"), F.lit(" ")))
    figures = [(F.col("c_custkey") + k).cast("string").alias(n) for k, n in enumerate(counts)]
    return t.customer.select(named.alias(place), (F.col("c_nationkey") + 2000).cast("string").alias("year"), *figures)


HOUSEHOLD_SQL = """CAST(2000 + c_nationkey AS INTEGER) AS year_key, CAST(c_custkey AS INTEGER) AS total_households, CAST(c_custkey + 1 AS INTEGER) AS poverty_households,
      CAST(c_custkey + 2 AS INTEGER) AS alice_households, CAST(c_custkey + 3 AS INTEGER) AS above_alice_households FROM customer WHERE c_nationkey <> 3"""


@query(f"SELECT c_name AS town_name, {HOUSEHOLD_SQL}")
def clean_alice_town_household(t):
    return housing.clean_town_hardship(raw_households(t, "town"))


@query(f"SELECT '37119' AS \"county_GEOID\", c_name || ' County' AS county_name, {HOUSEHOLD_SQL}")
def clean_alice_county(t):
    return housing.clean_county_hardship(raw_households(t, "county"))


@query(
    """SELECT p_type AS bedrooms, (p_size % 5) * 10 || '% AMI' AS ami_level, CAST(p_size AS INTEGER) AS household_size, CAST(p_partkey AS INTEGER) AS annual_income,
      CAST(p_partkey + 1 AS INTEGER) AS max_affordable_rent, CAST(p_size * 7 AS INTEGER) AS fmr, CAST(25 - p_size AS INTEGER) AS monthly_gap,
      CASE WHEN p_size <= 25 THEN 'Affordable' ELSE 'Unaffordable' END AS affordability_status FROM part"""
)
def clean_ami_affordability_gap(t):
    figures = {"household_size": F.col("p_size"), "annual_income": F.col("p_partkey"), "max_affordable_rent": F.col("p_partkey") + 1, "fmr": F.col("p_size") * 7, "monthly_gap": 25 - F.col("p_size")}
    level = F.concat(F.lit(" "), ((F.col("p_size") % 5) * 10).cast("string"), F.lit("% AMI"))
    raw = t.part.select(F.concat("p_type", F.lit(" ")).alias("bedrooms"), level.alias("ami_level"), *[v.cast("string").alias(n) for n, v in figures.items()])
    return housing.clean_affordability(raw)


@query(
    """SELECT p_name AS occupation, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS hourly_wage, CASE WHEN p_size % 4 > 0 THEN CAST(p_size AS INTEGER) END AS employment,
      p_type AS category FROM part"""
)
def clean_charlotte_housing_wage(t):
    employed = F.when(F.col("p_size") % 4 == 0, "NA").otherwise(F.col("p_size").cast("string"))
    wage = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    raw = t.part.select(F.concat(F.lit(" "), "p_name").alias("occupation"), wage.alias("hourly_wage"), employed.alias("employment"), F.concat("p_type", F.lit(" ")).alias("category"))
    return housing.clean_wages(raw)


@query("SELECT p_brand AS region, CAST(1990 + p_size AS INTEGER) AS year_key, p_type AS bedrooms, CAST(p_partkey AS INTEGER) AS fmr FROM part")
def clean_charlotte_rent_by_bedroom(t):
    raw = t.part.select(
        F.concat("p_brand", F.lit(" ")).alias("region"), (F.col("p_size") + 1990).cast("string").alias("year"), F.concat(F.lit(" "), "p_type").alias("bedrooms"), F.col("p_partkey").cast("string").alias("fmr")
    )
    return housing.clean_market_rents(raw)


# -- health ------------------------------------------------------------------

FACILITY_SQL = """
    SELECT c_name AS facility_name, 'street ' || c_custkey AS street1, '' AS street2, c_mktsegment AS city, 'NC' AS state, CAST(28000 + c_nationkey AS VARCHAR) AS zip,
      CASE c_nationkey % 3 WHEN 0 THEN 'MECKLENBURG' WHEN 1 THEN 'Union' ELSE 'Unknown' END AS county, CAST(c_custkey AS VARCHAR) AS phone, 'w' AS website,
      CAST(c_nationkey + 0.5 AS DOUBLE) AS latitude, CASE WHEN c_nationkey <> 5 THEN CAST(-80.25 AS DOUBLE) END AS longitude,
      CASE c_nationkey % 5 WHEN 0 THEN 'MH' WHEN 1 THEN 'SU' WHEN 2 THEN 'OTP' WHEN 3 THEN 'HRSA' ELSE 'ZZ' END AS type_facility,
      CASE c_nationkey % 5 WHEN 0 THEN 'Mental Health' WHEN 1 THEN 'Substance Use' WHEN 2 THEN 'Opioid Treatment Program' WHEN 3 THEN 'HRSA Health Center' ELSE 'ZZ' END AS facility_type_label,
      'cash' AS payment_accepted, 's' AS services, c_nationkey % 3 = 0 AS is_mecklenburg
    FROM customer WHERE c_acctbal >= 0"""


@query(FACILITY_SQL)
def fact_mh_su_facilities(t):
    """Facilities as they are cleaned and kept as a fact."""
    nation, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    raw = t.customer.select(
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), "c_name")).alias("name1"),
        F.concat(F.lit("street "), key, F.lit(" ")).alias("street1"),
        F.lit(" ").alias("street2"),
        F.concat("c_mktsegment", F.lit(" ")).alias("city"),
        F.lit(" NC").alias("state"),
        (nation + 28000).alias("zip"),
        F.when(nation % 3 == 0, " MECKLENBURG").when(nation % 3 == 1, "Union ").alias("county"),
        key.alias("phone"),
        F.lit("w ").alias("website"),
        F.concat(nation.cast("string"), F.lit(".5")).alias("latitude"),
        F.when(nation == 5, "west").otherwise("-80.25").alias("longitude"),
        picked(["MH ", " SU", "OTP", "HRSA", "ZZ"], nation % 5).alias("type_facility"),
        F.lit("cash").alias("payment_accepted"),
        F.lit(" s").alias("services"),
    )
    return health.clean_facilities(raw)


@query(
    """SELECT CAST(2000 + l_linenumber AS INTEGER) AS year_key, 'NC' AS state_abbr, 'Town ' || l_suppkey AS town_name, CAST(3700000 + l_suppkey AS VARCHAR) AS "place_GEOID",
      'B' AS data_source, l_linestatus AS category_id, 'M_' || l_returnflag AS measure_id, CASE WHEN l_partkey % 3 = 0 THEN 'AgeAdjPrv' ELSE 'CrdPrv' END AS data_value_type_id,
      'measure' AS measure_text, 'question' AS short_question_text, CAST(l_quantity AS DOUBLE) AS data_value, CAST(NULL AS DOUBLE) AS low_confidence_limit,
      CAST(l_quantity + 1 AS DOUBLE) AS high_confidence_limit, CAST(l_suppkey + 1000 AS INTEGER) AS total_population,
      'm_' || lower(l_returnflag) || '_' || CASE WHEN l_partkey % 3 = 0 THEN 'ageadjprv' ELSE 'crdprv' END AS col_name
    FROM lineitem WHERE l_partkey % 3 < 2 AND l_linenumber <> 7"""
)
def clean_cdc_places(t):
    """Prevalence rows that have a value; a population of four digits has a comma."""
    quantity, supplier = F.col("l_quantity").cast("int"), F.col("l_suppkey")
    people = F.concat(F.floor((supplier + 1000) / 1000).cast("string"), F.lit(","), F.lpad(((supplier + 1000) % 1000).cast("string"), 3, "0"))
    raw = t.lineitem.select(
        (F.col("l_linenumber") + 2000).cast("string").alias("Year"),
        F.lit("NC ").alias("StateAbbr"),
        F.concat(F.lit(" Town "), supplier.cast("string")).alias("LocationName"),
        (supplier + 3700000).alias("LocationID"),
        F.lit(" B").alias("DataSource"),
        F.concat("l_linestatus", F.lit(" ")).alias("CategoryID"),
        F.concat(F.lit("M_"), "l_returnflag").alias("MeasureID"),
        picked(["AgeAdjPrv", "CrdPrv", "Other"], F.col("l_partkey") % 3).alias("DataValueTypeID"),
        F.lit("measure ").alias("Measure"),
        F.lit(" question").alias("Short_Question_Text"),
        F.when(F.col("l_linenumber") != 7, quantity.cast("string")).alias("Data_Value"),
        F.lit("low").alias("Low_Confidence_Limit"),
        (quantity + 1).cast("string").alias("High_Confidence_Limit"),
        people.alias("TotalPopulation"),
    )
    return health.clean_measures(raw)


# -- boundaries --------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS "block_group_GEOID", 'shape ' || c_custkey AS geometry_geojson FROM customer WHERE c_nationkey = 4""")
def clean_bg_geometry(t):
    key = F.col("c_custkey").cast("string")
    county = F.when(F.col("c_nationkey") == 4, "119").otherwise("025")
    return places.clean_block_groups(t.customer.select(key.alias("GEOID"), county.alias("COUNTYFP"), F.concat(F.lit("shape "), key).alias("geometry")))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS "block_GEOID", c_name AS block_name, 'shape ' || c_custkey AS geometry_geojson FROM customer WHERE c_nationkey = 4""")
def clean_block_geometry(t):
    key = F.col("c_custkey").cast("string")
    county = F.when(F.col("c_nationkey") == 4, "119").otherwise("025")
    raw = t.customer.select(key.alias("GEOID20"), F.col("c_name").alias("NAME20"), county.alias("COUNTYFP20"), F.concat(F.lit("shape "), key).alias("geometry"))
    return places.clean_blocks(raw)
