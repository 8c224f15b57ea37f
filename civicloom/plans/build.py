"""Run the warehouse: land, clean, model, report - layer by layer.

Every step reads the stored tables of the step before and writes its own, so no plan
grows across layers.  A run that is started again lands, cleans and models anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.operators import model
from civicloom.plans import health, housing, places, reports, schools, survey
from civicloom.plans.layers import Warehouse
from civicloom.session import scratch_path
from civicloom.sources import boundaries, files, relations

# Columns of the landed CSV files, by bronze table.
CSV_COLUMNS = {
    "zillow_home_values": ["town", "housing_type", "date", "home_value"],
    "zillow_rents": ["RegionName", "date", "rent_index"],
    "alice_household": ["town", "year", *housing.HOUSEHOLD_COUNTS],
    "alice_county": ["county", "year", *housing.HOUSEHOLD_COUNTS],
    "ami_affordability_gap": [
        "bedrooms", "household_size", "ami_level", "annual_income", "max_affordable_rent", "fmr", "monthly_gap",
    ],
    "housing_wage": ["occupation", "hourly_wage", "employment", "category"],
    "rent_by_bedroom": ["region", "year", "bedrooms", "fmr"],
    "mh_su_facilities": [
        "name1", "street1", "street2", "city", "state", "zip", "county", "phone", "website",
        "latitude", "longitude", "type_facility", "payment_accepted", "services",
    ],
    "cdc_places": [
        "Year", "StateAbbr", "LocationName", "LocationID", "DataSource", "CategoryID", "MeasureID",
        "DataValueTypeID", "Measure", "Short_Question_Text", "Data_Value", "Low_Confidence_Limit",
        "High_Confidence_Limit", "TotalPopulation",
    ],
}

# Headers of these files hold line breaks and punctuation; names are normalised.
SCHOOL_FILES = (
    "school_combined_test_results",
    "school_growth",
    "school_other_hs_indicators",
    "school_assess_ind_master",
    "school_eog_eoc",
    "school_act_grade11",
    "school_workkeys",
    "school_english_learner",
    "school_subject_code_format",
    "school_subgroup_format",
)

# Survey responses and dictionaries (JSON) and boundary features (one per line).
SURVEY_INPUTS = {"acs_blockgroup": "block group", "acs_place": "place"}
BOUNDARY_INPUTS = {
    "bg_geometry": {"GEOID": "GEOID", "COUNTYFP": "COUNTYFP"},
    "block_geometry": {"GEOID20": "GEOID20", "NAME20": "NAME20", "COUNTYFP20": "COUNTYFP20"},
}

CALENDAR = ("1990-01-01", "2050-12-31")
COUNTIES = [("37119", "Mecklenburg County")]


def land(house: Warehouse, inputs: Mapping[str, str]) -> list[str]:
    """Bronze: raw files to tables of text.  ``inputs`` maps bronze names to paths."""
    spark = house.spark
    tables = {}
    for name, path in inputs.items():
        if name in CSV_COLUMNS:
            raw = files.read_csv(spark, path, CSV_COLUMNS[name])
        elif name in SCHOOL_FILES:
            raw = files.read_csv_text(spark, path, line_breaks=True)
        elif name in SURVEY_INPUTS:
            raw = survey.read_landed(spark, path, SURVEY_INPUTS[name])
        elif name == "acs_requested":
            raw = survey.read_requested(spark, path)
        elif name == "acs_metadata":
            raw = survey.read_dictionaries(spark, path)
        elif name in BOUNDARY_INPUTS:
            raw = boundaries.read_features(spark, path, BOUNDARY_INPUTS[name])
        else:
            raise ValueError(f"unknown input {name}")
        tables[name] = raw
    return house.replace_all("bronze", tables)


SILVER = {
    "zillow_zhvi": ("zillow_home_values", housing.clean_home_values),
    "zillow_zori": ("zillow_rents", housing.clean_rents),
    "alice_town_household": ("alice_household", housing.clean_town_hardship),
    "alice_county": ("alice_county", housing.clean_county_hardship),
    "ami_affordability_gap": ("ami_affordability_gap", housing.clean_affordability),
    "charlotte_housing_wage": ("housing_wage", housing.clean_wages),
    "charlotte_rent_by_bedroom": ("rent_by_bedroom", housing.clean_market_rents),
    "mh_su_facilities_clean": ("mh_su_facilities", health.clean_facilities),
    "cdc_places": ("cdc_places", health.clean_measures),
    "bg_geometry": ("bg_geometry", places.clean_block_groups),
    "block_geometry": ("block_geometry", places.clean_blocks),
    "school_combined_test_results": ("school_combined_test_results", schools.clean_results),
    "school_growth": ("school_growth", schools.clean_growth),
    "school_other_hs_indicators": ("school_other_hs_indicators", schools.clean_high_school),
    "school_assess_ind_master": ("school_assess_ind_master", schools.clean_master),
    "school_eog_eoc": ("school_eog_eoc", schools.clean_subjects),
    "school_act_grade11": ("school_act_grade11", schools.clean_act),
    "school_workkeys": ("school_workkeys", schools.clean_workkeys),
    "school_english_learner": ("school_english_learner", schools.clean_learners),
    "school_subject_code_format": (
        "school_subject_code_format",
        lambda raw: schools.clean_code_list(raw, "subject_code", "description"),
    ),
    "school_subgroup_format": (
        "school_subgroup_format",
        lambda raw: schools.clean_code_list(raw, "subgroup_code", "subgroup_label"),
    ),
}


def clean(house: Warehouse) -> None:
    """Silver: typed tables, long observations and the variable crosswalk."""
    house.replace_all(
        "silver", {name: step(house.table("bronze", source)) for name, (source, step) in SILVER.items()}
    )
    raw = {name: house.table("bronze", name) for name in SURVEY_INPUTS}
    if "acs_requested" in house.tables("bronze"):
        asked, listed = house.table("bronze", "acs_requested"), house.table("bronze", "acs_metadata")
        raw = {name: survey.listed_observations(df, asked, listed, SURVEY_INPUTS[name]) for name, df in raw.items()}
    block_groups = survey.clean_observations(raw["acs_blockgroup"])
    towns = survey.clean_observations(raw["acs_place"], places=survey.TOWN_PLACES)
    # Sorted by variable, a report's codes are few row groups of a file.
    stored = [
        house.replace("silver", name, df, sort_by=["variable"], partition_by=["vintage_year"])
        for name, df in (("acs_bg", block_groups), ("acs_place", towns))
    ]
    cross = survey.crosswalk(house.table("bronze", "acs_metadata"), stored)
    house.replace("silver", "variable_crosswalk", cross)
    if "acs_requested" in house.tables("bronze"):
        asked, listed = house.table("bronze", "acs_requested"), house.table("bronze", "acs_metadata")
        house.replace("silver", "variables_missing", survey.missing_variables(asked, listed))


def _dimensions(house: Warehouse) -> None:
    def silver(name: str) -> DataFrame:
        return house.table("silver", name)

    dates = house.replace("gold", "dim_date", relations.calendar(house.spark, *CALENDAR))
    house.replace("gold", "dim_year", relations.years_of(dates))
    towns = house.replace("gold", "dim_town", survey.town_dimension(silver("acs_place")))
    columns = {"county_GEOID": "string", "county_name": "string"}
    counties = relations.literal(house.spark, COUNTIES, columns)
    gap, wages, rents = (
        silver(n) for n in ("ami_affordability_gap", "charlotte_housing_wage", "charlotte_rent_by_bedroom")
    )
    master = silver("school_assess_ind_master")
    scopes = silver("school_combined_test_results"), silver("school_eog_eoc")
    house.replace_all(
        "gold",
        {
            "dim_bg": places.block_group_dimension(silver("acs_bg"), silver("bg_geometry")),
            "dim_block": places.block_dimension(silver("block_geometry")),
            "dim_county": counties.where("false"),
            "dim_region": housing.region_dimension(rents),
            "dim_bedrooms": housing.bedroom_dimension(gap),
            "dim_ami_level": housing.income_level_dimension(gap),
            "dim_occupation": housing.occupation_dimension(wages),
            "dim_school": schools.school_dimension(master, towns),
            "dim_subgroup": schools.subgroup_dimension(master, silver("school_subgroup_format")),
            "dim_subject_code": schools.subject_dimension(master, silver("school_subject_code_format")),
            "dim_grade_scope": schools.scope_dimension(*scopes),
            "dim_act_measure": schools.act_dimension(silver("school_act_grade11")),
        },
    )
    house.insert("gold", "dim_county", counties, ["county_GEOID"])


SCHOOL_FACT_SOURCES = {
    "fact_school_test_results": "school_combined_test_results",
    "fact_school_growth": "school_growth",
    "fact_school_hs_indicators": "school_other_hs_indicators",
    "fact_school_eog_eoc": "school_eog_eoc",
    "fact_school_act": "school_act_grade11",
    "fact_school_workkeys": "school_workkeys",
    "fact_school_english_learner": "school_english_learner",
}


def missing_variables(house: Warehouse) -> list[str]:
    """Requested variables a dictionary lacks, as ``geography/year/variable``.

    At most one line per requested code, dictionary year and geography.
    """
    if "variables_missing" not in house.tables("silver"):
        return []
    lines = house.table("silver", "variables_missing").select(F.concat_ws("/", "geography", "year", "variable"))
    return sorted(row[0] for row in lines.collect())


class BrokenKeys(ValueError):
    """Keys of a star schema that repeat, hold a NULL or point nowhere."""


def model_star(house: Warehouse) -> tuple[list[str], list[str]]:
    """Gold: dimensions, fixed facts and one fact per concept and geography.

    Returns the concepts that had no rows and the labels that stand for several
    variables, so none disappears unnoticed.  The layer is built as a draft, its keys are
    checked, and only then is it published; if anything fails, the old layer stays.
    """
    draft = house.draft("gold")
    try:
        made = _star(draft)
        if broken := integrity(draft):
            raise BrokenKeys(f"gold is not published: {broken[:20]}")
    except BaseException:
        draft.discard("gold")
        raise
    draft.publish("gold")
    return made


def _star(house: Warehouse) -> tuple[list[str], list[str]]:
    _dimensions(house)

    def silver(name: str) -> DataFrame:
        return house.table("silver", name)

    def gold(name: str) -> DataFrame:
        return house.table("gold", name)

    skipped, shared = [], []
    cross = silver("variable_crosswalk")
    for source, suffix, key in (("acs_bg", "bg", "block_group_GEOID"), ("acs_place", "town", "place_GEOID")):
        stage = scratch_path(house.spark, f"staged-{suffix}")
        made = survey.concept_facts(silver(source), cross, key, stage_to=stage)
        tables = {f"{name}_{suffix}": fact for name, fact in made.tables.items()}
        house.replace_all("gold", tables, keys=dict.fromkeys(tables, [key, "year_key"]))
        skipped += [f"{name}_{suffix}" for name in made.skipped]
        shared += [f"{name}_{suffix}.{label}" for name, labels in made.shared_labels.items() for label in labels]

    towns, regions, bedrooms = gold("dim_town"), gold("dim_region"), gold("dim_bedrooms")
    gap, wages = silver("ami_affordability_gap"), silver("charlotte_housing_wage")
    facts = {
        "fact_zillow_home_value": housing.home_value_fact(silver("zillow_zhvi"), towns),
        "fact_zillow_rent": housing.rent_fact(silver("zillow_zori"), towns),
        "fact_alice_town_household": housing.town_hardship_fact(silver("alice_town_household"), towns),
        "fact_alice_county": housing.county_hardship_fact(silver("alice_county")),
        "fact_fair_market_rent": housing.market_rent_fact(silver("charlotte_rent_by_bedroom"), regions, bedrooms),
        "fact_ami_affordability_gap": housing.affordability_fact(gap, regions, bedrooms, gold("dim_ami_level")),
        "fact_occupation_housing_wage": housing.wage_fact(wages, regions, gold("dim_occupation")),
        "fact_mh_su_facilities": silver("mh_su_facilities_clean"),
        "cdc_places": silver("cdc_places"),
        **health.category_facts(silver("cdc_places"), towns),
        "fact_school_assessment_master": schools.master_fact(silver("school_assess_ind_master")),
    }
    for name, source in SCHOOL_FACT_SOURCES.items():
        facts[name] = schools.school_fact(name, silver(source))
    house.replace_all("gold", facts, keys=FACT_KEYS)
    return skipped, shared


def report(house: Warehouse) -> list[str]:
    """Main: every report table."""

    def gold(name: str) -> DataFrame:
        return house.table("gold", name)

    spark = house.spark
    towns, regions, bedrooms = gold("dim_town"), gold("dim_region"), gold("dim_bedrooms")
    newest = house.table("silver", "variable_crosswalk")
    newest = newest.where(F.col("year") == newest.select(F.max("year")).scalar()).select("variable").distinct()
    town_rows = house.table("silver", "acs_place").join(newest, "variable", "left_semi")
    block_rows = house.table("silver", "acs_bg").join(newest, "variable", "left_semi")

    tables = {name: reports.town_report(name, town_rows, towns) for name in reports.TOWN_REPORTS}
    members = reports.neighborhood_members(spark, reports.NEIGHBORHOOD_BLOCK_GROUPS, "GEOID")
    for name in reports.NEIGHBORHOOD_REPORTS:
        tables[name] = reports.neighborhood_report(name, block_rows, members)

    values, rents = gold("fact_zillow_home_value"), gold("fact_zillow_rent")
    market = gold("fact_fair_market_rent")
    facilities = gold("fact_mh_su_facilities")
    levels = gold("dim_ami_level")
    tables |= {
        "agg_town_alice_household": housing.town_hardship(gold("fact_alice_town_household"), towns),
        "agg_county_alice_household": housing.county_hardship(gold("fact_alice_county"), gold("dim_county")),
        "agg_town_home_value_trends": housing.home_value_trends(values, towns),
        "agg_town_rent_trends": housing.rent_trends(rents, towns),
        "zillow_market_affordability_index": housing.market_affordability(town_rows, values, rents, towns),
        "agg_mhsu_facility_summary": health.facility_summary(facilities),
        "agg_mhsu_facility_detail": health.facility_detail(facilities),
        "agg_charlotte_fair_market_rent": housing.market_rents(market, regions, bedrooms),
        "agg_charlotte_ami_affordability_gap": housing.affordability_gap(
            gold("fact_ami_affordability_gap"), market, regions, bedrooms, levels
        ),
        "agg_charlotte_occupation_housing_wage": housing.occupation_wages(
            gold("fact_occupation_housing_wage"), regions, gold("dim_occupation")
        ),
    }
    present = set(house.tables("gold"))
    for fact, name in health.CATEGORY_REPORTS.items():
        if fact in present:
            tables[name] = gold(fact)

    blocks = reports.neighborhood_members(spark, reports.NEIGHBORHOOD_BLOCKS, "block_GEOID")
    tables["agg_neighborhood_blocks"] = places.neighborhood_blocks(
        blocks.select("block_GEOID", "neighborhood_name"), gold("dim_block")
    )
    tables["agg_neighborhood_geometry_block"] = places.neighborhood_boundary(tables["agg_neighborhood_blocks"])
    areas = gold("dim_bg").join(members.withColumnRenamed("GEOID", "block_group_GEOID"), "block_group_GEOID")
    tables["agg_neighborhood_blockgroup_geometry"] = places.neighborhood_boundary(
        areas.where(F.col("geometry").isNotNull()).select("neighborhood_name", "geometry")
    )

    school_facts = {n: gold(n) for n in (*SCHOOL_FACT_SOURCES, "fact_school_assessment_master")}
    tables |= schools.reports(school_facts, gold("dim_school"), gold("dim_subgroup"))
    orders = {name: reports.stored_order(name, df.columns) for name, df in tables.items()}
    return house.replace_all("main", tables, orders=orders)


# Keys of the star schema, and the dimension each key column points to.
DIMENSION_KEYS = {
    "dim_date": "date_key", "dim_year": "year_key", "dim_bg": "block_group_GEOID",
    "dim_block": "block_GEOID", "dim_town": "place_GEOID", "dim_county": "county_GEOID",
    "dim_region": "region_key", "dim_bedrooms": "bedroom_key", "dim_ami_level": "ami_level_key",
    "dim_occupation": "occupation_key", "dim_school": "school_code", "dim_subgroup": "subgroup_code",
    "dim_subject_code": "subject_code", "dim_grade_scope": "grade_scope", "dim_act_measure": "act_measure",
}
FACT_KEYS = {
    "fact_zillow_home_value": ["place_GEOID", "date_key", "housing_type"],
    "fact_zillow_rent": ["place_GEOID", "date_key"],
    "fact_alice_town_household": ["place_GEOID", "year_key"],
    "fact_alice_county": ["county_GEOID", "year_key"],
    "fact_fair_market_rent": ["region_key", "year_key", "bedroom_key"],
    "fact_ami_affordability_gap": ["region_key", "year_key", "bedroom_key", "ami_level_key"],
    "fact_occupation_housing_wage": ["region_key", "year_key", "occupation_key"],
    "fact_school_test_results": ["school_code", "year_key", "subgroup_code", "grade_scope"],
    "fact_school_growth": ["school_code", "year_key", "subgroup_code", "growth_type"],
    "fact_school_hs_indicators": ["school_code", "year_key", "subgroup_code"],
    "fact_school_assessment_master": ["school_code", "year_key", "subgroup_code", "subject_code"],
    "fact_school_eog_eoc": ["school_code", "year_key", "subgroup_code", "original_subject_label"],
    "fact_school_act": ["school_code", "year_key", "subgroup_code", "act_measure"],
    "fact_school_workkeys": ["school_code", "year_key", "subgroup_code"],
    "fact_school_english_learner": ["school_code", "year_key", "subgroup_code"],
}


def _fact_key(house: Warehouse, table: str) -> list[str] | None:
    if table in FACT_KEYS:
        return FACT_KEYS[table]
    columns = house.table("gold", table).columns
    for geo_key in ("place_GEOID", "block_group_GEOID"):
        if table.startswith("fact_") and geo_key in columns and "year_key" in columns:
            return [geo_key, "year_key"]
    return None


def broken_keys(house: Warehouse, table: str) -> DataFrame | None:
    """Key problems of one gold table: (table_name, key, problem, broken_keys), or None.

    Keys that repeat or hold a NULL, and key values their dimension lacks.
    """
    df = house.table("gold", table)
    key = [DIMENSION_KEYS[table]] if table in DIMENSION_KEYS else _fact_key(house, table)
    if key is None:
        return None
    found = []
    if ("gold", table) not in house.key_checks:  # else counted while it was written
        found = [(", ".join(key), model.key_violations(df, key), F.col("problem"))]
    if table not in DIMENSION_KEYS:
        dimensions = {column: name for name, column in DIMENSION_KEYS.items()}
        for column in (c for c in df.columns if c in dimensions):
            missing = model.orphan_keys(df, house.table("gold", dimensions[column]), [column])
            found.append((column, missing, F.lit("missing in dimension")))
    counted = [
        problems.groupBy(F.lit(name).alias("key"), problem.alias("problem")).agg(
            F.count(F.lit(1)).alias("broken_keys")
        )
        for name, problems, problem in found
    ]
    if not counted:
        return None
    return reduce(DataFrame.unionByName, counted).select(F.lit(table).alias("table_name"), "*")


def integrity(house: Warehouse) -> list[tuple]:
    """(table, key, problem, broken keys) of the whole star schema.

    Spark does not enforce keys; this is what a constraint would refuse.  Each
    table gives at most two rows per key, so only those reach the driver.
    """

    def check(table: str) -> list[tuple]:
        problems = broken_keys(house, table)
        seen = house.key_checks.get(("gold", table), {})
        names = {"repeated": "duplicate key", "null": "null key"}
        written = [(table, ", ".join(_fact_key(house, table)), names[k], n) for k, n in seen.items() if n]
        return written + ([] if problems is None else [tuple(row) for row in problems.collect()])

    with ThreadPoolExecutor(house.writers) as pool:
        return sorted(row for rows in pool.map(check, house.tables("gold")) for row in rows)


def run(house: Warehouse, inputs: Mapping[str, str]) -> dict[str, list[str]]:
    """The whole warehouse, in order: table names by layer, and what was asked for but not found.

    ``missing_variables`` needs the input ``acs_requested``, a text file of variable codes.
    """
    made = {"bronze": land(house, inputs)}
    clean(house)
    made["missing_variables"] = missing_variables(house)
    made["skipped_concepts"], made["shared_labels"] = model_star(house)
    made["main"] = report(house)
    return made | {"silver": house.tables("silver"), "gold": house.tables("gold")}
