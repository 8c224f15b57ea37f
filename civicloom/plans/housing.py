"""Housing values, rents, household hardship and regional affordability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.parse import percent_of_label
from civicloom.functions.semantics import (
    at_least,
    round_binary,
    safe_ratio,
    strict_int,
    tolerant_double,
    tolerant_int,
)
from civicloom.operators import joins, metrics, model

REFERENCE_REGION = "Charlotte-Concord-Gastonia"
REFERENCE_YEAR = 2025
COUNTY_GEOID = "37119"
HOUSEHOLD_COUNTS = ("total_households", "poverty_households", "alice_households", "above_alice_households")


def tolerant_day(text: Column | str) -> Column:
    """``2015-01-31`` or ``1/31/15`` to a date; NULL otherwise.

    Two-digit years 69-99 belong to the last century.
    """
    c = F.col(text) if isinstance(text, str) else text
    short = F.try_to_date(c, "M/d/yy")
    short = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), short)


# -- cleaning ----------------------------------------------------------------


def clean_home_values(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("town").isNotNull()).select(
        F.trim("town").alias("town_name"),
        F.trim("housing_type").alias("housing_type"),
        tolerant_day("date").alias("date_key"),
        tolerant_double("home_value").alias("home_value"),
    )


def clean_rents(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("RegionName").isNotNull()).select(
        F.trim("RegionName").alias("town_name"),
        tolerant_day("date").alias("date_key"),
        tolerant_double("rent_index").alias("rent_value"),
    )


def clean_town_hardship(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("town").isNotNull()).select(
        F.trim("town").alias("town_name"),
        strict_int("year").alias("year_key"),
        *[strict_int(c).alias(c) for c in HOUSEHOLD_COUNTS],
    )


def clean_county_hardship(raw: DataFrame, geoid: str = COUNTY_GEOID) -> DataFrame:
    return raw.where(F.col("county").isNotNull()).select(
        F.lit(geoid).alias("county_GEOID"),
        F.concat(F.trim("county"), F.lit(" County")).alias("county_name"),
        strict_int("year").alias("year_key"),
        *[strict_int(c).alias(c) for c in HOUSEHOLD_COUNTS],
    )


def clean_affordability(raw: DataFrame) -> DataFrame:
    numbers = ("household_size", "annual_income", "max_affordable_rent", "fmr", "monthly_gap")
    typed = raw.select(
        F.trim("bedrooms").alias("bedrooms"),
        F.trim("ami_level").alias("ami_level"),
        *[strict_int(c).alias(c) for c in numbers],
    )
    status = at_least("monthly_gap", 0, "Affordable", "Unaffordable")
    return typed.withColumn("affordability_status", status)


def clean_wages(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("occupation").alias("occupation"),
        F.col("hourly_wage").cast("double").alias("hourly_wage"),
        tolerant_int("employment").alias("employment"),
        F.trim("category").alias("category"),
    )


def clean_market_rents(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("region").alias("region"),
        strict_int("year").alias("year_key"),
        F.trim("bedrooms").alias("bedrooms"),
        strict_int("fmr").alias("fmr"),
    )


# -- star schema -------------------------------------------------------------


def region_dimension(market_rents: DataFrame) -> DataFrame:
    named = market_rents.select(F.col("region").alias("region_name"))
    return model.dimension(named, ["region_name"], "region_key")


def bedroom_dimension(affordability: DataFrame) -> DataFrame:
    """Bedroom types in order of household size, the label breaking ties."""
    named = affordability.select(
        F.col("bedrooms").alias("bedroom_label"), F.col("household_size").alias("assumed_household_size")
    )
    columns = ["bedroom_label", "assumed_household_size"]
    return model.dimension(named, columns, "bedroom_key", columns[::-1])


def income_level_dimension(affordability: DataFrame) -> DataFrame:
    """Income levels in order of their percentage, not of their text."""
    named = affordability.select(
        F.col("ami_level").alias("ami_level_label"), percent_of_label("ami_level").alias("ami_pct")
    )
    columns = ["ami_level_label", "ami_pct"]
    return model.dimension(named, columns, "ami_level_key", columns[::-1])


def occupation_dimension(wages: DataFrame) -> DataFrame:
    named = wages.select(F.col("occupation").alias("occupation_name"), "category")
    return model.dimension(named, ["occupation_name", "category"], "occupation_key")


def home_value_fact(values: DataFrame, towns: DataFrame) -> DataFrame:
    joined = joins.attach(values, towns.select("place_GEOID", "town_name"), "town_name")
    return joined.select("place_GEOID", "date_key", "housing_type", "home_value")


def rent_fact(rents: DataFrame, towns: DataFrame) -> DataFrame:
    joined = joins.attach(rents, towns.select("place_GEOID", "town_name"), "town_name")
    return joined.select("place_GEOID", "date_key", "rent_value")


def town_hardship_fact(hardship: DataFrame, towns: DataFrame) -> DataFrame:
    """Town names are matched whatever their case."""
    places = towns.select("place_GEOID", F.col("town_name").alias("standard_name"))
    joined = joins.match_ignoring_case(hardship, places, "town_name", "standard_name")
    return joined.select("place_GEOID", "year_key", *HOUSEHOLD_COUNTS)


def county_hardship_fact(hardship: DataFrame) -> DataFrame:
    return hardship.select("county_GEOID", "year_key", *HOUSEHOLD_COUNTS)


def market_rent_fact(market_rents: DataFrame, regions: DataFrame, bedrooms: DataFrame) -> DataFrame:
    keyed = market_rents.withColumnsRenamed({"region": "region_name", "bedrooms": "bedroom_label"})
    joined = joins.attach(joins.attach(keyed, regions, "region_name"), bedrooms, "bedroom_label")
    return joined.select("region_key", "year_key", "bedroom_key", "fmr")


def _of_one_region(df: DataFrame, regions: DataFrame, region: str, year: int) -> DataFrame:
    """The source covers one region and one year and names neither."""
    tagged = joins.attach_constant(df, regions, F.col("region_name") == region, ["region_key"])
    return tagged.withColumn("year_key", F.lit(year))


def affordability_fact(
    affordability: DataFrame,
    regions: DataFrame,
    bedrooms: DataFrame,
    levels: DataFrame,
    region: str = REFERENCE_REGION,
    year: int = REFERENCE_YEAR,
) -> DataFrame:
    keyed = _of_one_region(affordability, regions, region, year).withColumnsRenamed(
        {"bedrooms": "bedroom_label", "ami_level": "ami_level_label"}
    )
    joined = joins.attach(joins.attach(keyed, bedrooms, "bedroom_label"), levels, "ami_level_label")
    return joined.select(
        "region_key", "year_key", "bedroom_key", "ami_level_key",
        "annual_income", "max_affordable_rent", "monthly_gap", "affordability_status",
    )


def wage_fact(
    wages: DataFrame,
    regions: DataFrame,
    occupations: DataFrame,
    region: str = REFERENCE_REGION,
    year: int = REFERENCE_YEAR,
) -> DataFrame:
    keyed = _of_one_region(wages, regions, region, year)
    keyed = keyed.withColumnRenamed("occupation", "occupation_name")
    joined = joins.attach(keyed, occupations.drop("category"), "occupation_name")
    return joined.select("region_key", "year_key", "occupation_key", "hourly_wage", "employment")


# -- reports -----------------------------------------------------------------


def town_hardship(fact: DataFrame, towns: DataFrame) -> DataFrame:
    named = towns.where(F.col("town_name") != "Other").select("place_GEOID", F.col("town_name").alias("town"))
    return joins.attach(fact, named, "place_GEOID").select(
        F.col("place_GEOID").alias("GEOID"), "town", F.col("year_key").alias("year"), *HOUSEHOLD_COUNTS
    )


def county_hardship(fact: DataFrame, counties: DataFrame) -> DataFrame:
    return joins.attach(fact, counties, "county_GEOID").select(
        F.col("county_GEOID").alias("GEOID"),
        F.col("county_name").alias("county"),
        F.col("year_key").alias("year"),
        *HOUSEHOLD_COUNTS,
    )


def home_value_trends(fact: DataFrame, towns: DataFrame) -> DataFrame:
    """Monthly values beside the month before; a series is keyed by town and day."""
    named = joins.attach(fact, towns, "place_GEOID", "left").select(
        F.col("town_name").alias("town"), F.col("date_key").alias("date"), "housing_type", "home_value"
    )
    return metrics.previous_value(named, ["town", "housing_type"], "date", "home_value", "prev_home_value")


def rent_trends(fact: DataFrame, towns: DataFrame) -> DataFrame:
    named = joins.attach(fact, towns, "place_GEOID", "left").select(
        F.col("town_name").alias("town"), F.col("date_key").alias("date"), "rent_value"
    )
    return metrics.previous_value(named, ["town"], "date", "rent_value", "prev_rent_value")


def market_affordability(
    observations: DataFrame, home_values: DataFrame, rents: DataFrame, towns: DataFrame
) -> DataFrame:
    """Yearly home values and rents beside median income, which keeps all its years."""
    income = observations.where(F.col("variable") == "B19013_001").groupBy(
        F.col("GEOID").alias("place_GEOID"), F.col("vintage_year").alias("year")
    )
    base = income.agg(F.max("estimate").alias("median_income"))
    means = [
        metrics.yearly_mean(home_values, ["place_GEOID"], "date_key", "home_value", "avg_home_val"),
        metrics.yearly_mean(rents, ["place_GEOID"], "date_key", "rent_value", "avg_rent"),
    ]
    joined = metrics.with_yearly(base, means, ["place_GEOID", "year"])
    named = joins.attach(joined, towns, "place_GEOID", "left")
    return named.select(
        F.col("town_name").alias("town"), "year", "avg_home_val", "avg_rent", "median_income",
        round_binary(safe_ratio("avg_home_val", "median_income"), 2).alias("price_to_income_ratio"),
    )


def market_rents(fact: DataFrame, regions: DataFrame, bedrooms: DataFrame) -> DataFrame:
    joined = joins.attach(joins.attach(fact, regions, "region_key"), bedrooms, "bedroom_key")
    return joined.select(
        "region_name", F.col("year_key").alias("year"), "bedroom_label", "assumed_household_size", "fmr"
    )


def affordability_gap(
    fact: DataFrame, rent: DataFrame, regions: DataFrame, bedrooms: DataFrame, levels: DataFrame
) -> DataFrame:
    """Gaps with the market rent beside them; a gap without a rent stays."""
    joined = joins.attach(fact, rent, ["region_key", "year_key", "bedroom_key"], "left")
    for dim, key in ((regions, "region_key"), (bedrooms, "bedroom_key"), (levels, "ami_level_key")):
        joined = joins.attach(joined, dim, key)
    return joined.select(
        "region_name", F.col("year_key").alias("year"), "bedroom_label", "assumed_household_size",
        "ami_level_label", "ami_pct", "annual_income", "max_affordable_rent", "fmr", "monthly_gap",
        "affordability_status",
    )


def occupation_wages(fact: DataFrame, regions: DataFrame, occupations: DataFrame) -> DataFrame:
    joined = joins.attach(joins.attach(fact, regions, "region_key"), occupations, "occupation_key")
    return joined.select(
        "region_name", F.col("year_key").alias("year"), "occupation_name", "category", "hourly_wage", "employment"
    )
