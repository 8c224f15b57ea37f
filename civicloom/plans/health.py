"""Care facilities and community health measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.functions.names import measure_column
from civicloom.functions.semantics import (
    code_label,
    strict_int,
    strip_thousands,
    tolerant_double,
    tolerant_int,
)
from civicloom.operators import joins, reshape

# Facility type codes.
FACILITY_TYPES = {
    "MH": "Mental Health",
    "SU": "Substance Use",
    "OTP": "Opioid Treatment Program",
    "HRSA": "HRSA Health Center",
}

# Measure categories and the fact each one fills.
CATEGORY_FACTS = {
    "HLTHOUT": "fact_health_outcomes_town",
    "HLTHSTAT": "fact_health_status_town",
    "PREVENT": "fact_prevention_town",
    "DISABLT": "fact_disability_town",
    "RISKBEH": "fact_risk_behaviors_town",
    "SOCLNEED": "fact_social_needs_town",
}
CATEGORY_REPORTS = {
    "fact_health_outcomes_town": "agg_town_cdc_health_outcomes",
    "fact_health_status_town": "agg_town_cdc_health_status",
    "fact_prevention_town": "agg_town_cdc_prevention",
    "fact_disability_town": "agg_town_cdc_disability",
    "fact_risk_behaviors_town": "agg_town_cdc_risk_behaviors",
    "fact_social_needs_town": "agg_town_cdc_social_needs",
}
PREVALENCE = ("AgeAdjPrv", "CrdPrv")
HOME_COUNTY = "mecklenburg"


def clean_facilities(raw: DataFrame) -> DataFrame:
    kind = F.trim("type_facility")
    at_home = F.lower(F.trim("county")) == HOME_COUNTY
    return raw.where(F.col("name1").isNotNull()).select(
        F.trim("name1").alias("facility_name"),
        *[F.trim(c).alias(c) for c in ("street1", "street2", "city", "state")],
        F.col("zip").cast("string").alias("zip"),
        F.trim(F.coalesce("county", F.lit("Unknown"))).alias("county"),
        *[F.trim(c).alias(c) for c in ("phone", "website")],
        tolerant_double("latitude").alias("latitude"),
        tolerant_double("longitude").alias("longitude"),
        kind.alias("type_facility"),
        code_label(kind, FACILITY_TYPES, passthrough=True).alias("facility_type_label"),
        *[F.trim(c).alias(c) for c in ("payment_accepted", "services")],
        F.coalesce(at_home, F.lit(False)).alias("is_mecklenburg"),
    )


def facility_summary(facilities: DataFrame) -> DataFrame:
    return facilities.groupBy(
        "county", "state", "facility_type_label", "type_facility", "is_mecklenburg"
    ).agg(F.count(F.lit(1)).alias("facility_count"))


def facility_detail(facilities: DataFrame) -> DataFrame:
    return facilities.drop("payment_accepted", "services")


def clean_measures(raw: DataFrame) -> DataFrame:
    """Prevalence measures that have a value, with the column name they will pivot to."""
    kept = raw.where(
        F.col("LocationName").isNotNull()
        & F.col("Data_Value").isNotNull()
        & F.col("DataValueTypeID").isin(*PREVALENCE)
    )
    return kept.select(
        strict_int("Year").alias("year_key"),
        F.trim("StateAbbr").alias("state_abbr"),
        F.trim("LocationName").alias("town_name"),
        F.col("LocationID").cast("string").alias("place_GEOID"),
        F.trim("DataSource").alias("data_source"),
        F.trim("CategoryID").alias("category_id"),
        F.trim("MeasureID").alias("measure_id"),
        F.trim("DataValueTypeID").alias("data_value_type_id"),
        F.trim("Measure").alias("measure_text"),
        F.trim("Short_Question_Text").alias("short_question_text"),
        tolerant_double("Data_Value").alias("data_value"),
        tolerant_double("Low_Confidence_Limit").alias("low_confidence_limit"),
        tolerant_double("High_Confidence_Limit").alias("high_confidence_limit"),
        tolerant_int(strip_thousands("TotalPopulation")).alias("total_population"),
        measure_column("MeasureID", "DataValueTypeID").alias("col_name"),
    )


def category_facts(measures: DataFrame, towns: DataFrame) -> dict[str, DataFrame]:
    """One wide fact per measure category; every measure of the category is a column.

    The measures that occur are read once for all categories.
    """
    listed = measures.where(F.col("category_id").isin(*CATEGORY_FACTS)).select(
        F.concat_ws("/", "category_id", "col_name").alias("cell")
    )
    cells = [c.split("/", 1) for c in reshape.distinct_labels(listed, "cell")]
    named = towns.select("place_GEOID", "town_name")
    facts = {}
    for category, table in CATEGORY_FACTS.items():
        labels = [label for where, label in cells if where == category]
        if not labels:
            continue
        rows = measures.where(F.col("category_id") == category)
        wide = reshape.pivot_labels(
            rows, ["place_GEOID", "year_key"], "col_name", {"data_value": ""}, labels
        )
        joined = joins.attach(wide, named, "place_GEOID")
        facts[table] = joined.select("place_GEOID", "town_name", "year_key", *labels)
    return facts
