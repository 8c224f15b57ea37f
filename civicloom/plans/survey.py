"""Survey observations: requested variables, cleaning, crosswalk and concept facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicloom.functions import names
from civicloom.functions.semantics import NOT_ESTIMATED, first_match, null_if_sentinel
from civicloom.operators import joins, reshape
from civicloom.operators.reshape import FanOut
from civicloom.sources import payloads

# Names of the reporting towns inside place names.
TOWN_RULES = [("%davidson%", "Davidson"), ("%cornelius%", "Cornelius"), ("%huntersville%", "Huntersville")]
TOWN_PLACES = "davidson town|cornelius town|huntersville town"

GEO_PARTS = {"block group": ["state", "county", "tract", "block group"], "place": ["state", "place"]}


def read_requested(spark: SparkSession, path: str) -> DataFrame:
    """Requested codes, one per line of a text file: (variable, kind).

    Blank lines and lines that start with ``#`` are left out; a code named twice counts once.
    """
    code = F.trim("value")
    named = spark.read.text(path).select(code.alias("variable"))
    wanted = named.where((F.col("variable") != "") & ~F.col("variable").startswith("#")).distinct()
    return wanted.withColumn("kind", payloads.table_kind("variable"))


def missing_variables(
    requested: DataFrame, dictionaries: DataFrame, geographies: Sequence[str] = tuple(GEO_PARTS)
) -> DataFrame:
    """(geography, year, variable): requested codes that a year's dictionary lacks.

    ``dictionaries`` is (year, name).  Subject codes are not asked for at block groups.
    The requested list is joined once with the codes of all years, one row per code.
    """
    estimates = dictionaries.where(F.col("name").endswith("E"))
    coded = estimates.select("year", F.expr("substring(name, 1, length(name) - 1)").alias("variable"))
    listed = coded.groupBy("variable").agg(F.collect_set("year").alias("__listed"))
    every = dictionaries.select(F.collect_set("year")).scalar()
    absent = F.array_except(every, F.coalesce("__listed", F.array().cast("array<int>")))
    found = requested.join(listed, "variable", "left").select("variable", F.explode(absent).alias("year"))
    parts = [
        payloads.published_at(found, geography).select(F.lit(geography).alias("geography"), "year", "variable")
        for geography in geographies
    ]
    return reduce(DataFrame.unionByName, parts)


def listed_observations(
    observations: DataFrame, requested: DataFrame, dictionaries: DataFrame, geography: str
) -> DataFrame:
    """Observations of requested codes that the dictionary of their vintage lists.

    ``dictionaries`` is (year, name); subject codes are not asked for at block groups.  The
    wanted codes are a few thousand rows, whatever the number of areas.
    """
    asked = payloads.published_at(requested, geography).select("variable")
    coded = dictionaries.where(F.col("name").endswith("E")).select(
        F.col("year").alias("vintage_year"), F.expr("substring(name, 1, length(name) - 1)").alias("variable")
    )
    wanted = coded.join(asked, "variable", "left_semi").distinct()
    return observations.join(wanted, ["vintage_year", "variable"], "left_semi").select(observations.columns)


def read_landed(spark: SparkSession, path: str, geography: str) -> DataFrame:
    """Landed responses of one geography to raw tidy observations.

    Subject tables are published without margins here, so theirs is NULL even where the
    response names one; block groups have no subject tables, so such rows do not land.
    """
    landed = payloads.read_payloads(spark, path).withColumn(
        "vintage_year", payloads.vintage_from_path("path")
    )
    tidy = payloads.tidy_observations(landed, "body", GEO_PARTS[geography], ["vintage_year"])
    moe = F.when(payloads.table_kind("variable") == "detailed", F.col("moe")).alias("moe")
    landed = payloads.published_at(tidy, geography)
    return landed.select("GEOID", "NAME", "variable", "estimate", moe, "vintage_year")


def read_dictionaries(spark: SparkSession, path: str) -> DataFrame:
    """Landed variable dictionaries to (year, name, label, concept)."""
    landed = payloads.read_payloads(spark, path).withColumn(
        "year", payloads.vintage_from_path("path")
    )
    return payloads.dictionary_rows(landed, "body", ["year"])


def clean_observations(
    raw: DataFrame, sentinels: Sequence[float] = (NOT_ESTIMATED,), places: str | None = None
) -> DataFrame:
    """Typed observations without sentinels, optionally only matching place names."""
    kept = raw if places is None else raw.where(F.lower("NAME").rlike(places))
    return kept.select(
        "GEOID",
        F.trim("NAME").alias("NAME"),
        reshape.base_code("variable").alias("variable"),
        F.col("vintage_year").cast("int").alias("vintage_year"),
        null_if_sentinel(F.col("estimate").cast("double"), sentinels).alias("estimate"),
        null_if_sentinel(F.col("moe").cast("double"), sentinels).alias("moe"),
    )


def crosswalk(metadata: DataFrame, observations: Sequence[DataFrame]) -> DataFrame:
    """Column and table name of every estimate variable that occurs in the observations.

    Concepts are cut to a bounded title; two concepts of one year whose titles then name
    one table are an error, as their columns would be mixed up.
    """
    used = reduce(DataFrame.union, [df.select("variable") for df in observations]).distinct()
    estimates = metadata.where(F.col("name").endswith("E") & ~F.col("name").isin("for", "in"))
    coded = estimates.withColumn("variable", F.regexp_replace("name", "E$", ""))
    title = names.concept_title("concept")
    named = coded.join(used, "variable", "left_semi").select(
        "year",
        "name",
        "variable",
        names.label_slug("label").alias("label_clean"),
        title.alias("concept"),
        names.table_slug(title).alias("table_name"),
        names.table_slug(names.concept_title("concept", None)).alias("__whole"),
    )
    same = Window.partitionBy("year", "table_name")
    clash = F.min("__whole").over(same) != F.max("__whole").over(same)
    why = F.concat(F.lit("different concepts share the table name "), "table_name")
    checked = F.when(clash, F.raise_error(why).cast("string")).otherwise(F.col("table_name"))
    return named.withColumn("table_name", checked).drop("__whole")


def concept_facts(
    observations: DataFrame, cross: DataFrame, geo_key: str, stage_to: str | None = None
) -> FanOut:
    """One wide fact per concept of the newest dictionary vintage, keyed (geo, year).

    With ``stage_to`` all of them are made and written there at once.
    """
    naming = joins.latest_only(cross, "year").select(
        "variable", F.col("label_clean").alias("label"), "table_name"
    )
    keyed = observations.select(
        F.col("GEOID").alias(geo_key),
        F.col("vintage_year").alias("year_key"),
        "variable",
        "estimate",
        "moe",
    )
    keys = [geo_key, "year_key"]
    return reshape.fan_out(keyed, naming, keys) if stage_to is None else reshape.fan_out_at_once(keyed, naming, keys, stage_to)


def town_dimension(place_observations: DataFrame) -> DataFrame:
    """Place identifiers with their standard town name."""
    town = first_match("NAME", TOWN_RULES, "Other")
    return place_observations.select(
        F.col("GEOID").alias("place_GEOID"), town.alias("town_name")
    ).distinct()
