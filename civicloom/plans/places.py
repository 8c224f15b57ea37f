"""Small areas, blocks, counties and neighbourhood boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.functions.parse import area_hierarchy
from civicloom.operators import geo, groups, joins

COUNTY_CODE = "119"


def clean_block_groups(features: DataFrame, county: str = COUNTY_CODE) -> DataFrame:
    """(GEOID, COUNTYFP, geometry) features to the block groups of one county."""
    return features.where(F.col("COUNTYFP") == county).select(
        F.col("GEOID").alias("block_group_GEOID"), F.col("geometry").alias("geometry_geojson")
    )


def clean_blocks(features: DataFrame, county: str = COUNTY_CODE) -> DataFrame:
    return features.where(F.col("COUNTYFP20") == county).select(
        F.col("GEOID20").alias("block_GEOID"),
        F.col("NAME20").alias("block_name"),
        F.col("geometry").alias("geometry_geojson"),
    )


def block_group_dimension(
    observations: DataFrame, shapes: DataFrame, county: str = "Mecklenburg County"
) -> DataFrame:
    """Block groups that occur, their tract and county, and their boundary if not retired."""
    areas = observations.select("GEOID", "NAME").distinct()
    parsed = areas.select(*area_hierarchy("GEOID", "NAME", county)).distinct()
    joined = joins.attach(parsed, shapes, "block_group_GEOID", "left")
    return joined.withColumnRenamed("geometry_geojson", "geometry")


def block_dimension(blocks: DataFrame) -> DataFrame:
    return blocks.withColumnRenamed("geometry_geojson", "geometry")


def neighborhood_blocks(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block_GEOID, neighborhood_name) members with name and boundary."""
    joined = groups.by_group(blocks, members, "block_GEOID")
    return joined.select("neighborhood_name", "block_GEOID", "block_name", "geometry")


def neighborhood_boundary(areas: DataFrame) -> DataFrame:
    """One boundary per neighbourhood from (neighborhood_name, geometry) areas."""
    return geo.dissolve(areas, "neighborhood_name", "geometry")
