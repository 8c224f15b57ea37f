"""Reading structure out of identifiers and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicloom.functions.semantics import as_column


def _number(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def grade_bounds(scope: Column | str, everything: str = "All", exam: str = "EOC") -> list[Column]:
    """``3-8`` -> (3, 8, false), ``EOC (9-12)`` -> (9, 12, true), ``All`` -> (NULL, NULL, false)."""
    c = as_column(scope)
    low = _number(c, "([0-9]+)")
    high = F.coalesce(_number(c, "[0-9]+[-&]([0-9]+)"), low)
    bounded = c != F.lit(everything)
    return [
        F.when(bounded, low).alias("grade_min"),
        F.when(bounded, high).alias("grade_max"),
        c.contains(exam).alias("is_eoc"),
    ]


def percent_of_label(label: Column | str) -> Column:
    """``30% AMI`` -> 30."""
    return _number(as_column(label), "([0-9]+)%")


def area_hierarchy(geoid: Column | str, name: Column | str, county: str | None = None) -> list[Column]:
    """Block-group, tract and county identifiers and names from a small-area id and name.

    The county name is any ``… County`` part of the name, or only ``county`` when given.
    """
    g, n = as_column(geoid), as_column(name)
    county_pattern = f"({county})" if county else "([A-Z][A-Za-z .'-]* County)"
    return [
        g.alias("block_group_GEOID"),
        F.regexp_extract(n, "^(Block Group [0-9]+)", 1).alias("block_group_name"),
        F.substring(g, 1, 11).alias("census_tract_GEOID"),
        F.regexp_extract(n, r"(Census Tract [0-9.]+)", 1).alias("census_tract_name"),
        F.substring(g, 1, 5).alias("county_GEOID"),
        F.regexp_extract(n, county_pattern, 1).alias("county_name"),
    ]


def date_parts(day: Column | str) -> list[Column]:
    d = as_column(day)
    name = F.date_format(d, "EEEE")
    return [
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.dayofmonth(d).alias("calendar_day"),
        F.date_format(d, "MMMM").alias("month_name"),
        name.alias("day_name"),
        name.isin("Saturday", "Sunday").alias("is_weekend"),
    ]
