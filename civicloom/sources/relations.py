"""Relations that do not come from a file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.parse import date_parts


def literal(spark: SparkSession, rows: Sequence[tuple], columns: Mapping[str, str]) -> DataFrame:
    """Rows written out in the program.

    ``columns`` maps names to type names.  The rows travel as one literal array
    inside the plan; no Python task is started to produce them.
    """
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, columns.items())])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def date_spine(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Every day of a one-row (first, last) relation with its calendar parts."""
    days = bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_key")
    )
    return days.select("date_key", *date_parts("date_key"))


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Date dimension between two ISO dates."""
    days = spark.range(1).select(
        F.to_date(F.lit(first)).alias("first"), F.to_date(F.lit(last)).alias("last")
    )
    return date_spine(days)


def years_of(dates: DataFrame) -> DataFrame:
    """Year dimension of a date dimension."""
    years = dates.select(F.col("calendar_year").alias("year_key")).distinct()
    return years.withColumn("year_label", F.col("year_key").cast("string"))


def stack_vintages(frames: Mapping[int, DataFrame], tag: str = "vintage_year") -> DataFrame:
    """Frames of several years under one another, tagged with their year.

    Columns are matched by name; a column one year lacks is NULL there.
    """
    tagged = [df.withColumn(tag, F.lit(year)) for year, df in frames.items()]
    stacked = tagged[0]
    for frame in tagged[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a frame addressable from SQL text."""
    df.createOrReplaceTempView(name)
    return df
