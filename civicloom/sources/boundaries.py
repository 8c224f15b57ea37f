"""Boundary features: identifier, name and GeoJSON geometry text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = "properties map<string,string>, geometry string, __broken string"


def _parsed(df: DataFrame, body: str) -> DataFrame:
    """``df`` without blank lines, with the feature ``f`` and why a line is none: NULL where it is one.

    A feature has properties; its geometry may be null, as that of a retired area is.
    """
    f = F.from_json(body, FEATURE, {"columnNameOfCorruptRecord": "__broken"})
    read = df.where(F.trim(body) != "").withColumn("f", f)
    why = F.when(F.col("f.__broken").isNotNull(), "no JSON object").when(F.col("f.properties").isNull(), "no properties")
    return read.withColumn("why", why)


def features(df: DataFrame, body: str, names: Mapping[str, str]) -> DataFrame:
    """Feature text, one per row, to named properties plus ``geometry``.

    ``names`` maps a property to its output column.  Text that is no feature is an error;
    ``rejected`` lists such rows, and what ``accepted`` keeps can be read.
    """
    parsed = _parsed(df, body)
    sample = F.concat(F.lit("no feature: "), "why", F.lit(": "), F.substring(body, 1, 80))
    read = F.when(F.col("why").isNull(), F.col("f")).otherwise(F.raise_error(sample).cast(parsed.schema["f"].dataType))
    return parsed.select(read.alias("f")).select(
        *[F.col("f.properties")[p].alias(n) for p, n in names.items()],
        F.col("f.geometry").alias("geometry"),
    )


def rejected(df: DataFrame, body: str) -> DataFrame:
    """The rows whose text is no feature, with the reason as ``why``; blank lines are none."""
    return _parsed(df, body).where("why IS NOT NULL").drop("f")


def accepted(df: DataFrame, body: str) -> DataFrame:
    """The rows whose text is a feature."""
    return _parsed(df, body).where("why IS NULL").drop("f", "why")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, line): lines with their file and the first byte of the split they stand in."""
    text = spark.read.text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def read_features(
    spark: SparkSession, path: str | list[str], names: Mapping[str, str]
) -> DataFrame:
    """A file of one GeoJSON feature per line; lines split across tasks, malformed ones are an error."""
    return features(read_lines(spark, path), "line", names)


def read_rejected(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, line, why) of the lines that are no feature."""
    return rejected(read_lines(spark, path), "line")
