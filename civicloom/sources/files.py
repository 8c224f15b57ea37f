"""Delimited text read as text; typing happens in the cleaning step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from civicloom.functions.names import normalize_names
from civicloom.sources.quoted import read_quoted_csv


def read_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """CSV with a header row and the given columns, all strings.

    The schema is declared, so no pass over the data infers it; files split
    across tasks.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


def read_csv_text(
    spark: SparkSession, path: str | list[str], line_breaks: bool = False
) -> DataFrame:
    """CSV of unknown header as strings under normalised column names.

    ``line_breaks`` admits quoted line breaks in headers and cells.
    """
    if line_breaks:
        return read_quoted_csv(spark, path)
    options = {"header": True, "quote": '"', "escape": '"'}
    header = spark.read.csv(path, inferSchema=False, **options).schema
    # Every file's header is held against the first one's: another order is an error.
    raw = spark.read.csv(path, schema=header, enforceSchema=False, **options)
    return raw.toDF(*normalize_names(raw.columns))
