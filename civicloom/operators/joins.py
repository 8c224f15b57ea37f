"""Joining facts, dimensions and lookups.

No join here forces a broadcast of a table whose size depends on the data: AQE
measures each side and broadcasts it when it is small.  Only relations written
out in the program (fixed size) carry a hint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_only(df: DataFrame, year: str) -> DataFrame:
    """Rows of the newest vintage, through a one-value subquery."""
    newest = df.select(F.max(year)).scalar()
    return df.where(F.col(year) == newest)


def join_facts(facts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of any number of facts on the same keys.

    Every fact is shuffled once at most: the result of each step is already
    partitioned on ``keys`` for the next one.
    """
    return reduce(lambda left, right: left.join(right, list(keys)), facts)


def attach(
    fact: DataFrame, dimension: DataFrame, on: Sequence[str] | str, how: str = "inner"
) -> DataFrame:
    """Equi join of a fact to a dimension on shared key names."""
    return fact.join(dimension, on, how)


def match_ignoring_case(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str
) -> DataFrame:
    """Inner join on text equality regardless of case."""
    key = "__folded"
    folded_right = right.withColumn(key, F.lower(right_name))
    return left.withColumn(key, F.lower(left_name)).join(folded_right, key).drop(key)


def attach_constant(
    fact: DataFrame, dimension: DataFrame, which: Column, columns: Sequence[str]
) -> DataFrame:
    """Put the one dimension row selected by ``which`` on every fact row.

    A scalar subquery: Spark checks that it is one row and no join is planned.
    No such row leaves nothing, as an inner join would.
    """
    row = dimension.where(which).select(F.struct(*columns)).scalar()
    tagged = fact.withColumn("__row", row).where(F.col("__row").isNotNull())
    return tagged.select(*fact.columns, *[F.col(f"__row.{c}").alias(c) for c in columns])


def role_join(
    base: DataFrame,
    fact: DataFrame,
    keys: Sequence[str],
    condition: Column,
    columns: Mapping[str, str],
) -> DataFrame:
    """Left join of the fact rows meeting ``condition``, renamed by ``columns``.

    The condition is applied before the join, so a base row without such a fact
    row stays, with NULLs.
    """
    chosen = fact.where(condition).select(*keys, *[F.col(c).alias(n) for c, n in columns.items()])
    return base.join(chosen, list(keys), "left")


def lookup(
    codes: DataFrame,
    reference: DataFrame,
    code: str,
    column: str,
    addendum: Mapping[str, object] | None = None,
) -> DataFrame:
    """Describe codes from a reference table, then from a fixed addendum.

    Codes known to neither keep their row with NULL.
    """
    described = codes.join(reference.select(code, column), code, "left")
    if not addendum:
        return described
    extra = F.create_map(*[F.lit(part) for pair in addendum.items() for part in pair])
    return described.withColumn(column, F.coalesce(column, F.element_at(extra, F.col(code))))


def only_members(df: DataFrame, members: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(members, on, "left_semi")


def non_members(df: DataFrame, members: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(members, on, "left_anti")
