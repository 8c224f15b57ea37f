"""Groups that share members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def membership(
    spark: SparkSession, groups: Mapping[str, Sequence[object]], member: str, group: str
) -> DataFrame:
    """(member, group) rows of a map written out in the program."""
    claims = [
        F.struct(F.lit(m).alias(member), F.lit(name).alias(group))
        for name, members in groups.items()
        for m in members
    ]
    return spark.range(1).select(F.inline(F.array(*claims)))


def by_group(df: DataFrame, members: DataFrame, on: str) -> DataFrame:
    """Rows repeated once per group that claims them."""
    return df.join(members, on)


def overlap_report(members: DataFrame, member: str, group: str) -> DataFrame:
    """Members claimed by more than one group, whose values count more than once."""
    claims = members.select(member, group).distinct()
    counted = claims.groupBy(member).agg(
        F.count(F.lit(1)).alias("n_groups"), F.array_sort(F.collect_set(group)).alias("__groups")
    )
    return counted.where("n_groups > 1").select(
        member, "n_groups", F.array_join("__groups", ", ").alias("claimed_by")
    )
