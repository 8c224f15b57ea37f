"""Dimensions, surrogate keys and integrity reports."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicloom.functions.semantics import nulls_last
from civicloom.session import durable


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a declared schema, in its order and types.

    A value that does not fit its declared type is an error (ANSI cast).
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def surrogate_key(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Dense keys 1..n in the order of the natural key, without a one-task window.

    Rows are range partitioned and sorted, materialised once, and numbered
    inside their partition; the offset of a partition is the row count of those
    before it.  The driver sees one count per partition and nothing else.  Equal
    to ``row_number() over (order by ...)``; ``order`` must identify a row.
    """
    keys = nulls_last(*order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id packs (partition, row in partition).
    placed = durable(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).cast("int")
    row = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.select(*df.columns, part.alias("__part"), row.alias("__row"))
    last = dict(placed.groupBy("__part").agg(F.max("__row")).collect())
    sizes = [last.get(p, -1) + 1 for p in range(max(last, default=0) + 1)]
    before = ",".join(f"{n}L" for n in accumulate([0, *sizes[:-1]]))
    offset = F.element_at(F.expr(f"array({before})"), F.col("__part") + 1)
    return placed.select((offset + F.col("__row") + 1).alias(name), *df.columns)


def dimension(
    df: DataFrame, columns: Sequence[str], key: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Distinct natural keys with a surrogate key in front."""
    return surrogate_key(df.select(*columns).distinct(), key, order or columns)


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL: (key columns, occurrences, problem)."""
    holed = F.lit(False)
    for column in key:
        holed = holed | F.col(column).isNull()
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
    problem = F.when(holed, "null key").when(F.col("occurrences") > 1, "duplicate key")
    return counted.withColumn("problem", problem).where(F.col("problem").isNotNull())


def orphan_keys(
    fact: DataFrame, dim: DataFrame, key: Sequence[str], references: Sequence[str] | None = None
) -> DataFrame:
    """Key values of a fact that its dimension lacks, with their row counts.

    The fact is reduced to one row per key value before it meets the dimension,
    so a hot key costs one row.  A key with a NULL part references nothing.
    """
    used = fact.select(*key).na.drop(subset=list(key))
    used = used.groupBy(*key).agg(F.count(F.lit(1)).alias("fact_rows"))
    target = dim.select(*[F.col(r).alias(k) for k, r in zip(key, references or key)])
    return used.join(target, list(key), "left_anti")


def missing_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """The incoming rows whose key is new, in the columns of ``existing``.

    Of several incoming rows with one key the smallest is kept, in every run.
    """
    rest = [c for c in existing.columns if c not in key]
    if rest:
        unique = incoming.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__row"))
        unique = unique.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest])
    else:
        unique = incoming.select(*key).distinct()
    fresh = unique.join(existing.select(*key), list(key), "left_anti")
    return fresh.select(*existing.columns)


def append_missing(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows plus the incoming rows whose key is new; ``Warehouse.insert`` stores only those."""
    return existing.unionByName(missing_rows(existing, incoming, key))
