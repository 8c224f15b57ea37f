"""Indicators: bracket totals, rates, gaps, trends and yearly means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicloom.functions.semantics import (
    difference,
    ieee_ratio,
    nulls_last,
    round_binary,
    safe_ratio,
)
from civicloom.operators.reshape import NARROW, cell, pivoted, widen
from civicloom.session import durable


def lines(table: str, *numbers: int) -> tuple[str, ...]:
    """Variable codes of one published table: ``lines("B19001", 2, 3)``."""
    return tuple(f"{table}_{n:03d}" for n in numbers)


@dataclass(frozen=True)
class Measure:
    """An output column: a total of variables, optionally over another total."""

    name: str
    top: tuple[str, ...]
    bottom: tuple[str, ...] = ()
    scale: float = 1.0
    digits: int | None = None
    guarded: bool = True

    @property
    def codes(self) -> set[str]:
        return set(self.top) | set(self.bottom)

    def column(self) -> Column:
        total = _added(self.top)
        if not self.bottom:
            return total.alias(self.name)
        base = _added(self.bottom)
        ratio = safe_ratio(total, base) if self.guarded else ieee_ratio(total, base)
        if self.scale != 1.0:
            ratio = ratio * F.lit(self.scale)
        return (ratio if self.digits is None else round_binary(ratio, self.digits)).alias(self.name)


def _added(codes: Sequence[str]) -> Column:
    """Sum of variables, NULL when one is; one expression text keeps long sums cheap to build."""
    return F.expr(" + ".join(f"`{c}`" for c in codes))


def total(name: str, *codes: str) -> Measure:
    return Measure(name, tuple(codes))


def percent(
    name: str, top: Sequence[str], bottom: Sequence[str], digits: int = 2, guarded: bool = True
) -> Measure:
    return Measure(name, tuple(top), tuple(bottom), 100.0, digits, guarded)


def ratio(
    name: str, top: Sequence[str], bottom: Sequence[str], digits: int, guarded: bool = True
) -> Measure:
    return Measure(name, tuple(top), tuple(bottom), 1.0, digits, guarded)


def table_of(code: Column | str) -> Column:
    """Published table of a variable: ``B01003_001`` -> ``B01003``."""
    return F.substring_index(F.col(code) if isinstance(code, str) else code, "_", 1)


def indicators(
    observations: DataFrame,
    measures: Sequence[Measure],
    requires: Sequence[str],
    geo: str,
    year: str,
) -> DataFrame:
    """A report table straight from long observations.

    Equivalent to widening every published table in ``requires`` and inner
    joining them on (geo, year), then computing ``measures``; but the rows are
    read once and shuffled once.  An area and year missing from any required
    table is left out, as the joins would.
    """
    # Prefixes, unlike a computed table name, reach the Parquet reader.
    own = reduce(or_, [F.col("variable").startswith(f"{t}_") for t in requires])
    wanted = observations.where(own)
    codes = sorted({c for m in measures for c in m.codes})
    outside = sorted({c.split("_")[0] for c in codes} - set(requires))
    if outside:
        raise ValueError(f"measures use tables that are not required: {outside}")
    seen = {t: f"__has_{t}" for t in requires}
    if len(codes) <= NARROW:
        flags = [F.expr(f"max(startswith(variable, '{t}_')) AS `{f}`") for t, f in seen.items()]
        picks = [F.expr(f"max(CASE WHEN variable = '{c}' THEN estimate END) AS `{c}`") for c in codes]
        wide = wanted.groupBy(geo, year).agg(*picks, *flags)
    else:
        wide = _many_codes(wanted, codes, seen, geo, year)
    for flag in seen.values():
        wide = wide.where(F.col(flag))
    return wide.select(geo, year, *[m.column() for m in measures])


def _many_codes(
    rows: DataFrame, codes: Sequence[str], seen: Mapping[str, str], geo: str, year: str
) -> DataFrame:
    """Estimates by code and presence by table through a pivot.

    A code the measures do not use counts only as a sign of its table.
    """
    used = F.col("variable").isin(list(codes))
    slot = F.when(used, F.col("variable")).otherwise(table_of("variable"))
    wide = pivoted(
        rows.withColumn("__slot", slot),
        [geo, year],
        "__slot",
        [*codes, *seen],
        {"top": F.max("estimate"), "n": F.count(F.lit(1))},
    )
    signs = {t: [t, *[c for c in codes if c.split("_")[0] == t]] for t in seen}
    return wide.select(
        geo,
        year,
        *[cell(c, "top").alias(c) for c in codes],
        *[
            F.coalesce(*[cell(s, "n") for s in signs[t]]).isNotNull().alias(f)
            for t, f in seen.items()
        ],
    )


def gap_wide(
    df: DataFrame,
    keys: Sequence[str],
    role: str,
    value: str,
    low: tuple[str, str],
    high: tuple[str, str],
    gap: str = "gap",
    digits: int = 1,
) -> DataFrame:
    """Two role values side by side and their difference (high minus low).

    ``low`` and ``high`` are (role value, output name).  Keys lacking either
    value are left out.
    """
    pair = widen(df, keys, role, {name: [which] for which, name in (low, high)}, {value: ""})
    both = pair.where(F.col(low[1]).isNotNull() & F.col(high[1]).isNotNull())
    return both.withColumn(gap, difference(high[1], low[1], digits))


def gap_long(
    df: DataFrame,
    keys: Sequence[str],
    role: str,
    value: str,
    baseline: tuple[str, str],
    others: Sequence[str],
    comparison: str = "comparison_pct",
    gap: str = "gap",
    digits: int = 1,
) -> DataFrame:
    """One row per (key, other role) with the baseline value and the gap to it.

    One aggregation over the fact instead of joining two filtered copies.  A
    row needs both roles to be present; their values may be NULL.  ``df`` holds
    at most one row per (key, role).
    """
    kept = df.where(F.col(role).isin(baseline[0], *others))
    picks = []
    for which in (baseline[0], *others):
        at = F.col(role) == F.lit(which)
        picks.append(
            F.struct(
                F.max(F.when(at, True)).alias("here"), F.max(F.when(at, F.col(value))).alias("v")
            ).alias(f"__{which}")
        )
    wide = kept.groupBy(*keys).agg(*picks).where(F.col(f"`__{baseline[0]}`.here"))
    rows = F.array(
        *[
            F.struct(
                F.lit(o).alias(role),
                F.col(f"`__{o}`.here").alias("__here"),
                F.col(f"`__{o}`.v").alias(comparison),
            )
            for o in others
        ]
    )
    long = wide.select(*keys, F.col(f"`__{baseline[0]}`.v").alias(baseline[1]), F.inline(rows))
    return (
        long.where("__here")
        .drop("__here")
        .withColumn(gap, difference(baseline[1], comparison, digits))
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str
) -> DataFrame:
    """Value of the preceding period of the same series.

    For series at calendar grain - at most one row per key and day - where a
    series can never be longer than the calendar.  Finer series go through
    ``previous_event``.
    """
    series = Window.partitionBy(*keys).orderBy(*[F.col(order).asc_nulls_last()])
    return df.withColumn(name, F.lag(value).over(series))


def previous_event(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """``previous_value`` for series with any number of rows per key.

    Rows are range partitioned on key and order, sorted and materialised once, so a hot
    key is spread over as many partitions as its rows need.  Inside a partition the
    previous row is the one before; the first row of a partition takes the last row of
    the partition before it, from a table of one row per partition.  A NULL key is a
    series like any other and a NULL in ``order`` sorts last.  ``order`` must identify
    a row within a key.
    """
    sort = nulls_last(*keys, *order)
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # monotonically_increasing_id packs (partition, row in partition).
    placed = durable(ranged.withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    row = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(value).alias("v"))
    inside = Window.partitionBy("__part").orderBy("__at")
    marked = placed.withColumn("__lag", F.lag(row).over(inside))
    tails = placed.groupBy("__part").agg(F.max_by(row, "__at").alias("__tail"))
    # One row per partition: this window and the broadcast are bounded by the partition count.
    carried = tails.select("__part", F.lag("__tail").over(Window.orderBy("__part")).alias("__carry"))
    joined = marked.join(F.broadcast(carried), "__part", "left")
    before = F.coalesce("__lag", "__carry")
    same = reduce(and_, [F.col(k).eqNullSafe(before[f"k{i}"]) for i, k in enumerate(keys)])
    # Without a row before, every part of it is NULL, and so is the value.
    return joined.select(*df.columns, F.when(same, before["v"]).alias(name))


def yearly_mean(
    df: DataFrame, keys: Sequence[str], day: str, value: str, name: str, year: str = "year"
) -> DataFrame:
    """Mean per key and calendar year, NULLs ignored."""
    return df.groupBy(*keys, F.year(day).alias(year)).agg(F.avg(value).alias(name))


def with_yearly(
    base: DataFrame, means: Sequence[DataFrame], keys: Sequence[str]
) -> DataFrame:
    """Left join yearly means to a base table on (keys, year); base rows always stay."""
    joined = base
    for mean in means:
        joined = joined.join(mean, list(keys), "left")
    return joined

