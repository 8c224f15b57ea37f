"""Wide to long, long to wide, and one wide table per concept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.semantics import tolerant_double


def composite_id(*parts: Column | str) -> Column:
    """Concatenated identifier; NULL when any part is NULL."""
    return F.concat(*[F.col(p) if isinstance(p, str) else p for p in parts])


def base_code(code: Column | str) -> Column:
    """Drop the estimate/margin suffix: ``B01003_001E`` -> ``B01003_001``."""
    return F.regexp_replace(F.col(code) if isinstance(code, str) else code, "[EM]$", "")


def melt_measures(
    df: DataFrame,
    ids: Sequence[str],
    with_moe: bool = True,
    skip: Sequence[str] = ("NAME",),
) -> DataFrame:
    """Columns ``<code>E`` / ``<code>M`` to rows (ids, variable, estimate, moe).

    One generator over an array of structs: no shuffle, no join between the two
    measures, and empty cells stay as rows.
    """
    codes = [c[:-1] for c in df.columns if c.endswith("E") and c not in skip]

    def cell(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("double")
        return tolerant_double(F.col(name).cast("string"))

    none = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(code).alias("variable"),
            cell(f"{code}E").alias("estimate"),
            (cell(f"{code}M") if with_moe else none).alias("moe"),
        )
        for code in codes
    ]
    return df.select(*ids, F.inline(F.array(*rows)))


def melt_columns(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], label: str, value: str
) -> DataFrame:
    """Plain unpivot of same-typed columns; empty cells stay as rows."""
    return df.unpivot(list(ids), list(columns), label, value)


def distinct_labels(df: DataFrame, label: str) -> list[str]:
    """Sorted labels that actually occur; the only data the driver needs to name columns.

    Spark's own ``pivotMaxValues`` is the bound: more labels than that is a
    modelling error, and is reported instead of being cut off.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(label).where(F.col(label).isNotNull()).distinct().limit(bound + 1).collect()
    if len(found) > bound:
        raise ValueError(f"{label} has more than {bound} distinct values; it cannot name columns")
    return sorted(row[0] for row in found)


def pick_columns(
    df: DataFrame,
    keys: Sequence[str],
    cells: Mapping[str, Column],
    measures: Mapping[str, str],
) -> DataFrame:
    """One row per key; one column per (measure, cell), by conditional maxima.

    ``cells`` maps an output name to the condition that selects its rows and
    ``measures`` maps a value column to the suffix of its output columns.  All
    columns of the first measure come first.  The maxima combine on the map
    side, so the single shuffle moves at most one partial row per key and task
    however hot a key is, and repeated cells give the same answer in every run.
    """
    picks = [
        F.max(F.when(condition, F.col(value))).alias(f"{name}{suffix}")
        for value, suffix in measures.items()
        for name, condition in cells.items()
    ]
    return df.groupBy(*keys).agg(*picks)


#: Output columns up to which conditional maxima beat a pivot.  Their work per
#: input row grows with the columns, and past 100 fields Spark stops compiling
#: the stage; a pivot costs one more shuffle but the same work for any width.
NARROW = 80


def widen(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    cells: Mapping[str, Sequence[str]],
    measures: Mapping[str, str],
) -> DataFrame:
    """Long to wide: one row per key, one column per (measure, cell).

    ``cells`` maps an output name to the label values it collects, ``measures`` a
    value column to the suffix of its output columns; the columns of the first
    measure come first.  A key stays when any of its rows carries a listed label.
    """
    listed = [v for values in cells.values() for v in values]
    rows = df.where(F.col(label).isin(listed))
    if len(cells) * len(measures) <= NARROW:
        conditions = {name: F.col(label).isin(list(values)) for name, values in cells.items()}
        return pick_columns(rows, keys, conditions, measures)
    wide = pivoted(rows, keys, label, listed, {value: F.max(value) for value in measures})
    columns = [
        _largest([cell(v, value) for v in values]).alias(f"{name}{suffix}")
        for value, suffix in measures.items()
        for name, values in cells.items()
    ]
    return wide.select(*keys, *columns)


def pivoted(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    values: Sequence[str],
    aggregates: Mapping[str, Column],
) -> DataFrame:
    """Spark's pivot over known labels; ``cell`` addresses its columns."""
    named = [agg.alias(name) for name, agg in aggregates.items()]
    wide = df.groupBy(*keys).pivot(label, list(values)).agg(*named)
    if len(named) == 1:
        (only,) = aggregates
        renamed = [F.col(f"`{v}`").alias(f"{v}_{only}") for v in values]
        wide = wide.select(*keys, *renamed)
    return wide


def cell(value: str, aggregate: str) -> Column:
    return F.col(f"`{value}_{aggregate}`")


def _largest(columns: Sequence[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def pivot_labels(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    measures: Mapping[str, str],
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Long to wide on a label column; labels are discovered when not given."""
    chosen = distinct_labels(df, label) if labels is None else list(labels)
    return widen(df, keys, label, {v: [v] for v in chosen}, measures)


def role_columns(
    df: DataFrame,
    keys: Sequence[str],
    role: str,
    roles: Mapping[str, str],
    measures: Mapping[str, str],
) -> DataFrame:
    """Columns per role of one long fact, e.g. reading/math/science side by side.

    Replaces one filtered self-join per role by one aggregation.  ``roles`` maps
    a role value to a column prefix and ``measures`` a value column to a suffix.
    """
    return widen(df, keys, role, {prefix: [value] for value, prefix in roles.items()}, measures)


@dataclass(frozen=True)
class FanOut:
    """Wide tables by name, the names that had nothing to show, and the shared labels by table."""

    tables: dict[str, DataFrame]
    skipped: list[str] = field(default_factory=list)
    shared_labels: dict[str, list[str]] = field(default_factory=dict)


def fan_out(
    observations: DataFrame,
    crosswalk: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str] | None = None,
    code: str = "variable",
    stage_to: str | None = None,
) -> FanOut:
    """One wide table per concept, as decided by a variable crosswalk.

    ``crosswalk`` has (code, label, table_name) for the vintage that names the
    columns.  Only the codes that occur are collected - a subset of the variable
    dictionary, and no more than ``pivotMaxValues`` a table - because they become
    column names.  Codes of one table that share a label keep a column each,
    ``<label>_<code>``, and are listed in ``shared_labels``.  Each table is then a
    filter on its own codes plus one conditional aggregation; the crosswalk is never
    joined to the observations.  With ``stage_to`` the observations are first
    written once, partitioned by table, so every table reads only its own folder.
    """
    measures = measures or {"estimate": "", "moe": "_moe"}
    columns, skipped, shared = _planned(observations, crosswalk, code)
    source = observations
    if stage_to is not None:
        source = _staged(observations, columns, code, stage_to)
    tables = {}
    for table, cells in columns.items():
        rows = source if stage_to is None else source.where(F.col("table_name") == table)
        tables[table] = widen(rows, keys, code, cells, measures)
    return FanOut(tables, skipped, shared)


def _planned(
    observations: DataFrame, crosswalk: DataFrame, code: str
) -> tuple[dict[str, dict[str, list[str]]], list[str], dict[str, list[str]]]:
    """Columns by table (name -> its one code), tables without rows, and shared labels by table."""
    named = crosswalk.where(F.col("table_name").isNotNull())
    occurring = observations.select(code).distinct()
    present = (
        named.join(occurring, code, "left_semi").select(code, "label", "table_name").distinct()
    )
    labelled: dict[str, dict[str, list[str]]] = {}
    for row in present.collect():
        labelled.setdefault(row["table_name"], {}).setdefault(row["label"], []).append(row[code])
    wanted = [r[0] for r in named.select("table_name").distinct().collect()]
    bound = int(observations.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    columns, shared = {}, {}
    for table in sorted(labelled):
        columns[table], twice = _column_names(labelled[table])
        if twice:
            shared[table] = twice
        if len(columns[table]) > bound:
            raise ValueError(f"{table} has more than {bound} columns")
    return columns, sorted(set(wanted) - set(columns)), shared


def fan_out_at_once(
    observations: DataFrame,
    crosswalk: DataFrame,
    keys: Sequence[str],
    path: str,
    measures: Mapping[str, str] | None = None,
    code: str = "variable",
) -> FanOut:
    """``fan_out`` by one aggregation and one write, however many concepts there are.

    A code becomes its table and its place among the columns of that table; one pivot on
    the place, keyed by (table, ``keys``), makes every wide row, and one write puts each
    table into a folder of its own under ``path``.  A table is then a projection of its
    folder that gives the places their names; nothing runs for it until it is read.
    """
    measures = measures or {"estimate": "", "moe": "_moe"}
    columns, skipped, shared = _planned(observations, crosswalk, code)
    spark = observations.sparkSession
    places = [(codes[0], table, n) for table, cells in columns.items() for n, codes in enumerate(cells.values())]
    if not places:
        return FanOut({}, skipped, shared)
    # As many rows as the driver holds to name the columns.
    placed = F.broadcast(spark.createDataFrame(places, f"{code} string, table_name string, __place int"))
    width = max(map(len, columns.values()))
    tagged = observations.join(placed, code)
    wide = pivoted(tagged, ["table_name", *keys], "__place", list(range(width)), {value: F.max(value) for value in measures})
    wide.hint("rebalance", "table_name").write.mode("overwrite").partitionBy("table_name").parquet(path)
    stored = spark.read.schema(wide.schema).parquet(path)
    tables = {}
    for table, cells in columns.items():
        rows = stored.where(F.col("table_name") == table)
        named = [cell(str(n), value).alias(f"{name}{suffix}") for value, suffix in measures.items() for n, name in enumerate(cells)]
        tables[table] = rows.select(*keys, *named)
    return FanOut(tables, skipped, shared)


def _column_names(labels: Mapping[str, list[str]]) -> tuple[dict[str, list[str]], list[str]]:
    """Column name -> its one code, sorted, and the labels that several codes share."""
    named, shared = {}, []
    for label, codes in labels.items():
        if len(codes) > 1:
            shared.append(label)
        for one in codes:
            name = label if len(codes) == 1 else f"{label}_{one.lower()}"
            if name in named:
                raise ValueError(f"column name {name} stands for two variables")
            named[name] = [one]
    return dict(sorted(named.items())), sorted(shared)


def _staged(
    observations: DataFrame, columns: Mapping[str, Mapping[str, list[str]]], code: str, path: str
) -> DataFrame:
    """Observations with their table name, written once, one folder per table.

    The table of a code is read from a literal map of the codes already collected, so hot
    codes are not brought together for a join; rebalancing on the table before the write
    gives each folder few files and splits a hot table.
    """
    tables = {c: table for table, cells in columns.items() for codes in cells.values() for c in codes}
    if not tables:
        return observations.limit(0).withColumn("table_name", F.lit(None).cast("string"))
    listed = F.create_map(*[F.lit(part) for pair in sorted(tables.items()) for part in pair])
    tagged = observations.where(F.col(code).isin(sorted(tables))).withColumn("table_name", listed[F.col(code)])
    spread = tagged.hint("rebalance", "table_name")
    spread.write.mode("overwrite").partitionBy("table_name").parquet(path)
    return observations.sparkSession.read.parquet(path)
