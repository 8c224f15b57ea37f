"""Landed API responses: tables of observations and variable dictionaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicloom.functions.semantics import tolerant_double


def read_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row (path, body) per landed response file."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.input_file_name().alias("path"), F.col("value").alias("body"))


def vintage_from_path(path: Column | str) -> Column:
    """The four-digit year in a landing path, e.g. ``…/2023/acs5.json``.

    A path part that is a year, or ``name=year``, goes before a year inside a part, so a
    load date is not taken for the vintage.  A path without a year is an error.
    """
    c = F.col(path) if isinstance(path, str) else path
    part = F.regexp_extract(c, "(?:^|/)(?:[A-Za-z_]+=)?((?:19|20)[0-9]{2})(?:/|$)", 1)
    inside = F.regexp_extract(c, "(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    year = F.coalesce(part.try_cast("int"), inside.try_cast("int"))
    missing = c.isNotNull() & year.isNull()
    return F.when(missing, F.raise_error(F.concat(F.lit("no vintage in path "), c)).cast("int")).otherwise(year)


def _refused(body: Column | str, broken: Column, why: str):
    """A raising branch for non-blank bodies that are ``broken``; the caller adds the other."""
    c = F.col(body) if isinstance(body, str) else body
    sample = F.concat(F.lit(why + ": "), F.substring(c, 1, 80))
    return F.when(c.isNotNull() & (F.trim(c) != "") & broken, F.raise_error(sample))


def payload_rows(df: DataFrame, body: str, keep: Sequence[str] = (), layout: Callable[[Column], Column] | None = None) -> DataFrame:
    """Array-of-arrays JSON to one row per record: (keep, header, cells), both arrays of text.

    Element 0 is the header; a payload of a header only, or none, gives no rows.  A body
    that is no array of arrays - cut short, an error object - is an error, and so is a record
    that is not as long as its header.  ``layout`` of the header is worked out once per
    payload and comes as a column of that name.
    """
    parsed = df.select(*keep, F.col(body).alias("__body"), F.try_parse_json(body).alias("__v"))
    header = F.expr("try_variant_get(__v, '$[0]', 'array<string>')")
    broken = F.col("__v").isNull() | (header.isNull() & (F.to_json("__v") != "[]"))
    checked = _refused("__body", broken, "payload is no array of arrays").otherwise(F.lit(None).cast("variant"))
    table = F.coalesce(checked, F.col("__v"))
    laid = [] if layout is None else [layout(F.col("header")).alias("layout")]
    tables = parsed.select(*keep, table.alias("__v"), header.alias("header")).select(*keep, "__v", "header", *laid)
    records = tables.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__v").outer())).where("pos > 0")
    cells = F.expr("try_variant_get(value, '$', 'array<string>')")
    whole = cells.isNotNull() & (F.size(cells) == F.size("header"))
    uneven = F.raise_error(F.concat(F.lit("payload is no array of arrays: record "), F.col("pos").cast("string"))).cast("array<string>")
    return records.select(*keep, "header", *(["layout"] if laid else []), F.when(whole, cells).otherwise(uneven).alias("cells"))


def _layout(geo_parts: Sequence[str]) -> Callable[[Column], Column]:
    """Where a header keeps the parts of a GEOID, NAME and the cells of every variable."""

    def of(header: Column) -> Column:
        def at(name: Column) -> Column:
            return (F.array_position(header, name) - 1).cast("int")

        placed = F.transform(header, lambda h, k: F.struct(h.alias("h"), k.alias("at")))
        # The first of a repeated header counts.
        estimates = F.filter(placed, lambda p: p["h"].endswith("E") & (p["h"] != "NAME") & (at(p["h"]) == p["at"]))

        def variable(p: Column) -> Column:
            code = F.substring(p["h"], F.lit(1), F.length(p["h"]) - 1)
            return F.struct(code.alias("code"), p["at"].alias("e"), at(F.concat(code, F.lit("M"))).alias("m"))

        parts = F.array(*[at(F.lit(p)) for p in geo_parts])
        return F.struct(parts.alias("geo"), at(F.lit("NAME")).alias("name"), F.transform(estimates, variable).alias("variables"))

    return of


def tidy_observations(
    df: DataFrame,
    body: str,
    geo_parts: Sequence[str],
    keep: Sequence[str] = (),
    with_moe: bool = True,
) -> DataFrame:
    """Payload bodies to (keep, GEOID, NAME, variable, estimate, moe) rows.

    Every header ``<code>E`` is a variable; ``<code>M`` is its margin of error, NULL where
    absent or for tables published without margins.  The header is searched once per
    payload; a record's cells are then taken by position, so its work grows with its length.
    No shuffle and no join of the two measures.
    """
    records = payload_rows(df, body, keep, _layout(geo_parts))

    def cell(place: Column) -> Column:
        return F.get(F.col("cells"), place)

    def measured(v: Column) -> Column:
        moe = tolerant_double(cell(v["m"])) if with_moe else F.lit(None).cast("double")
        return F.struct(v["code"].alias("variable"), tolerant_double(cell(v["e"])).alias("estimate"), moe.alias("moe"))

    geoid = F.concat(*[cell(F.col("layout.geo")[k]) for k in range(len(geo_parts))])
    return records.select(*keep, geoid.alias("GEOID"), cell(F.col("layout.name")).alias("NAME"), F.inline(F.transform("layout.variables", measured)))


def dictionary_rows(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """``{"variables": {code: {label, concept}}}`` to (name, label, concept) rows.

    The query keywords ``for`` and ``in`` are not variables; a missing label or
    concept is the empty string; a body without variables, or one that names a variable
    twice, is an error.
    """
    parsed = df.select(*keep, F.col(body).alias("__body"), F.expr(f"try_variant_get(try_parse_json({body}), '$.variables', 'variant')").alias("__v"))
    object_ = F.expr("try_variant_get(__v, '$', 'map<string, variant>')").isNotNull()
    checked = _refused("__body", ~object_, "dictionary has no variables").otherwise(F.lit(None).cast("variant"))
    tables = parsed.select(*keep, F.coalesce(checked, F.col("__v")).alias("__v"))
    entries = tables.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__v").outer())).where(~F.col("key").isin("for", "in"))

    def text(field: str) -> Column:
        return F.coalesce(F.expr(f"try_variant_get(value, '$.{field}', 'string')"), F.lit(""))

    return entries.select(*keep, F.col("key").alias("name"), text("label").alias("label"), text("concept").alias("concept"))


def table_kind(code: Column | str) -> Column:
    """``subject`` for codes starting with S, ``detailed`` otherwise."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(F.upper(c).startswith("S"), "subject").otherwise("detailed")


def published_at(codes: DataFrame, geography: str, code: str = "variable") -> DataFrame:
    """Requested codes a geography can have: no subject tables for block groups."""
    if geography == "block group":
        return codes.where(table_kind(code) != "subject")
    return codes


def requested_present(
    requested: DataFrame, dictionary: DataFrame, code: str = "variable"
) -> DataFrame:
    """Requested codes whose estimate the dictionary lists."""
    listed = dictionary.where(F.col("name").endswith("E"))
    return requested.join(_codes(listed, code), code, "left_semi")


def requested_missing(
    requested: DataFrame, dictionary: DataFrame, code: str = "variable"
) -> DataFrame:
    """Requested codes the dictionary lacks, to be reported."""
    listed = dictionary.where(F.col("name").endswith("E"))
    return requested.join(_codes(listed, code), code, "left_anti")


def _codes(listed: DataFrame, code: str) -> DataFrame:
    return listed.select(F.expr("substring(name, 1, length(name) - 1)").alias(code)).distinct()
