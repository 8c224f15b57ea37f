"""Turning headers, labels and concepts into identifiers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Collection, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicloom.functions.semantics import as_column

# Words that cannot stand alone as a column name in common SQL.
RESERVED = frozenset(
    """
    all and any array as asc both by case cast check column constraint create
    cross date default desc distinct else end except exists false for foreign
    from full group having in inner intersect into is join key left like limit
    name natural not null offset on or order outer primary references right
    select set some table then time timestamp to true union unique using values
    when where window with year
    """.split()
)


def normalize_name(header: str, reserved: Collection[str] = RESERVED) -> str:
    """One raw header (accents, punctuation, line breaks) to a snake name."""
    plain = unicodedata.normalize("NFKD", header).encode("ascii", "ignore").decode()
    words = re.sub(r"\s+", "_", plain.strip().lower())
    name = re.sub(r"[^a-z0-9_]", "", words)
    if not name or name[0].isdigit() or name in reserved:
        return "_" + name
    return name


def normalize_names(headers: Iterable[str], reserved: Collection[str] = RESERVED) -> list[str]:
    """Normalise a header row; repeats get ``_1``, ``_2``, …"""
    taken: dict[str, int] = {}
    result = []
    for header in headers:
        name = normalize_name(header, reserved)
        seen = taken.get(name, 0)
        taken[name] = seen + 1
        result.append(f"{name}_{seen}" if seen else name)
    return result


def slug(text: Column | str) -> Column:
    """Lower-case words joined by single underscores."""
    joined = F.regexp_replace(F.lower(as_column(text)), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def label_slug(label: Column | str) -> Column:
    """``Estimate!!Total:!!Male:`` -> ``total_male``."""
    body = F.regexp_replace(as_column(label), "^Estimate!!", "")
    return slug(F.regexp_replace(F.regexp_replace(body, "!!", " "), ":", ""))


def concept_title(concept: Column | str, limit: int | None = 200) -> Column:
    """Concept without its inflation-adjustment note, at most ``limit`` characters."""
    note = "[(]in [0-9]{4} Inflation-Adjusted Dollars[)]"
    title = F.trim(F.regexp_replace(as_column(concept), note, ""))
    return title if limit is None else F.substring(title, 1, limit)


def table_slug(title: Column | str, prefix: str = "fact_", missing: str = "misc") -> Column:
    return F.concat(F.lit(prefix), slug(F.coalesce(as_column(title), F.lit(missing))))


def measure_column(measure: Column | str, kind: Column | str) -> Column:
    """``ARTHRITIS`` + ``AgeAdjPrv`` -> ``arthritis_ageadjprv``."""
    return F.concat(F.lower(as_column(measure)), F.lit("_"), F.lower(as_column(kind)))
