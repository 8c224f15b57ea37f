"""Scalar rules whose edge cases decide whether two warehouses agree.

Every helper returns a plain ``Column`` built from JVM functions, so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code survey agencies publish for "could not be estimated".
NOT_ESTIMATED = -666666666


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# -- rounding and division -------------------------------------------------


def round_binary(value: Column | str, digits: int) -> Column:
    """Round the binary value of a double, half away from zero.

    ``F.round(x, 2)`` rounds the shortest decimal text of ``x`` (1.005 -> 1.01);
    the warehouse rounds the number actually stored (1.005 -> 1.0).
    """
    scale = F.lit(float(10**digits))
    return _whole(as_column(value).cast("double") * scale) / scale


def _whole(value: Column) -> Column:
    """Nearest whole double, ties away from zero; ``rint`` alone would send ties to even."""
    near = F.rint(value)
    side = F.signum(value)
    return F.when(value - near == side * F.lit(0.5), near + side).otherwise(near)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``n / d`` as double, NULL when the denominator is zero or NULL."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


def ieee_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``n / d`` as double with IEEE results: x/0 is +-Infinity and 0/0 is NaN."""
    n = as_column(numerator).cast("double")
    d = as_column(denominator).cast("double")
    at_zero = (
        F.when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .when(n == 0, F.lit(float("nan")))
    )
    return F.when(d == 0, at_zero).otherwise(F.try_divide(n, d))


def safe_percent(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """Guarded percentage: NULL on a zero denominator."""
    return round_binary(safe_ratio(numerator, denominator) * F.lit(100.0), digits)


def ieee_percent(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """Unguarded percentage: Infinity/NaN on a zero denominator."""
    return round_binary(ieee_ratio(numerator, denominator) * F.lit(100.0), digits)


def bracket_total(parts: Iterable[Column | str]) -> Column:
    """Sum of brackets; NULL as soon as one bracket is NULL."""
    return reduce(lambda left, right: left + right, [as_column(p) for p in parts])


def difference(left: Column | str, right: Column | str, digits: int = 1) -> Column:
    return round_binary(as_column(left) - as_column(right), digits)


def exact(value: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """A decimal view of a money-like double.

    Sums of doubles depend on the order tasks finish in; decimal sums do not,
    so a retried task cannot change a result.
    """
    return as_column(value).cast(f"decimal({precision},{scale})")


def units(value: Column | str, digits: int = 2) -> Column:
    """A money-like double as a whole number of its smallest units.

    Sums as exactly as ``exact`` and several times faster; for totals that stay
    below 9.2e18 units (an overflow is an error, never a wrong total).
    """
    return F.rint(as_column(value) * F.lit(float(10**digits))).cast("bigint")


def from_units(total: Column | str, digits: int = 2) -> Column:
    """A total of ``units`` back as a double."""
    return as_column(total).cast("double") / F.lit(float(10**digits))


# -- casts -----------------------------------------------------------------


def tolerant_double(text: Column | str) -> Column:
    """Text to double, NULL when it is not a number (``'>95'``, ``'NA'``, ``''``).

    The JVM parser also takes a Java type suffix (``'5d'``); that is refused.
    """
    c = as_column(text)
    suffixed = c.rlike(r"[0-9.]\s*[dDfF]\s*$")
    return F.when(~suffixed, c.try_cast("double"))


def tolerant_int(text: Column | str) -> Column:
    """Text to int, rounding a fraction (``'12.7'`` -> 13), NULL when unusable."""
    return _whole(tolerant_double(text)).try_cast("int")


def strict_int(value: Column | str) -> Column:
    """Numeric text to int, a half going away from zero; bad text is an error."""
    return _whole(as_column(value).cast("double")).cast("int")


def whole_number(value: Column | str) -> Column:
    """A double to int, a half going to the even neighbour (2.5 -> 2); text goes through ``strict_int``."""
    return F.rint(as_column(value)).cast("int")


def strip_thousands(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), ",", "")


def blank_trimmed(text: Column | str) -> Column:
    return F.trim(as_column(text))


# -- missing, suppressed and coded values ----------------------------------


def null_if_sentinel(
    value: Column | str, sentinels: Sequence[float] = (NOT_ESTIMATED,)
) -> Column:
    c = as_column(value)
    return F.when(~c.isin(list(sentinels)), c)


def raw_and_number(text: Column | str, raw_name: str, number_name: str) -> list[Column]:
    """Keep suppressed text (``>95``, ``<5``, ``*``) beside its numeric reading."""
    c = as_column(text)
    return [c.alias(raw_name), tolerant_double(c).alias(number_name)]


def is_suppressed(raw: Column | str) -> Column:
    return tolerant_double(raw).isNull()


def code_label(
    code: Column | str, labels: Mapping[str, object], passthrough: bool = False
) -> Column:
    """Look a code up in a fixed mapping.

    Unknown codes become NULL, or keep their own text with ``passthrough``.
    """
    c = as_column(code)
    literal_pairs = [F.lit(part) for pair in labels.items() for part in pair]
    found = F.element_at(F.create_map(*literal_pairs), c)
    return F.coalesce(found, c) if passthrough else found


def first_match(
    text: Column | str, rules: Sequence[tuple[str, str]], otherwise: str | None
) -> Column:
    """Label of the first LIKE pattern the lower-cased text matches."""
    c = F.lower(as_column(text))
    chosen = F.lit(otherwise)
    for pattern, label in reversed(list(rules)):
        chosen = F.when(c.like(pattern), F.lit(label)).otherwise(chosen)
    return chosen


def at_least(value: Column | str, bound: float, yes: str, no: str) -> Column:
    """Two-way status; NULL reads as ``no``."""
    return F.when(as_column(value) >= F.lit(bound), F.lit(yes)).otherwise(F.lit(no))


# -- ordering --------------------------------------------------------------


def nulls_last(*names: str) -> list[Column]:
    """Sort keys with NULLs at the end; a leading ``-`` sorts descending."""
    return [
        F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc_nulls_last()
        for n in names
    ]
