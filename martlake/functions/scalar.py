"""Column functions (the macro and helper surface of the reference).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money and rate types used for exact arithmetic.
MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"

# Numeric text accepted by the string-to-number coercion: optional sign,
# digits with an optional fraction or a bare fraction, optional exponent,
# or an infinity word. Leading/trailing blanks are allowed.
NUMERIC_TEXT = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity|INFINITY)\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(col) -> Column:
    """Amount as exact decimal(12,2)."""
    return _c(col).cast(MONEY)


def rate(col) -> Column:
    return _c(col).cast(RATE)


def units(col, scale: int, strict: bool = True) -> Column:
    """Exact fixed-point value as a 64-bit integer of 10^-scale units.

    Same result as ``cast(col as decimal(18, scale))`` scaled to an integer.
    The fast path rounds ``col * 10^scale`` with plain double arithmetic
    (Spark's ``round`` on doubles goes through BigDecimal); only values
    within 1e-6 of a half unit (where float error could flip the rounding)
    take the exact decimal route, so the cost of decimal arithmetic is paid
    on those rows alone. Null stays null; NaN, infinities and amounts of 1e15
    units or more raise, so that no sum silently loses a row. Not ``strict``: they
    are null, for callers that check several amounts of a row at once
    (``checked_units``).
    """
    c = _c(col)
    scaled = c * F.lit(float(10 ** scale))
    frac = F.abs(scaled - F.floor(scaled))
    near_half = F.abs(frac - F.lit(0.5)) < F.lit(1e-6)
    exact = (c.cast(f"decimal(18,{scale})") * F.lit(10 ** scale)).cast("bigint")
    nearest = F.when(scaled >= 0, F.floor(scaled + F.lit(0.5))).otherwise(-F.floor(F.lit(0.5) - scaled))
    finite = ~F.isnan(c) & (F.abs(scaled) < F.lit(1e15))
    value = F.when(finite, F.when(near_half, exact).otherwise(nearest.cast("bigint")))
    if not strict:
        return value
    broken = F.raise_error(F.concat(F.lit("amount out of range: "), c.cast("string"))).cast("bigint")
    return value.when(c.isNotNull() & ~finite, broken)


def checked_units(cols: dict[str, str], scale: int) -> list[Column]:
    """``units`` of several columns of a row (result name -> column), with one check for
    all of them: a row with an amount out of range raises."""
    values = {name: units(c, scale, strict=False) for name, c in cols.items()}
    bad = reduce(lambda x, y: x | y, [F.col(c).isNotNull() & values[n].isNull() for n, c in cols.items()])
    text = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols.values()])
    broken = F.raise_error(F.concat(F.lit("amount out of range in: "), text)).cast("bigint")
    (first, value), *rest = values.items()
    return [F.when(bad, broken).otherwise(value).alias(first), *[v.alias(n) for n, v in rest]]


def units_to_double(col, scale: int):
    """Integer units back to the nearest double, through an exact decimal."""
    c = F.col(col) if isinstance(col, str) else col
    return (c.cast("decimal(38,0)") / F.lit(10 ** scale).cast("decimal(19,0)")).cast("double")


def cents_to_dollars(col, precision: int = 2) -> Column:
    """cents / 100.0 rounded half-up to ``precision`` digits (decimal stays decimal)."""
    return F.round(_c(col) / F.lit(100.0).cast("decimal(4,1)"), precision)


def safe_divide(numerator, denominator, default=0) -> Column:
    """numerator / denominator; ``default`` when the denominator is 0 or null.

    A null numerator with a valid denominator stays null. The CASE guards the
    ANSI divide-by-zero error.
    """
    n, d = _c(numerator), _c(denominator)
    default_col = default if isinstance(default, Column) else F.lit(default)
    return F.when(d.isNull() | (d == 0), default_col).otherwise(n / d)


def to_number(col) -> Column:
    """Text to double; anything that is not numeric text becomes null.

    Spark's own cast accepts forms such as ``1d`` or ``1f``; the pattern guard
    rejects them while still admitting infinities.
    """
    s = _c(col).cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))


def parse_timestamp(col) -> Column:
    """String to naive UTC timestamp; an explicit offset is honoured.

    Goes through a zoned timestamp and casts to NTZ (session zone UTC), so
    ``10:00+02:00`` becomes 08:00. Raises on malformed input under ANSI.
    """
    return F.to_timestamp(_c(col)).cast("timestamp_ntz")


def try_parse_timestamp(col) -> Column:
    """As :func:`parse_timestamp`, null on malformed input (quarantine mode)."""
    return F.try_to_timestamp(_c(col)).cast("timestamp_ntz")


def date_parts(col) -> list[Column]:
    """Zero-padded year / month / day strings for lake partition folders."""
    c = _c(col)
    return [F.date_format(c, "yyyy").alias("year"),
            F.date_format(c, "MM").alias("month"),
            F.date_format(c, "dd").alias("day")]


def batch_stamp(col) -> Column:
    """Timestamp rendered to the second for batch identifiers."""
    return F.date_format(_c(col), "yyyyMMdd_HHmmss")


def strip_suffix(col, suffix: str) -> Column:
    """Remove a literal suffix from a string column."""
    import re
    return F.regexp_replace(_c(col), re.escape(suffix) + "$", "")


def age_hours(ts, as_of) -> Column:
    """Hours between ``ts`` and ``as_of`` rounded to 2 digits."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    secs = F.unix_micros(as_of_col.cast("timestamp")) - F.unix_micros(_c(ts).cast("timestamp"))
    return F.round(secs / F.lit(3_600_000_000.0), 2)
