"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest numeric prefix of a text, leading blanks allowed: "12.5kW" reads as 12.5.
NUMBER_PREFIX = r"^\s*([+-]?(Infinity|([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?))"


def zero_fill(value: Column) -> Column:
    """Null and NaN become 0.0. Apply after an aggregate: before it, averages would shift."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def half_up(value: Column, digits: int) -> Column:
    """Round halves towards plus infinity: -2.5 gives -2 and, in binary, 1.005 gives 1.0.

    ``floor`` of a double is a BIGINT, so values whose scaled size a double holds without a fraction,
    from 2^52 on, stay as they are, and so do NaN and infinities.
    """
    scale = float(10**digits)
    scaled = value * F.lit(scale)
    rounded = F.floor(scaled + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(scaled) < F.lit(float(2**52)), rounded).otherwise(value)


def whole_number(text: Column) -> Column:
    """The text as a plain number, by a cast, which is faster than the pattern.

    Hexadecimal floats, which the cast would read, are left out.
    """
    return F.when(~(text.contains("x") | text.contains("X")), text.try_cast("double"))


def parse_number(text: Column, whole: Column | None = None) -> Column:
    """Prefix parse; null where the text does not start with a number.

    What the cast does not read, or reads from a word for infinity or NaN, is left to the pattern.
    ``whole`` may be a column that holds :func:`whole_number` already.
    """
    whole = whole_number(text) if whole is None else whole
    prefix = F.regexp_extract(text, NUMBER_PREFIX, 1).try_cast("double")
    return F.when(is_finite(whole), whole).otherwise(prefix)


def is_finite(value: Column) -> Column:
    return F.abs(value) < F.lit(float("inf"))
