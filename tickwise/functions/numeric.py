"""Numeric parsing and division helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _null_d() -> Column:
    return F.lit(None).cast("double")

# Java's parser accepts a trailing type suffix ("1d", "2.5f") and hexadecimal
# floats ("0x1p3"); the feed's other consumers treat such strings as missing,
# so they are mapped to NULL. The leading class of the suffix rule keeps
# "inf"/"Infinity" out of it.
_SUFFIX = r"[0-9.][dDfF]\s*$|^\s*[+-]?0[xX]"


def num(c: str | Column, from_string: bool = True) -> Column:
    """Parse a feed value to double: malformed -> NULL, NaN -> NULL.

    ``try_cast`` keeps ANSI mode on without failing the job on bad input;
    ``nanvl`` maps NaN to NULL with a single evaluation of the cast.
    """
    c = F.col(c) if isinstance(c, str) else c
    d = F.nanvl(c.try_cast("double"), _null_d())
    if not from_string:
        return d
    return F.when(c.rlike(_SUFFIX), _null_d()).otherwise(d)


def ieee_div(a: Column, b: Column) -> Column:
    """IEEE-754 style division: x/0 -> +-Infinity by the sign of x, 0/0 -> NULL."""
    return (
        F.when(b == 0,
               F.when(a > 0, F.lit(float("inf")))
               .when(a < 0, F.lit(float("-inf")))
               .otherwise(_null_d()))
        .otherwise(F.try_divide(a, b))
    )
