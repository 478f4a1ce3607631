"""Sums of doubles that do not depend on the order of the rows.

A distributed sum of doubles rounds at every addition, so its last digits follow
the partitioning. Here each value is cut into a whole part and a fraction in
units of 2^-40, two integers that decimals add up exactly; one rounding at the
end gives the same double for every order. Fractions below 2^-40 are cut off
(less than one part in 10^12 of a dollar for each row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = float(1 << 40)
#: Whole parts up to here are added exactly; larger values (and infinities) are
#: added as doubles.
_LARGEST = 9.0e17


def _parts(value: Column) -> tuple[Column, Column, Column]:
    fits = F.abs(value) < _LARGEST
    whole = F.floor(F.when(fits, value))
    rest = F.floor((F.when(fits, value) - whole) * F.lit(_UNIT))
    return (F.sum(whole.cast("decimal(18,0)")), F.sum(rest.cast("decimal(13,0)")),
            F.sum(F.when(~fits, value)))


def exact_sum(value: Column | str) -> Column:
    """Sum aggregate of a double column, NULL without values."""
    value = F.col(value) if isinstance(value, str) else value
    whole, rest, large = _parts(value)
    fine = whole.cast("double") + rest.cast("double") / F.lit(_UNIT)
    return F.when(large.isNull(), fine).otherwise(F.coalesce(fine, F.lit(0.0)) + large)


def exact_avg(value: Column | str) -> Column:
    """Mean aggregate of a double column (missing ignored), NULL without values."""
    value = F.col(value) if isinstance(value, str) else value
    return F.try_divide(exact_sum(value), F.count(value))
