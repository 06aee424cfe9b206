"""Sums and means of doubles that do not depend on the order of the rows.

A double is cut into whole multiples of 2**32, 1, 2**-32 and 2**-64, all exactly; each kind is
added up as a decimal, and the four sums are joined at the end. So any partitioning gives the same
bits. What lies below 2**-64 is cut off each value alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = float(2**32)
#: Magnitudes from here on, infinities and NaN are added as they are.
LARGE = float(2**94)


def _limbs(value: Column) -> list[Column]:
    out, rest = [], value / F.lit(LIMB)
    for _ in range(4):
        whole = rest.cast("long")
        out.append(whole)
        rest = (rest - whole.cast("double")) * F.lit(LIMB)
    return out


def exact_sum(column: str | Column) -> Column:
    """The sum of a column of doubles, null for none. Use it like any aggregate."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    plain = F.abs(value) < F.lit(LARGE)
    sums = [
        F.coalesce(F.sum(limb.cast("decimal(20,0)")).cast("double"), F.lit(0.0))
        for limb in _limbs(F.when(plain, value))
    ]
    total = sums[3] / F.lit(LIMB) + sums[2]
    total = total / F.lit(LIMB) + sums[1]
    total = total + sums[0] * F.lit(LIMB)
    others = F.coalesce(F.sum(F.when(~plain, value)), F.lit(0.0))
    return F.when(F.count(value) > 0, total + others)


def exact_mean(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))
