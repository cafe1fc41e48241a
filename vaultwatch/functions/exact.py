"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 31  # of a part, so that a long holds the sum of 2**32 of them
_PARTS = 3


def exact_unit(largest: Column) -> Column:
    """A power of two for terms of 0 to ``largest``, which are then below 2**31 units; 1 where that is 0 or not finite."""
    usable = (largest > 0) & (largest < float("inf"))
    power = F.greatest(F.ceil(F.log2(F.when(usable, largest))) + 1 - _BITS, F.lit(-1000))
    return F.coalesce(F.pow(F.lit(2.0), power), F.lit(1.0))


def exact_sum(term: Column, unit: Column, row_unit: Column) -> Column:
    """The sum of terms that are not negative, as an aggregate: the same double in any order of the rows.

    A term is cut into a high, a middle and a low part of 31 bits each, in units of ``row_unit`` (one value for the
    group, that of the aggregate ``unit``), which divides without rounding; parts are summed as longs. What lies
    below the low part, 2**-62 of a unit, is left out row by row, so that too is the same in any order.
    """
    step = float(1 << _BITS)
    rest, sums = term / row_unit, []
    for _ in range(_PARTS):
        part = F.floor(rest)
        sums.append(F.sum(part))
        rest = (rest - part) * step
    high, middle, low = sums
    middle = middle + F.shiftright(low, _BITS)
    high = high + F.shiftright(middle, _BITS)
    below = F.lit((1 << _BITS) - 1)
    return (high + (middle.bitwiseAND(below) + low.bitwiseAND(below) / step) / step) * unit
