"""Means and their differences that do not depend on the order rows are added in.

A sum of doubles depends on how rows were spread over tasks; a sum of whole numbers does not.  Values are
taken as whole numbers of 10**-8 (decimal(38,0)), summed exactly, and a mean is rounded once, half away from zero.
Values up to 10**20 are taken; sums up to 10**30.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"
UNIT = 10 ** 8


def whole_units(col: Column) -> Column:
    return (col.cast("decimal(28,8)") * F.lit(UNIT).cast("decimal(9,0)")).cast(WHOLE)


def exact_sum(col: Column) -> Column:
    """Aggregate: the sum of a number column in whole units."""
    return F.sum(whole_units(col))


def _whole(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast(WHOLE)


def _times(a: Column | int, b: Column | int) -> Column:
    return (_whole(a) * _whole(b)).cast(WHOLE)


def rounded_quotient(units: Column, count: Column) -> Column:
    """``units`` / ``count`` rounded to two decimals, half away from zero, as a double; null for a count of 0."""
    cent = _times(count, UNIT // 100)
    twice = _times(F.abs(units), 2) + cent
    cents = F.call_function("div", twice.cast(WHOLE), _times(cent, 2))
    return F.when(count > 0, F.sign(units.cast("double")) * cents / F.lit(100.0) + F.lit(0.0))


def mean_difference(units1: Column, count1: Column, units2: Column, count2: Column) -> Column:
    """The first mean minus the second, rounded once."""
    difference = (_times(units1, count2) - _times(units2, count1)).cast(WHOLE)
    return rounded_quotient(difference, _times(count1, count2))
