"""Exact money sums. SPEND arrives as float; adding floats gives a result that depends on task order."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10_000


def money_units(column) -> Column:
    """Money as a whole number of 1/10000 units: exact to add, and a plain long in the aggregation buffer.

    An amount that is no such number, because it is NaN, infinite or beyond 9.2e14, counts as missing (NULL)."""
    column = F.col(column) if isinstance(column, str) else column
    return F.rint(column.cast("double") * F.lit(float(SCALE))).try_cast("bigint")


def exact_sum(column) -> Column:
    """Sum of long units that can not overflow."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast("decimal(20,0)"))


def to_money(units) -> Column:
    """Units back to money."""
    units = F.col(units) if isinstance(units, str) else units
    return units.cast("double") / F.lit(float(SCALE))
