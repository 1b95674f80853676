"""Rounding and rounded aggregates.

``exact=None`` is plain DOUBLE arithmetic. ``exact=s`` says that the values are fixed-point
numbers with ``s`` decimals; they are then added up as whole units, so the result does not
depend on the order in which partitions arrive. Units are BIGINT, which is as fast as DOUBLE
and several times faster than DECIMAL.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Beyond this many units a DOUBLE does not tell neighbours apart.
MAX_UNITS = float(2**53)
_HALF_BITS = 20


def units(value: Column, scale: int) -> Column:
    """A fixed-point number as a BIGINT count of 10^-scale; out of range is an error."""
    scaled = value.cast("double") * float(10**scale)
    failure = F.raise_error(F.lit(f"no fixed-point number with {scale} decimals")).cast("bigint")
    sound = F.when(F.abs(scaled) <= MAX_UNITS, F.floor(scaled + 0.5).cast("bigint"))
    return F.when(value.isNotNull(), sound.otherwise(failure))


def units_sum(count: Column, scale: int) -> Column:
    """The exact sum of unit counts as DECIMAL.

    High and low bits are added apart, so that no number of rows overflows a BIGINT.
    """
    high = F.sum(F.shiftright(count, _HALF_BITS)).cast("decimal(19,0)")
    low = F.sum(count.bitwiseAND(F.lit(2**_HALF_BITS - 1))).cast("decimal(19,0)")
    whole = high * F.lit(Decimal(2**_HALF_BITS)) + low
    return whole * F.lit(Decimal(1).scaleb(-scale)) if scale else whole


def fixed_sum(value: Column, scale: int) -> Column:
    return units_sum(units(value, scale), scale)


def from_units(count: Column, scale: int) -> Column:
    """The DOUBLE nearest to a number of units."""
    return count.cast("double") / float(10**scale)


def round_value(value: Column, places: int = 2, exact: int | None = None) -> Column:
    """Row by row, half away from zero."""
    if exact is None:
        return F.round(value, places)
    count = units(value, exact)
    if exact <= places:
        return from_units(count, exact)
    step = 10 ** (exact - places)
    size = F.floor((F.abs(count) + step // 2) / step).cast("bigint")
    return from_units(F.when(count < 0, -size).otherwise(size), places)


def round_result(value: Column, places: int = 2, exact: int | None = None) -> Column:
    """The same for results of aggregates, which have any number of decimals."""
    if exact is None:
        return F.round(value, places)
    return F.round(value.cast("decimal(38,6)"), places).cast("double")


def partial_sum(value: Column, exact: int | None = None) -> Column:
    """A sum meant to be added up again."""
    return F.sum(value) if exact is None else fixed_sum(value, exact)


def mean_of(total: Column, count: Column, places: int = 2, exact: int | None = None) -> Column:
    """The rounded mean from a sum and a count kept apart by a pre-aggregation."""
    return round_result(F.try_divide(total.cast("double"), count), places, exact)


def rounded_sum(value: Column, places: int = 2, exact: int | None = None) -> Column:
    return F.round(partial_sum(value, exact), places).cast("double")


def rounded_mean(value: Column, places: int = 2, exact: int | None = None) -> Column:
    if exact is None:
        return F.round(F.avg(value), places)
    return mean_of(fixed_sum(value, exact), F.count(value), places, exact)


def rounded_std(value: Column, places: int = 2, exact: int | None = None) -> Column:
    return round_result(F.stddev_samp(value), places, exact)
