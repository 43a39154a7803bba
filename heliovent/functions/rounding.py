"""Rounding, and means and sums that do not depend on the order of their parts.

``round_cents`` is for values of one record, ``stable_round`` for results of inexact arithmetic. A sum of doubles depends on
the order in which partial sums arrive, so ``exact_mean`` and ``exact_sum`` add whole numbers and divide or round once.

A value counts as a whole number of 10^-places, a BIGINT, of which the high and the low bits are summed apart; the two sums of
a group meet in one decimal. ``exact_parts`` gives these sums by themselves: they can be stored and added up later.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOISE_FREE = "decimal(38,10)"

# Bits of the low part: a sum of them holds 3e10 rows of a group; Spark stops the job should a sum not fit.
_LOW_BITS = 28


def round_cents(x: Column) -> Column:
    """Same value as ``F.round(x, 2)`` (half up on the decimal text), at a third of its cost.

    ``F.round`` builds a BigDecimal per row. Away from a tie plain arithmetic gives the same
    double, and only values near a tie, large, NaN or NULL take the slow way.
    """
    hundreds = x * 100
    near_tie = F.abs(hundreds - F.floor(hundreds) - 0.5) <= 1e-6
    plain = (F.abs(x) < 1e6) & ~near_tie
    return F.when(plain, F.floor(hundreds + 0.5) / F.lit(100.0)).otherwise(F.round(x, 2))


def stable_round(x: Column, digits: int = 2) -> Column:
    """Half-up rounding that ignores differences below 1e-10.

    What does not fit the decimal (NaN, infinity, 1e28 and up) has no decimals to round
    and stays as it is.
    """
    return F.coalesce(F.round(x.try_cast(_NOISE_FREE), digits).cast("double"), x)


def _units(x: Column, places: int) -> Column:
    """Each value in whole 10^-places, half up on its decimal text; NULL where it does not fit 18 digits.

    Below 10^14 units the product is off by less than 0.02, so only values near a tie and large ones need a decimal.
    """
    scaled = x * float(10**places)
    near_tie = F.abs(scaled - F.floor(scaled) - 0.5) <= 0.05
    plain = (F.abs(x) < float(10 ** (14 - places))) & ~near_tie
    text = x.try_cast(f"decimal(18,{places})") * F.lit(Decimal(10**places))
    return F.when(plain, F.floor(scaled + 0.5)).otherwise(text.cast("bigint"))


def exact_parts(x: Column, places: int = 8) -> dict[str, Column]:
    """Aggregates that ``mean_of_parts`` and ``sum_of_parts`` take, by name; the sums of several groups add up.

    ``rest`` sums what has no decimal text (NaN, infinity) or too long a one, which must not be left out.
    """
    units = _units(x, places)
    return {
        "high": F.sum(F.shiftright(units, _LOW_BITS)),
        "low": F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))),
        "rest": F.sum(F.when(units.isNull(), x)),
        "n": F.count(x),
    }


def _total(parts: dict[str, Column], places: int) -> Column:
    high, low = (parts[name].cast("decimal(20,0)") for name in ("high", "low"))
    unit = Decimal(1).scaleb(-places)
    return (high * F.lit((1 << _LOW_BITS) * unit) + low * F.lit(unit)).cast(f"decimal(28,{places})")


def _unless_rest(parts: dict[str, Column], total: Column, exact: Column, divisor: Column, digits: int) -> Column:
    every = parts["rest"] + F.coalesce(total.cast("double"), F.lit(0.0))
    return F.when(parts["rest"].isNull(), exact).otherwise(stable_round(every / divisor, digits))


def mean_of_parts(parts: dict[str, Column], digits: int = 2, places: int = 8) -> Column:
    total = _total(parts, places)
    exact = F.round(total / parts["n"], digits).cast("double")
    return _unless_rest(parts, total, exact, parts["n"], digits)


def sum_of_parts(parts: dict[str, Column], digits: int = 2, places: int = 8) -> Column:
    total = _total(parts, places)
    return _unless_rest(parts, total, F.round(total, digits).cast("double"), F.lit(1), digits)


def exact_mean(x: Column, digits: int = 2, places: int = 8) -> Column:
    """Mean, half up, that is the same for every partitioning: values count to ``places`` decimals."""
    return mean_of_parts(exact_parts(x, places), digits, places)


def exact_sum(x: Column, digits: int = 2, places: int = 8) -> Column:
    return sum_of_parts(exact_parts(x, places), digits, places)
