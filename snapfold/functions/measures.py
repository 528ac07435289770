"""Date arithmetic, guarded ratios, row sums and exact money sums."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, positive_only: bool = True) -> Column:
    """``numerator / denominator``, 0.0 where the denominator is NULL or zero.

    With ``positive_only`` a negative denominator gives 0.0 as well.
    """
    usable = denominator > 0 if positive_only else denominator != 0
    return F.when(usable, numerator / denominator).otherwise(F.lit(0.0))


def years_between(later: Column, earlier: Column) -> Column:
    """Completed years of 365.25 days."""
    return F.floor(F.datediff(later, earlier) / 365.25).cast("int")


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The reporting date; the current date unless one is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def days_since(date: Column, as_of: dt.date | str | None = None) -> Column:
    """Days from ``date`` to the reporting date."""
    return F.datediff(as_of_date(as_of), date)


def row_sum(columns: Iterable[Column]) -> Column:
    """Sum across the columns of one row; NULL if any part is NULL."""
    return reduce(add, columns)


def next_period(period: Column) -> Column:
    """The period that follows."""
    return period + 1


#: Money up to this is a whole number of units to the last digit a double keeps.
LARGEST_EXACT = 1e11
#: Units of an amount: ten-thousandths.
UNITS = 1e4


def to_cents(money: Column) -> Column:
    """Two-decimal money as whole cents, so sums are exact in any row order; NULL for amounts beyond those."""
    return F.when(F.abs(money) < LARGEST_EXACT, F.round(money * 100)).cast("long")


def _is_exact(money: Column) -> Column:
    """Whether an amount has four decimals at most; false for huge and non-finite ones."""
    return (F.abs(money) < LARGEST_EXACT) & (F.rint(money * UNITS) / UNITS == money)


def exact_sum(money: Column) -> Column:
    """Sum of double amounts, the same in any row order as long as they have four decimals at most.

    Such amounts are summed as whole numbers.  With any other among them, and where whole numbers run out of room, it is the
    plain sum of doubles: finer amounts keep their digits, and huge or non-finite ones show in the total and fail no job.
    """
    exact = _is_exact(money)
    units = F.try_sum(F.when(exact, F.rint(money * UNITS).cast("long")))
    return F.coalesce(F.when(F.bool_and(exact), units / UNITS), F.sum(money))


def exact_row_sum(columns: Iterable[Column]) -> Column:
    """``exact_sum`` across the columns of one row; NULL if any part is NULL."""
    parts = list(columns)
    exact = reduce(and_, map(_is_exact, parts))
    units = [F.when(_is_exact(p), F.rint(p * UNITS).cast("long")) for p in parts]
    return F.coalesce(F.when(exact, row_sum(units) / UNITS), row_sum(parts))


def from_cents(cents: Column) -> Column:
    """Whole cents back to a double amount."""
    return cents / F.lit(100.0)
