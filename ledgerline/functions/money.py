"""Money arithmetic with one rounding rule everywhere.

Half-way cases round differently across engines when applied to binary
doubles (1.005 is stored as 1.00499...).  Every rounding therefore goes
through a decimal with ten places first, then rounds half-up to cents.
Sums of money are exact decimal sums, so ranks over them have exact ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM_TYPE = "decimal(24,4)"
ROUND_TYPE = "decimal(28,10)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_sql(expr: str, places: int = 2) -> str:
    """SQL text of :func:`round2`."""
    return (f"coalesce(cast(round(try_cast(({expr}) as {ROUND_TYPE}), {places}) as double), "
            f"round(cast(({expr}) as double), {places}))")


def round2(col: Column | str, places: int = 2) -> Column:
    """Half-up rounding to ``places`` decimals, result double.

    A value outside the decimal's range (or not finite) is rounded as a
    double, so no value can stop a job.
    """
    c = _c(col)
    return F.coalesce(F.round(c.try_cast(ROUND_TYPE), places).cast("double"), F.round(c.cast("double"), places))


def exact_sum(col: Column | str) -> Column:
    """Exact decimal sum of the amounts that fit the decimal."""
    return F.try_sum(_c(col).try_cast(MONEY_SUM_TYPE))


def beyond_sum(col: Column | str) -> Column:
    """Double sum of the amounts that do not fit; NULL when all do."""
    c = _c(col)
    return F.sum(F.when(c.try_cast(MONEY_SUM_TYPE).isNull(), c))


def total(exact: Column | str, beyond: Column | str) -> Column:
    """Both sums together: exact to the last double bit when all amounts fit."""
    exact, beyond = _c(exact), _c(beyond)
    return F.when(beyond.isNull(), exact.cast("double")).otherwise(F.coalesce(exact.cast("double"), F.lit(0.0)) + beyond)


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole in doubles, rounded to cents; NULL when whole is 0."""
    return round2(F.try_divide(part.cast("double") * F.lit(100.0),
                               F.when(whole != 0, whole.cast("double"))))
