"""Arithmetic whose results must not depend on ANSI mode, row order or float noise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_LIMIT = 2.0**63
EXACT = T.DecimalType(28, 8)
WHOLE = T.DecimalType(28, 0)
FRACTION = T.DecimalType(28, 28)
PLACES = {"exact": EXACT.scale, "whole": WHOLE.scale, "fraction": FRACTION.scale}
WIDE_LIMIT = 1e28


def divide(a: Column, b: Column) -> Column:
    """Floating-point division: x/0 is an infinity and 0/0 is NaN, instead of an error."""
    return (
        F.when(b != 0, a / b)
        .when(a > 0, F.lit(float("inf")))
        .when(a < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def floor_thousandths(x: Column) -> Column:
    """Round down to three places; NULL where the result is not finite or not a long."""
    scaled = x * 1000
    return F.when(F.abs(scaled) < LONG_LIMIT, F.floor(scaled) / 1000)


def half_even(x: Column, places: int) -> Column:
    """Round halves to the even neighbour; never negative zero."""
    scale = float(10**places)
    return F.rint(x * scale) / scale + 0.0


@dataclass(frozen=True)
class Terms:
    """A column of doubles in parts that sum up alike in any order of rows.

    A value below 1e20 of at most eight decimals is ``exact``; another one below 1e28 is its ``whole`` number and
    its ``fraction``, to 28 places. What is ``beyond`` that, or not finite, stays a double.
    """

    exact: Column
    whole: Column
    fraction: Column
    beyond: Column
    inexact: Column


def terms(x: Column) -> Terms:
    exact = x.try_cast(EXACT)
    fits = F.coalesce(exact.cast("double") == x, x.isNull())
    narrow = ~fits & (F.abs(x) < WIDE_LIMIT)
    return Terms(
        F.when(fits, exact),
        F.when(narrow, (x - x % 1).try_cast(WHOLE)),
        F.when(narrow, (x % 1).try_cast(FRACTION)),
        F.when(~fits & ~narrow, x),
        ~fits,
    )


def _joined(exact: Column, whole: Column, fraction: Column) -> Column:
    """The sum of the parts' sums, always taken in the same order."""
    exact, whole, fraction = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (exact, whole, fraction))
    return whole + (exact + fraction)


def exact_sum(x: Column) -> Column:
    """Sum a double column without float noise, in any order of rows and either ANSI mode.

    Exact where every value is below 1e20 and has at most eight decimals. Other values below 1e28 are summed
    to 28 decimals, also alike in any order; those beyond it as doubles. NULL only where there is no value.
    """
    parts = terms(x)
    exact, whole, fraction = (F.sum(c) for c in (parts.exact, parts.whole, parts.fraction))
    any_order = _joined(exact, whole, fraction) + F.coalesce(F.sum(parts.beyond), F.lit(0.0))
    return F.when(F.count_if(parts.inexact) > 0, any_order).otherwise(exact.cast("double"))


def running_sum(x: Column, rows: WindowSpec) -> Column:
    """What ``sum_between`` needs of all values up to each row, as one column; ``rows`` has an order."""
    parts, up_to = terms(x), rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"exact": parts.exact, "whole": parts.whole, "fraction": parts.fraction}
    counts = {"values": x.isNotNull(), "inexact": parts.inexact, "beyond": parts.beyond.isNotNull()}
    return F.struct(
        # one digit is left for the difference of two of them
        *[
            F.coalesce(F.sum(c).over(up_to), F.lit(0)).cast(T.DecimalType(37, PLACES[n])).alias(n)
            for n, c in sums.items()
        ],
        *[F.count_if(c).over(up_to).alias(n) for n, c in counts.items()],
    )


def sum_between(before: Column, upto: Column) -> Column:
    """The sum of the rows behind one row up to another, as ``exact_sum`` gives it, whatever their number.

    Both are ``running_sum``; ``before`` is NULL where there is no row before the first. NaN where a value is
    beyond 1e28 or not finite; NULL where there is no value.
    """

    def part(name: str) -> Column:
        return upto[name] - F.coalesce(before[name], F.lit(0).cast(T.DecimalType(37, PLACES[name])))

    def count(name: str) -> Column:
        return upto[name] - F.coalesce(before[name], F.lit(0))

    return (
        F.when(count("beyond") > 0, F.lit(float("nan")))
        .when(count("inexact") > 0, _joined(part("exact"), part("whole"), part("fraction")))
        .when(count("values") > 0, part("exact").cast("double"))
    )
