"""Exact averages, two-decimal rounding and the grid-cell key.

Sums of doubles depend on the order in which partitions arrive, and an average that lies on a
rounding tie then flips between runs. Sums here run over whole numbers in BIGINT instead: they
are the same for every partitioning and retry, and nearly as fast as sums of doubles. A reading is
split into high and low millionths and the millionths of a millionth that are left;
no part can overflow in a group of two billion readings, with or without ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MILLION = 1_000_000


#: Readings from this magnitude on are no measurements: they count as missing, and
#: ``quality.unusable`` reports them.
LIMIT = 9e12
_HALF = 1 << 32


def usable(x: Column) -> Column:
    """Whether ``x`` is a measurement: neither null, NaN, infinite nor beyond the limit."""
    return F.coalesce(F.abs(x) < F.lit(LIMIT), F.lit(False))


def finite(x: Column) -> Column:
    """``x``, or null where it is no measurement."""
    return F.when(F.abs(x) < F.lit(LIMIT), x)


def millionths(x: Column) -> Column:
    """A measurement as a whole number of millionths."""
    return F.rint(finite(x) * F.lit(float(MILLION))).cast("bigint")


def parts(x: Column) -> dict[str, Column]:
    """What to sum of a reading: high and low millionths, the rest; and the reading to count.

    The rest is in millionths of a millionth, as far as a double of that magnitude tells decimals from noise:
    fourteen significant digits at least.
    """
    whole, size = millionths(x), F.abs(x)
    scaled = x * F.lit(float(MILLION))
    rest = (scaled - F.rint(scaled)) * F.lit(float(MILLION))
    unit = F.when(size < F.lit(1e3), F.lit(1.0)).when(size < F.lit(1e5), F.lit(1e2)).when(size < F.lit(1e7), F.lit(1e4))
    return {
        "high": F.shiftright(whole, 32),
        "low": whole.bitwiseAND(F.lit(_HALF - 1)),
        "rest": (F.rint(rest / unit) * unit).cast("bigint"),
        "count": whole,
    }


def combined(high: Column, low: Column, rest: Column, count: Column) -> Column:
    """The average of the summed parts.

    One division of two whole numbers, each the double nearest to it: both terms of a sum are exact, up to
    3.7e13 also where readings are finer than millionths.
    """
    above = (high + F.shiftright(low, 32)).cast("double") * F.lit(float(_HALF))
    below = low.bitwiseAND(F.lit(_HALF - 1))
    n = count.cast("double") * F.lit(float(MILLION))
    fine = above * F.lit(float(MILLION)) + (below * F.lit(MILLION) + rest).cast("double")
    return F.when(F.coalesce(rest, F.lit(0)) == 0, F.try_divide(above + below.cast("double"), n)).otherwise(
        F.try_divide(fine, n * F.lit(float(MILLION)))
    )


def ratio(total: Column, count: Column) -> Column:
    """``total`` millionths over ``count`` in units, null for a count of zero."""
    return F.try_divide(total.cast("double"), count.cast("double") * F.lit(float(MILLION)))


def mean(x: Column) -> Column:
    """Unrounded average of the measurements, null without any.

    A reading whose magnitude is 9e12 or more, NaN or infinite is no measurement and left out.
    """
    p = parts(x)
    return combined(F.sum(p["high"]), F.sum(p["low"]), F.sum(p["rest"]), F.count(p["count"]))


def difference(x: Column, y: Column) -> Column:
    """``x - y`` without binary noise: 286.82 - 283.06 is 3.76."""
    return (millionths(x) - millionths(y)).cast("double") / F.lit(float(MILLION))


def _near_tie(hundredths: Column) -> Column:
    """Whether binary noise could decide which way ``hundredths`` rounds."""
    return F.abs(F.abs(hundredths - F.rint(hundredths)) - 0.5) < F.lit(1e-6)


def round2(x: Column) -> Column:
    """Round half up to two decimals, as ``round(x, 2)`` does.

    ``round`` goes through decimal text; only ties and large numbers need that.
    """
    scaled = x * F.lit(100.0)
    plain = (F.abs(x) < F.lit(1e7)) & ~_near_tie(scaled)
    return F.when(plain, (F.rint(scaled) + F.lit(0.0)) / F.lit(100.0)).otherwise(F.round(x, 2))


def rounded(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``df`` with ``cols`` rounded, as a step of its own after the one that computes them.

    The rounding mentions its input several times; on finished columns that stays small code.
    """
    return df.withColumns({c: round2(F.col(c)) for c in cols})


def cell(x: Column) -> Column:
    """A coordinate as its grid cell: whole hundredths of a degree, rounded half up.

    An integer key has no -0.0 or NaN and groups and joins faster than a rounded double.
    Coordinates that are missing or out of range give null.
    """
    scaled = x * F.lit(100.0)
    tied = F.rint(F.round(x, 2) * F.lit(100.0))
    return F.when(_near_tie(scaled), tied).otherwise(F.rint(scaled)).try_cast("int")


def degrees(cell: Column) -> Column:
    """The coordinate a cell is centred on."""
    return cell / F.lit(100.0)
