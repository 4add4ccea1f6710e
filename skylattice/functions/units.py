"""Unit conversion and readable sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.functions.numeric import MILLION, millionths, ratio


# target = (source * numerator + addend) / denominator, addend in source units.
CONVERSIONS = {
    ("K", "C"): (1, -273.15, 1),
    ("K", "F"): (9, -2298.35, 5),
    ("m/s", "km/h"): (18, 0, 5),
}


def convert_unit(x: Column, source: str, target: str) -> Column:
    """Convert a double column; whole millionths keep the result free of binary noise."""
    try:
        numerator, addend, denominator = CONVERSIONS[source, target]
    except KeyError:
        raise ValueError(f"no conversion from {source!r} to {target!r}") from None
    scaled = millionths(x).cast("decimal(20,0)") * numerator + round(addend * MILLION)
    return ratio(scaled, F.lit(denominator))


def convert(df: DataFrame, col: str, source: str, target: str, name: str | None = None) -> DataFrame:
    """``df`` with ``col`` converted, in place or as the new column ``name``.

    Readings arrive in the unit of their source (kelvin, m/s) and no operator converts them
    implicitly; standardising is planned but unspecified in the original design, so the
    formulas are our definition.
    """
    return df.withColumn(name or col, convert_unit(F.col(col), source, target))


def size_mb(size: Column) -> Column:
    """Bytes as megabytes (1024 * 1024), two decimals."""
    return F.round(size / F.lit(1024 * 1024), 2)


def human_size(size: Column) -> Column:
    """Bytes as text in the largest unit that keeps at least ten of it: ``12 MB``."""
    text = F.format_string("%d bytes", size)
    for power, unit in enumerate(["kB", "MB", "GB", "TB", "PB"], start=1):
        scaled = F.round(size / F.lit(1024**power)).cast("bigint")
        text = F.when(size >= F.lit(10 * 1024**power), F.format_string(f"%d {unit}", scaled)).otherwise(text)
    return text
