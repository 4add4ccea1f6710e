"""The scalar functions for users of SQL: temporary functions with SQL bodies.

Catalyst puts their bodies into the query, so that no user-defined function runs. The bodies state
the same rules as the column functions beside this module, and a test holds them against each other.
Averages add up four sums of ``reading_*`` parts; ``average_of`` divides them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from skylattice.functions.numeric import LIMIT
from skylattice.functions.time import FIRST_SECOND, LAST_SECOND

_WHOLE = f"CAST(rint(CASE WHEN abs(x) < {LIMIT!r}D THEN x END * 1e6D) AS BIGINT)"
_TIED = "abs(abs(x * 100D - rint(x * 100D)) - 0.5D) < 1e-6D"
_TIME = f"""timestampadd(SECOND, CASE WHEN dt BETWEEN {FIRST_SECOND} AND {LAST_SECOND} THEN dt END,
    TIMESTAMP_NTZ'1970-01-01 00:00:00')"""

#: name -> (arguments, result, body).
FUNCTIONS = {
    "grid_cell": ("x DOUBLE", "INT", f"try_cast(CASE WHEN {_TIED} THEN rint(round(x, 2) * 100D) ELSE rint(x * 100D) END AS INT)"),
    "obs_time": ("dt BIGINT", "TIMESTAMP_NTZ", _TIME),
    "obs_date": ("dt BIGINT", "DATE", f"to_date({_TIME})"),
    "obs_hour": ("dt BIGINT", "INT", f"hour({_TIME})"),
    "to_day": ("day STRING", "DATE", "try_cast(day AS DATE)"),
    "round_2": (
        "x DOUBLE",
        "DOUBLE",
        f"CASE WHEN abs(x) < 1e7D AND NOT ({_TIED}) THEN (rint(x * 100D) + 0D) / 100D ELSE round(x, 2) END",
    ),
    "reading_high": ("x DOUBLE", "BIGINT", f"shiftright({_WHOLE}, 32)"),
    "reading_low": ("x DOUBLE", "BIGINT", f"{_WHOLE} & 4294967295"),
    "reading_rest": (
        "x DOUBLE",
        "BIGINT",
        """CAST(rint((x * 1e6D - rint(x * 1e6D)) * 1e6D
            / CASE WHEN abs(x) < 1e3D THEN 1D WHEN abs(x) < 1e5D THEN 1e2D WHEN abs(x) < 1e7D THEN 1e4D END)
            * CASE WHEN abs(x) < 1e3D THEN 1D WHEN abs(x) < 1e5D THEN 1e2D WHEN abs(x) < 1e7D THEN 1e4D END AS BIGINT)""",
    ),
    "average_of": (
        "high BIGINT, low BIGINT, rest BIGINT, n BIGINT",
        "DOUBLE",
        """CASE WHEN coalesce(rest, 0) = 0
            THEN try_divide(CAST(high + shiftright(low, 32) AS DOUBLE) * 4294967296D + CAST(low & 4294967295 AS DOUBLE), n * 1e6D)
            ELSE try_divide(CAST(high + shiftright(low, 32) AS DOUBLE) * 4294967296D * 1e6D
                + CAST((low & 4294967295) * 1000000 + rest AS DOUBLE), n * 1e6D * 1e6D) END""",
    ),
    "megabytes": ("size BIGINT", "DOUBLE", "round(size / 1048576D, 2)"),
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions known to ``spark.sql`` of this session."""
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
