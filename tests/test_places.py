"""Cities of the same cells are worked out once and give the rows that each alone would give."""

from datetime import datetime

import pytest
from conftest import doc, plan, rows

from pyspark.sql import functions as F

from skylattice.operators.daily import daily
from skylattice.operators.gaps import fill_gaps, gap_report
from skylattice.operators.hourly import hourly
from skylattice.operators.monthly import monthly, weekly
from skylattice.operators.places import at_cities, members, places
from skylattice.operators.rolling import anomalies, rolling
from skylattice.plans.catalog import QUERIES
from skylattice.schemas import TABLES

A, B = datetime(2024, 1, 1), datetime(2024, 1, 3)
BUILDS = {
    "daily": lambda h, c: daily(h),
    "monthly": lambda h, c: monthly(daily(h)),
    "weekly": lambda h, c: weekly(daily(h)),
    "rolling": lambda h, c: rolling(daily(h), ["TempAvg"], 7),
    "anomalies": lambda h, c: anomalies(h, "Temp", 168, 0.5),
    "gap_report": lambda h, c: gap_report(h, c, A, B),
    "fill_gaps": lambda h, c: fill_gaps(h, c, A, B),
}


@pytest.fixture
def seen(raw):
    """Three cells, one with nobody in it."""
    places = [(7.367, 45.133), (10.75, 59.91), (0.0, 0.0)]
    return raw(
        *(
            doc(f"2024-01-0{d}T{h:02}:10:00", lon, lat, temp=float(d * h % 7 + i), rain=0.1 * i)
            for i, (lon, lat) in enumerate(places)
            for d in (1, 2)
            for h in (1, 2, 5, 9, 13)
        )
    )


@pytest.fixture
def crowd(spark):
    """Cities that share a cell, one listed twice, one in two cells, one without a cell, and rows without an id."""
    turin, oslo = (7.367, 45.133), (10.75, 59.91)
    listed = [(1, *turin), (2, *turin), (3, *oslo), (3, *oslo), (4, *turin), (4, *oslo), (5, None, None), (6, 50.0, 50.0), (None, *oslo), (None, None, None)]
    return spark.createDataFrame([(k, str(k), 1, *at) for k, *at in listed], TABLES["city"].ddl)


@pytest.mark.parametrize("name", BUILDS)
def test_rows_by_place_are_those_of_each_city(seen, crowd, name):
    build = BUILDS[name]
    one = build(hourly(seen, crowd), crowd)
    shared = at_cities(build(hourly(seen, places(crowd)), places(crowd)), members(crowd))
    assert shared.columns == one.columns
    found = sorted(map(str, rows(one)))
    assert found and sorted(map(str, rows(shared))) == found


def test_a_place_stands_once_for_all_its_cities(crowd):
    # Turin's two; the one in Oslo twice; both cells; a cell far off; no cell; the rows without an id.
    assert members(crowd).select("_place").distinct().count() == 6
    assert members(crowd).count() == 7


@pytest.mark.parametrize("name", ["temperature_day", "month_summary", "weekly", "rolling_7d", "daily_backfill", "gap_fill"])
def test_no_query_gathers_hours_by_city(spark, tmp_path, name):
    """A thousand cities of one cell: the shuffles carry the cell's rows, not those of each city."""
    for t, ddl, made in (
        ("customer", "c_custkey bigint, c_name string, c_nationkey int", [(i * 61200, "a", 1) for i in range(1000)]),
        ("supplier", "s_suppkey bigint, s_name string, s_nationkey int", []),
        ("events", "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
         [(9 * 13 * i + 58, datetime(2024, 1, 1 + i % 20, i % 24), 0, "view", float(i), '{"k": 3}') for i in range(60)]),
    ):
        spark.createDataFrame(made, ddl).write.parquet(str(tmp_path / f"{t}.parquet"))
    found = QUERIES[name](spark, str(tmp_path))
    assert found.select("IdCity").distinct().count() == 1000
    text = plan(found.filter(F.lit(True)))
    tree = text.split("\n\n(1)")[0]
    # The cities come in after the last aggregate or window over readings: the outermost join has them on one side.
    assert tree.index("Join") < min(tree.index(w) for w in ("Aggregate", "Window") if w in tree)
