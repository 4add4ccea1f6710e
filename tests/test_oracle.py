"""Every registered query against its DuckDB form, and the driver contract."""

import pytest
from conftest import SF

import __spark_entry__ as contract
from check import compare, connect
from skylattice.functions.periods import date_period
from skylattice.operators.gaps import fill_gaps
from skylattice.plans.catalog import FIRST, LAST, QUERIES, SPLIT, weather_hour
from skylattice.plans.oracle import ORACLES
from skylattice.sources import star


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_oracle(spark, duck, name):
    assert compare(spark, duck, SF, name) == ""


def test_only_stored_sizes_have_no_oracle():
    assert set(QUERIES) - set(ORACLES) == {"table_stats", "table_total"}
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_queries_hold_in_another_session_zone(spark, duck, any_zone):
    for name in ("hourly_calendar", "condition_backfill", "alerts", "gap_fill"):
        assert compare(spark, duck, SF, name) == ""


def test_gap_fill_covers_the_whole_period(spark):
    """Every hour of FIRST to LAST for every city, and the same hours from a start in its middle."""
    whole, city = QUERIES["gap_fill"](spark, SF), star.cities(spark, SF)
    days, n = (LAST - FIRST).days + 1, city.select("IdCity").distinct().count()
    dates = {r.Date: r["count"] for r in whole.groupBy("Date").count().collect()}
    assert len(dates) == days and (min(dates), max(dates)) == (FIRST, LAST) and set(dates.values()) == {24 * n}
    late = date_period(SPLIT, LAST)
    rest = fill_gaps(weather_hour(spark, SF), city, late.start, late.end)
    wanted = whole.where(whole.Date >= SPLIT)
    assert rest.exceptAll(wanted).count() == wanted.exceptAll(rest).count() == 0
    assert rest.where("Filled and Temp is not null").count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
