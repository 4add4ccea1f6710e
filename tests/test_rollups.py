from datetime import date, timedelta

from conftest import rows

from skylattice.operators.daily import daily, day_table
from skylattice.operators.filters import in_month
from skylattice.operators.monthly import monthly, monthly_join, week_dim, weekly
from skylattice.schemas import DAY_FAMILIES, TABLES

D = date(2024, 1, 31)


def test_daily_families(hours):
    data = hours(
        {"IdCity": 1, "Date": D, "Hour": 0, "Temp": 1.0, "FeelsLike": 0.5, "Rain": 0.0, "Wind": 3.0},
        {"IdCity": 1, "Date": D, "Hour": 1, "Temp": 2.01, "FeelsLike": 0.52, "Rain": 0.01},
        {"IdCity": 1, "Date": D + timedelta(1), "Hour": 0, "Temp": 9.0},
    )
    wide = daily(data, end=D + timedelta(1))
    assert rows(day_table(wide, "Temp")) == [(1, D, 1.0, 2.01, 1.51, 0.51)]
    assert rows(day_table(wide, "Rain")) == [(1, D, 0.0, 0.01, 0.01)]
    assert rows(day_table(wide, "Wind")) == [(1, D, 3.0, 3.0, 3.0)]
    assert rows(day_table(wide, "Humidity")) == [(1, D, None, None, None)]
    for family, (name, _, _) in DAY_FAMILIES.items():
        assert day_table(daily(data, [family]), family).columns == list(TABLES[name].columns)


def _wide(hours, *days, **measures):
    values = {"Temp": 1.0, "FeelsLike": 1.0, "Rain": 1.0, "Wind": 1.0, "Humidity": 1.0, "Pressure": 1.0}
    return daily(
        hours(*({"IdCity": c, "Date": d, "Hour": 0} | values | measures | m for c, d, m in days))
    )


def test_month_is_the_mean_of_days_and_the_spread_of_extremes(hours):
    data = hours(
        *(
            {"IdCity": 1, "Date": d, "Hour": h, "Temp": t, "FeelsLike": t, "Rain": 0.0, "Wind": 1.0, "Humidity": 2.0, "Pressure": 3.0}
            for d, h, t in [
                (date(2024, 1, 1), 0, 0.1),
                (date(2024, 1, 1), 1, 0.1),
                (date(2024, 1, 1), 2, 0.1),
                (date(2024, 1, 31), 0, 0.3),
                (date(2024, 2, 1), 0, 100.0),
            ]
        )
    )
    found = monthly(daily(data), 2024, 1).first()
    assert (found.Year, found.Month, found.AvgTemp, found.TempVariation) == (2024, 1, 0.2, 0.2)


def test_months_and_years_do_not_mix(hours):
    wide = _wide(hours, *((1, d, {"Temp": float(d.day)}) for d in [date(2023, 12, 31), date(2024, 1, 1), date(2024, 12, 31)]))
    assert [(r.Year, r.Month) for r in monthly(wide).orderBy("Year", "Month").collect()] == [
        (2023, 12),
        (2024, 1),
        (2024, 12),
    ]
    assert rows(in_month(wide, 2024, 12).select("Date")) == [(date(2024, 12, 31),)]


def test_city_without_one_family_drops_from_both_forms(hours):
    wide = _wide(hours, (1, D, {}), (2, D, {"Rain": None}), (2, date(2024, 1, 1), {"Rain": None}))
    stored = {f: day_table(wide, f).na.drop() for f in ("Temp", "Humidity", "Rain", "Wind")}
    joined = monthly_join(*stored.values())
    assert [r.IdCity for r in joined.collect()] == [1]
    assert rows(monthly(wide)) == rows(joined)


def test_iso_weeks(hours):
    days = [date(2020, 12, 31), date(2021, 1, 3), date(2021, 1, 4), date(2024, 12, 30)]
    found = weekly(_wide(hours, *((1, d, {}) for d in days))).orderBy("Year", "NumWeek")
    assert [(r.Year, r.NumWeek) for r in found.collect()] == [(2020, 53), (2021, 1), (2025, 1)]
    one = weekly(_wide(hours, *((1, d, {}) for d in days)), 2020, 53).collect()
    assert [(r.Year, r.NumWeek) for r in one] == [(2020, 53)]


def test_week_dimension(spark):
    dates = spark.createDataFrame([(date(2020, 12, 29),), (date(2021, 1, 12),)], "Date date")
    assert rows(week_dim(dates), "IdWeek") == [
        (202053, 53, date(2020, 12, 28), date(2021, 1, 3)),
        (202101, 1, date(2021, 1, 4), date(2021, 1, 10)),
        (202102, 2, date(2021, 1, 11), date(2021, 1, 17)),
    ]
    assert week_dim(dates.limit(0)).collect() == []
