import math
import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows

from skylattice.operators.alerts import Rule, alerts
from skylattice.operators.gaps import fill_gaps, gap_report
from skylattice.operators.rolling import anomalies, rolling
from skylattice.schemas import HOUR_MEASURES

START = datetime(2024, 1, 1)


def series(seed, cities=3, hours=96, keep=0.4):
    """Irregular hourly rows: {(city, hour): temp or None}."""
    rng = random.Random(seed)
    return {
        (c, h): rng.choice([None, rng.randrange(0, 3000) / 100, rng.randrange(900, 1100) / 100])
        for c in range(cities)
        for h in range(hours)
        if rng.random() < keep
    }


def frame(hours, data):
    return hours(
        *(
            {"IdCity": c, "Date": (START + timedelta(hours=h)).date(), "Hour": h % 24, "Temp": t}
            for (c, h), t in data.items()
        )
    )


def roster(hours, n):
    """Cities 0 to n - 1; the last one is silent."""
    return hours().sparkSession.range(n).withColumnRenamed("id", "IdCity")


def test_filling_in_two_steps_is_filling_in_one(hours):
    data, city = series(7), roster(hours, 4)
    at = lambda h: START + timedelta(hours=h)
    df = frame(hours, data)
    whole = fill_gaps(df, city, at(5), at(90)).collect()
    steps = fill_gaps(df, city, at(5), at(41)).collect() + fill_gaps(df, city, at(41), at(90)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, steps))
    assert fill_gaps(df, city.filter("false"), at(5), at(9)).count() == 0


def hour_of(row):
    return int((datetime.combine(row.Date, datetime.min.time()) - START).total_seconds() // 3600) + row.Hour


@pytest.mark.parametrize("seed", [1, 2])
def test_fill_gaps_against_a_loop(hours, seed):
    data = series(seed)
    a, b = 10, 80
    city = roster(hours, 4)
    found = fill_gaps(frame(hours, data), city, START + timedelta(hours=a), START + timedelta(hours=b))
    got = {(r.IdCity, hour_of(r)): (r.Temp, r.Filled) for r in found.collect()}
    wanted = {}
    for c in range(4):
        last = None
        for h in range(b):
            last = data[c, h] if data.get((c, h)) is not None else last
            if h >= a:
                wanted[c, h] = (last, (c, h) not in data)
    assert got == wanted
    assert found.columns == ["IdCity", "Date", "Hour", *HOUR_MEASURES, "Filled"]


def test_gap_report_against_a_loop(hours):
    data = series(3)
    found = gap_report(frame(hours, data), roster(hours, 4), START, START + timedelta(hours=96)).collect()
    assert {r.IdCity for r in found} == {0, 1, 2, 3}
    for r in found:
        present = sorted(h for c, h in data if c == r.IdCity)
        edges = [-1, *present, 96]
        longest = max(y - x - 1 for x, y in zip(edges, edges[1:]))
        assert (r.HoursPresent, r.HoursMissing, r.LongestGap) == (len(present), 96 - len(present), longest)


def test_rolling_against_a_loop(spark):
    rng = random.Random(4)
    data = {(c, d): rng.randrange(0, 5000) / 100 for c in range(3) for d in range(40) if rng.random() < 0.6}
    day = lambda d: date(2024, 2, 1) + timedelta(days=d)
    df = spark.createDataFrame([(c, day(d), x) for (c, d), x in data.items()], "IdCity int, Date date, TempAvg double")
    for r in rolling(df, ["TempAvg"], 7).collect():
        d = (r.Date - day(0)).days
        inside = [round(data[r.IdCity, e] * 100) for e in range(d - 6, d + 1) if (r.IdCity, e) in data]
        assert r.TempAvgRoll == pytest.approx(sum(inside) / len(inside) / 100, abs=1e-12)


def test_anomalies_against_a_loop(hours):
    data = series(5, keep=0.8)
    data[0, 95] = 500.0
    found = {(r.IdCity, hour_of(r)): r.Z for r in anomalies(frame(hours, data), "Temp", 24, 2.0).collect()}
    wanted = {}
    for (c, h), x in data.items():
        past = [data[c, e] for e in range(h - 24, h) if data.get((c, e)) is not None]
        if x is None or len(past) < 3 or min(past) == max(past):
            continue
        m = sum(past) / len(past)
        z = (x - m) / math.sqrt(sum((p - m) ** 2 for p in past) / (len(past) - 1))
        if abs(z) > 2.0:
            wanted[c, h] = z
    assert wanted and (0, 95) in found
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(z) for k, z in wanted.items())


def test_alerts(hours):
    rules = [Rule("heat", "Temp", True, 308.15), Rule("frost", "Temp", False, 273.15), Rule("storm", "Wind", True, 20)]
    d = date(2024, 3, 10)
    data = hours(
        {"IdCity": 1, "Date": d, "Hour": 2, "Temp": 310.0, "Wind": 25.5},
        {"IdCity": 2, "Date": d, "Hour": 2, "Temp": 270.0},
        {"IdCity": 3, "Date": d, "Hour": 2, "Temp": 308.15, "Wind": 20.0},
        {"IdCity": 4, "Date": d, "Hour": 2},
    )
    t = datetime(2024, 3, 10, 2)
    assert rows(alerts(data, rules), "IdCity") == [
        (1, t, "heat", "Temp 310.00 > 308.15; Wind 25.50 > 20.00"),
        (2, t, "frost", "Temp 270.00 < 273.15"),
    ]
