import json
from datetime import date, datetime

import pytest
from conftest import doc, plan, rows

from skylattice.operators.alerts import Rule, alerts, alerts_by_rules
from skylattice.schemas import TABLES
from skylattice.sinks.tables import WriteConflict, write_table
from skylattice.sources.tables import FileStore
from skylattice.streaming.observations import into_hours, read_document_stream

DAY = date(2024, 1, 2)


@pytest.fixture
def rules(table):
    return lambda *rs: table("AlertRules", *rs)


def test_rules_of_one_city_and_of_all(spark, hours, rules):
    seen = hours(
        {"IdCity": 1, "Date": DAY, "Hour": 0, "Temp": 30.0, "Wind": 1.0},
        {"IdCity": 2, "Date": DAY, "Hour": 0, "Temp": 30.0, "Wind": 9.0},
        {"IdCity": 2, "Date": DAY, "Hour": 1, "Temp": None, "Wind": None},
        {"IdCity": 3, "Date": date(2024, 1, 9), "Hour": 5, "Temp": -5.0},
    )
    table = rules(
        (5, "heat", "Temp", True, 25.0, None, None, None),
        (2, "storm", "Wind", True, 8.0, 2, None, None),
        (3, "calm", "Wind", False, 2.0, 1, DAY, DAY),
        (4, "over", "Wind", False, 2.0, 1, None, date(2024, 1, 1)),
        (6, "early", "Temp", False, 0.0, None, date(2024, 1, 10), None),
        (7, "frost", "Temp", False, 0.0, None, date(2024, 1, 9), None),
        (8, "odd", "Snow", True, 0.0, None, None, None),
    )
    found = rows(alerts_by_rules(seen, table), "IdCity", "Timestamp")
    assert found == [
        (1, datetime(2024, 1, 2), "calm", "Wind 1.00 < 2.00; Temp 30.00 > 25.00"),
        (2, datetime(2024, 1, 2), "storm", "Wind 9.00 > 8.00; Temp 30.00 > 25.00"),
        (3, datetime(2024, 1, 9, 5), "frost", "Temp -5.00 < 0.00"),
    ]
    assert rows(alerts_by_rules(seen, rules())) == []


def test_table_rules_equal_rules_in_code(spark, hours, rules):
    seen = hours(*({"IdCity": i % 5, "Date": DAY, "Hour": i % 24, "Temp": i * 1.5 % 40, "Wind": i * 0.7 % 12} for i in range(24)))
    code = [Rule("heat", "Temp", True, 20.0), Rule("storm", "Wind", True, 6.0), Rule("cold", "Temp", False, 5.0)]
    table = rules(*((i, r.alert, r.measure, r.above, r.limit, None, None, None) for i, r in enumerate(code)))
    assert sorted(rows(alerts_by_rules(seen, table))) == sorted(rows(alerts(seen, code)))


def test_no_cross_join(spark, hours, rules):
    text = plan(alerts_by_rules(hours(), rules((1, "a", "Temp", True, 1.0, None, None, None))))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_ids_are_keys_as_well(spark, tmp_path, table):
    store = FileStore(spark, str(tmp_path / "t"))
    with pytest.raises(WriteConflict, match=r"1 x key twice in the batch \(IdCity\)"):
        write_table(store, table("city", (1, "a", 1, 0.0, 0.0), (1, "b", 1, 0.0, 0.0)), "city")
    with pytest.raises(WriteConflict, match=r"1 x key twice in the batch \(CityName, IdCountry\)"):
        write_table(store, table("city", (1, "a", 1, 0.0, 0.0), (2, "a", 1, 0.0, 0.0)), "city")
    write_table(store, table("city", (1, "a", 1, 0.0, 0.0), (2, "a", 2, 0.0, 0.0)), "city")
    for mode in ("error", "skip"):
        with pytest.raises(WriteConflict, match=r"key exists \(IdCity\)"):
            write_table(store, table("city", (2, "c", 1, 0.0, 0.0)), "city", mode)
    write_table(store, table("city", (1, "a", 1, 9.0, 9.0), (3, "c", 1, 0.0, 0.0)), "city", "skip")
    assert rows(store.read("city").select("IdCity", "CityName", "Lon"), "IdCity") == [(1, "a", 0.0), (2, "a", 0.0), (3, "c", 0.0)]
    assert TABLES["country"].unique == (("IdCountry",),)


def test_running_hours_and_late_observations_are_in_the_table(spark, tmp_path, city):
    store, state = FileStore(spark, str(tmp_path / "t")), tmp_path / "state"
    write_table(store, city, "city", "append")
    (tmp_path / "in").mkdir()

    def feed(name, *docs):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(d) for d in docs))
        into_hours(read_document_stream(spark, str(tmp_path / "in")), store, str(state), "s").awaitTermination()
        return rows(store.read("weather_hour").select("Date", "Hour", "Temp"), "Date", "Hour")

    first = feed("1.json", doc("2024-01-02T10:10:00", temp=1.0))
    assert first == [(DAY, 10, 1.0)]
    late = feed("2.json", doc("2024-01-02T10:50:00", temp=2.0), doc("2024-01-05T00:00:00", temp=5.0))
    assert late == [(DAY, 10, 1.5), (date(2024, 1, 5), 0, 5.0)]
    for name in ("1", ".1.crc"):
        (state / "commits" / name).unlink()  # the second batch again
    assert feed("3.json", doc("2024-01-02T10:00:00", temp=9.0)) == [(DAY, 10, 4.0), (date(2024, 1, 5), 0, 5.0)]
