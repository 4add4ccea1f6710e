"""Rules tried once a place give every city the alerts that its own hours would give."""

import random
from collections import defaultdict
from datetime import date, datetime

from conftest import plan, rows

from skylattice.operators.alerts import alerts_by_rules
from skylattice.schemas import HOUR_MEASURES

DAY = date(2024, 1, 2)
PLACE = {1: 1, 4: 1, 5: 1, 2: 2, 6: 2, 3: 3}


def expected(seen, rules):
    told = defaultdict(list)
    for h in seen:
        for seq, kind, measure, above, limit, city, first, last in rules:
            x = h.get(measure)
            if x is None or limit is None or city not in (None, h["IdCity"]) or (first and DAY < first) or (last and DAY > last):
                continue
            if x > limit if above else x < limit:
                text = f"{measure} {x:.2f} {'>' if above else '<'} {limit:.2f}"
                told[h["IdCity"], datetime(2024, 1, 2, h["Hour"])].append((seq, kind, text))
    return sorted((*key, min(found)[1], "; ".join(x[2] for x in sorted(found))) for key, found in told.items())


def test_own_rules_join_those_of_the_place(spark, hours, table):
    draw = random.Random(5)
    at_places = [
        {"IdCity": p, "Date": DAY, "Hour": h, **{m: draw.choice([None, draw.randint(-20, 20) / 4]) for m in HOUR_MEASURES}}
        for p in (1, 2, 3)
        for h in [*range(12), 11]  # the last hour stands twice
    ]
    rules = [
        (
            seq,
            f"rule {seq % 7}",
            draw.choice([*HOUR_MEASURES, "Snow"]),
            draw.random() < 0.5,
            draw.randint(2, 18) / 4,
            draw.choice([None, 1, 2, 3, 4, 5]),
            draw.choice([None, None, DAY, date(2024, 1, 9)]),
            draw.choice([None, None, DAY, date(2024, 1, 1)]),
        )
        for seq in draw.sample(range(100), 50)
    ]
    each = [h | {"IdCity": city} for h in at_places for city, place in PLACE.items() if place == h["IdCity"]]
    wanted = expected(each, rules)
    of_place = spark.createDataFrame(list(PLACE.items()), "IdCity bigint, _place bigint")
    assert {r[0] for r in wanted} == set(PLACE)
    assert sorted(rows(alerts_by_rules(hours(*at_places), table("AlertRules", *rules), of_place))) == wanted
    assert sorted(rows(alerts_by_rules(hours(*each), table("AlertRules", *rules)))) == wanted


def test_no_cross_join_at_places(spark, hours, table):
    of_place = spark.createDataFrame(list(PLACE.items()), "IdCity bigint, _place bigint")
    text = plan(alerts_by_rules(hours(), table("AlertRules", (1, "a", "Temp", True, 1.0, None, None, None)), of_place))
    assert "Cartesian" not in text and "NestedLoop" not in text
