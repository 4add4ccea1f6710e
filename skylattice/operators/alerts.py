"""Threshold alerts on hourly rows, by rules in code or in a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.functions.time import hour_start
from skylattice.operators.places import at_cities
from skylattice.schemas import HOUR_MEASURES, TABLES, to_table


@dataclass(frozen=True)
class Rule:
    """Raise ``alert`` where ``measure`` lies above (``>``) or below (``<``) ``limit``."""

    alert: str
    measure: str
    above: bool
    limit: float

    @property
    def fires(self) -> Column:
        x = F.col(self.measure)
        return x > F.lit(self.limit) if self.above else x < F.lit(self.limit)

    @property
    def detail(self) -> Column:
        sign = ">" if self.above else "<"
        return F.format_string(f"{self.measure} %.2f {sign} {self.limit:.2f}", F.col(self.measure))


def alerts(weather_hour: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``WeatherAlerts`` rows: at most one per city and hour.

    The original design declares the table only; the rules and texts are ours. The first rule
    that fires, in the given order, names the alert and ``Details`` lists all that fire. The
    rules are expressions on the row, so nothing is joined or shuffled.
    """
    kinds = F.filter(
        F.array(*(F.when(r.fires, F.lit(r.alert)) for r in rules)), lambda x: x.isNotNull()
    )
    details = F.concat_ws("; ", *(F.when(r.fires, r.detail) for r in rules))
    fired = weather_hour.withColumns(
        {
            "Timestamp": hour_start(F.col("Date"), F.col("Hour")),
            "AlertType": F.get(kinds, 0),
            "Details": details,
        }
    ).filter(F.col("AlertType").isNotNull())
    return to_table(fired, TABLES["WeatherAlerts"])


def alerts_by_rules(weather_hour: DataFrame, rules: DataFrame, of_place: DataFrame | None = None) -> DataFrame:
    """``WeatherAlerts`` rows by an ``AlertRules`` table: at most one per city and hour.

    A rule holds for one city or, without ``IdCity``, for all; from ``ValidFrom`` to ``ValidTo``, each open if
    null. Of the rules that fire, the one of the smallest ``Seq`` names the alert and ``Details`` lists all in
    that order. A rule of an unknown measure never fires.

    The rules of all cities are one list, tried once an hour. Those of a city meet its hours by ``IdCity``, also as
    one list. With ``of_place`` (``places.members``) the hours are those of places, and alerts go to every city: the
    rules of all cities are then tried once a place, and a city's row adds its own.
    """
    known = rules.filter(F.col("Measure").isin(HOUR_MEASURES)).withColumns(
        {
            "at": F.array_position(F.array(*map(F.lit, HOUR_MEASURES)), F.col("Measure")).cast("int") - 1,
            "says": F.format_string(" %s %.2f", F.when(F.col("Above"), ">").otherwise("<"), F.col("Limit")),
        }
    )
    rule = F.collect_list(F.struct("Seq", "AlertType", "Above", "Limit", "ValidFrom", "ValidTo", "at", "says"))
    shared = known.filter(F.col("IdCity").isNull()).agg(rule.alias("_shared"))
    own = known.filter(F.col("IdCity").isNotNull()).groupBy("IdCity").agg(rule.alias("_own"))

    def fires(r: Column, seen: Column) -> Column:
        x = F.get(seen, r["at"])["x"]
        valid = F.coalesce(F.col("Date") >= r["ValidFrom"], F.lit(True)) & F.coalesce(F.col("Date") <= r["ValidTo"], F.lit(True))
        return valid & F.coalesce(F.when(r["Above"], x > r["Limit"]).otherwise(x < r["Limit"]), F.lit(False))

    def told(r: Column, seen: Column) -> Column:
        return F.struct(r["Seq"].alias("Seq"), r["AlertType"].alias("AlertType"), F.concat(F.get(seen, r["at"])["text"], r["says"]).alias("Detail"))

    def fired(of: str) -> Column:
        """The rules of a list that fire in any row of the hour, in order."""
        each = F.transform("_rows", lambda seen: F.transform(F.filter(of, lambda r: fires(r, seen)), lambda r: told(r, seen)))
        return F.array_sort(F.flatten(each))

    def listed(told: Column) -> Column:
        return F.array_join(F.transform(told, lambda x: x["Detail"]), "; ")

    # An hour that stands twice counts twice, as its alerts are one row all the same.
    readings = F.array(*(F.struct(F.col(m).alias("x"), F.format_string(f"{m} %.2f", F.col(m)).alias("text")) for m in HOUR_MEASURES))
    by_hour = weather_hour.groupBy("IdCity", "Date", "Hour").agg(F.collect_list(readings).alias("_rows"))
    tried = by_hour.withColumn("_shared", shared.scalar()).withColumn("_all", fired("_shared")).drop("_shared")
    tried = tried.withColumn("_text", listed(F.col("_all")))
    if of_place is None:
        met = tried.join(own, "IdCity", "left")
    else:
        met = at_cities(tried, of_place.join(own, "IdCity", "left"))
    none = F.array().cast("array<struct<Seq: bigint, AlertType: string, Detail: string>>")
    met = met.withColumn("_more", F.coalesce(fired("_own"), none)).filter((F.size("_all") > 0) | (F.size("_more") > 0))
    both, more = F.array_sort(F.concat("_all", "_more")), listed(F.col("_more"))
    # Mostly one list comes after the other and need not be sorted into it.
    before = F.element_at("_more", -1) <= F.get("_all", 0)
    after = F.element_at("_all", -1) <= F.get("_more", 0)

    def by_case(only_shared: Column, only_own: Column, own_first: Column, own_last: Column, mixed: Column) -> Column:
        one = F.when(F.size("_more") == 0, only_shared).when(F.size("_all") == 0, only_own)
        return one.when(before, own_first).when(after, own_last).otherwise(mixed)

    kind, own_kind = F.get("_all", 0)["AlertType"], F.get("_more", 0)["AlertType"]
    rows = met.select(
        "IdCity",
        hour_start(F.col("Date"), F.col("Hour")).alias("Timestamp"),
        by_case(kind, own_kind, own_kind, kind, F.get(both, 0)["AlertType"]).alias("AlertType"),
        by_case(F.col("_text"), more, F.concat_ws("; ", more, "_text"), F.concat_ws("; ", "_text", more), listed(both)).alias("Details"),
    )
    return to_table(rows, TABLES["WeatherAlerts"])
