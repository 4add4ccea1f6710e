"""Declared schemas: the nested raw observation and the relational tables.

Schemas are DDL text, which every Spark reader takes as is. ``IdCity`` is BIGINT because a
city dimension may outgrow 32 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt"
OBS_DATE = "obs_date"

# Field names and types of one observation document.
RAW = """
    coord struct<lon: double, lat: double>,
    weather array<struct<id: int, main: string, description: string, icon: string>>,
    base string,
    main struct<temp: double, feels_like: double, temp_min: double, temp_max: double,
                pressure: double, humidity: double, sea_level: double, grnd_level: double>,
    visibility int,
    wind struct<speed: double, deg: double, gust: double>,
    rain struct<`1h`: double>,
    clouds struct<all: double>,
    dt bigint,
    sys struct<type: int, id: bigint, country: string, sunrise: bigint, sunset: bigint>,
    timezone int,
    id bigint,
    name string,
    cod int
"""
RAW_WITH_CORRUPT = f"{RAW}, {CORRUPT} string"
#: The landed document with every field it had, declared or not; the text itself is kept only where it
#: is no JSON. The digest of the text tells documents apart.
BODY, DOCUMENT, DIGEST = "body", "document", "digest"
RAW_LANDED = f"{RAW_WITH_CORRUPT}, {BODY} variant, {DOCUMENT} string, {DIGEST} binary"

SEED = "country string, city string, lat double, lon double, seq bigint"


@dataclass(frozen=True)
class Table:
    """One relational table: column types, key, columns that may not be null, partitioning.

    ``unique`` names further keys, such as the number beside a name.
    """

    name: str
    columns: dict[str, str]
    keys: tuple[str, ...]
    not_null: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.columns.items())


def _day(name: str, prefix: str, extra: tuple[str, ...] = ()) -> Table:
    measures = [f"{prefix}Min", f"{prefix}Max", f"{prefix}Avg", *extra]
    columns = {"IdCity": "bigint", "Date": "date"} | dict.fromkeys(measures, "double")
    return Table(name, columns, ("IdCity", "Date"), tuple(columns), ("Date",))


def _summary(name: str, period: str) -> Table:
    # The averages a month or week row carries, in table order.
    averages = ["AvgTemp", "AvgHumidity", "AvgRain", "AvgWind", "TempVariation"]
    columns = {"IdCity": "bigint", "Year": "int", period: "int"} | dict.fromkeys(averages, "double")
    return Table(name, columns, ("IdCity", "Year", period), tuple(columns), ("Year", period))


# The measures of an hourly row, in table order.
HOUR_MEASURES = ["Temp", "FeelsLike", "Clouds", "Rain", "Wind", "Pressure", "Humidity"]

# Daily family -> (table, column prefix, extra averages).
DAY_FAMILIES = {
    "Temp": ("temperature_day", "Temp", ("AvgFeelsLike",)),
    "Wind": ("wind_day", "Wind", ()),
    "Humidity": ("humidity_day", "Humidity", ()),
    "Rain": ("rain_day", "Rain", ()),
    "Pressure": ("pressure_day", "Pressure", ()),
}

TABLES = {
    t.name: t
    for t in [
        Table(
            "country",
            {"IdCountry": "int", "CountryName": "string"},
            ("CountryName",),
            ("IdCountry", "CountryName"),
            unique=(("IdCountry",),),
        ),
        Table(
            "city",
            {
                "IdCity": "bigint",
                "CityName": "string",
                "IdCountry": "int",
                "Lon": "double",
                "Lat": "double",
            },
            ("CityName", "IdCountry"),
            ("IdCity", "CityName", "Lon", "Lat"),
            unique=(("IdCity",),),
        ),
        Table(
            "weather_hour",
            {"IdCity": "bigint", "Date": "date", "Hour": "int"}
            | dict.fromkeys(HOUR_MEASURES, "double"),
            ("IdCity", "Date", "Hour"),
            ("IdCity", "Date", "Hour"),
            ("Date",),
        ),
        *(_day(*family) for family in DAY_FAMILIES.values()),
        Table(
            "weather_condition_day",
            {
                "IdCity": "bigint",
                "Date": "date",
                "WeatherMain": "string",
                "WeatherDescription": "string",
            },
            ("IdCity", "Date"),
            ("IdCity", "Date", "WeatherMain", "WeatherDescription"),
            ("Date",),
        ),
        _summary("AVG_month", "Month"),
        _summary("AVGWeek", "NumWeek"),
        Table(
            "Week",
            {"IdWeek": "int", "NumWeek": "int", "DateIni": "date", "DateEnd": "date"},
            ("IdWeek",),
            ("IdWeek", "NumWeek", "DateIni", "DateEnd"),
        ),
        Table(
            "WeatherAlerts",
            {
                "IdCity": "bigint",
                "Timestamp": "timestamp_ntz",
                "AlertType": "string",
                "Details": "string",
            },
            ("IdCity", "Timestamp"),
            ("IdCity", "Timestamp", "AlertType"),
        ),
        Table(
            "AlertRules",
            {
                "Seq": "bigint",
                "AlertType": "string",
                "Measure": "string",
                "Above": "boolean",
                "Limit": "double",
                "IdCity": "bigint",
                "ValidFrom": "date",
                "ValidTo": "date",
            },
            ("Seq",),
            ("Seq", "AlertType", "Measure", "Above", "Limit"),
        ),
    ]
}


# The sums that an average is kept as.
PARTS = ("high", "low", "rest", "count")

#: What jobs keep for their next run: for each lot the sums of a cell and hour, and the counts of its
#: conditions; hours without gaps, and the values last known at the end of a filled period.
STATES = {
    t.name: t
    for t in [
        Table(
            "cell_hour",
            {"lon_c": "int", "lat_c": "int", "Date": "date", "Hour": "int", "Lot": "string"}
            | {f"{m}_{p}": "bigint" for m in HOUR_MEASURES for p in PARTS},
            ("lon_c", "lat_c", "Date", "Hour", "Lot"),
            ("Date", "Hour", "Lot"),
            ("Date", "Lot"),
        ),
        Table(
            "cell_condition",
            {
                "lon_c": "int",
                "lat_c": "int",
                "Date": "date",
                "WeatherMain": "string",
                "WeatherDescription": "string",
                "Lot": "string",
                "cnt": "bigint",
            },
            ("lon_c", "lat_c", "Date", "WeatherMain", "WeatherDescription", "Lot"),
            ("Date", "Lot"),
            ("Date", "Lot"),
        ),
        Table(
            "hour_filled",
            {"IdCity": "bigint", "Date": "date", "Hour": "int"}
            | dict.fromkeys(HOUR_MEASURES, "double")
            | {"Filled": "boolean"},
            ("IdCity", "Date", "Hour"),
            ("IdCity", "Date", "Hour", "Filled"),
            ("Date",),
        ),
        Table(
            "last_known",
            {"IdCity": "bigint", "AsOf": "date"} | dict.fromkeys(HOUR_MEASURES, "double"),
            ("IdCity", "AsOf"),
            ("IdCity", "AsOf"),
            ("AsOf",),
        ),
    ]
}


def declared(name: str) -> Table:
    return TABLES[name] if name in TABLES else STATES[name]


def to_table(df: DataFrame, table: Table) -> DataFrame:
    """Select and cast the columns of ``table``, in table order."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in table.columns.items()))
