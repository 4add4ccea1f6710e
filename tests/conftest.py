import os
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skylattice.schemas import RAW, TABLES  # noqa: E402
from skylattice.session import build  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build("tests", "local[4]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York"])
def any_zone(request, spark):
    """Run a test under several session time zones."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def at(text: str) -> int:
    """Epoch seconds of a UTC timestamp."""
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def doc(dt, lon=7.367, lat=45.133, temp=284.2, weather=(("Rain", "moderate rain"),), rain=None, **more):
    """One observation; ``dt`` is epoch seconds or UTC text."""
    return {
        "coord": None if lon is None else {"lon": lon, "lat": lat},
        "weather": None if weather is None else [{"main": m, "description": d} for m, d in weather],
        "main": {
            "temp": temp,
            "feels_like": more.get("feels_like", temp),
            "pressure": more.get("pressure", 1021.0),
            "humidity": more.get("humidity", 60.0),
        },
        "wind": {"speed": more.get("wind", 4.09)},
        "rain": None if rain is None else {"1h": rain},
        "clouds": {"all": more.get("clouds", 83.0)},
        "dt": at(dt) if isinstance(dt, str) else dt,
    }


@pytest.fixture
def raw(spark):
    return lambda *docs: spark.createDataFrame(list(docs), RAW)


@pytest.fixture
def table(spark):
    """A DataFrame of a declared table from tuples in column order."""
    return lambda name, *rows: spark.createDataFrame(list(rows), TABLES[name].ddl)


@pytest.fixture
def city(table):
    return table("city", (1, "Turin", 1, 7.367, 45.133), (2, "Oslo", 2, 10.75, 59.91))


@pytest.fixture
def hours(spark):
    """weather_hour from dicts; measures not given are null."""
    t = TABLES["weather_hour"]
    return lambda *rows: spark.createDataFrame(
        [tuple(r.get(c) for c in t.columns) for r in rows], t.ddl
    )


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
