import pytest
from conftest import rows
from pyspark.sql import functions as F

from skylattice.operators import dims
from skylattice.operators.dims import (
    absent_cities,
    absent_countries,
    assign_keys,
    insert_if_absent,
    number_cities,
    number_countries,
)
from skylattice.schemas import SEED as SEED_COLUMNS
from skylattice.sources.tables import in_order, seed_cities



def new_countries(seed, country):
    return number_countries(absent_countries(seed, country), country)


def new_cities(seed, country, city):
    return number_cities(absent_cities(seed, country, city), city)


SEED = [
    {"country": "Italy", "city": "Turin", "lat": 45.1, "lon": 7.3},
    {"country": "France", "city": "Paris", "lat": 48.8, "lon": 2.3},
    {"country": "Italy", "city": "Paris", "lat": 1.0, "lon": 1.0},
    {"country": "Italy", "city": "Turin", "lat": 9.0, "lon": 9.0},
]


def test_first_load_numbers_by_appearance_and_keeps_first_coordinates(spark, table):
    seed = seed_cities(spark, SEED)
    countries = new_countries(seed, table("country"))
    assert rows(countries, "IdCountry") == [(1, "Italy"), (2, "France")]
    assert rows(new_cities(seed, countries, table("city")), "IdCity") == [
        (1, "Turin", 1, 7.3, 45.1),
        (2, "Paris", 2, 2.3, 48.8),
        (3, "Paris", 1, 1.0, 1.0),
    ]


def test_second_load_adds_only_what_is_new(spark, table):
    seed = seed_cities(spark, [*SEED, {"country": "Spain", "city": "Turin", "lat": 2, "lon": 3}])
    country = table("country", (7, "Italy"), (9, "France"))
    city = table("city", (20, "Turin", 7, 0.0, 0.0))
    added = new_countries(seed, country)
    assert rows(added) == [(10, "Spain")]
    found = new_cities(seed, country.unionByName(added), city)
    assert rows(found, "IdCity") == [
        (21, "Paris", 9, 2.3, 48.8),
        (22, "Paris", 7, 1.0, 1.0),
        (23, "Turin", 10, 3.0, 2.0),
    ]


def test_keys_are_dense_and_ordered_across_ranges(spark, table, monkeypatch):
    monkeypatch.setattr(dims, "KEY_RANGE", 10)
    new = spark.range(200).select((F.col("id") * 3).alias("seq"), F.col("id").cast("string").alias("CountryName"))
    found = assign_keys(new.repartition(7), table("country", (100, "x")), "IdCountry", "seq")
    assert [r.IdCountry for r in found.orderBy("seq").collect()] == list(range(101, 301))
    sparse = new.withColumn("seq", F.col("seq") * 12345 * F.col("seq"))
    found = assign_keys(sparse.repartition(7), table("country", (100, "x")), "IdCountry", "seq")
    assert [r.IdCountry for r in found.orderBy("seq").collect()] == list(range(101, 301))
    assert found.schema["IdCountry"].dataType.simpleString() == "int"


def test_insert_if_absent_first_wins(spark):
    new = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c"), (3, 1, "d")], "k int, o int, v string")
    held = spark.createDataFrame([(2,)], "k int")
    assert rows(insert_if_absent(new, held, ["k"], [F.asc("o")]).select("k", "v"), "k") == [(1, "a"), (3, "d")]
    unique = new.filter("o = 1")
    assert rows(insert_if_absent(unique, held, ["k"]).select("v"), "k") == [("a",), ("d",)]


def test_seed_file(spark, tmp_path):
    (tmp_path / "s.csv").write_text("country,city,lat,lon,seq\nItaly,Turin,45.1,7.3,0\n")
    assert rows(seed_cities(spark, str(tmp_path / "s.csv"), "csv")) == [("Italy", "Turin", 45.1, 7.3, 0)]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_seed_file_without_positions(spark, table, tmp_path, fmt):
    listed = spark.createDataFrame([(s["country"], s["city"], float(s["lat"]), float(s["lon"])) for s in SEED], "country string, city string, lat double, lon double")
    listed.repartition(3).write.format(fmt).option("header", "true").save(str(tmp_path / "seed"))
    seed = seed_cities(spark, str(tmp_path / "seed"), fmt)
    assert rows(seed.select("country", "city", "lat", "seq"), "seq") == [
        ("France", "Paris", 48.8, 0), ("Italy", "Paris", 1.0, 1), ("Italy", "Turin", 9.0, 2), ("Italy", "Turin", 45.1, 3),
    ]
    assert rows(new_countries(seed, table("country")), "IdCountry") == [(1, "France"), (2, "Italy")]


@pytest.mark.parametrize("given", [[0, 0], [0, None], [-1, 3]])
def test_seed_positions_must_be_unique_and_whole(spark, given):
    seed = spark.createDataFrame([("a", str(i), 0.0, 0.0, s) for i, s in enumerate(given)], SEED_COLUMNS)
    with pytest.raises(ValueError):
        in_order(seed)


def test_seed_entries_need_names(spark):
    with pytest.raises(ValueError, match="1 seed entries"):
        in_order(spark.createDataFrame([(None, "x", 0.0, 0.0, 1), ("a", "x", 0.0, 0.0, 2)], SEED_COLUMNS))
