from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stationcast.functions.names import slug
from stationcast.functions.numbers import round_half_even, to_fahrenheit
from stationcast.functions.weather import local_day, wet_flag, wet_label, wmo_category
from stationcast.schemas import CANDIDATES, ISO3, WMO_CATEGORIES, WMO_TEXT


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_slug_folds_names(spark):
    table = {
        "New York": "new_york", "São Paulo": "sao_paulo", "Zörnach Bay": "zornach_bay",
        "TOKYO": "tokyo", "  spaced  ": "spaced", "St. John's [old]": "st__john_s__old",
        "a<b": "a_b", "Ünïcödé": "unicode", "Sao  Paulo": "sao__paulo", "①ﬁ": "1fi",
        "Łódź": "odz", "": "", "東京": "",
    }
    df = spark.createDataFrame(list(table.items()), "name STRING, expected STRING")
    assert df.filter(slug("name") != F.col("expected")).count() == 0
    assert values(spark.createDataFrame([(None,)], "name STRING"), slug("name")) == [None]


@pytest.mark.parametrize("code, expected", [
    (0.0, "Clear"), (1.0, "Clear"), (3.0, "Cloudy"), (45.0, "Fog"), (53.0, "Drizzle"),
    (65.0, "Rain"), (82.0, "Rain"), (73.0, "Snow"), (95.0, "Thunderstorm"), (61.9, "Rain"),
    (7.0, "Unknown"), (99999.0, "Unknown"), (-1.0, "Unknown"), (None, "Unknown"),
    (float("nan"), "Unknown"), (1e20, "Unknown"),
])
def test_wmo_category(spark, code, expected):
    df = spark.createDataFrame([(code,)], "code DOUBLE")
    assert values(df, wmo_category(F.col("code"))) == [expected]


def test_lookup_tables_are_consistent():
    codes = [c for group in WMO_CATEGORIES.values() for c in group]
    assert len(codes) == len(set(codes)) == len(WMO_TEXT)
    assert set(codes) == set(WMO_TEXT)
    assert all(len(text) <= 40 for text in WMO_TEXT.values())
    assert all(len(a) == 2 and len(b) == 3 for a, b in ISO3.items())
    assert len({c["name"] for c in CANDIDATES}) == len(CANDIDATES) == 10


def test_wet_flag_and_label_treat_missing_rain_differently(spark):
    df = spark.createDataFrame([(0.1,), (0.11,), (0.0,), (None,)], "mm DOUBLE")
    assert values(df, wet_flag(F.col("mm"))) == [0.0, 1.0, 0.0, 0.0]
    assert values(df, wet_label(F.col("mm"))) == [0.0, 1.0, 0.0, None]


def test_rounding_equals_python(spark):
    rng = random.Random(3)
    numbers = [0.35, 0.25, 0.15, -0.35, -0.25, 2.5, 3.5, -2.5, 1.005, 0.0, -0.04, 12.345, 1e9 + .05]
    numbers += [rng.uniform(-100, 100) for _ in range(2000)]
    numbers += [rng.randint(-40000, 40000) / d for d in (20, 40, 200, 400, 20000) for _ in range(800)]
    df = spark.createDataFrame([(x,) for x in numbers], "x DOUBLE")
    rows = df.select("x", *[round_half_even(F.col("x"), d).alias(f"d{d}") for d in range(5)])
    for row in rows.collect():
        for digits in range(5):
            assert row[f"d{digits}"] == round(row.x, digits), (row.x, digits)


def test_rounding_keeps_null_and_rejects_many_digits(spark):
    df = spark.createDataFrame([(None,)], "x DOUBLE")
    assert values(df, round_half_even(F.col("x"), 1)) == [None]
    with pytest.raises(ValueError):
        round_half_even(F.col("x"), 9)


def test_fahrenheit(spark):
    df = spark.createDataFrame([(100.0,), (-40.0,)], "c DOUBLE")
    assert values(df, to_fahrenheit(F.col("c"))) == [212.0, -40.0]


def test_local_day_draws_the_border_in_the_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-01 03:30:00' AS n, "
                   "TIMESTAMP'2024-03-01 03:30:00Z' AS t")
    for column, kind in (("n", "timestamp_ntz"), ("t", "timestamp")):
        def day(tz):
            return str(values(df, local_day(F.col(column), kind, tz))[0])
        assert day("UTC") == "2024-03-01"
        assert day("America/New_York") == "2024-02-29"
        assert day("Asia/Tokyo") == "2024-03-01"
