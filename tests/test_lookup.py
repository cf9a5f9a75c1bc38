from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stationcast.functions.names import slug
from stationcast.operators import export, lookup, rollup
from stationcast.operators.features import build_features

KNOWN = ["Marwick", "East Hollow", "Solmar", "Sänt Piro", "Kettlefoss"]


def known(spark, names=KNOWN):
    return spark.createDataFrame([(n,) for n in names], "city STRING")


def ask(spark, texts, names=KNOWN):
    requests = spark.createDataFrame([(t,) for t in texts], "query STRING")
    rows = lookup.match_city(requests, known(spark, names)).collect()
    return {r["query"]: (r.city, r.reason) for r in rows}


def test_match_city(spark):
    expected = {
        "East Hollow": "East Hollow", "east hollow": "East Hollow", "EAST HOLLOW": "East Hollow",
        "east_hollow": "East Hollow", "Sänt Piro": "Sänt Piro", "sant piro": "Sänt Piro",
        "kett": "Kettlefoss", "marw": "Marwick",
    }
    refused = {"Nowhere": "unknown city", "Sant  Piro": "unknown city", "s": "ambiguous city: 2 fit, from Solmar to Sänt Piro",
               "": "ambiguous city: 5 fit, from East Hollow to Sänt Piro", "Kettlefoss Tower": "unknown city"}
    got = ask(spark, [*expected, *refused])
    assert got == {**{k: (v, None) for k, v in expected.items()},
                   **{k: (None, v) for k, v in refused.items()}}


def test_exact_name_wins_over_prefix(spark):
    assert ask(spark, ["Pell", "Pell R"], ["Pell", "Pell Ridge"]) == {
        "Pell": ("Pell", None), "Pell R": ("Pell Ridge", None)}


def test_empty_text_matches_a_lone_city_and_equal_folds_take_the_first(spark):
    assert ask(spark, [""], ["Varn"]) == {"": ("Varn", None)}
    assert ask(spark, ["sant piro", "sant"], ["Sänt Piro", "Sant Piro"]) == {
        "sant piro": ("Sant Piro", None), "sant": (None, "ambiguous city: 2 fit, from Sant Piro to Sänt Piro")}


def test_matching_needs_no_pairwise_join(spark):
    requests = spark.createDataFrame([("kett",)], "query STRING")
    plan = lookup.match_city(requests, known(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_attach_coordinates(spark):
    days = spark.createDataFrame([("Sant Piro", 1), ("Marwick", 2)], "city STRING, v INT")
    places = spark.createDataFrame([("Sänt Piro", -23.5, -46.6), ("Marwick", 51.5, 0.0)],
                                   "name STRING, latitude DOUBLE, longitude DOUBLE")
    places = places.withColumn("slug", slug("name"))
    out = lookup.attach_coordinates(days, places)
    assert out.columns == ["city", "latitude", "longitude", "v"]
    assert {r.city: r.latitude for r in out.collect()} == {"Sant Piro": -23.5, "Marwick": 51.5}
    some = places.filter("name = 'Marwick'")
    with pytest.raises(ValueError, match="Sant Piro"):
        lookup.attach_coordinates(days, some)
    assert lookup.attach_coordinates(days, some, strict=False).filter(
        "latitude IS NULL").count() == 1


def test_requests_to_features(spark, days):
    features = build_features(days)
    requests = spark.createDataFrame(
        [("Brackwater", datetime(2021, 5, 1, 18, 30)), ("Brackwater", datetime(1999, 1, 1)),
         ("Brackwater", datetime(2021, 1, 5)), ("Umberfeld", datetime(2021, 5, 30))],
        "city STRING, as_of TIMESTAMP")
    rows = {(r.city, r.as_of): r
            for r in lookup.requests_to_features(requests, features).collect()}
    assert len(rows) == 4
    assert rows["Brackwater", date(2021, 5, 1)].temp_mean_c is not None
    assert rows["Umberfeld", date(2021, 5, 30)].reason is None
    for day in (date(1999, 1, 1), date(2021, 1, 5)):
        reason = rows["Brackwater", day].reason
        assert "no usable history for Brackwater" in reason
        assert "2021-01-30 to 2021-06-09" in reason


def test_point_lookup(spark):
    t = datetime(2021, 1, 1, 6)
    readings = spark.createDataFrame(
        [(1, t, 1.0, 0.5, 0.1, 2), (1, t, 2.0, 0.5, 0.1, 2)],
        "city_id INT, dtg TIMESTAMP, temp_c DOUBLE, humidity DOUBLE, precip_chance DOUBLE, "
        "precip_mm INT")
    cities = spark.createDataFrame([(1, "Varn")], "city_id INT, city_name STRING")
    requests = spark.createDataFrame(
        [("Varn", t), (None, t), ("Varn", None), ("Rome", t)], "city STRING, dtg TIMESTAMP")
    rows = lookup.point_lookup(requests, readings, cities).collect()
    assert sorted(r.status for r in rows) == [
        "no city given", "no dtg given", "not found", "ok", "ok"]
    assert sorted(r.temp_c for r in rows if r.status == "ok") == [1.0, 2.0]


def test_gazetteer_prefers_the_wanted_country(spark):
    rows = [("Marwick", "GB", 1, "CA", "Marwick, Ontario"), ("Marwick", "GB", 2, "GB", "Marwick"),
            ("Marwick", "GB", 3, "GB", "Marwickderry"), ("Paris", "BR", 1, "FR", "Paris"),
            ("Paris", "BR", 2, "US", "Paris, Texas"), ("Rome", "", 1, "US", "Rome, Georgia"),
            ("Rome", "", 2, "IT", "Rome")]
    df = spark.createDataFrame(
        rows, "query STRING, wanted_country STRING, rank INT, country_code STRING, name STRING")
    got = {r["query"]: r.name for r in lookup.gazetteer_pick(df).collect()}
    assert got == {"Marwick": "Marwick", "Paris": "Paris", "Rome": "Rome, Georgia"}


def test_gazetteer_fills_missing_fields(spark):
    df = spark.createDataFrame(
        [("Varn", None, 1, None, None, None)], "query STRING, wanted_country STRING, rank INT, "
        "country_code STRING, name STRING, timezone STRING")
    assert tuple(lookup.gazetteer_pick(df).first()) == ("Varn", None, 1, "", "Varn", "UTC")


def test_cutoff_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT id, TIMESTAMP'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS dtg "
              "FROM range(100)").write.parquet(str(tmp_path / "f"))
    df = export.recent_since_cutoff(spark.read.parquet(str(tmp_path / "f")),
                                    datetime(2024, 4, 9, 12), 10)
    assert df.count() == 10
    assert "GreaterThanOrEqual(dtg," in df._jdf.queryExecution().executedPlan().toString()


def test_equal_city_names_are_refused(spark):
    readings = spark.createDataFrame(
        [(1, datetime(2021, 1, 1), 1.0, 0, "61"), (2, datetime(2021, 1, 1, 5), 2.0, 0, "61")],
        "city_id INT, dtg TIMESTAMP, temp_c DOUBLE, precip_mm INT, wmo_code STRING")
    cities = spark.createDataFrame([(1, "Twin"), (2, "Twin")], "city_id INT, city_name STRING")
    days = rollup.daily_rollup(readings, cities)
    assert days.count() == 2
    with pytest.raises(ValueError, match="Twin"):
        rollup.require_unique_names(days)


def test_minimum_readings_and_local_days(spark):
    readings = spark.createDataFrame(
        [(1, datetime(2021, 1, 1, 1), 1.0, 1, " 3"), (1, datetime(2021, 1, 1, 2), None, 2, ""),
         (1, datetime(2021, 1, 1, 23), 5.0, None, None), (1, datetime(2021, 1, 2, 1), None, 1, "3")],
        "city_id INT, dtg TIMESTAMP, temp_c DOUBLE, precip_mm INT, wmo_code STRING")
    cities = spark.createDataFrame([(1, "Varn")], "city_id INT, city_name STRING")
    day = rollup.daily_rollup(readings, cities).collect()
    assert [tuple(r) for r in day] == [("Varn", date(2021, 1, 1), 3.0, 5.0, 1.0, 3.0, 3)]
    assert rollup.daily_rollup(readings, cities, min_obs=3).count() == 0
    assert rollup.daily_rollup(readings, cities, min_obs=0).count() == 2
    kettyo = rollup.daily_rollup(readings, cities, tz="Asia/Tokyo").orderBy("date").collect()
    assert [(r.date.day, r.temp_mean_c) for r in kettyo] == [(1, 1.0), (2, 5.0)]


def test_first_coordinates_skip_nulls_per_column(spark):
    df = spark.createDataFrame(
        [("A", date(2021, 1, 1), None, 5.0), ("A", date(2021, 1, 2), 7.0, 6.0),
         ("B", date(2021, 1, 1), None, None)],
        "city STRING, date DATE, latitude DOUBLE, longitude DOUBLE")
    got = {r.city: (r.latitude, r.longitude) for r in rollup.first_coordinates(df).collect()}
    assert got == {"A": (7.0, 5.0), "B": (None, None)}
