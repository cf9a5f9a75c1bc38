from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from stationcast import sources
from stationcast.session import scratch_path, shared_dir
from tests.conftest import make_days, to_spark


def test_csv_round_trip(spark, tmp_path):
    days = to_spark(spark, make_days(5))
    path = str(tmp_path / "obs")
    sources.export_csv(days.unionByName(days.limit(3)), path)
    back = sources.scan_observations_csv(spark, path)
    assert back.columns == days.columns
    assert back.exceptAll(days).count() == 0 and back.count() == 15


def test_csv_keeps_the_first_of_equal_city_days(spark, tmp_path):
    lines = ["city,latitude,longitude,date,temp_mean_c,temp_max_c,temp_min_c,precip_mm,wmo_code"]
    for day in range(1, 29):
        for temp in (50 + day, 10, 99):
            lines.append(f"Oslo,59.9,10.7,2021-01-{day:02d},{temp},{temp},{temp},,")
    (tmp_path / "obs.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = sources.scan_observations_csv(spark, str(tmp_path / "obs.csv")).collect()
    assert {r.date.day: r.temp_mean_c for r in rows} == {d: 50.0 + d for d in range(1, 29)}
    assert all(r.precip_mm is None and r.wmo_code is None for r in rows)


def test_csv_rejects_text_in_a_number(spark, tmp_path):
    path = str(tmp_path / "obs")
    days = to_spark(spark, make_days(2))
    sources.export_csv(days.withColumn("precip_mm", F.lit("wet")), path)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        sources.scan_observations_csv(spark, path).collect()


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    days = to_spark(spark, make_days(2))
    path = str(tmp_path / "obs")
    sources.export_csv(days.select(F.lit("x").alias("note"), *reversed(days.columns)), path)
    assert sources.scan_observations_csv(spark, path).exceptAll(days).count() == 0


def test_csv_needs_all_nine_columns(spark, tmp_path):
    path = str(tmp_path / "obs")
    sources.export_csv(to_spark(spark, make_days(2)).drop("latitude"), path)
    with pytest.raises(ValueError, match="latitude"):
        sources.scan_observations_csv(spark, path)


def test_json_export_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    sources.export_json(spark.createDataFrame(
        [("Portland", None, date(2021, 1, 1))], "city_name STRING, temp_c DOUBLE, day DATE"), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert lines == [{"city_name": "Portland", "temp_c": None, "day": "2021-01-01"}]


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError, match="unknown data source"):
        sources.load_observations(spark, "ftp", "x")


def test_csv_and_star_schema_give_equal_days(spark, tmp_path):
    days = to_spark(spark, make_days(6)).drop("latitude", "longitude")
    ids = {"Brackwater": 1, "Umberfeld": 2, "Zörnach Bay": 3}
    city_ids = spark.createDataFrame(list(ids.items()), "city STRING, city_id INT")
    readings = days.join(city_ids, "city").select(
        F.monotonically_increasing_id().alias("data_id"), "city_id",
        F.col("date").cast("timestamp").alias("dtg"),
        F.col("temp_mean_c").cast("decimal(4,1)").alias("temp_c"),
        F.lit(None).cast("decimal(3,2)").alias("humidity"),
        F.lit(None).cast("decimal(3,2)").alias("precip_chance"),
        F.col("precip_mm").cast("int").alias("precip_mm"),
        F.col("wmo_code").cast("int").cast("string").alias("wmo_code"))
    empty = {n: spark.createDataFrame([], s) for n, s in {
        "states": "state_id INT", "admin_div_1": "div1_id INT", "wmo_codes": "wmo_code STRING",
    }.items()}
    path = str(tmp_path / "star")
    sources.write_star_schema({
        **empty, "wx_data": readings,
        "cities": city_ids.select("city_id", F.col("city").alias("city_name"))}, path)
    coordinates = spark.createDataFrame(
        [("brackwater", 40.0, -74.0), ("umberfeld", -33.0, 151.0), ("zornach_bay", 10.0, 20.0)],
        "slug STRING, latitude DOUBLE, longitude DOUBLE")
    out = sources.load_observations(spark, "db", path, coordinates)
    assert out.columns[:4] == ["city", "latitude", "longitude", "date"]
    both = out.alias("a").join(days.alias("b"), ["city", "date"])
    assert both.count() == 18
    assert both.filter("a.temp_mean_c <> b.temp_mean_c OR a.temp_max_c <> b.temp_mean_c "
                       "OR a.wmo_code <> b.wmo_code").count() == 0
    with pytest.raises(ValueError, match="no coordinates"):
        sources.load_observations(spark, "db", path, coordinates.limit(1))


def test_empty_star_schema_is_an_error(spark, tmp_path):
    from stationcast.plans.jobs import empty_star_schema

    empty_star_schema(spark, str(tmp_path))
    coordinates = spark.createDataFrame([], "slug STRING, latitude DOUBLE, longitude DOUBLE")
    with pytest.raises(ValueError, match="no observations"):
        sources.load_observations(spark, "db", str(tmp_path), coordinates)


def payload_days(spark, payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    df = spark.createDataFrame([("Oslo", 59.9, 10.7, text)],
                               "city STRING, latitude DOUBLE, longitude DOUBLE, payload STRING")
    return sources.payload_rows(df).orderBy("date").collect()


def test_payload_rows_follow_the_time_array(spark):
    rows = payload_days(spark, {"daily": {
        "time": ["2021-01-01", "2021-01-02", "2021-01-03"],
        "temperature_2m_mean": [1.5, None], "temperature_2m_max": [],
        "precipitation_sum": [0, 1, 2, 3, 4], "weather_code": [61, 3, 0]}})
    assert [r.date.day for r in rows] == [1, 2, 3]
    assert [r.temp_mean_c for r in rows] == [1.5, None, None]
    assert [r.temp_max_c for r in rows] == [r.temp_min_c for r in rows] == [None] * 3
    assert [r.precip_mm for r in rows] == [0.0, 1.0, 2.0]
    assert [r.wmo_code for r in rows] == [61, 3, 0]


@pytest.mark.parametrize("payload", [{}, {"daily": None}, {"daily": {}}, {"daily": {"time": []}},
                                     {"daily": {"weather_code": [1]}}])
def test_payload_without_days_gives_no_rows(spark, payload):
    assert payload_days(spark, payload) == []


def test_broken_payload_is_an_error(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        payload_days(spark, '{"daily": {"time": ["2021-01-01"')


def test_geocode_map(spark):
    def place(name, lat, lon):
        return {"name": name, "latitude": lat, "longitude": lon, "timezone": "UTC",
                "country": "", "country_code": "", "admin1": ""}
    document = {"São Paulo|BR": place("São Paulo", -23.5, -46.6), "X|": place("X", None, 1.0),
                "Oslo|NO": place("Oslo", 1.0, 1.0), "oslo|": place("OSLO", 59.9, 10.7)}
    df = spark.createDataFrame([(json.dumps(document),)], "json STRING")
    rows = {r.slug: (r.name, r.latitude, r.longitude)
            for r in sources.scan_geocode_map(df).collect()}
    assert rows == {"sao_paulo": ("São Paulo", -23.5, -46.6), "oslo": ("OSLO", 59.9, 10.7)}
    assert sources.extract_places(df).count() == 4


def test_jdbc_schema_name_is_checked(spark):
    with pytest.raises(ValueError, match="identifier"):
        sources.scan_star_schema_jdbc(spark, "jdbc:x", "bad; name", 4, (1, 10))


def test_trailing_years():
    assert sources.trailing_years(5, date(2024, 12, 31)) == (date(2019, 12, 31), date(2024, 12, 31))
    assert sources.trailing_years(1, date(2024, 2, 29))[0] == date(2023, 2, 28)
    assert sources.trailing_years(4, date(2024, 2, 29))[0] == date(2020, 2, 29)
    now = datetime(2024, 3, 1, 5, tzinfo=timezone.utc)
    assert sources.trailing_years(1, now=now) == (date(2023, 2, 28), date(2024, 2, 29))
    assert sources.trailing_years(5, date(2024, 1, 1), date(2023, 1, 1))[0] == date(2023, 1, 1)
    with pytest.raises(ValueError, match="on or before"):
        sources.trailing_years(5, date(2020, 1, 1), date(2021, 1, 1))


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_dir(spark))


def test_csv_folder_with_differing_headers_is_refused(spark, tmp_path):
    columns = "city,latitude,longitude,date,temp_mean_c,temp_max_c,temp_min_c,precip_mm,wmo_code"
    (tmp_path / "a.csv").write_text(f"{columns}\nVarn,1,2,2021-01-01,10,20,5,0,1\n")
    same = sources.scan_observations_csv(spark, str(tmp_path)).collect()
    assert [(r.temp_mean_c, r.temp_max_c) for r in same] == [(10.0, 20.0)]
    swapped = columns.replace("temp_mean_c,temp_max_c", "temp_max_c,temp_mean_c")
    for other in (f"{swapped}\nVarn,1,2,2021-01-02,20,10,5,0,1\n",
                  f"{columns.removesuffix(',wmo_code')}\nVarn,1,2,2021-01-02,10,20,5,0\n"):
        (tmp_path / "b.csv").write_text(other)
        with pytest.raises(Exception, match="(?i)header"):
            sources.scan_observations_csv(spark, str(tmp_path)).collect()


def test_tables_of_either_reader_serve_as_source(spark, tmp_path):
    days = to_spark(spark, make_days(4))
    readings = days.select(
        F.lit(1).alias("city_id"), F.col("date").cast("timestamp").alias("dtg"),
        F.col("temp_mean_c").cast("decimal(4,1)").alias("temp_c"),
        F.col("precip_mm").cast("int").alias("precip_mm"), F.lit("61").alias("wmo_code"))
    cities = spark.createDataFrame([(1, "Brackwater")], "city_id INT, city_name STRING")
    places = spark.createDataFrame([("brackwater", 54.2, -2.9)],
                                   "slug STRING, latitude DOUBLE, longitude DOUBLE")
    out = sources.load_observations(spark, "db", {"wx_data": readings, "cities": cities}, places)
    assert out.count() == 4
