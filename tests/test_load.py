from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stationcast.operators import load, quality
from stationcast.operators.ordering import dense_numbers, running_totals
from stationcast.operators.rejects import RejectedRows
from stationcast.plans import jobs
from stationcast.schemas import OBS_SCHEMA
from stationcast.sources import Warehouse, scan_star_schema
from tests.conftest import make_days, to_spark

PLACES = [
    ("Brackwater", "United States", "US", "Ohio"),
    ("Umberfeld", "Australia", "AU", ""),
    ("Zörnach Bay", "Brazil", "BR", None),
]
PLACE_SCHEMA = "city STRING, country STRING, country_code STRING, admin1 STRING"


@pytest.fixture
def star(spark, tmp_path):
    path = str(tmp_path / "star")
    jobs.empty_star_schema(spark, path)
    return path


def places(spark, rows=PLACES):
    return spark.createDataFrame(rows, PLACE_SCHEMA)


def test_normalize_keeps_the_first_ingested_row(spark):
    frame = to_spark(spark, make_days(20)).withColumn("seq", F.lit(1))
    wrong = frame.withColumn("temp_mean_c", F.lit(999.0)).withColumn("seq", F.lit(2))
    out = load.normalize(wrong.unionByName(frame), ingest_order="seq")
    assert out.columns == [f.name for f in OBS_SCHEMA.fields]
    assert out.count() == 60 and out.filter("temp_mean_c = 999").count() == 0


def test_normalize_checks_columns_and_turns_nan_into_null(spark):
    with pytest.raises(ValueError, match="missing column.*precip_mm"):
        load.normalize(spark.createDataFrame([("A", "2021-01-01")], "city STRING, date STRING"))
    frame = to_spark(spark, make_days(2)).withColumn("precip_mm", F.lit(float("nan")))
    assert load.normalize(frame).filter("precip_mm IS NULL").count() == 6


def test_storage_rows_round_like_python(spark):
    obs = spark.createDataFrame(
        [("A", date(2021, 1, 1), 0.35, 2.5, 61.0), ("A", date(2021, 1, 2), 0.25, 3.5, None),
         ("A", date(2021, 1, 3), None, None, 3.0)],
        "city STRING, date DATE, temp_mean_c DOUBLE, precip_mm DOUBLE, wmo_code DOUBLE")
    ids = spark.createDataFrame([("A", 7)], "city STRING, city_id INT")
    rows = sorted(load.to_storage_rows(obs, ids).collect(), key=lambda r: r.dtg)
    assert [float(r.temp_c) if r.temp_c is not None else None for r in rows] == [0.3, 0.2, None]
    assert [r.precip_mm for r in rows] == [2, 4, None]
    assert [r.wmo_code for r in rows] == ["61", None, "3"]
    assert rows[0].dtg == datetime(2021, 1, 1) and rows[0].city_id == 7


def test_loading_twice_inserts_nothing_new(spark, star):
    obs = to_spark(spark, make_days(40))
    assert jobs.ingest(spark, obs, places(spark), star)[:3] == (120, 0, 0)
    assert jobs.ingest(spark, obs, places(spark), star)[:3] == (0, 120, 0)
    more = to_spark(spark, make_days(45))
    assert jobs.ingest(spark, more, places(spark), star)[:3] == (15, 120, 0)
    tables = scan_star_schema(spark, star)
    facts = tables["wx_data"]
    assert facts.count() == 135
    assert sorted(r.data_id for r in facts.collect()) == list(range(1, 136))
    assert [r.city_name for r in tables["cities"].orderBy("city_id").collect()] == [
        "Brackwater", "Umberfeld", "Zörnach Bay"]
    assert {r.div1_name for r in tables["admin_div_1"].collect()} == {
        "Ohio", "Australia", "Brazil"}
    bad = quality.constraint_violations(tables).filter("violations > 0")
    assert bad.count() == 0


def test_replace_clears_the_box_and_empty_years(spark, star):
    obs = to_spark(spark, make_days(40))
    jobs.ingest(spark, obs, places(spark), star)
    later = obs.withColumn("date", F.date_add("date", 365))
    jobs.ingest(spark, later, places(spark), star)
    last = obs.withColumn("date", F.date_add("date", 730))
    jobs.ingest(spark, last, places(spark), star)
    assert scan_star_schema(spark, star)["wx_data"].count() == 360
    # One city, first and last year only: its rows of the middle year lie inside the box.
    some = obs.filter("city = 'Brackwater' AND date <= '2021-01-10'")
    batch = some.unionByName(some.withColumn("date", F.date_add("date", 730 + 35)))
    inserted = jobs.ingest(spark, batch, places(spark), star, replace=True).inserted
    facts = scan_star_schema(spark, star)["wx_data"]
    assert inserted == 20
    ids = {r.city_name: r.city_id for r in scan_star_schema(spark, star)["cities"].collect()}
    mine = facts.filter(F.col("city_id") == ids["Brackwater"])
    assert mine.filter("year(dtg) = 2022").count() == 0
    assert mine.count() == 20
    assert facts.filter(F.col("city_id") != ids["Brackwater"]).count() == 240


def test_replace_drops_a_year_that_lost_all_rows(spark, star):
    one = to_spark(spark, make_days(10)).filter("city = 'Brackwater'")
    jobs.ingest(spark, one, places(spark), star)
    jobs.ingest(spark, one.withColumn("date", F.date_add("date", 365)), places(spark), star)
    jobs.ingest(spark, one.withColumn("date", F.date_add("date", 730)), places(spark), star)
    ends = one.unionByName(one.withColumn("date", F.date_add("date", 730)))
    jobs.ingest(spark, ends, places(spark), star, replace=True)
    facts = scan_star_schema(spark, star)["wx_data"]
    assert facts.count() == 20 and facts.filter("year = 2022").count() == 0


def test_append_keeps_copies_inside_the_batch(spark):
    schema = "city_id INT, dtg TIMESTAMP, temp_c INT"
    t = datetime(2021, 1, 1)
    stage = spark.createDataFrame([(1, t, 1), (1, t, 2), (2, t, 3)], schema)
    target = spark.createDataFrame([(2, t, 9)] * 4, schema)
    assert sorted(r.temp_c for r in load.append_new_only(stage, target).collect()) == [1, 2]
    assert tuple(load.load_counts(stage, target).first()) == (2, 1)


def test_replace_scope_is_a_box(spark):
    schema = "city_id INT, dtg TIMESTAMP"
    def at(d):
        return datetime(2021, 1, d)
    target = spark.createDataFrame([(1, at(1)), (1, at(5)), (1, at(9)), (2, at(5))], schema)
    batch = spark.createDataFrame([(1, at(4)), (1, at(6))], schema)
    left = load.outside_replace_scope(target, batch)
    assert sorted((r.city_id, r.dtg.day) for r in left.collect()) == [(1, 1), (1, 9), (2, 5)]
    assert load.outside_replace_scope(target, batch.limit(0)).count() == 4


def dimensions(spark):
    return (spark.createDataFrame([], "state_id INT, state_name_long STRING, "
                                      "state_name_short STRING, state_abbr STRING"),
            spark.createDataFrame([], "div1_id INT, div1_name STRING, state_id INT"),
            spark.createDataFrame([], "city_id INT, city_name STRING, div1_id INT"))


def test_equal_division_names_merge_unless_composite(spark):
    rows = [("A", "Canada", "CA", "Victoria"), ("B", "Australia", "AU", "Victoria")]
    merged = load.load_reference(places(spark, rows), *dimensions(spark))
    assert merged["admin_div_1"].count() == 1
    apart = load.load_reference(places(spark, rows), *dimensions(spark), natural_key="composite")
    assert apart["admin_div_1"].count() == 2
    assert {(r.city, r.city_id) for r in apart["city_ids"].collect()} == {("A", 1), ("B", 2)}


def test_long_names_are_cut(spark):
    rows = [("C" * 70, "L" * 70, "US", "D" * 70)]
    out = load.load_reference(places(spark, rows), *dimensions(spark))
    state = out["states"].first()
    assert len(state.state_name_long) == 60 and len(state.state_name_short) == 40
    assert len(out["admin_div_1"].first().div1_name) == 60
    assert len(out["cities"].first().city_name) == 60
    assert out["city_ids"].first().city == "C" * 70


def test_unknown_codes_are_errors(spark):
    with pytest.raises(ValueError, match="XX"):
        load.require_iso3(places(spark, [("A", "Nowhere", "XX", "")]))
    codes = spark.createDataFrame([("61",), ("7",), (" ",), (None,)], "wmo_code STRING")
    with pytest.raises(ValueError, match="7"):
        load.require_code_texts(codes)
    assert load.code_texts(codes).count() == 2


def test_a_city_without_place_is_an_error(spark, star):
    with pytest.raises(ValueError, match="Umberfeld"):
        jobs.ingest(spark, to_spark(spark, make_days(3)), places(spark, PLACES[:1]), star)


def test_rain_stored_as_dry(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (0.49,), (0.5,), (None,)], "precip_mm DOUBLE")
    assert load.rounded_to_dry(df).first().stored_as_dry == 2


@pytest.mark.parametrize("partitions", [None, 1, 3, 8])
def test_running_totals(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(2).alias("v"))
    out = running_totals(df, ["k"], {"before": "v"}, partitions)
    assert out.filter(F.col("before") != F.col("k") * 2).count() == 0 and out.count() == 1000
    numbered = dense_numbers(df, ["k"], "n", 10)
    assert numbered.filter(F.col("n") != F.col("k") + 11).count() == 0


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)"])
def test_running_totals_of_fractions_and_nulls(spark, kind):
    df = spark.range(40).select("id", F.when(F.col("id") % 4 != 0, F.lit(0.5)).cast(kind).alias("v"))
    out = running_totals(df, ["id"], {"before": "v"}, 5).orderBy("id").collect()
    so_far = 0.0
    for row in out:
        assert float(row.before) == so_far
        so_far += float(row.v or 0)


def test_running_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "k INT, v INT")
    assert running_totals(empty, ["k"], {"before": "v"}).count() == 0


def test_constraints_find_each_violation(spark):
    schema = ("data_id BIGINT, city_id INT, dtg TIMESTAMP, temp_c DECIMAL(4,1), "
              "humidity DECIMAL(3,2), precip_chance DECIMAL(3,2), precip_mm INT, wmo_code STRING")
    from decimal import Decimal

    ok = datetime(2020, 1, 1)
    df = spark.createDataFrame([
        (1, 1, ok, Decimal("1.0"), None, None, None, "61"),
        (1, None, ok, Decimal("101.0"), None, None, -1, None),
        (2, 5, datetime(2016, 1, 1), None, None, Decimal("1.50"), 0, "7"),
        (None, 1, None, None, None, None, 0, "61"),
    ], schema)
    cities = spark.createDataFrame([(1, "A", 1)], "city_id INT, city_name STRING, div1_id INT")
    codes = spark.createDataFrame([("61", "Slight rain")], "wmo_code STRING, wmo_text STRING")
    tables = {"wx_data": df, "cities": cities, "wmo_codes": codes}
    found = {r.constraint: r.violations
             for r in quality.constraint_violations(tables).collect() if r.violations}
    assert found == {
        "wx_data_data_id_not_null": 1, "wx_data_city_id_not_null": 1, "wx_data_dtg_not_null": 1,
        "wx_data_dtg_range": 1, "wx_data_temp_range": 1, "wx_data_precipch_range": 1,
        "wx_data_precipmm_range": 1, "wx_data_pk": 1, "wx_data_city_id_cities_fk": 1,
        "wx_data_wmo_code_wmo_codes_fk": 1,
    }
    broken = quality.quarantine(df, tables)
    assert broken.count() == 3
    assert set(broken.filter("data_id = 2").first().broken) == {
        "wx_data_dtg_range", "wx_data_precipch_range", "wx_data_city_id_cities_fk",
        "wx_data_wmo_code_wmo_codes_fk"}


def test_ingest_keeps_first_rows_last_places_and_holds_back_bad_rows(spark, star):
    days = to_spark(spark, make_days(10)).withColumn("seq", F.lit(1))
    copies = days.withColumns({"temp_mean_c": F.col("temp_mean_c") - 9, "seq": F.lit(2)})
    batch = copies.unionByName(days).withColumn(
        "precip_mm", F.when(F.dayofmonth("date") == 4, -1.0).otherwise(F.col("precip_mm")))
    listed = places(spark).withColumn("n", F.lit(1)).unionByName(places(spark, [
        ("Brackwater", "Canada", "CA", "Ontario")]).withColumn("n", F.lit(2)))
    done = jobs.ingest(spark, batch, listed, star, ingest_order="seq", place_order="n")
    assert done[:3] == (27, 0, 3)
    tables = scan_star_schema(spark, star)
    names = tables["cities"].select("city_id", F.col("city_name").alias("city"))
    stored = {(r.city, r.dtg.date()): float(r.temp_c) for r in
              tables["wx_data"].join(names, "city_id").collect()}
    assert stored == {(r.city, r.date): pytest.approx(r.temp_mean_c) for r in days.collect()
                      if r.date.day != 4}
    assert tables["cities"].count() == 3
    assert {r.div1_name for r in tables["admin_div_1"].collect()} == {"Ontario", "Australia", "Brazil"}
    held = Warehouse(spark, star).read("quarantine").collect()
    assert [r.broken for r in held] == [["wx_data_precipmm_range"]] * 3
    again = jobs.ingest(spark, batch, listed, star, ingest_order="seq", place_order="n")
    assert again[:3] == (0, 27, 3)
    with pytest.raises(ValueError, match="ingest order"):
        jobs.ingest(spark, batch.drop("seq"), listed, star, place_order="n")
    with pytest.raises(ValueError, match="Brackwater"):
        jobs.ingest(spark, days.drop("seq"), listed.drop("n"), star)


def test_refused_rows_come_as_a_table(spark):
    bad = places(spark, [(f"C{k}", "Nowhere", f"X{k:02}", "") for k in range(60)])
    with pytest.raises(RejectedRows, match="60 in all") as refused:
        load.require_iso3(bad)
    assert refused.value.rows.count() == 60


def test_export_job(spark, star, tmp_path):
    obs = to_spark(spark, make_days(12))
    jobs.ingest(spark, obs, places(spark), star)
    tables, now = scan_star_schema(spark, star), datetime(2021, 1, 12)
    path = str(tmp_path / "out")
    assert jobs.export(tables, path, days=3, now=now)
    assert spark.read.option("header", True).csv(path).count() == 12
    assert jobs.export(tables, path + "-json", form="json")
    assert spark.read.json(path + "-json").count() == 36
    assert not jobs.export(tables, path + "-none", days=3, now=datetime(2030, 1, 1))
    assert not (tmp_path / "out-none").exists()
    with pytest.raises(ValueError, match="csv or json"):
        jobs.export(tables, path, form="xml")
