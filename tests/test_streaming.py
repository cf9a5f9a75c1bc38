from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationcast.operators import features as ft
from stationcast.operators.rollup import daily_rollup
from stationcast.schemas import OBS_SCHEMA
from stationcast.streaming import (
    ForeignCheckpoint,
    compact,
    compact_tails,
    features_to_serve,
    keep_newest,
    merged_days,
    newest_days,
    read_readings,
    run_available,
)
from stationcast.streaming.batches import parts

SCHEMA = "data_id BIGINT, city_id INT, dtg TIMESTAMP, temp_c DECIMAL(4,1), precip_mm INT, " \
         "wmo_code STRING"


def readings(spark, first_day, days):
    rows = spark.range(days * 24 * 2).select(
        F.col("id").alias("data_id"), (F.col("id") % 2 + 1).cast("int").alias("city_id"),
        (F.lit(datetime(2022, 1, 1) + timedelta(days=first_day))
         + F.make_dt_interval(hours=(F.col("id") / 2).cast("int"))).alias("dtg"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 300 / 10)).cast("decimal(4,1)").alias("temp_c"),
        (F.col("id") % 3).cast("int").alias("precip_mm"), F.lit("61").alias("wmo_code"))
    return rows


def check(spark, sums, source, cities):
    streamed = merged_days(spark, sums, cities)
    batch = daily_rollup(spark.read.parquet(source), cities)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0
    return batch.count()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    cities = spark.createDataFrame([(1, "A"), (2, "B")], "city_id INT, city_name STRING")
    source, sums, state = (str(tmp_path / n) for n in ("in", "sums", "state"))
    for first_day in (0, 6):
        readings(spark, first_day, 6).write.mode("append").parquet(source)
        run_available(read_readings(spark, source), sums, state)
    assert check(spark, sums, source, cities) == 24


def test_order_of_files_and_batches_changes_nothing(spark, tmp_path):
    cities = spark.createDataFrame([(1, "A"), (2, "B")], "city_id INT, city_name STRING")
    source, sums, state = (str(tmp_path / n) for n in ("in", "sums", "state"))
    # Readings of every day in every file, and the oldest days last.
    readings(spark, 20, 10).repartition(5).write.parquet(source)
    readings(spark, 0, 10).repartition(3).write.mode("append").parquet(source)
    run_available(read_readings(spark, source, files_per_batch=1), sums, state)
    assert len(parts(spark, sums)[1]) == 8
    assert check(spark, sums, source, cities) == 40


def test_a_new_checkpoint_over_old_sums_is_refused(spark, tmp_path):
    cities = spark.createDataFrame([(1, "A"), (2, "B")], "city_id INT, city_name STRING")
    source, sums, state = (str(tmp_path / n) for n in ("in", "sums", "state"))
    readings(spark, 0, 6).repartition(3).write.parquet(source)
    run_available(read_readings(spark, source, files_per_batch=1), sums, state)
    assert check(spark, sums, source, cities) == 12
    for other in ("other", "other"):            # without metadata, then with
        with pytest.raises(Exception, match="belong to checkpoint") as refused:
            run_available(read_readings(spark, source), sums, str(tmp_path / other))
        assert isinstance(refused.value, ForeignCheckpoint)
    assert check(spark, sums, source, cities) == 12
    # The right one goes on; another folder may be begun with any.
    readings(spark, 6, 2).write.mode("append").parquet(source)
    run_available(read_readings(spark, source), sums, state)
    run_available(read_readings(spark, source), str(tmp_path / "sums2"), str(tmp_path / "other"))
    assert check(spark, sums, source, cities) == check(spark, str(tmp_path / "sums2"), source, cities) == 16


def test_batches_are_merged_and_the_stream_goes_on(spark, tmp_path, monkeypatch):
    from stationcast.sources import files

    cities = spark.createDataFrame([(1, "A"), (2, "B")], "city_id INT, city_name STRING")
    source, sums, state = (str(tmp_path / n) for n in ("in", "sums", "state"))
    readings(spark, 0, 6).repartition(4).write.parquet(source)
    run_available(read_readings(spark, source, files_per_batch=1), sums, state, compact_after=4)
    assert parts(spark, sums) == (3, []) and check(spark, sums, source, cities) == 12
    readings(spark, 3, 6).repartition(2).write.mode("append").parquet(source)     # days of before, too
    run_available(read_readings(spark, source, files_per_batch=1), sums, state)
    assert parts(spark, sums) == (3, [4, 5]) and check(spark, sums, source, cities) == 18
    # Killed before the folder is in its place, and after that before the batches are gone.
    for step in ("move", "delete"):
        with monkeypatch.context() as patched:
            patched.setattr(files, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                compact(spark, sums)
        assert check(spark, sums, source, cities) == 18
    compact(spark, sums)
    assert parts(spark, sums) == (5, []) and check(spark, sums, source, cities) == 18
    assert not [n for n in files.names(spark, sums) if n.startswith(("_draft", "batch="))]


def test_forecasts_are_served_from_state(spark, tmp_path, days):
    """Days that arrive out of order, twice and corrected; then the features of every city's newest
    day equal those built from the whole history."""
    source, tails, state = (str(tmp_path / n) for n in ("in", "tails", "state"))
    names = [f.name for f in OBS_SCHEMA.fields]
    some = days.select(*names)
    wrong = some.where("date = '2021-06-01'").withColumn("temp_mean_c", F.lit(99.0))
    order = [some.where("date > '2021-05-20' AND city <> 'Umberfeld'"), wrong,
             some.where("date <= '2021-05-25'"), some.where("date = '2021-06-01'"),
             some.where("date > '2021-05-25' AND date < '2021-06-05' AND city = 'Umberfeld'")]
    for number, batch in enumerate(order):
        batch.coalesce(1).write.mode("append").parquet(source)
        keep_newest(spark.readStream.schema(OBS_SCHEMA).parquet(source), tails, state)
        if number == 3:
            compact_tails(spark, tails)
    kept = newest_days(spark, tails).groupBy("city").agg(
        F.count("*").alias("n"), F.max("date").alias("last")).collect()
    assert {r.n for r in kept} == {30} and len(kept) == 3
    full = ft.build_features(some.where("city <> 'Umberfeld' OR date < '2021-06-05'"))
    got = {r.city: r for r in features_to_serve(spark, tails).collect()}
    assert set(got) == {r.city for r in kept}
    labels = {"y_temp_mean_c", "y_precip_mm", "y_is_wet", "y_condition"}
    for row in kept:
        want = full.where((F.col("city") == row.city) & (F.col("date") == row["last"])).first()
        assert got[row.city].date == want.date
        for name in set(full.columns) - labels:
            value = want[name]
            assert got[row.city][name] == (pytest.approx(value) if isinstance(value, float) else value), name
