from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.operators import trailing

START = datetime(1999, 12, 25)
SCHEMA = ("data_id BIGINT, city_id INT, dtg TIMESTAMP_NTZ, temp_c DECIMAL(4,1), "
          "humidity DECIMAL(3,2), precip_mm INT")


@pytest.fixture(scope="module")
def rows():
    """A third of the readings in one city, a third of those at one instant; edges at 30 days."""
    from decimal import Decimal

    rng = random.Random(5)
    out = []
    for i in range(600):
        if i % 3 == 0:
            city, minutes = 1, (0 if i % 9 == 0 else rng.randint(0, 60 * 24 * 80))
        else:
            city, minutes = rng.randint(2, 9), rng.randint(0, 60 * 24 * 80)
        if i % 11 == 0:
            minutes = 60 * 24 * 30 * rng.randint(0, 2)
        temp = None if i % 7 == 0 else Decimal(rng.randint(-400, 400)) / 10
        out.append((i, city, START + timedelta(minutes=minutes), temp,
                    Decimal(rng.randint(0, 100)) / 100, None if i % 5 == 0 else rng.randint(0, 9)))
    return out


def mean(values):
    values = [float(v) for v in values if v is not None]
    return sum(values) / len(values) if values else None


def near(a, b):
    return (a is None and b is None) or a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("days", [1, 2, 30])
def test_trailing_averages_equal_brute_force(spark, rows, days):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.data_id: r for r in trailing.trailing_averages(df, days).collect()}
    assert len(got) == len(rows)
    for i, city, dtg, *_ in rows:
        frame = [r for r in rows if r[1] == city and dtg - timedelta(days=days) <= r[2] <= dtg]
        assert near(got[i][f"avg_temp_c_{days}day"], mean(r[3] for r in frame))
        assert near(got[i][f"avg_humidity_{days}day"], mean(r[4] for r in frame))
        assert near(got[i][f"avg_precip_mm_{days}day"], mean(r[5] for r in frame))


def pairs(rows):
    return [d for d in rows for c in rows
            if d[1] == c[1] and c[2] - timedelta(days=30) <= d[2] <= c[2]]


def test_pair_weighted_averages_equal_the_pair_join(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = trailing.pair_weighted_averages(df).first()
    joined = pairs(rows)
    assert near(got.avg_temp_c_30day, mean(d[3] for d in joined))
    assert near(got.avg_humidity_30day, mean(d[4] for d in joined))
    assert near(got.avg_precip_mm_30day, mean(d[5] for d in joined))


def test_as_written_repeats_the_one_average_row(spark, rows):
    out = trailing.trailing_as_written(spark.createDataFrame(rows, SCHEMA))
    assert out.count() == len(rows)
    assert out.select("avg_temp_c_30day").distinct().count() == 1


def test_times_before_1970_fall_into_the_right_day(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1L, 1, TIMESTAMP_NTZ'1969-12-31 23:00:00', 1.0BD, 0.1BD, 1),
        (2L, 1, TIMESTAMP_NTZ'1969-12-01 22:00:00', 3.0BD, 0.1BD, 1),
        (3L, 1, TIMESTAMP_NTZ'1970-01-01 01:00:00', 5.0BD, 0.1BD, 1)
        AS t(data_id, city_id, dtg, temp_c, humidity, precip_mm)""")
    got = {r.data_id: r.avg_temp_c_30day for r in trailing.trailing_averages(df).collect()}
    assert got == {2: 3.0, 1: 1.0, 3: 3.0}


def test_float_measures_work_too(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("temp_c", F.col("temp_c").cast("double"))
    exact = trailing.pair_weighted_averages(spark.createDataFrame(rows, SCHEMA)).first()
    assert trailing.pair_weighted_averages(df).first().avg_temp_c_30day == pytest.approx(
        exact.avg_temp_c_30day)


def test_no_window_follows_the_data(spark, rows):
    """Windows run over ranges of the global order, whatever a city or a day holds, and the measures
    are read once."""
    df = spark.createDataFrame(rows, SCHEMA)
    plan = trailing.trailing_averages(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__range#" in line for line in windows)
    assert not any("day#" in line or "city_id#" in line.rsplit("], [", 2)[1] for line in windows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_million_stamps_in_one_day_of_one_city(spark):
    n = 1_000_000
    day = spark.range(n).select(
        F.col("id").alias("data_id"), F.lit(1).alias("city_id"),
        F.timestamp_micros(F.lit(946_684_800_000_000) + F.col("id") * 86_399).alias("dtg"),
        (F.col("id") % 601 / 10).cast("decimal(4,1)").alias("temp_c"),
        F.lit(None).cast("decimal(3,2)").alias("humidity"), (F.col("id") % 7).cast("int").alias("precip_mm"))
    later = day.select((F.col("data_id") + n).alias("data_id"), "city_id",
                       F.expr("dtg + INTERVAL 30 DAYS").alias("dtg"), "temp_c", "humidity", "precip_mm")
    out = trailing.trailing_averages(day.unionByName(later.where("data_id % 1000 = 0")))
    got = {r.data_id: (r.avg_temp_c_30day, r.avg_precip_mm_30day, r.avg_humidity_30day)
           for r in out.where("data_id % 5000 = 0").collect()}
    temp, rain = np.arange(n) % 601 / 10, np.arange(n) % 7
    assert len(got) == 400
    for i, (t, p, h) in got.items():
        if i < n:
            assert (t, p) == pytest.approx((temp[:i + 1].mean(), rain[:i + 1].mean()))
        else:                     # the rest of the first day, and every thousandth of the later one
            some = np.arange(0, i - n + 1, 1000)
            want = [(x[i - n:].sum() + x[some].sum()) / (n - (i - n) + len(some)) for x in (temp, rain)]
            assert (t, p) == pytest.approx(tuple(want))
        assert h is None
