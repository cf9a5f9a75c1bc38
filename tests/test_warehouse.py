"""Loads become visible whole or not at all, and read only the files that may hold their keys."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stationcast.operators import load
from stationcast.plans import jobs
from stationcast.schemas import STAR_SCHEMAS
from stationcast.sources import Warehouse, vacuum, versions
from stationcast.sources.warehouse import CommitConflict
from tests.conftest import make_days, to_spark

PLACES = [("Brackwater", "United Kingdom", "GB", "Cumbria"), ("Umberfeld", "Australia", "AU", "Victoria"),
          ("Zörnach Bay", "Brazil", "BR", "Pará")]


@pytest.fixture
def path(spark, tmp_path):
    folder = str(tmp_path / "w")
    Warehouse.create(spark, folder)
    return folder


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, "city STRING, country STRING, country_code STRING, admin1 STRING")


def seen(spark, path):
    """What a reader finds in all tables."""
    tables = Warehouse(spark, path).tables()
    return {name: sorted(map(str, df.collect())) for name, df in tables.items()}


def stage(spark, city, first, days, temp=1.0):
    return spark.range(days).select(
        F.lit(city).cast("int").alias("city_id"),
        (F.lit(first) + F.make_dt_interval(days=F.col("id").cast("int"))).alias("dtg"),
        F.lit(temp).cast("decimal(4,1)").alias("temp_c"),
        *[F.lit(None).cast("decimal(3,2)").alias(c) for c in ("humidity", "precip_chance")],
        F.lit(0).alias("precip_mm"), F.lit("61").alias("wmo_code"))


def test_a_load_killed_before_any_write_changes_nothing(spark, path, places, monkeypatch):
    """Kill a load at its first write, then at its second, and so on until one gets through."""
    first, more = to_spark(spark, make_days(4)), to_spark(spark, make_days(9))
    jobs.ingest(spark, first, places, path)
    before, writes = seen(spark, path), {"left": 0}
    write = DataFrameWriter.parquet

    def dying(self, where, *args, **kwargs):
        if str(where).startswith(path):
            if not writes["left"]:
                raise RuntimeError("lost")
            writes["left"] -= 1
        return write(self, where, *args, **kwargs)

    survived = 0
    while True:
        with monkeypatch.context() as patched:
            patched.setattr(DataFrameWriter, "parquet", dying)
            writes["left"] = survived
            try:
                done = jobs.ingest(spark, more, places, path)
                break
            except RuntimeError:
                survived += 1
        assert seen(spark, path) == before and versions(spark, path) == [0, 1]
    assert survived >= 3                     # facts, their keys, the manifest
    assert done[:2] == (15, 12) and versions(spark, path) == [0, 1, 2]
    facts = Warehouse(spark, path).read("wx_data")
    assert sorted(r.data_id for r in facts.collect()) == list(range(1, 28))
    # A reader of the older version still finds what it found.
    assert Warehouse(spark, path, 1).read("wx_data").count() == 12
    assert vacuum(spark, path, keep=1) >= survived
    assert Warehouse(spark, path).read("wx_data").count() == 27 and versions(spark, path) == [2]


def test_of_two_loads_at_once_the_second_is_an_error(spark, path):
    one, two = (Warehouse(spark, path).begin() for _ in range(2))
    load.load_facts(stage(spark, 1, datetime(2021, 1, 1), 3), one)
    load.load_facts(stage(spark, 1, datetime(2021, 1, 1), 5), two)
    assert one.commit() == 1
    with pytest.raises(CommitConflict):
        two.commit()
    assert Warehouse(spark, path).read("wx_data").count() == 3
    again = Warehouse(spark, path).begin()
    assert load.load_facts(stage(spark, 1, datetime(2021, 1, 1), 5), again) == (2, 3)
    again.commit()
    facts = Warehouse(spark, path).read("wx_data").collect()
    assert sorted(r.data_id for r in facts) == [1, 2, 3, 4, 5]


def test_files_without_a_staged_key_are_not_read(spark, path):
    for city in (1, 2, 3):
        for year in (2019, 2020, 2021):
            change = Warehouse(spark, path).begin()
            load.load_facts(stage(spark, city, datetime(year, 3, 1), 40).coalesce(1), change)
            change.commit()
    warehouse = Warehouse(spark, path)
    everything = warehouse.files["wx_data"]
    batch = stage(spark, 2, datetime(2020, 3, 20), 40)
    near = warehouse.near(batch)
    assert len(everything) >= 9 and 0 < len(near) <= len(everything) / 9
    assert {(r.city_id, r.dtg.year) for r in warehouse.read("wx_data", near).collect()} == {(2, 2020)}
    counts = load.load_counts(batch, warehouse.read("wx_data")).first()
    change = warehouse.begin()
    assert load.load_facts(batch, change) == (counts.inserted, counts.skipped) == (19, 21)
    change.commit()
    # Between two years of the city lies nothing: no file is read at all.
    assert Warehouse(spark, path).near(stage(spark, 2, datetime(2020, 8, 1), 40)) == []


def test_replace_rewrites_only_files_in_the_box(spark, path):
    for city in (1, 2):
        change = Warehouse(spark, path).begin()
        load.load_facts(stage(spark, city, datetime(2021, 1, 1), 10), change)
        change.commit()
    before = Warehouse(spark, path)
    other = {f for f in before.files["wx_data"] if f not in before.near(stage(
        spark, 1, datetime(2021, 1, 1), 10))}
    change = before.begin()
    assert load.replace_facts(stage(spark, 1, datetime(2021, 1, 4), 3, temp=9.0), change) == (3, 3)
    change.commit()
    after = Warehouse(spark, path)
    assert other and other <= set(after.files["wx_data"])
    rows = {(r.city_id, r.dtg.day): float(r.temp_c) for r in after.read("wx_data").collect()}
    assert len(rows) == 20 and {k for k, t in rows.items() if t == 9.0} == {(1, 4), (1, 5), (1, 6)}
    assert after.keys().agg(F.sum("rows")).first()[0] == 20
    assert load.replace_facts(stage(spark, 1, datetime(2021, 1, 4), 0), after.begin()) == (0, 0)


def test_odd_folders(spark, tmp_path, path):
    with pytest.raises(ValueError, match="no warehouse"):
        Warehouse(spark, str(tmp_path / "none"))
    with pytest.raises(CommitConflict):
        Warehouse.create(spark, path)
    with pytest.raises(ValueError, match="no version"):
        Warehouse(spark, path, 7)
    warehouse = Warehouse(spark, path)
    assert {name: df.count() for name, df in warehouse.tables().items()} == dict.fromkeys(STAR_SCHEMAS, 0)
    assert warehouse.begin().commit() == 0 and warehouse.last_id() == 0
    with pytest.raises(ValueError, match="no table"):
        warehouse.read("quarantine")
