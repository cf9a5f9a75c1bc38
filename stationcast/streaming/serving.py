"""The newest days of every city as keyed state, so that a forecast reads no history.

A stream of city-days keeps, per city, the newest rows that one forecast needs. Days may arrive in any
order and again: a later copy of a day replaces it, and a day older than the kept ones says nothing
about a forecast and is let go. The state lies in the checkpoint; each batch also hands on the rows of
the cities it touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stationcast.operators import features as ft
from stationcast.schemas import OBS_SCHEMA, WINDOWS
from stationcast.streaming.batches import merge_parts, read_parts

KEPT = max(WINDOWS)
#: Spark's own state store that holds maps.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VALUE = T.StructType([f for f in OBS_SCHEMA.fields if f.name not in ("city", "date")])
KEY = T.StructType([T.StructField("day", T.IntegerType())])
EPOCH = pd.Timestamp("1970-01-01").date()


class NewestDays(StatefulProcessor):
    """Per city a map from day to measures, of ``KEPT`` days at most."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", KEY, VALUE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            names = [f.name for f in VALUE.fields]
            for row in part[["date", *names]].itertuples(index=False):
                values = tuple(None if pd.isna(v) else float(v) for v in row[1:])
                self.days.updateValue(((row[0] - EPOCH).days,), values)
        known = sorted(day[0] for day in self.days.keys())
        for day in known[:-KEPT]:
            self.days.removeKey((day,))
        kept = [(key[0], EPOCH + pd.Timedelta(days=day), *self.days.getValue((day,)))
                for day in known[-KEPT:]]
        yield pd.DataFrame(kept, columns=["city", "date", *[f.name for f in VALUE.fields]])

    def close(self) -> None:
        pass


TAIL_SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("date", T.DateType()),
                            *VALUE.fields])


def keep_newest(days: DataFrame, path: str, checkpoint: str) -> None:
    """Take in all city-days that have arrived on the stream ``days`` (columns of the observations), and
    write the newest rows of the cities that changed to ``path``, a folder per batch."""
    spark = days.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def hand_on(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    try:
        tails = days.select("city", "date", *[f.name for f in VALUE.fields]).groupBy(
            "city").transformWithStateInPandas(NewestDays(), TAIL_SCHEMA, "Update", "None")
        tails.writeStream.foreachBatch(hand_on).outputMode("update").option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def newest_days(spark: SparkSession, path: str) -> DataFrame:
    """The newest rows of every city: those its last batch handed on."""
    rows = read_parts(spark, path)
    last = Window.partitionBy("city")
    return rows.withColumn("__last", F.max("batch").over(last)).where("batch = __last").drop("__last")


def compact_tails(spark: SparkSession, path: str) -> None:
    """Keep only the newest rows of all cities, in one folder; not while a stream runs."""
    merge_parts(spark, path, newest_days(spark, path))


def features_to_serve(spark: SparkSession, path: str, vocabulary: dict[str, str] | None = None) -> DataFrame:
    """The feature row of every city's newest day, from its kept rows alone; cities without a full window
    have none."""
    newest = newest_days(spark, path).drop("batch")
    last = Window.partitionBy("city")
    built = ft.build_features(newest.withColumn("__newest", F.max("date").over(last)), vocabulary)
    return built.where(F.col("date") == F.col("__newest")).drop("__newest")
