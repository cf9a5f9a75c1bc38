"""The daily rollup over a stream of readings: every reading counts, in whatever order it arrives.

Each micro-batch leaves the mergeable sums of its city-days in a folder named after the batch, which
a repeated batch replaces. Reading merges the sums of all batches, so a late reading changes its day
and no watermark decides what is too late.

Batch numbers mean something to one checkpoint only. The folder therefore belongs to the checkpoint
whose id it was begun with, and another one is refused. Batches that are done are merged from time to
time into one folder, which takes their place in one step.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.functions.weather import local_day
from stationcast.operators.rollup import finish_day, reading_measures
from stationcast.schemas import STAR_SCHEMAS
from stationcast.sources import files
from stationcast.streaming.batches import merge_parts, parts, read_parts

#: How the sums of one city-day in several batches become one.
MERGE = {"temp_sum": F.sum, "temp_n": F.sum, "temp_max_c": F.max, "temp_min_c": F.min,
         "precip_mm": F.sum, "wmo_code": F.max}
#: So many batches are merged into one folder.
COMPACT_AFTER = 50


class ForeignCheckpoint(ValueError):
    """The sums were begun with another checkpoint, whose batches would be counted again."""


def read_readings(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New reading files below ``path`` as a stream; how files fall into batches changes no result."""
    reader = spark.readStream.schema(STAR_SCHEMAS["wx_data"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    if "metadata" not in files.names(spark, checkpoint):
        return None
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def _owner(spark: SparkSession, path: str) -> str | None:
    known = [name for name in files.names(spark, path) if name.startswith("owner=")]
    return known[0].removeprefix("owner=") if known else None


def _claim(spark: SparkSession, path: str, identity: str) -> None:
    """Make sure that the sums at ``path`` belong to this checkpoint."""
    owner = _owner(spark, path)
    if owner is None:
        spark.range(0).write.parquet(f"{path}/owner={identity}")
        owner = _owner(spark, path)
    if owner != identity:
        raise ForeignCheckpoint(f"the sums at {path} belong to checkpoint {owner}, not to {identity}; "
                                "go on with that one, or begin another folder")


def run_available(readings: DataFrame, path: str, checkpoint: str, tz: str = "UTC",
                  compact_after: int = COMPACT_AFTER) -> None:
    """Add the sums of all readings that have arrived to ``path``, and stop.

    A folder begun with another checkpoint is an error, before anything is added. One run at a time.
    """
    spark = readings.sparkSession
    day = local_day(F.col("dtg"), readings.schema["dtg"].dataType.typeName(), tz)
    identity = _checkpoint_id(spark, checkpoint)
    if _owner(spark, path) is not None:
        _claim(spark, path, identity or "a new one")

    def add(batch: DataFrame, number: int) -> None:
        if identity is None:               # the checkpoint was made when the stream started
            _claim(spark, path, _checkpoint_id(spark, checkpoint))
        sums = batch.groupBy("city_id", day.alias("date")).agg(*reading_measures())
        sums.write.mode("overwrite").parquet(f"{path}/batch={number}")

    readings.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
    _, loose = parts(spark, path)
    if len(loose) >= compact_after:
        compact(spark, path)


def _sums(spark: SparkSession, path: str) -> DataFrame:
    """One row of sums per (city_id, date) from the merged folder and the batches after it."""
    return read_parts(spark, path).groupBy("city_id", "date").agg(
        *[merge(c).alias(c) for c, merge in MERGE.items()])


def compact(spark: SparkSession, path: str) -> None:
    """Merge the sums of all batches into one folder; not while a stream runs."""
    merge_parts(spark, path, _sums(spark, path))


def merged_days(spark: SparkSession, path: str, cities: DataFrame, min_obs: int = 1) -> DataFrame:
    """One row per (city, local day) from the sums below ``path``: the batch rollup of all readings.

    A day that is still open is there too, with what has arrived.
    """
    names = cities.select("city_id", F.col("city_name").alias("city"))
    return finish_day(_sums(spark, path), min_obs).join(names, "city_id").select(
        "city", "date", "temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm", "wmo_code")
