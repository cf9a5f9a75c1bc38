"""Denormalised export of readings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_since_cutoff(readings: DataFrame, now: datetime, days: int) -> DataFrame:
    """Readings of the last ``days`` before ``now``; the bound reaches the Parquet scan."""
    cutoff = (now - timedelta(days=days)).replace(microsecond=0)
    kind = readings.schema["dtg"].dataType.typeName()
    return readings.filter(F.col("dtg") >= F.lit(cutoff.isoformat(sep=" ")).cast(kind))


def denormalised(readings: DataFrame, cities: DataFrame, divisions: DataFrame,
                 states: DataFrame, codes: DataFrame, newest_first: bool = True) -> DataFrame:
    """Readings with their place names and weather text, newest first.

    The location tables are joined one by one: each has a known size of its own, by which Spark
    decides to broadcast it, while the size of a join of them would only be guessed.
    """
    rows = (
        readings.join(cities.select("city_id", "city_name", "div1_id"), "city_id")
        .join(divisions.select("div1_id", F.col("div1_name").alias("admin_region"), "state_id"),
              "div1_id")
        .join(states.select("state_id", F.col("state_name_short").alias("state_country"),
                            "state_abbr"), "state_id")
        .join(codes.select("wmo_code", F.col("wmo_text").alias("weather_condition")),
              "wmo_code", "left")
    )
    if newest_first:
        # The key as second order lets Spark cut one busy timestamp into several ranges.
        rows = rows.orderBy(F.col("dtg").desc(), F.col("data_id").desc())
    return rows.select(
        "dtg", "city_name", "admin_region", "state_country", "state_abbr", "temp_c", "humidity",
        "precip_chance", "precip_mm", "weather_condition")
