"""Daily rollup of sub-daily readings, and the checks that belong to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions.weather import local_day, wet_flag
from stationcast.operators.ordering import dense_numbers
from stationcast.operators.rejects import refuse


def reading_measures() -> list:
    """Aggregates of one city-day, in the readings' own types: decimals and integers add up to the same
    sums in any order. They merge, so Spark pre-aggregates map-side."""
    code = F.nullif(F.trim("wmo_code"), F.lit("")).cast("int")
    return [
        F.sum("temp_c").alias("temp_sum"),
        F.count("temp_c").alias("temp_n"),
        F.max("temp_c").alias("temp_max_c"),
        F.min("temp_c").alias("temp_min_c"),
        F.sum("precip_mm").alias("precip_mm"),
        F.max(code).alias("wmo_code"),
    ]


def finish_day(days: DataFrame, min_obs: int) -> DataFrame:
    """Turn merged sums into the city-day measures, keeping days with enough temperatures."""
    return (
        days.filter(F.col("temp_n") >= min_obs)
        .withColumn("temp_mean_c", F.try_divide(F.col("temp_sum").cast("double"),
                                                F.col("temp_n").cast("double")))
        .withColumns({c: F.col(c).cast("double")
                      for c in ("temp_max_c", "temp_min_c", "precip_mm")})
        .drop("temp_sum", "temp_n")
    )


def daily_rollup(readings: DataFrame, cities: DataFrame, tz: str = "UTC",
                 min_obs: int = 1) -> DataFrame:
    """One row per (city, local day): mean/max/min temperature, rain sum, most severe code.

    Readings are aggregated before the city names are joined on, so a city holding a large share
    of the rows shrinks to one row per day on the map side and never meets the join as raw rows.
    """
    day = local_day(F.col("dtg"), readings.schema["dtg"].dataType.typeName(), tz)
    days = finish_day(
        readings.groupBy("city_id", day.alias("date")).agg(*reading_measures()), min_obs)
    names = cities.select("city_id", F.col("city_name").alias("city"))
    return days.join(names, "city_id").select(
        "city", "date", "temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm", "wmo_code")


def name_clashes(days: DataFrame) -> DataFrame:
    """City names that own more than one row on some day (two city ids share the name)."""
    return (
        days.groupBy("city", "date").agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("clashing_days"), F.max("rows").cast("bigint").alias("max_rows"))
    )


def require_unique_names(days: DataFrame) -> DataFrame:
    """Return ``days`` unchanged, or fail naming cities whose series would be mixed."""
    refuse(name_clashes(days), "give the rows distinct city_name values; more than one is named",
           "city")
    return days


def dataset_profile(days: DataFrame) -> DataFrame:
    """Row count, distinct cities, first and last day, share of wet days."""
    return days.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("city").alias("cities"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg(wet_flag(F.col("precip_mm"))).alias("wet_day_rate"),
    )


def first_coordinates(days: DataFrame) -> DataFrame:
    """Earliest known latitude and longitude of every city, each taken on its own."""
    def earliest(column: str):
        dated = F.when(F.col(column).isNotNull(), F.col("date"))
        return F.min_by(column, dated).alias(column)

    return days.groupBy("city").agg(earliest("latitude"), earliest("longitude"))


def usable_range(features: DataFrame) -> DataFrame:
    """First and last servable day per city."""
    return features.groupBy("city").agg(
        F.min("date").alias("first_usable"), F.max("date").alias("last_usable"))


def city_listing(features: DataFrame) -> DataFrame:
    """The cities that can be asked for, in the order of their names: position (from 1), city and the
    days that can be served."""
    return dense_numbers(usable_range(features), ["city"], "position")
