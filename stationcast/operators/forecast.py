"""Forecast documents: one nested struct per request, built in bulk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.functions.numbers import round_half_even, to_fahrenheit
from stationcast.operators.metrics import first_best
from stationcast.schemas import API_VERSION, WET_THRESHOLD_MM


def condition_ranking(probabilities: Column, classes: list[str]) -> Column:
    """Map of class to probability (4 decimals), most likely first; ties keep class order."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("order"), i.alias("i")))
    names = F.array(*map(F.lit, classes))
    return F.map_from_entries(F.transform(F.array_sort(pairs), lambda pair: F.struct(
        F.get(names, pair["i"]), round_half_even(F.get(probabilities, pair["i"]), 4))))


def forecast_documents(scored: DataFrame, classes: list[str], cities: DataFrame,
                       expected_error_c: float | Column, model_info: dict,
                       day: str = "date") -> DataFrame:
    """Add ``forecast`` to rows with features, ``p_temp``, ``p_wet`` and ``p_condition``.

    ``cities`` (city, latitude, longitude) gives the trained location; an untrained city keeps the
    coordinates of its own row.
    """
    error = (expected_error_c if isinstance(expected_error_c, Column)
             else F.lit(expected_error_c).cast("double"))
    temp, wet, p = F.col("p_temp"), F.col("p_wet"), F.col("p_condition")
    trained = cities.select(
        "city", F.struct("latitude", "longitude").alias("__trained"))
    names = F.array(*map(F.lit, classes))
    document = F.struct(
        F.col("city"),
        F.date_format(day, "yyyy-MM-dd").alias("as_of_date"),
        F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("target_date"),
        F.coalesce("__trained", F.struct("latitude", "longitude")).alias("location"),
        F.struct(
            round_half_even(temp, 1).alias("mean_c"),
            round_half_even(to_fahrenheit(temp), 1).alias("mean_f"),
            round_half_even(error, 2).alias("expected_error_c"),
        ).alias("temperature"),
        F.struct(
            round_half_even(wet, 4).alias("probability"),
            (wet >= 0.5).alias("will_precipitate"),
            F.lit(WET_THRESHOLD_MM).alias("threshold_mm"),
        ).alias("precipitation"),
        F.struct(
            F.get(names, first_best(p).cast("int")).alias("category"),
            round_half_even(F.array_max(p), 4).alias("confidence"),
            condition_ranking(p, classes).alias("probabilities"),
        ).alias("condition"),
        F.struct("temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm", "condition")
        .alias("observed_on_as_of_date"),
        F.struct(
            F.lit(API_VERSION).alias("api_version"),
            F.lit(model_info.get("bundle_version", "unknown")).alias("bundle_version"),
            F.lit(model_info.get("trained_at", "")).alias("trained_at"),
            F.lit(model_info.get("split", "")).alias("split"),
            F.create_map(*[F.lit(x) for pair in model_info.get("configs", {}).items()
                           for x in pair]).cast("map<string,string>").alias("configs"),
        ).alias("model"),
    )
    return scored.join(trained, "city", "left").withColumn("forecast", document).drop("__trained")


def to_json(document: str = "forecast") -> Column:
    return F.to_json(document, {"ignoreNullFields": "false"})
