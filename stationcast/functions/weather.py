"""Weather expressions over one observation row."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationcast.schemas import UNKNOWN_CATEGORY, WET_THRESHOLD_MM, WMO_CATEGORIES


def wmo_category(code: Column) -> Column:
    """Forecast category of a WMO code; missing and unmapped codes are ``Unknown``."""
    whole = code.try_cast("int")
    chain = None
    for category, codes in WMO_CATEGORIES.items():
        hit = whole.isin(*codes)
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return chain.otherwise(UNKNOWN_CATEGORY)


def wet_flag(precip: Column) -> Column:
    """1.0 above the wet threshold, 0.0 below it and where the amount is missing."""
    return F.coalesce((precip > WET_THRESHOLD_MM).cast("double"), F.lit(0.0))


def wet_label(precip: Column) -> Column:
    """Like :func:`wet_flag`, but a missing amount gives no label."""
    return (precip > WET_THRESHOLD_MM).cast("double")


def temp_range(high: Column, low: Column) -> Column:
    return high - low


def season(day: Column, latitude: Column) -> dict[str, Column]:
    """Seasonal position of the day after ``day``; the wave is mirrored south of the equator."""
    target = F.date_add(day, 1)
    angle = F.lit(2 * math.pi) * F.dayofyear(target) / 365.25
    return {
        "target_date": target,
        "target_doy_sin": F.sin(angle),
        "target_doy_cos": F.cos(angle),
        "target_month": F.month(target).cast("double"),
        "hemisphere_doy_sin": F.sin(angle) * F.signum(latitude),
    }


def condition_flags(condition: Column) -> dict[str, Column]:
    """One 0/1 column per mapped category; ``Unknown`` leaves all of them 0."""
    return {
        f"cond_today_{category.lower()}": (condition == category).cast("double")
        for category in WMO_CATEGORIES
    }


def local_day(moment: Column, kind: str, tz: str = "UTC") -> Column:
    """Calendar day of an instant in zone ``tz``.

    ``kind`` is the Spark type name: ``timestamp_ntz`` values are read as UTC wall clock,
    ``timestamp`` values as instants.
    """
    if kind == "timestamp_ntz":
        clock = moment if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), moment)
    else:
        clock = F.convert_timezone(None, F.lit(tz), moment)
    return F.to_date(clock)
