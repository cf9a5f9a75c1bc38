"""Time-range statistics over raw readings, without self-joins or long sliding frames.

A 30-day RANGE frame over raw rows re-reads up to 30 days of rows for every reading and puts a whole
city into one task. Here equal timestamps are merged map-side, and a frame is the difference of two
running totals of the merged points: the one up to its end and the one before its start. Ends and starts
are put into one global order, cut into ranges of similar size, so no task depends on how many readings
a city, a day or a minute has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.operators.ordering import running_totals
from stationcast.session import cut_lineage

DAY_US = 86_400_000_000


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def range_sums(points: DataFrame, key: str, sums: list[str], days: int = 30) -> DataFrame:
    """Sums of ``sums`` over ``[us - days, us]`` per key, both ends included.

    ``points`` holds one row per (key, us), ``us`` being microseconds as a long. Returns the same
    (key, us) rows with the framed sums. Exact for integer and decimal columns; doubles keep the
    precision of a running total over the whole table.
    """
    span = days * DAY_US
    # A frame's start stands before the point of that time, its end is the point itself.
    slots = points.select(key, F.explode(F.array(
        F.struct(F.lit(0).alias("__end"), (F.col("us") - F.lit(span)).alias("us"),
                 *[F.lit(0).cast(points.schema[c].dataType).alias(c) for c in sums]),
        F.struct(F.lit(1).alias("__end"), F.col("us"),
                 *[F.coalesce(c, F.lit(0)).cast(points.schema[c].dataType).alias(c) for c in sums]),
    )).alias("slot")).select(key, "slot.*")
    placed = running_totals(slots, [key, "us", "__end"], {f"__before_{c}": c for c in sums})
    end = F.col("__end") == 1
    return placed.groupBy(key, F.when(end, F.col("us")).otherwise(F.col("us") + span).alias("us")).agg(*[
        F.sum(F.when(end, F.col(f"__before_{c}") + F.col(c)).otherwise(-F.col(f"__before_{c}")))
        .alias(c) for c in sums])


def _points(readings: DataFrame, key: str, ts: str, measures: list[str]) -> DataFrame:
    """One row per (key, timestamp): row count, and sum and count of each measure. Stored, the only
    step that reads the measures."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for m in measures:
        aggs += [F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n")]
    return cut_lineage(readings.groupBy(key, _micros(ts).alias("us")).agg(*aggs))


MEASURES = ("temp_c", "humidity", "precip_mm")


def trailing_averages(readings: DataFrame, days: int = 30, key: str = "city_id",
                      ts: str = "dtg", measures=MEASURES) -> DataFrame:
    """Per reading, the averages over the ``days`` up to and including its own timestamp."""
    sums = [f"{m}_{part}" for m in measures for part in ("sum", "n")]
    framed = range_sums(_points(readings, key, ts, list(measures)).drop("rows"), key, sums, days)
    averages = framed.select(
        key, "us",
        *[F.try_divide(F.col(f"{m}_sum").cast("double"), F.col(f"{m}_n").cast("double"))
          .alias(f"avg_{m}_{days}day") for m in measures])
    rows = readings.select("data_id", key, ts, _micros(ts).alias("us"))
    # Raw rows stay on the left: AQE may split a hot (key, timestamp) on that side.
    return rows.join(averages, [key, "us"], "left").drop("us")


def pair_weighted_averages(readings: DataFrame, days: int = 30, key: str = "city_id",
                           ts: str = "dtg", measures=MEASURES) -> DataFrame:
    """One row: averages over all (reading, later reading within ``days``) pairs of a city.

    Every reading counts once per reading that lies at most ``days`` after it, so the pair count of
    a timestamp is a forward range count; time is mirrored to get it from :func:`range_sums`.
    """
    points = _points(readings, key, ts, list(measures))
    mirrored = points.select(key, (-F.col("us")).alias("us"), "rows")
    pairs = range_sums(mirrored, key, ["rows"], days).select(
        key, (-F.col("us")).alias("us"), F.col("rows").alias("pairs"))
    weight = F.col("pairs").cast("decimal(20,0)")
    return points.join(pairs, [key, "us"]).agg(*[
        F.try_divide(
            F.sum(F.col(f"{m}_sum") * weight).cast("double"),
            F.sum(F.col(f"{m}_n") * weight).cast("double"),
        ).alias(f"avg_{m}_{days}day")
        for m in measures
    ])


def trailing_as_written(readings: DataFrame, days: int = 30) -> DataFrame:
    """Every reading beside the one global pair-weighted average row (scalar subqueries)."""
    averages = pair_weighted_averages(readings, days)
    names = averages.columns
    one = averages.select(F.struct(*names).alias("a")).scalar()
    return readings.select("data_id", "city_id", "dtg", one.alias("a")).select(
        "data_id", "city_id", "dtg", *[F.col(f"a.{n}").alias(n) for n in names])
