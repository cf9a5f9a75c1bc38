"""Running totals over a globally ordered table, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.session import cut_lineage


def running_totals(df: DataFrame, order: list[str], totals: dict[str, str],
                   partitions: int | None = None) -> DataFrame:
    """Add, per output name, the sum of a column over all rows ordered before the current one.

    Rows are range-partitioned on ``order`` (sampled, so ranges are of similar size) and stored.
    Each range is then summed on its own and shifted by the total of the ranges before it; that
    offset table has one row per range. ``order`` must be unique: aggregate equal keys first.
    """
    spark = df.sparkSession
    # Without a number given, Spark merges small ranges at run time; they stay in order.
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    # The range number is only stable once written down: a recomputed or re-planned exchange could
    # number its ranges differently.
    placed = cut_lineage(ranged.withColumn("__range", F.spark_partition_id()))

    # One small row per range: their running totals are added up on the driver.
    names = list(totals)
    per_range = placed.groupBy("__range").agg(
        *[F.sum(column).alias(name) for name, column in totals.items()])
    offsets, before = [], dict.fromkeys(names)
    for row in sorted(per_range.collect(), key=lambda r: r["__range"]):
        offsets.append((row["__range"], *before.values()))
        for name in names:
            if row[name] is not None:
                before[name] = row[name] if before[name] is None else before[name] + row[name]
    types = {f.name: f.dataType.simpleString() for f in per_range.schema.fields}
    shifts = spark.createDataFrame(
        offsets, ", ".join(f"`{c}` {types[c]}" for c in ("__range", *names))
    ).select("__range", *[F.coalesce(name, F.lit(0)).alias(f"__o_{name}") for name in names])

    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per range, so the broadcast is bounded by the shuffle partition count.
    return placed.join(F.broadcast(shifts), "__range").select(
        *df.columns,
        *[(F.coalesce(F.sum(column).over(inside), F.lit(0)) + F.col(f"__o_{name}")).alias(name)
          for name, column in totals.items()],
    )


def dense_numbers(df: DataFrame, order: list[str], output: str, start=0) -> DataFrame:
    """Number rows start+1, start+2, ... in ``order``; ``start`` is a number or a column."""
    counted = running_totals(df.withColumn("__one", F.lit(1)), order, {"__before": "__one"})
    return counted.withColumn(output, F.col("__before") + 1 + start).drop("__one", "__before")
