"""Global prefix sums from per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.store import stored


def prefix_sums(df: DataFrame, order: list[str], sums: dict[str, str]) -> tuple[DataFrame, dict]:
    """Add, per output name, the sum of a column over all rows ordered before the current one.

    Rows go to ranges of ``order`` (Spark samples the bounds), the ranges are written with their
    number, each is summed, and every row's own running total is shifted by the total of the ranges
    before it. Rows that tie in ``order`` follow each other in any order, each with its own total.
    Returns the table and the grand totals. The offsets are one row per range, so broadcasting them
    is bounded by the number of shuffle partitions; columns must be integers and not null.
    """
    spark, columns = df.sparkSession, df.columns
    placed = stored(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()),
                    "ranges")
    per_range = sorted(
        placed.groupBy("__range").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
        .collect(), key=lambda row: row["__range"])
    running, offsets = dict.fromkeys(sums, 0), []
    for row in per_range:
        offsets.append((row["__range"], *running.values()))
        for name in sums:
            running[name] += row[name]
    shifts = spark.createDataFrame(
        offsets, "__range int, " + ", ".join(f"`__o_{name}` bigint" for name in sums))
    before = Window.partitionBy("__range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(shifts), "__range").select(*columns, *[
        (F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"__o_{name}")).alias(name)
        for name, c in sums.items()])
    return out, running
