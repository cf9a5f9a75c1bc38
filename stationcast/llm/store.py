"""Tables written between jobs, stable row identities and the folds of the labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.session import scratch_path


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: a cut in the lineage that
    outlives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def in_fold(doc_id: Column, remainder: int, folds: int = 5) -> Column:
    """Whether the id falls into this fold. A null id falls into none."""
    return F.coalesce(fold(doc_id, folds) == remainder, F.lit(False))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi join in which null keys meet; the keys come from the left side."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    condition = None
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"__right_{key}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__right_{key}" for key in keys])
