"""Folders of numbered batches, and one folder that stands for those up to a number."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.sources import files


def _numbers(names: list[str], kind: str) -> list[int]:
    return sorted(int(name.removeprefix(kind)) for name in names if name.startswith(kind))


def parts(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The last batch of the newest merged folder (-1 for none) and the batches after it."""
    names = files.names(spark, path)
    upto = max(_numbers(names, "merged="), default=-1)
    return upto, [n for n in _numbers(names, "batch=") if n > upto]


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the merged folder and of the batches after it."""
    upto, loose = parts(spark, path)
    folders = [f"{path}/merged={upto}"] * (upto >= 0) + [f"{path}/batch={n}" for n in loose]
    if not folders:
        raise ValueError(f"no batches at {path}")
    return spark.read.parquet(*folders)


def merge_parts(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Let ``rows``, made from all parts, stand for them, and remove the parts. A run that dies at any
    point leaves either the parts or what stands for them to be read, never both. Not while a stream
    runs."""
    upto, loose = parts(spark, path)
    if loose:
        draft = f"{path}/_draft-{uuid.uuid4().hex}"
        # In the types of the parts, which sums would widen.
        kinds = read_parts(spark, path).schema.fields
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds]).write.parquet(draft)
        upto = loose[-1]
        files.move(spark, draft, f"{path}/merged={upto}")
    names = files.names(spark, path)
    done = [f"batch={n}" for n in _numbers(names, "batch=") if n <= upto]
    done += [f"merged={n}" for n in _numbers(names, "merged=") if n < upto]
    done += [name for name in names if name.startswith("_draft-")]
    for name in done:
        files.delete(spark, f"{path}/{name}")
