"""Session construction and shared storage locations."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "stationcast", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes (UTC, AQE, ANSI)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    The cluster says where through ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one machine, may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stationcast-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier job has used."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored_table(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: a cut in the lineage that
    outlives executors. Later jobs read the columns they need and know the size. The files go when the
    session's JVM ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows stored once: later jobs read them, also after losing executors."""
    return stored_table(df, "rows")


def fixed_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small fixed table. Spark knows its size, unlike that of rows parallelised from Python."""
    names = [column.split()[0] for column in schema.split(", ")]
    columns = [list(values) for values in zip(*rows)]
    table = spark.createDataFrame(pa.table(dict(zip(names, columns))))
    return table.selectExpr(*[
        f"CAST({column.split()[0]} AS {column.split()[1]}) AS {column.split()[0]}"
        for column in schema.split(", ")])
