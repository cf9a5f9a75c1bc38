"""Writers: every task writes its own part files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header; nulls are empty fields."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines with ISO dates and explicit nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_star_schema(tables: dict[str, DataFrame], path: str) -> None:
    """The star schema as Parquet, facts partitioned by year of the reading."""
    for name, df in tables.items():
        if name == "wx_data":
            (
                df.withColumn("year", F.year("dtg"))
                .write.mode("overwrite").partitionBy("year").parquet(f"{path}/{name}")
            )
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
