"""Tables that change together: data files first, then one manifest that makes them visible.

A load writes its files into folders of its own. Nothing reads them until the manifest of the next
version, the list of all files of all tables, has been moved to its place in one step. Readers take the
newest manifest, so they see a load whole or not at all; a load that dies leaves files that no manifest
names. Two loads from the same version want the same next one, and the second to commit is an error.

Facts have a key index, a table like the others: per data file and city the first and last time in it.
A load reads only the files that may hold its keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.schemas import STAR_SCHEMAS
from stationcast.sources import files

FACTS, KEYS = "wx_data", "wx_data_keys"
FACT_KEY = ["city_id", "dtg"]
SCHEMAS = STAR_SCHEMAS | {
    KEYS: "file STRING, city_id INT, low TIMESTAMP, high TIMESTAMP, rows BIGINT, last_id BIGINT"}
ENTRY = "name STRING, file STRING"


class CommitConflict(RuntimeError):
    """Another load has committed since this one began."""


class Warehouse:
    """The tables below ``path`` as of a version, the newest by default."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        known = versions(spark, path)
        if not known:
            raise ValueError(f"no warehouse at {path}")
        if version is not None and version not in known:
            raise ValueError(f"no version {version} at {path}")
        self.version = known[-1] if version is None else version
        entries = spark.read.schema(ENTRY).parquet(_manifest(self.path, self.version))
        self.files: dict[str, list[str]] = {}
        for row in entries.orderBy("name", "file").collect():         # one short row per data file
            self.files.setdefault(row["name"], []).append(row["file"])

    @classmethod
    def create(cls, spark: SparkSession, path: str) -> Warehouse:
        """An empty warehouse as version 0; an error if there is one."""
        _commit(spark, path.rstrip("/"), 0, {})
        return cls(spark, path)

    def read(self, name: str, only: list[str] | None = None) -> DataFrame:
        """A table; with ``only``, what these of its files hold."""
        listed = self.files.get(name, []) if only is None else only
        if not listed:
            if name not in SCHEMAS:
                raise ValueError(f"no table {name} at {self.path}")
            return self.spark.createDataFrame([], SCHEMAS[name])
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(*[f"{self.path}/{file}" for file in listed])

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in STAR_SCHEMAS}

    def keys(self) -> DataFrame:
        """The key index of the files that this version names."""
        current = self.spark.createDataFrame([(f,) for f in self.files.get(FACTS, [])], "file STRING")
        return self.read(KEYS).join(current, "file", "left_semi")

    def last_id(self) -> int:
        return self.keys().agg(F.max("last_id")).first()[0] or 0

    def near(self, stage: DataFrame) -> list[str]:
        """The fact files that may hold a key of ``stage``: of one of its cities, with times that
        overlap the city's times in the stage."""
        spans = stage.groupBy("city_id").agg(F.min("dtg").alias("from"), F.max("dtg").alias("to"))
        hit = self.keys().join(spans, "city_id").where("low <= to AND high >= from")
        return sorted(row["file"] for row in hit.select("file").distinct().collect())

    def begin(self) -> Load:
        return Load(self)


class Load:
    """Changes to a warehouse that become visible together, at ``commit``."""

    def __init__(self, base: Warehouse):
        self.base, self.spark = base, base.spark
        self.files = {name: list(listed) for name, listed in base.files.items()}
        self.id = uuid.uuid4().hex

    def _write(self, name: str, rows: DataFrame) -> list[str]:
        folder = f"data/{name}/{self.id}-{len(self.files.get(name, []))}"
        rows.write.parquet(f"{self.base.path}/{folder}")
        return [f"{folder}/{file}" for file in files.names(self.spark, f"{self.base.path}/{folder}")
                if file.endswith(".parquet")]

    def append(self, name: str, rows: DataFrame) -> None:
        added = self._write(name, rows)
        self.files[name] = [*self.files.get(name, []), *added]

    def append_facts(self, rows: DataFrame) -> None:
        """Add facts (with data_id) and the keys of their files."""
        added = self._write(FACTS, rows.withColumn("year", F.year("dtg")))
        if not added:
            return
        self.files[FACTS] = [*self.files.get(FACTS, []), *added]
        place = F.concat(F.lit(added[0].rsplit("/", 1)[0] + "/"),
                         F.element_at(F.split("_metadata.file_path", "/"), -1))
        written = self.base.read(FACTS, added).select(place.alias("file"), "city_id", "dtg", "data_id")
        self.append(KEYS, written.groupBy("file", "city_id").agg(
            F.min("dtg").alias("low"), F.max("dtg").alias("high"), F.count("*").alias("rows"),
            F.max("data_id").alias("last_id")).coalesce(1))

    def drop_facts(self, dropped: list[str]) -> None:
        """Leave fact files out of the next version."""
        self.files[FACTS] = [f for f in self.files.get(FACTS, []) if f not in set(dropped)]

    def commit(self) -> int:
        """Make the changes visible; returns the version, the same one if there were none."""
        if self.files == self.base.files:
            return self.base.version
        _commit(self.spark, self.base.path, self.base.version + 1, self.files)
        return self.base.version + 1


def _manifest(path: str, version: int) -> str:
    return f"{path}/manifests/v={version:010}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the warehouse at ``path``, ascending; none if there is no warehouse."""
    return [int(name[2:]) for name in files.names(spark, f"{path.rstrip('/')}/manifests")
            if name.startswith("v=")]


def _commit(spark: SparkSession, path: str, version: int, listed: dict[str, list[str]]) -> None:
    draft, target = f"{path}/manifests/_draft-{uuid.uuid4().hex}", _manifest(path, version)
    rows = [(name, file) for name, some in listed.items() for file in some]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.parquet(draft)
    try:
        files.move(spark, draft, target)
    except Exception as error:
        if files.exists(spark, target):
            raise CommitConflict(f"version {version} of {path} is there already") from error
        raise


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove old manifests, all but the newest ``keep``, and the folders that no kept one names; returns
    how many folders. Not while a load is running: its files are in no manifest yet."""
    known = versions(spark, path)
    kept = known[-keep:]
    named = {file.rsplit("/", 1)[0] for v in kept
             for some in Warehouse(spark, path, v).files.values() for file in some}
    path, gone = path.rstrip("/"), 0
    for version in known[:-keep]:
        files.delete(spark, _manifest(path, version))
    for draft in files.names(spark, f"{path}/manifests"):
        if draft.startswith("_draft-"):
            files.delete(spark, f"{path}/manifests/{draft}")
    for table in files.names(spark, f"{path}/data"):
        for folder in files.names(spark, f"{path}/data/{table}"):
            if f"data/{table}/{folder}" not in named:
                files.delete(spark, f"{path}/data/{table}/{folder}")
                gone += 1
    return gone
