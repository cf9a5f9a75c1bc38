"""Readers for observation files, the star schema, geocode maps and landed API payloads."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.functions.names import slug
from stationcast.operators.load import normalize
from stationcast.operators.lookup import attach_coordinates
from stationcast.operators.rollup import daily_rollup, require_unique_names
from stationcast.schemas import (
    DAILY_PAYLOAD_SCHEMA,
    GEOCODE_SCHEMA,
    OBS_SCHEMA,
    STAR_SCHEMAS,
)
from stationcast.session import cut_lineage
from stationcast.sources.warehouse import Warehouse, versions

SOURCES = ("csv", "db")


def scan_observations_csv(spark: SparkSession, path: str) -> DataFrame:
    """City-day CSV with header, normalised. Columns are typed strictly.

    All files of a folder must have the same columns in the same order: each header is compared and
    another one is an error, since values are read by position. Of several rows for one city-day the
    first in the file counts (files in path order).
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = sorted({f.name for f in OBS_SCHEMA.fields} - set(header))
    if missing:
        raise ValueError(f"{path} is missing column(s): {', '.join(missing)}")
    types = {f.name: f.dataType.simpleString() for f in OBS_SCHEMA.fields}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in header)
    raw = (
        spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
        .option("encoding", "UTF-8").option("enforceSchema", False).csv(path)
    )
    # File, block and row within the block: the same for a task that runs again.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id())
    columns = [f.name for f in OBS_SCHEMA.fields]
    return normalize(raw.select(*columns, place.alias("place")), "place", origin=path)


def scan_star_schema(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The five tables below ``path``: the newest version of a warehouse, or else Parquet folders, facts
    partitioned by year."""
    if versions(spark, path):
        return Warehouse(spark, path).tables()
    return {name: spark.read.schema(schema).parquet(f"{path}/{name}")
            for name, schema in STAR_SCHEMAS.items()}


def scan_star_schema_jdbc(spark: SparkSession, url: str, schema: str, partitions: int,
                          data_id_bounds: tuple[int, int], **options: str) -> dict[str, DataFrame]:
    """The same tables over JDBC; facts are read in ``partitions`` ranges of ``data_id``."""
    if not schema.isidentifier():
        raise ValueError(f"schema {schema!r} is not a plain SQL identifier")

    def table(name: str, **extra) -> DataFrame:
        return spark.read.format("jdbc").options(
            url=url, dbtable=f"{schema}.{name}", **options, **extra).load()

    low, high = data_id_bounds
    tables = {name: table(name) for name in STAR_SCHEMAS if name != "wx_data"}
    tables["wx_data"] = table("wx_data", partitionColumn="data_id", lowerBound=str(low),
                              upperBound=str(high), numPartitions=str(partitions))
    return tables


def load_observations(spark: SparkSession, source: str, path: str | dict[str, DataFrame],
                      coordinates: DataFrame | None = None, tz: str = "UTC",
                      min_obs: int = 1) -> DataFrame:
    """City-days with coordinates from a CSV (``csv``) or a star schema (``db``).

    The star schema is a Parquet folder, or its tables as either star schema reader returns them.
    """
    kind = source.strip().lower()
    if kind not in SOURCES:
        raise ValueError(f"unknown data source {source!r}; expected one of: {', '.join(SOURCES)}")
    if kind == "csv":
        return scan_observations_csv(spark, path)
    if coordinates is None:
        raise ValueError("the star schema stores no coordinates: pass them")
    tables = path if isinstance(path, dict) else scan_star_schema(spark, path)
    path = "the tables" if isinstance(path, dict) else path
    # The readings are scanned once: the checks below and the caller read the stored city-days.
    days = cut_lineage(daily_rollup(tables["wx_data"], tables["cities"], tz, min_obs))
    if days.isEmpty():
        raise ValueError(f"no observations in {path}")
    return normalize(attach_coordinates(require_unique_names(days), coordinates), origin=path)


def extract_places(documents: DataFrame, text: str = "json",
                   order: str | None = None) -> DataFrame:
    """Entries of geocode maps (one JSON object per row), in document order."""
    entries = F.map_entries(F.from_json(text, GEOCODE_SCHEMA, {"mode": "FAILFAST"}))
    keep = [order] if order else []
    return documents.select(*keep, F.posexplode(entries).alias("position", "entry")).select(
        *keep, "position", F.col("entry.key").alias("cache_key"), "entry.value.*")


def scan_geocode_map(documents: DataFrame, text: str = "json",
                     order: str | None = None) -> DataFrame:
    """Coordinates by folded city name: (slug, name, latitude, longitude).

    Entries without both coordinates are left out; of several entries that fold alike the last
    one counts.
    """
    places = extract_places(documents, text, order).dropna(subset=["latitude", "longitude"])
    fields = ["name", "latitude", "longitude"]
    last = F.max(F.struct(*([order] if order else []), "position", *fields)).alias("last")
    return places.groupBy(slug("name").alias("slug")).agg(last).select(
        "slug", *[F.col(f"last.{c}").alias(c) for c in fields])


def payload_rows(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Archive payloads (city, latitude, longitude, JSON text) as one row per day.

    The ``time`` array decides how many rows there are; a shorter, empty or absent array gives
    nulls. Text that is no JSON is an error.
    """
    daily = F.from_json(text, DAILY_PAYLOAD_SCHEMA, {"mode": "FAILFAST"})["daily"]
    days = payloads.select("city", "latitude", "longitude", daily.alias("d")).select(
        "city", "latitude", "longitude", "d", F.posexplode("d.time").alias("i", "day"))

    def at(field: str, name: str):
        return F.get(F.col(f"d.{field}"), F.col("i")).alias(name)

    return days.select(
        "city", "latitude", "longitude", F.to_date("day").alias("date"),
        at("temperature_2m_mean", "temp_mean_c"), at("temperature_2m_max", "temp_max_c"),
        at("temperature_2m_min", "temp_min_c"), at("precipitation_sum", "precip_mm"),
        at("weather_code", "wmo_code"))


def scan_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload records: JSON lines of city, latitude, longitude and payload text."""
    return payload_rows(spark.read.schema(
        "city STRING, latitude DOUBLE, longitude DOUBLE, payload STRING").json(path))


def trailing_years(years: int = 5, end: date | None = None, start: date | None = None,
                   now: datetime | None = None) -> tuple[date, date]:
    """Default date range: up to a day ago, from the same day ``years`` earlier (29 Feb: 28)."""
    if end is None:
        end = ((now or datetime.now(timezone.utc)) - timedelta(hours=24)).date()
    if start is None:
        leap_day = (end.month, end.day) == (2, 29)
        earlier = end.year - years
        is_leap = earlier % 4 == 0 and (earlier % 100 != 0 or earlier % 400 == 0)
        start = date(earlier, end.month, 28 if leap_day and not is_leap else end.day)
    if start > end:
        raise ValueError(f"start ({start}) must be on or before end ({end})")
    return start, end


def trailing_years_filter(days: DataFrame, years: int = 5, end: date | None = None,
                          start: date | None = None) -> DataFrame:
    first, last = trailing_years(years, end, start)
    return days.filter(F.col("date").between(F.lit(first), F.lit(last)))
