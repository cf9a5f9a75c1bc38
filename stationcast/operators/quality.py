"""Storage constraints as one report: NOT NULL, CHECK ranges, foreign and primary keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.schemas import EARLIEST_READING, TEMP_BOUNDS_C

NOT_NULL = {
    "states": ("state_id", "state_name_long", "state_abbr"),
    "admin_div_1": ("div1_id", "div1_name", "state_id"),
    "cities": ("city_id", "city_name", "div1_id"),
    "wmo_codes": ("wmo_code", "wmo_text"),
    "wx_data": ("data_id", "city_id", "dtg"),
}
PRIMARY_KEYS = {"states": "state_id", "admin_div_1": "div1_id", "cities": "city_id",
                "wmo_codes": "wmo_code", "wx_data": "data_id"}
FOREIGN_KEYS = (("wx_data", "city_id", "cities"), ("wx_data", "wmo_code", "wmo_codes"),
                ("cities", "div1_id", "admin_div_1"), ("admin_div_1", "state_id", "states"))


RANGED = ("dtg", "temp_c", "precip_chance", "precip_mm")


def check_ranges(earliest: str = EARLIEST_READING) -> dict[str, Column]:
    """Conditions a reading must not break; a null value passes."""
    low, high = TEMP_BOUNDS_C
    return {
        "wx_data_dtg_range": F.col("dtg") >= F.lit(earliest).cast("timestamp_ntz"),
        "wx_data_temp_range": F.col("temp_c").between(low, high),
        "wx_data_precipch_range": F.col("precip_chance").between(0, 1),
        "wx_data_precipmm_range": F.col("precip_mm") >= 0,
    }


def _row_rules(table: str, earliest: str, columns: list[str] | None = None) -> dict[str, Column]:
    """What rows must not meet; with ``columns``, only rules about those."""
    rules = {c: {f"{table}_{c}_not_null": F.col(c).isNull()} for c in NOT_NULL[table]}
    if table == "wx_data":
        for (name, holds), c in zip(check_ranges(earliest).items(), RANGED):
            rules.setdefault(c, {})[name] = ~holds
    return {name: broken for c, named in rules.items() if columns is None or c in columns
            for name, broken in named.items()}


def _primary_key(df: DataFrame, table: str) -> DataFrame:
    key = PRIMARY_KEYS[table]
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.count_if(F.col("rows") > 1).alias("violations"))
        .select(F.lit(f"{table}_pk").alias("constraint"), "violations")
    )


def _row_and_reference_rules(tables: dict[str, DataFrame], table: str, earliest: str) -> DataFrame:
    """All but the primary key from one pass: rows are counted by their foreign keys, with the rows
    that break each rule, and only those counts meet the parents."""
    rules = _row_rules(table, earliest)
    keys = [(key, parent) for child, key, parent in FOREIGN_KEYS
            if child == table and parent in tables]
    counted = tables[table].groupBy(*[key for key, _ in keys]).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(broken).alias(name) for name, broken in rules.items()])
    for key, parent in keys:
        known = tables[parent].select(key).distinct().withColumn(f"__has_{key}", F.lit(True))
        counted = counted.join(known, key, "left")
        orphan = F.col(key).isNotNull() & F.col(f"__has_{key}").isNull()
        counted = counted.withColumn(f"{table}_{key}_{parent}_fk",
                                     F.when(orphan, F.col("__rows")).otherwise(0))
    names = [*rules, *[f"{table}_{key}_{parent}_fk" for key, parent in keys]]
    totals = counted.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])
    return totals.select(F.explode(F.map_from_arrays(
        F.array(*map(F.lit, names)), F.array(*[F.col(f"`{name}`") for name in names])
    )).alias("constraint", "violations"))


def constraint_violations(tables: dict[str, DataFrame],
                          earliest: str = EARLIEST_READING) -> DataFrame:
    """(constraint, violations) for every constraint of the star schema, two passes per table.

    Tables missing from ``tables`` are skipped, so a single table can be checked too. Primary keys
    count the key values that occur more than once.
    """
    parts = []
    for table, df in tables.items():
        parts += [_row_and_reference_rules(tables, table, earliest), _primary_key(df, table)]
    return reduce(DataFrame.unionByName, parts)


def quarantine(readings: DataFrame, tables: dict[str, DataFrame],
               earliest: str = EARLIEST_READING) -> DataFrame:
    """Readings that break a row rule or a foreign key, with the names of what they break.

    Rules about columns that ``readings`` lacks, such as ids not yet given, are left out.
    """
    rules = _row_rules("wx_data", earliest, readings.columns)
    broken = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
    marked = readings
    for table, key, parent in FOREIGN_KEYS:
        if table == "wx_data" and parent in tables:
            flag = f"__has_{key}"
            marked = marked.join(
                tables[parent].select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
            broken.append(F.when(F.col(key).isNotNull() & F.col(flag).isNull(),
                                 F.lit(f"wx_data_{key}_{parent}_fk")))
    return (
        marked.withColumn("broken", F.array_compact(F.array(*broken)))
        .filter(F.size("broken") > 0)
        .select(*readings.columns, "broken")
    )
