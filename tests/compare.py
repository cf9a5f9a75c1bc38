"""Compare a Spark result with a DuckDB result, strictly: names, kinds, row multiset."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return names, Counter(zip(*[[_cell(v) for v in column] for column in columns]))


def _kinds(table):
    return {name: str(table.schema.field(name).type).replace("large_", "")
            .replace("timestamp[us, tz=UTC]", "timestamp[us]") for name in table.column_names}


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when both results agree."""
    left = spark_df.toArrow()
    right = connection.sql(sql).to_arrow_table()
    problems = []
    left_kinds, right_kinds = _kinds(left), _kinds(right)
    if left_kinds != right_kinds:
        odd = {k: (left_kinds.get(k), right_kinds.get(k))
               for k in {*left_kinds, *right_kinds} if left_kinds.get(k) != right_kinds.get(k)}
        problems.append(f"schema differs: {odd}")
    if set(left_kinds) == set(right_kinds):
        names, ours = _rows(left)
        _, theirs = _rows(right)
        if ours != theirs:
            extra, missing = ours - theirs, theirs - ours
            problems.append(
                f"rows differ: {left.num_rows} vs {right.num_rows}, {sum(extra.values())} extra, "
                f"{sum(missing.values())} missing; columns {names}; "
                f"extra {sorted(map(str, extra))[:2]}; missing {sorted(map(str, missing))[:2]}")
    return problems
