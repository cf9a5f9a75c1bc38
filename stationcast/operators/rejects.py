"""Rows that a strict step refuses: an error that carries all of them as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationcast.session import cut_lineage

NAMED = 20


class RejectedRows(ValueError):
    """The message says how many rows were refused and names the first; ``rows`` holds them all."""

    def __init__(self, message: str, rows: DataFrame):
        super().__init__(message)
        self.rows = rows


def refuse(rows: DataFrame, what: str, column: str) -> None:
    """Raise if ``rows`` is not empty. They are stored, not collected; the message names a few."""
    kept = cut_lineage(rows)
    n = kept.count()
    if n:
        first = [r[column] for r in kept.select(column).orderBy(column).take(NAMED)]
        raise RejectedRows(f"{what} {', '.join(map(repr, first))}"
                           + (f" and {n - len(first)} more ({n} in all)" if n > NAMED else ""), kept)
