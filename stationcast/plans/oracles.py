"""DuckDB SQL that defines the expected result of each query.

Written from the operator definitions (row windows, guarded frames, plain range joins), not from
the Spark plans. Every statement inlines the fixture views it needs.
"""

from __future__ import annotations

from stationcast.plans import oracle_features, oracle_tables
from stationcast.plans.oracle_views import with_views


def oracle_sql() -> dict[str, str]:
    bodies = oracle_features.ORACLES | oracle_tables.ORACLES
    return {name: with_views(body) for name, body in bodies.items()}
