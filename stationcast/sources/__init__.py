"""Readers and writers."""

from stationcast.sources.readers import (
    extract_places,
    load_observations,
    payload_rows,
    scan_geocode_map,
    scan_observations_csv,
    scan_payloads,
    scan_star_schema,
    scan_star_schema_jdbc,
    trailing_years,
    trailing_years_filter,
)
from stationcast.sources.warehouse import Warehouse, vacuum, versions
from stationcast.sources.writers import export_csv, export_json, write_star_schema

__all__ = [
    "Warehouse", "vacuum", "versions",
    "export_csv", "export_json", "extract_places", "load_observations", "payload_rows",
    "scan_geocode_map", "scan_observations_csv", "scan_payloads", "scan_star_schema",
    "scan_star_schema_jdbc", "trailing_years", "trailing_years_filter", "write_star_schema",
]
