"""Structured Streaming: the daily rollup, and the newest days that forecasts are served from."""

from stationcast.streaming.daily import (
    ForeignCheckpoint,
    compact,
    merged_days,
    read_readings,
    run_available,
)
from stationcast.streaming.serving import compact_tails, features_to_serve, keep_newest, newest_days

__all__ = ["ForeignCheckpoint", "compact", "compact_tails", "features_to_serve", "keep_newest",
           "merged_days", "newest_days", "read_readings", "run_available"]
