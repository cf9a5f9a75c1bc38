"""Station time-series analytics and next-day forecasting, written for Spark."""
