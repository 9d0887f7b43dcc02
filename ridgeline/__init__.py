"""Hourly station series, daily ordinal levels and their evaluation on Spark."""
