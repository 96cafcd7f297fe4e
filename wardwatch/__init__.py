"""Incident analytics on Spark: counts, match rates, lookups, hotspots and alerts."""
