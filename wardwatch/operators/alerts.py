"""Alerts on counted events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import alert_id, severity
from wardwatch.schemas import ALERT_SCHEMA

ALERT_TYPE = "HIGH_CRIME_RATE"


def detect_anomalies(
    counted: DataFrame,
    threshold: int = 5,
    key: str = "routed_district",
    event_id: str = "message_id",
    time: str = "event_time",
    kind: str = "primary_type",
    case: str = "case_number",
    block: str = "block",
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """One alert for every event whose window count is at or above the threshold."""
    values = {
        "alert_id": alert_id(key, event_id),
        "alert_type": F.lit(ALERT_TYPE),
        "district": F.col(key),
        "crime_count_in_window": F.col("window_count"),
        "window_seconds": F.col("window_seconds"),
        "threshold": F.lit(threshold),
        "latest_crime_type": F.col(kind),
        "latest_case_number": F.col(case),
        "latest_block": F.col(block),
        "latitude": F.col(latitude),
        "longitude": F.col(longitude),
        "triggered_at": F.col(time),
        "severity": severity("window_count", threshold),
    }
    return counted.filter(F.col("window_count") >= threshold).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA.fields]
    )


def route_counters(key: str = "routed_district") -> dict[str, Column]:
    """Events with a key to count under, and those under none."""
    return {
        "routed": F.count("*"),
        "unknown_district": F.count_if(F.col(key) == "UNKNOWN"),
    }


def check_counters(threshold: int = 5) -> dict[str, Column]:
    """Events that were held against the threshold, and those at or above it."""
    return {
        "events_checked": F.count_if(F.col("window_count").isNotNull()),
        "anomalies_detected": F.count_if(F.col("window_count") >= threshold),
    }


def alert_stats(counted: DataFrame, threshold: int = 5, key: str = "routed_district") -> DataFrame:
    """Counters of the chain: events routed, keys, events without a key, checked, alerted."""
    routed = route_counters(key)
    counters = {
        "routed": routed.pop("routed"),
        "active_districts": F.count_distinct(F.col(key)),
        **routed,
        **check_counters(threshold),
    }
    return counted.agg(*[column.alias(name) for name, column in counters.items()])
