"""Views over the batch tables and the alert table, as a dashboard asks for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import (
    bubble_size,
    cluster_label,
    day_name,
    decimal_round,
    full_name,
    percent,
    period_label,
    share_of_total,
    stamp,
)
from wardwatch.functions.columns import SEVERITIES


def _top(df: DataFrame, measure: str, tie: str, n: int | None = None) -> DataFrame:
    """Highest first, equal ones by name, so that the same rows come out every time."""
    ordered = df.orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(tie))
    return ordered if n is None else ordered.limit(n)


# Overview


def v_kpis(
    by_year: DataFrame,
    alerts: DataFrame,
    hotspots: DataFrame,
    rates_by_district: DataFrame,
    gunshot: DataFrame,
) -> DataFrame:
    """The headline numbers in one row, each a scalar subquery of its table."""
    # Both numbers of alerts from one pass; the others are scalars beside them.
    critical = F.col("severity") == "CRITICAL"
    counts = alerts.agg(F.count("*").alias("_total"), F.count_if(critical).alias("_critical"))
    best = _top(rates_by_district, "arrest_rate", "district", 1).select("district")
    rate = gunshot.select(percent("gunshot_proportion"))
    return counts.select(
        by_year.agg(F.sum("crime_count")).scalar().alias("total_crimes"),
        F.col("_total").alias("total_alerts"),
        F.col("_critical").alias("critical_alerts"),
        hotspots.agg(F.count("*")).scalar().alias("hotspot_count"),
        best.scalar().alias("top_district"),
        rate.scalar().alias("gunshot_pct"),
    )


# Time series


def v_monthly(by_month: DataFrame) -> DataFrame:
    ordered = by_month.orderBy("year", "month")
    return ordered.select(period_label("year", "month").alias("period"), "crime_count")


def v_by_hour(by_hour: DataFrame) -> DataFrame:
    return by_hour.select("hour_of_day", "crime_count").orderBy("hour_of_day")


def v_by_dow_named(by_dow: DataFrame) -> DataFrame:
    return by_dow.orderBy("day_of_week").select(
        "day_of_week", "crime_count", day_name("day_of_week").alias("day_name")
    )


def v_peak_hours(by_hour: DataFrame) -> DataFrame:
    """Busiest and quietest hour; the earlier one of equals."""
    hour, count = F.col("hour_of_day"), F.col("crime_count")
    return by_hour.agg(
        F.max_by(hour, F.struct(count, -hour)).alias("peak_hour"),
        F.max(count).alias("peak_count"),
        F.min_by(hour, F.struct(count, hour)).alias("low_hour"),
        F.min(count).alias("low_count"),
    )


# Arrests


def v_rate_pct(rates: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Rates of a table as percentages, highest first."""
    return _top(rates, "arrest_rate", key).select(
        key, "total_crimes", "total_arrests", percent("arrest_rate", digits).alias("arrest_pct")
    )


def v_race(by_race: DataFrame) -> DataFrame:
    return _top(by_race, "total_arrests", "arrestee_race")


# Violence


def v_gunshot_overall(gunshot: DataFrame) -> DataFrame:
    pct = percent("gunshot_proportion").alias("gunshot_pct")
    return gunshot.select("total_incidents", "gunshot_yes", "gunshot_proportion", pct)


def v_violence_by_type(by_month: DataFrame) -> DataFrame:
    total = F.sum("incident_count").alias("total")
    return _top(
        by_month.groupBy("victimization_primary").agg(total), "total", "victimization_primary"
    )


def v_violence_top_districts(by_district: DataFrame, n: int = 10) -> DataFrame:
    total = F.sum("incident_count").alias("total")
    return _top(by_district.groupBy("district").agg(total), "total", "district", n)


def v_gunshot_top(by_district: DataFrame, n: int = 15) -> DataFrame:
    named = by_district.filter(F.col("district").isNotNull() & (F.col("district") != ""))
    shown = named.select(
        "district",
        "total_incidents",
        "gunshot_yes",
        percent("gunshot_proportion").alias("gunshot_pct"),
    )
    return _top(shown, "gunshot_pct", "district", n)


def v_community_top(by_community: DataFrame, n: int = 15) -> DataFrame:
    shown = by_community.select("community_area", "total_incidents", "homicides", "non_fatal")
    return _top(shown, "total_incidents", "community_area", n)


# Hotspots


def v_hotspot_map(hotspots: DataFrame) -> DataFrame:
    return _top(hotspots, "crime_count", "cluster_id").select(
        "cluster_id",
        F.col("centroid_latitude").alias("lat"),
        F.col("centroid_longitude").alias("lon"),
        "crime_count",
        bubble_size("crime_count").alias("size"),
        cluster_label("cluster_id", "crime_count").alias("label"),
    )


def v_cluster_stats(hotspots: DataFrame) -> DataFrame:
    return _top(hotspots, "crime_count", "cluster_id").select(
        "cluster_id",
        F.col("centroid_latitude").alias("lat"),
        F.col("centroid_longitude").alias("lon"),
        F.format_number("crime_count", 0).alias("crimes_assigned"),
        F.concat(share_of_total("crime_count").cast("string"), F.lit("%")).alias("pct_of_total"),
    )


# Offenders


def v_density_top(density: DataFrame, n: int = 15) -> DataFrame:
    named = density.filter(F.col("district").isNotNull())
    return _top(named.select("district", "offender_count"), "offender_count", "district", n)


def v_density_scatter(correlation: DataFrame, n: int = 15) -> DataFrame:
    per_100 = decimal_round("offender_density_per_100_crimes", 2).alias("density_per_100")
    return _top(correlation, "total_crimes", "community_area", n).select(
        "community_area", "total_crimes", "offender_count", per_100
    )


def v_minor_priority(minors: DataFrame, n: int = 50) -> DataFrame:
    shown = minors.select(
        full_name("last", "first").alias("name"), "block", "gender", "race", "victim_minor"
    )
    columns = [F.asc_nulls_last(name) for name in shown.columns]
    return shown.orderBy(*columns).limit(n)


# Alerts


def v_alerts_by_severity(alerts: DataFrame) -> DataFrame:
    counted = alerts.groupBy("severity").agg(F.count("*").alias("cnt"))
    return _top(counted, "cnt", "severity")


def v_severity_tiles(alerts: DataFrame) -> DataFrame:
    """One column per severity, 0 where there is none."""
    return alerts.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])


def v_alerts_by_district(alerts: DataFrame) -> DataFrame:
    named = alerts.filter(F.col("district").isNotNull())
    counted = named.groupBy("district", "severity").agg(F.count("*").alias("cnt"))
    return counted.orderBy("district", "severity")


def v_alert_districts(alerts: DataFrame) -> DataFrame:
    named = alerts.filter(F.col("district").isNotNull())
    return named.select("district").distinct().orderBy("district")


def v_alert_feed(
    alerts: DataFrame, severity: str | None = None, district: str | None = None, n: int = 100
) -> DataFrame:
    """The newest alerts, of one severity or district if given."""
    conditions: list[Column] = []
    if severity is not None:
        conditions.append(F.col("severity") == F.lit(severity))
    if district is not None:
        conditions.append(F.col("district") == F.lit(district))
    for condition in conditions:
        alerts = alerts.filter(condition)
    newest = alerts.orderBy(F.desc_nulls_last("triggered_at"), "alert_id").limit(n)
    return newest.select(
        "alert_id",
        "district",
        "severity",
        "crime_count_in_window",
        "window_seconds",
        "threshold",
        "latest_crime_type",
        "latest_case_number",
        stamp("triggered_at").alias("triggered_at"),
    )


# All of them


def dashboard(tables: dict[str, DataFrame], alerts: DataFrame) -> dict[str, DataFrame]:
    """Every view by name, over the tables of the batch run and the alert table.

    The frames are lazy: one that is not shown costs nothing.
    """
    by_type = tables["arrest_rate_by_crime_type"]
    by_district = tables["arrest_rate_by_district"]
    gunshot = tables["gunshot_injury_proportion"]
    by_year = tables["crime_trends_by_year"]
    by_hour = tables["crime_trends_by_hour"]
    hotspots = tables["hotspots"]
    return {
        "kpis": v_kpis(by_year, alerts, hotspots, by_district, gunshot),
        "monthly": v_monthly(tables["crime_trends_by_month"]),
        "by_hour": v_by_hour(by_hour),
        "by_dow_named": v_by_dow_named(tables["crime_trends_by_day_of_week"]),
        "peak_hours": v_peak_hours(by_hour),
        "rate_pct_top": v_rate_pct(tables["top10_crime_types_by_arrest_rate"], "primary_type"),
        "race": v_race(tables["arrests_by_race"]),
        "rate_pct_district": v_rate_pct(by_district, "district"),
        "rate_pct_all": v_rate_pct(by_type, "primary_type", 2),
        "gunshot_overall": v_gunshot_overall(gunshot),
        "violence_by_type": v_violence_by_type(tables["violence_by_month"]),
        "violence_top_districts": v_violence_top_districts(tables["violence_by_district"]),
        "gunshot_top": v_gunshot_top(tables["gunshot_proportion_by_district"]),
        "community_top": v_community_top(tables["top_community_areas_by_violence"]),
        "hotspot_map": v_hotspot_map(hotspots),
        "cluster_stats": v_cluster_stats(hotspots),
        "density_top": v_density_top(tables["sex_offender_density_by_district"]),
        "density_scatter": v_density_scatter(tables["community_offender_vs_crime_correlation"]),
        "minor_priority": v_minor_priority(tables["sex_offenders_minor_victims_priority"]),
        "alerts_by_severity": v_alerts_by_severity(alerts),
        "severity_tiles": v_severity_tiles(alerts),
        "alerts_by_district": v_alerts_by_district(alerts),
        "alert_districts": v_alert_districts(alerts),
        "alert_feed": v_alert_feed(alerts),
    }
