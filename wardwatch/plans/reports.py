"""The batch tables: trends, arrest rates, violence, offenders, cross-dataset rates.

Every table function takes rows, or rows counted already (``weight`` names the count), so
that several tables can be built from one small frame of counts: see plans/batch.py.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import ratio
from wardwatch.operators import (
    correlate,
    density,
    match_facts,
    match_rate,
    matches_by,
    mode_lookup,
    share,
    tally,
    trends,
)

HOMICIDE = "HOMICIDE"
GUNSHOT = "YES"
MINOR = "Y"
NOISE_FLOOR = 10
OFFENDER_COLUMNS = [
    "last",
    "first",
    "block",
    "gender",
    "race",
    "birth_date",
    "height",
    "weight",
    "victim_minor",
]


# Trends


def trends_by_year(crimes: DataFrame, ts: str = "date") -> DataFrame:
    return trends(crimes, ts, ["year"], "crime_count")


def trends_by_month(crimes: DataFrame, ts: str = "date") -> DataFrame:
    return trends(crimes, ts, ["year", "month"], "crime_count")


def trends_by_dow(crimes: DataFrame, ts: str = "date") -> DataFrame:
    return trends(crimes, ts, ["day_of_week"], "crime_count")


def trends_by_hour(crimes: DataFrame, ts: str = "date") -> DataFrame:
    return trends(crimes, ts, ["hour_of_day"], "crime_count")


# Arrest rates


def arrest_facts(crimes: DataFrame, arrests: DataFrame, dims: list[str]) -> DataFrame:
    """Crimes left join arrests on the case, counted; input of the four tables below."""
    return match_facts(crimes, arrests, "case_number", dims, "race")


def _arrest_rate(facts: DataFrame, key: str) -> DataFrame:
    return match_rate(facts, [key], "race", "total_crimes", "total_arrests", "arrest_rate")


def rate_by_type(facts: DataFrame) -> DataFrame:
    return _arrest_rate(facts, "primary_type")


def rate_by_district(facts: DataFrame) -> DataFrame:
    return _arrest_rate(facts, "district")


def top_types(rates: DataFrame, n: int = 10, least: int = NOISE_FLOOR) -> DataFrame:
    """The types with the highest rate among those with enough crimes."""
    return (
        rates.filter(F.col("total_crimes") >= least)
        .orderBy(F.desc_nulls_last("arrest_rate"), F.asc_nulls_last("primary_type"))
        .limit(n)
    )


def matches_by_race(facts: DataFrame) -> DataFrame:
    return matches_by(facts, "race", "arrestee_race", "total_arrests")


# Violence


def violence_by_month(violence: DataFrame, weight: str | None = None) -> DataFrame:
    return tally(violence, ["month", "victimization_primary"], "incident_count", weight)


def violence_by_district(violence: DataFrame, weight: str | None = None) -> DataFrame:
    return tally(violence, ["district", "victimization_primary"], "incident_count", weight)


def _gunshot(violence: DataFrame, keys: list[str], weight: str | None) -> DataFrame:
    hit = F.col("gunshot_injury_i") == GUNSHOT
    names = "total_incidents", "gunshot_yes", "gunshot_proportion"
    return share(violence, keys, hit, *names, weight=weight)


def gunshot_overall(violence: DataFrame, weight: str | None = None) -> DataFrame:
    return _gunshot(violence, [], weight)


def gunshot_by_district(violence: DataFrame, weight: str | None = None) -> DataFrame:
    return _gunshot(violence, ["district"], weight)


def violence_by_community(violence: DataFrame, weight: str | None = None) -> DataFrame:
    """Incidents, homicides and others; an incident without class is in neither."""
    one = F.lit(1) if weight is None else F.col(weight)
    kind = F.col("victimization_primary")
    return (
        violence.filter(F.col("community_area").isNotNull())
        .groupBy("community_area")
        .agg(
            F.sum(one).alias("total_incidents"),
            F.sum(F.when(kind == HOMICIDE, one).otherwise(0)).alias("homicides"),
            F.sum(F.when(kind != HOMICIDE, one).otherwise(0)).alias("non_fatal"),
        )
    )


# Offenders


def offender_density(
    offenders: DataFrame, crimes: DataFrame, stations: DataFrame, weight: str | None = None
) -> DataFrame:
    """Offenders per district by way of their block, with the district's station."""
    lookup = mode_lookup(crimes, "block", "district", weight)
    counted = density(offenders, lookup, "block", "district", "offender_count")
    return counted.join(
        stations.select("district", "district_name", "address"), "district", "left"
    )


def minor_victims(offenders: DataFrame) -> DataFrame:
    return offenders.filter(F.col("victim_minor") == MINOR).select(*OFFENDER_COLUMNS)


# Cross-dataset rates


def district_corr(
    crimes: DataFrame,
    violence: DataFrame,
    weight: str | None = None,
    violence_weight: str | None = None,
) -> DataFrame:
    """Arrest rate (by the flag of the crime) and violence rate per district.

    Crimes without a district are a group of their own, to which no arrests and no
    violence belong.
    """
    one = F.lit(1) if weight is None else F.col(weight)
    arrested = F.col("arrest") & F.col("district").isNotNull()
    base = crimes.groupBy("district").agg(
        F.sum(one).alias("total_crimes"),
        F.sum(F.when(arrested, one).otherwise(0)).alias("total_arrests"),
    )
    incidents = tally(violence, ["district"], "total_violence_incidents", violence_weight)
    return (
        correlate(base, [incidents], "district", ["total_violence_incidents"])
        .withColumn("arrest_rate", ratio("total_arrests", "total_crimes"))
        .withColumn("violence_rate", ratio("total_violence_incidents", "total_crimes"))
    )


def community_corr(
    crimes: DataFrame, offenders: DataFrame, weight: str | None = None
) -> DataFrame:
    """Offenders per 100 crimes by community area."""
    known = crimes.filter(F.col("community_area").isNotNull())
    base = tally(known, ["community_area"], "total_crimes", weight)
    lookup = mode_lookup(crimes, "block", "community_area", weight)
    counted = density(offenders, lookup, "block", "community_area", "offender_count")
    return correlate(base, [counted], "community_area", ["offender_count"]).withColumn(
        "offender_density_per_100_crimes", ratio("offender_count", "total_crimes", scale=100)
    )
