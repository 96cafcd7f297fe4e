"""The whole batch layer in one run: every report table from the five cleaned tables.

Tables that group the same input are not computed from it one by one. Each input is read
once into a small frame of counts by all the columns its tables group by; the frame is
stored in the shared folder, and the tables are rolled up from that. Its size depends on
the number of distinct values (districts, types, months), not on the number of rows. Only
the counts per street block are larger: one row per block and area.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from wardwatch.functions import calendar_parts
from wardwatch.operators import cluster_sizes, fit_hotspots, fit_summary, label_points, tally
from wardwatch.plans import reports
from wardwatch.session import checkpointed

Write = Callable[[DataFrame, str], None]


def trend_facts(crimes: DataFrame) -> DataFrame:
    """Crimes by year, month, day of week and hour."""
    parts = [column.alias(name) for name, column in calendar_parts("date").items()]
    return tally(crimes, parts, "n")


def violence_facts(violence: DataFrame) -> DataFrame:
    """Incidents by everything the violence tables group by."""
    dims = ["month", "district", "community_area", "victimization_primary", "gunshot_injury_i"]
    return tally(violence, dims, "n")


def place_facts(crimes: DataFrame) -> DataFrame:
    """Crimes by block, district, community area and arrest flag."""
    return tally(crimes, ["block", "district", "community_area", "arrest"], "n")


def trend_tables(crimes: DataFrame) -> dict[str, DataFrame]:
    """The four trend tables from one stored frame of counts."""
    trend = checkpointed(trend_facts(crimes))

    def rolled(*parts):
        return tally(trend, list(parts), "crime_count", weight="n")

    return {
        "crime_trends_by_year": rolled("year"),
        "crime_trends_by_month": rolled("year", "month"),
        "crime_trends_by_day_of_week": rolled("day_of_week"),
        "crime_trends_by_hour": rolled("hour_of_day"),
    }


def arrest_tables(crimes: DataFrame, arrests: DataFrame) -> dict[str, DataFrame]:
    """The four tables of arrest rates from one stored join."""
    arrest = checkpointed(reports.arrest_facts(crimes, arrests, ["primary_type", "district"]))
    by_type = reports.rate_by_type(arrest)
    return {
        "arrest_rate_by_crime_type": by_type,
        "top10_crime_types_by_arrest_rate": reports.top_types(by_type),
        "arrest_rate_by_district": reports.rate_by_district(arrest),
        "arrests_by_race": reports.matches_by_race(arrest),
    }


def violence_tables(incidents: DataFrame) -> dict[str, DataFrame]:
    """The five violence tables from a stored frame of ``violence_facts``."""
    return {
        "violence_by_month": reports.violence_by_month(incidents, "n"),
        "violence_by_district": reports.violence_by_district(incidents, "n"),
        "gunshot_injury_proportion": reports.gunshot_overall(incidents, "n"),
        "gunshot_proportion_by_district": reports.gunshot_by_district(incidents, "n"),
        "top_community_areas_by_violence": reports.violence_by_community(incidents, "n"),
    }


def place_tables(
    places: DataFrame, incidents: DataFrame, offenders: DataFrame, stations: DataFrame
) -> dict[str, DataFrame]:
    """The tables across datasets from stored frames of ``place_facts``, ``violence_facts``."""
    return {
        "sex_offender_density_by_district": reports.offender_density(
            offenders, places, stations, "n"
        ),
        "sex_offenders_minor_victims_priority": reports.minor_victims(offenders),
        "district_arrest_vs_violence_correlation": reports.district_corr(
            places, incidents, "n", "n"
        ),
        "community_offender_vs_crime_correlation": reports.community_corr(
            places, offenders, "n"
        ),
    }


def batch_tables(
    crimes: DataFrame,
    arrests: DataFrame,
    violence: DataFrame,
    offenders: DataFrame,
    stations: DataFrame,
) -> dict[str, DataFrame]:
    """The 17 report tables by name; stores the four frames of counts on the way."""
    incidents = checkpointed(violence_facts(violence))
    places = checkpointed(place_facts(crimes))
    return {
        **trend_tables(crimes),
        **arrest_tables(crimes, arrests),
        **violence_tables(incidents),
        **place_tables(places, incidents, offenders, stations),
    }


def hotspot_tables(crimes: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The two tables of the clustering and the summary of its fit; fits the model."""
    model, positions = fit_hotspots(crimes, k=k)
    keep = ["id", "primary_type", "district"]
    return {
        "hotspots": cluster_sizes(model, positions),
        "crimes_with_clusters": label_points(model, crimes, keep),
        "hotspot_fit": fit_summary(model, positions),
    }


def run_batch(inputs: dict[str, DataFrame], write: Write, k: int = 10) -> None:
    """Build all 19 tables and the summary of the fit, and hand each to ``write(df, name)``.

    ``inputs`` are the cleaned tables by dataset name. A ``write`` is, for example,
    ``lambda df, name: write_jdbc(df, url, name)``.
    """
    tables = batch_tables(
        inputs["crimes"],
        inputs["arrests"],
        inputs["violence"],
        inputs["sex_offenders"],
        inputs["police_stations"],
    )
    tables |= hotspot_tables(inputs["crimes"], k)
    for name, table in tables.items():
        write(table, name)
