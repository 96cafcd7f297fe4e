"""The batch run with shared counts gives what the reports give one by one."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows

from wardwatch.plans import batch, reports, views
from wardwatch.schemas import ALERT_SCHEMA, clean_schema


def frame(spark, dataset, data):
    schema = clean_schema(dataset)
    full = [tuple(row.get(name) for name in schema.names) for row in data]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(7)
    districts = ["1", "2", "3", None]
    crimes = [
        {
            "id": str(i),
            "case_number": rng.choice([f"C{i}", "C-hot", None]),
            "date": datetime(2023, 12, 1) + timedelta(hours=rng.randrange(3000)),
            "block": rng.choice(["b1", "b2", "b3", None]),
            "primary_type": rng.choice(["THEFT", "ARSON", None]),
            "arrest": rng.choice([True, False, None]),
            "district": rng.choice(districts),
            "community_area": rng.choice(["7", "8", None]),
            "latitude": rng.choice([41.7, 41.8, 41.9, None]),
            "longitude": rng.choice([-87.6, -87.7]),
        }
        for i in range(300)
    ]
    arrests = [
        {"case_number": rng.choice([f"C{i}", "C-hot", None]), "race": rng.choice(["X", "Y", None])}
        for i in range(100)
    ]
    violence = [
        {
            "month": rng.choice([1, 2, None]),
            "district": rng.choice(districts),
            "community_area": rng.choice(["7", "8", None]),
            "victimization_primary": rng.choice(["HOMICIDE", "BATTERY", None]),
            "gunshot_injury_i": rng.choice(["YES", "NO", None]),
        }
        for _ in range(200)
    ]
    offenders = [
        {
            "last": f"L{i}",
            "first": "F",
            "block": rng.choice(["b1", "b2", "b9", None]),
            "victim_minor": rng.choice(["Y", "N", None]),
            "weight": 150,
        }
        for i in range(50)
    ]
    stations = [{"district": d, "district_name": f"D{d}", "address": "A"} for d in ("1", "2")]
    return {
        "crimes": frame(spark, "crimes", crimes),
        "arrests": frame(spark, "arrests", arrests),
        "violence": frame(spark, "violence", violence),
        "sex_offenders": frame(spark, "sex_offenders", offenders),
        "police_stations": frame(spark, "police_stations", stations),
    }


@pytest.fixture(scope="module")
def written(inputs):
    tables = {}
    batch.run_batch(inputs, lambda df, name: tables.__setitem__(name, df), k=3)
    return tables


def test_nineteen_tables(written):
    assert len(written) == 20


def test_shared_counts_change_nothing(inputs, written):
    crimes, arrests, violence, offenders, stations = (
        inputs[name]
        for name in ("crimes", "arrests", "violence", "sex_offenders", "police_stations")
    )
    by_type = reports.arrest_facts(crimes, arrests, ["primary_type"])
    by_district = reports.arrest_facts(crimes, arrests, ["district"])
    alone = {
        "crime_trends_by_year": reports.trends_by_year(crimes),
        "crime_trends_by_month": reports.trends_by_month(crimes),
        "crime_trends_by_day_of_week": reports.trends_by_dow(crimes),
        "crime_trends_by_hour": reports.trends_by_hour(crimes),
        "arrest_rate_by_crime_type": reports.rate_by_type(by_type),
        "top10_crime_types_by_arrest_rate": reports.top_types(reports.rate_by_type(by_type)),
        "arrest_rate_by_district": reports.rate_by_district(by_district),
        "arrests_by_race": reports.matches_by_race(by_type),
        "violence_by_month": reports.violence_by_month(violence),
        "violence_by_district": reports.violence_by_district(violence),
        "gunshot_injury_proportion": reports.gunshot_overall(violence),
        "gunshot_proportion_by_district": reports.gunshot_by_district(violence),
        "top_community_areas_by_violence": reports.violence_by_community(violence),
        "sex_offender_density_by_district": reports.offender_density(offenders, crimes, stations),
        "sex_offenders_minor_victims_priority": reports.minor_victims(offenders),
        "district_arrest_vs_violence_correlation": reports.district_corr(crimes, violence),
        "community_offender_vs_crime_correlation": reports.community_corr(crimes, offenders),
    }
    for name, table in alone.items():
        assert table.schema.names == written[name].schema.names, name
        assert rows(table) == rows(written[name]), name


def test_clustered_tables(inputs, written):
    located = inputs["crimes"].filter("latitude is not null and longitude is not null").count()
    assert sum(r["crime_count"] for r in written["hotspots"].collect()) == located
    assert written["crimes_with_clusters"].count() == located


def test_dashboard_over_the_written_tables(spark, written):
    shown = views.dashboard(written, spark.createDataFrame([], ALERT_SCHEMA))
    counts = {name: view.count() for name, view in shown.items()}
    one_row = {"kpis", "peak_hours", "gunshot_overall", "severity_tiles"}
    assert {name for name in one_row if counts[name] != 1} == set()
    no_alerts = {"alerts_by_severity", "alerts_by_district", "alert_districts", "alert_feed"}
    assert {name for name, n in counts.items() if n == 0} == no_alerts
    kpis = shown["kpis"].first()
    assert kpis["total_crimes"] == 300 and kpis["total_alerts"] == 0
    assert kpis["hotspot_count"] == 3
