"""The shape of physical plans: what is read, what is shuffled, what must not occur."""

import re

import pytest
from helpers import plan

import __spark_entry__ as entry
from wardwatch import operators as ops
from wardwatch.operators import rolling
from wardwatch.plans import reports, views
from wardwatch.schemas import clean_schema
from wardwatch.sources import read_table, write_parquet

QUERIES = entry.queries()
SMALL = "/root/testdata/sf0.001"
NEVER = [
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroups",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    found = {}
    for name in ("crimes", "violence", "sex_offenders", "arrests"):
        path = str(folder / name)
        write_parquet(spark.createDataFrame([], clean_schema(name)), path)
        found[name] = read_table(spark, path)
    return found


def read_columns(df):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan(df) + "\n")
    return [sorted(part.split(":")[0] for part in s.split(",") if part) for s in schemas]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not [word for word in NEVER if word in text]


def test_scans_read_only_what_is_used(tables):
    assert read_columns(reports.trends_by_month(tables["crimes"])) == [["date"]]
    assert read_columns(reports.gunshot_by_district(tables["violence"])) == [
        ["district", "gunshot_injury_i"]
    ]
    facts = reports.arrest_facts(tables["crimes"], tables["arrests"], ["primary_type"])
    assert read_columns(facts) == [["case_number", "primary_type"], ["case_number", "race"]]


def test_filters_reach_the_scan(tables):
    located = plan(ops.located(tables["crimes"], "latitude", "longitude"))
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude)]" in located
    minors = plan(reports.minor_victims(tables["sex_offenders"]))
    assert "EqualTo(victim_minor,Y)" in minors


def test_counts_are_partial_before_the_shuffle(tables):
    text = plan(reports.violence_by_month(tables["violence"]))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_ranking_is_limited_before_the_shuffle(tables):
    text = plan(ops.mode_lookup(tables["crimes"], "block", "district"))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 2


def test_top_lists_do_not_sort_everything(tables):
    facts = reports.arrest_facts(tables["crimes"], tables["arrests"], ["primary_type"])
    assert "TakeOrderedAndProject" in plan(reports.top_types(reports.rate_by_type(facts)))
    density = tables["crimes"].groupBy("district").count().withColumnRenamed(
        "count", "offender_count"
    )
    assert "TakeOrderedAndProject" in plan(views.v_density_top(density))


def test_density_join_reuses_the_partitioning_by_block(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = ops.mode_lookup(tables["crimes"], "block", "district")
        text = plan(ops.density(tables["sex_offenders"], lookup, "block", "district", "n"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Pairs, ranking by block, offenders by block, result by district.
    assert text.count("Exchange") == 4


def test_rolling_count_shuffles_once(tables):
    crimes = tables["crimes"].select("id", "date", "district")
    text = plan(ops.rolling_count(crimes, "district", "date", "id"))
    assert text.count("Exchange") == 1
    assert "hashpartitioning(_key" in text and "_block" in text


def test_large_groups_are_told_apart_by_an_equal_join(spark):
    events = spark.range(1000).selectExpr("'k' AS k", "timestamp_seconds(0) AS ts", "id")
    width = 300 * rolling.SECOND
    marks = rolling._marks(events, "k", "ts", "id", width)
    large = rolling._large_groups(events, "k", "ts", width, 100)
    text = plan(rolling._told_apart(marks, large))
    assert "LeftOuter" in text and ("HashJoin" in text or "SortMergeJoin" in text)
    assert not [word for word in NEVER if word in text]
    text = plan(ops.rolling_count(events, "k", "ts", "id", marks_per_task=100))
    assert not [word for word in NEVER if word in text]
