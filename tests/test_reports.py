"""Counts, match rates, lookups and correlations on rows made for their edge cases."""

from datetime import datetime

from helpers import plan, rows
from pyspark.sql import functions as F

from wardwatch import operators as ops
from wardwatch.plans import reports, views

CRIMES = "case_number string, primary_type string, district string, arrest boolean"


def test_trends_keep_missing_times_as_a_group(spark):
    times = [datetime(2024, 5, 4, 23), datetime(2024, 5, 5, 0), None]
    df = spark.createDataFrame([(t,) for t in times], "date timestamp")
    assert rows(reports.trends_by_month(df)) == [(None, None, 1), (2024, 5, 2)]
    assert rows(reports.trends_by_dow(df)) == [(None, 1), (1, 1), (7, 1)]
    assert rows(reports.trends_by_hour(df)) == [(None, 1), (0, 1), (23, 1)]
    assert rows(reports.trends_by_year(df)) == [(None, 1), (2024, 2)]


def match_inputs(spark):
    crimes = spark.createDataFrame(
        [
            ("a", "T", "1", True),  # no arrest record
            ("b", "T", "1", True),  # one
            ("c", "T", None, True),  # three, one of them without race
            ("c", "U", "2", False),  # the same case a second time
            (None, "U", "2", False),  # no case number
        ],
        CRIMES,
    )
    arrests = spark.createDataFrame(
        [("b", "X"), ("c", "X"), ("c", "Y"), ("c", None), (None, "X"), ("z", "X")],
        "case_number string, race string",
    )
    return crimes, arrests


def test_match_rate_fans_out_like_the_join(spark):
    crimes, arrests = match_inputs(spark)
    facts = reports.arrest_facts(crimes, arrests, ["primary_type", "district"])
    assert rows(reports.rate_by_type(facts)) == [("T", 5, 3, 0.6), ("U", 4, 2, 0.5)]
    assert rows(reports.rate_by_district(facts)) == [
        (None, 3, 2, 0.6667),
        ("1", 2, 1, 0.5),
        ("2", 4, 2, 0.5),
    ]
    assert rows(reports.matches_by_race(facts)) == [("X", 3), ("Y", 2)]


def test_match_facts_equal_the_plain_join(spark):
    crimes, arrests = match_inputs(spark)
    plain = (
        crimes.join(arrests, "case_number", "left")
        .groupBy("primary_type", "district", "race")
        .agg(F.count("*").alias("joined_rows"))
    )
    facts = reports.arrest_facts(crimes, arrests, ["primary_type", "district"])
    assert rows(facts) == rows(plain)


def test_a_case_with_a_third_of_all_rows_is_split(spark):
    """AQE cuts the hot case of the big side; it holds a third of the crimes."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "64KB",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        n = 300_000
        case = F.when(F.col("id") < n // 3, F.lit(-1)).otherwise(F.col("id"))
        crimes = spark.range(0, n, 1, 16).select(
            case.alias("case_number"), F.md5(F.col("id").cast("string")).alias("primary_type")
        )
        arrests = spark.range(0, 30_000, 1, 8).select(
            F.when(F.col("id") < 10_000, F.lit(-1)).otherwise(F.col("id") * 7).alias("case_number"),
            F.when(F.col("id") % 3 > 0, "X").alias("race"),
        )
        facts = reports.arrest_facts(crimes, arrests, ["primary_type"])
        total = facts.agg(F.sum("joined_rows"))
        assert total.collect()[0][0] == 1_000_000_000 + 2 * n // 3
        assert "skew=true" in plan(total)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_top_types_need_ten_crimes(spark):
    rates = spark.createDataFrame(
        [("nine", 9, 9, 1.0), ("ten", 10, 5, 0.5), ("b", 20, 10, 0.5), ("a", 20, 10, 0.5)],
        "primary_type string, total_crimes long, total_arrests long, arrest_rate double",
    )
    top = [r[0] for r in reports.top_types(rates, 2).collect()]
    assert top == ["a", "b"]
    assert len(reports.top_types(rates).collect()) == 3


VIOLENCE = "month int, district string, community_area string, victimization_primary string, "
VIOLENCE += "gunshot_injury_i string"


def violence(spark, *data):
    return spark.createDataFrame(list(data), VIOLENCE)


def test_shares_with_missing_values(spark):
    df = violence(
        spark,
        (1, "1", "7", "HOMICIDE", "YES"),
        (1, "1", "7", None, "NO"),
        (1, "1", "7", "BATTERY", None),
        (2, None, None, "ROBBERY", "YES"),
    )
    assert rows(reports.gunshot_overall(df)) == [(4, 2, 0.5)]
    assert rows(reports.gunshot_by_district(df)) == [(None, 1, 1, 1.0), ("1", 3, 1, 0.3333)]
    assert rows(reports.violence_by_community(df)) == [("7", 3, 1, 1)]
    assert rows(reports.violence_by_month(df)) == [
        (1, None, 1),
        (1, "BATTERY", 1),
        (1, "HOMICIDE", 1),
        (2, "ROBBERY", 1),
    ]


def test_overall_share_of_nothing_is_one_row(spark):
    empty = violence(spark).withColumn("n", F.lit(1))
    assert rows(reports.gunshot_overall(empty)) == [(0, None, None)]
    assert rows(reports.gunshot_overall(empty, "n")) == [(0, None, None)]
    shown = views.v_gunshot_overall(reports.gunshot_overall(empty))
    assert rows(shown) == [(0, None, None, None)]


PLACED = "block string, district string, community_area string, arrest boolean"


def test_mode_lookup(spark):
    df = spark.createDataFrame(
        [
            ("clear", "2", None, True),
            ("clear", "2", None, True),
            ("clear", "1", None, True),
            ("tie", "9", None, True),
            ("tie", "10", None, True),
            ("nowhere", None, None, True),
            (None, "1", None, True),
        ],
        PLACED,
    )
    assert rows(ops.mode_lookup(df, "block", "district")) == [("clear", "2"), ("tie", "10")]


def test_offender_density(spark):
    crimes = spark.createDataFrame(
        [("b1", "1", "5", True), ("b2", "2", "5", True), ("b3", "1", None, True)], PLACED
    )
    blocks = ["b1", "b1", "b2", "b3", "elsewhere", None]
    offenders = spark.createDataFrame([(b,) for b in blocks], "block string")
    stations = spark.createDataFrame(
        [("1", "Central", "1 Main St")], "district string, district_name string, address string"
    )
    density = reports.offender_density(offenders, crimes, stations)
    assert rows(density) == [("1", 3, "Central", "1 Main St"), ("2", 1, None, None)]
    assert rows(reports.community_corr(crimes, offenders)) == [("5", 2, 3, 150.0)]


def test_density_counts_a_hot_block_before_the_join(spark):
    crimes = spark.createDataFrame([("hot", "1", "5", True), ("b", "2", "5", True)], PLACED)
    offenders = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("block")
    )
    lookup = ops.mode_lookup(crimes, "block", "district")
    counted = ops.density(offenders, lookup, "block", "district", "n")
    assert rows(counted) == [("1", 10_000), ("2", 20_000)]


def test_district_corr(spark):
    crimes = spark.createDataFrame(
        [
            ("b", "1", "5", True),
            ("b", "1", "5", False),
            ("b", "1", "5", None),
            ("b", "2", "5", False),
            ("b", None, "5", True),
        ],
        PLACED,
    )
    incidents = violence(spark, (1, "1", "5", "A", "NO"), (1, "9", "5", "A", "NO"))
    incidents = incidents.union(violence(spark, (1, None, "5", "A", "NO")))
    assert rows(reports.district_corr(crimes, incidents)) == [
        (None, 1, 0, 0, 0.0, 0.0),
        ("1", 3, 1, 1, 0.3333, 0.3333),
        ("2", 1, 0, 0, 0.0, 0.0),
    ]


def test_views_break_ties_and_limit(spark):
    table = spark.createDataFrame(
        [(str(i), 5) for i in range(30)] + [(None, 9)], "district string, offender_count long"
    )
    top = [r[0] for r in views.v_density_top(table).collect()]
    assert top == sorted(str(i) for i in range(30))[:15]
    gunshot = spark.createDataFrame(
        [("1", 4, 2, 0.5), ("", 4, 4, 1.0), (None, 4, 4, 1.0)],
        "district string, total_incidents long, gunshot_yes long, gunshot_proportion double",
    )
    assert [r[0] for r in views.v_gunshot_top(gunshot).collect()] == ["1"]


def test_peak_hours_take_the_first_of_equals(spark):
    table = spark.createDataFrame(
        [(3, 9), (5, 9), (7, 1), (8, 1), (1, 4)], "hour_of_day int, crime_count long"
    )
    assert rows(views.v_peak_hours(table)) == [(3, 9, 7, 1)]


def test_alert_feed_binds_its_filters(spark):
    schema = "alert_id string, district string, severity string, crime_count_in_window long, "
    schema += "window_seconds int, threshold int, latest_crime_type string, "
    schema += "latest_case_number string, triggered_at timestamp"
    at = datetime(2024, 1, 1, 12, 30, 5)
    districts = ["1", "' OR 1=1", "1"]
    alerts = spark.createDataFrame(
        [(f"A{i}", d, "LOW", 5, 300, 5, "T", "C", at) for i, d in enumerate(districts)], schema
    )
    feed = views.v_alert_feed(alerts, district="1")
    assert [(r[0], r[-1]) for r in feed.collect()] == [
        ("A0", "2024-01-01 12:30:05"),
        ("A2", "2024-01-01 12:30:05"),
    ]
    assert views.v_alert_feed(alerts, "LOW", "' OR 1=1").count() == 1
    assert views.v_alert_feed(alerts, "HIGH").count() == 0
    assert views.v_alert_feed(alerts, n=2).count() == 2
    assert rows(views.v_severity_tiles(alerts)) == [(0, 0, 0, 3)]
