"""The rolling count against a plain count of every event's window."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from wardwatch import operators as ops
from wardwatch.operators import rolling

START = datetime(2024, 3, 1)
SCHEMA = "k string, ts timestamp, id long"


def brute_force(events, window):
    """For every event those of its key in (ts - window, ts], equal times up to its id."""
    counts = {}
    for key, ts, event_id in events:
        if ts is None:
            counts[event_id] = None
            continue
        counts[event_id] = sum(
            1
            for other_key, other, other_id in events
            if other_key == key
            and other is not None
            and ts - timedelta(seconds=window) < other
            and (other, other_id) <= (ts, event_id)
        )
    return counts


def count(spark, events, window, **options):
    df = spark.createDataFrame(events, SCHEMA).repartition(4)
    counted = ops.rolling_count(df, "k", "ts", "id", window, **options)
    return {r["id"]: r["window_count"] for r in counted.collect()}


def test_edges_of_the_window(spark):
    micro = timedelta(microseconds=1)
    window = timedelta(seconds=300)
    events = [
        ("a", START, 1),
        ("a", START + window, 2),  # the first is exactly one window old: out
        ("a", START + window - micro, 3),  # one microsecond younger: in
        ("b", START, 4),
        ("b", START, 5),  # equal times count in id order
        ("b", START, 6),
        (None, START, 7),
        (None, START + micro, 8),
        ("a", None, 9),
        ("a", None, 10),
    ]
    expected = {1: 1, 3: 2, 2: 2, 4: 1, 5: 2, 6: 3, 7: 1, 8: 2, 9: None, 10: None}
    assert brute_force(events, 300) == expected
    assert count(spark, events, 300) == expected
    assert count(spark, events, 300, marks_per_task=1) == expected


def random_events(seed, n):
    """A third under one key, half of those at one instant; ties, bursts, NULLs."""
    rng = random.Random(seed)
    events = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        second = rng.choice([0, 0, rng.randrange(40), rng.randrange(2000)])
        ts = START + timedelta(seconds=second, microseconds=rng.choice([0, 0, 1, 999_999]))
        if key == "hot" and rng.random() < 0.5:
            ts = START + timedelta(seconds=700)
        events.append((key, None if rng.random() < 0.02 else ts, i))
    rng.shuffle(events)
    return events


@pytest.mark.parametrize("marks_per_task", [10**6, 60, 10])
@pytest.mark.parametrize("seed, window", [(1, 300), (2, 7), (3, 1), (4, 5000)])
def test_random_events(spark, seed, window, marks_per_task):
    events = random_events(seed, 400)
    counted = count(spark, events, window, marks_per_task=marks_per_task)
    assert counted == brute_force(events, window)


def test_times_before_the_epoch(spark):
    old = [("a", datetime(1969, 12, 31, 23, 59) + timedelta(seconds=7 * i), i) for i in range(40)]
    assert count(spark, old, 60) == brute_force(old, 60)


def test_many_large_groups(spark):
    events = random_events(5, 300)
    assert count(spark, events, 30, marks_per_task=2) == brute_force(events, 30)


def test_untimed_events_of_one_key_are_spread(spark):
    df = spark.range(20_000).select(
        F.lit("a").alias("k"), F.lit(None).cast("timestamp").alias("ts"), F.lit(None).alias("id")
    )
    marks = rolling._marks(df, "k", "ts", "id", 300 * rolling.SECOND)
    assert marks.groupBy("_key", "_block").count().agg(F.max("count")).first()[0] <= 2
    assert ops.rolling_count(df, "k", "ts", "id").filter("window_count is null").count() == 20_000


@pytest.mark.parametrize("marks_per_task", [10**6, 10])
def test_events_are_read_twice(spark, marks_per_task, tmp_path):
    """Once for the sizes, once for the count or to be stored; told by an accumulator."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    events = random_events(9, 300)
    df = spark.createDataFrame(events, SCHEMA)
    df = df.mapInArrow(seen, df.schema)
    ops.rolling_count(df, "k", "ts", "id", 300, marks_per_task=marks_per_task).collect()
    assert read.value == 2 * len(events)


def test_a_hot_group_is_spread_over_tasks(spark):
    """One key at one instant holds a third of the rows: no task sorts all of them."""
    n = 30_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(START).alias("ts"),
        "id",
    )
    limit = 2_000
    counted = ops.rolling_count(df, "k", "ts", "id", 300, marks_per_task=limit)
    hot = counted.filter("k = 'hot'")
    assert hot.count() == n // 3
    assert hot.filter(F.col("window_count") != F.col("id") / 3 + 1).isEmpty()
    marks = rolling._marks(df, "k", "ts", "id", 300 * rolling.SECOND)
    pieces = rolling._range_pieces(marks.filter("_key = 'hot'"), 11)
    largest = pieces.groupBy("_place").count().agg(F.max("count")).first()[0]
    assert largest < 2 * limit


def test_columns_pass_through(spark):
    df = spark.createDataFrame([("a", START, 1, [1, 2])], SCHEMA + ", more array<int>")
    counted = ops.rolling_count(df, "k", "ts", "id")
    assert counted.columns == ["k", "ts", "id", "more", "window_count", "window_seconds"]
    assert counted.first()["more"] == [1, 2]
    assert counted.first()["window_seconds"] == 300


def test_snapshot_includes_its_end_only(spark):
    window = timedelta(seconds=300)
    events = [("a", START - window, 1), ("a", START, 2), ("b", START - window, 3)]
    events += [("c", START + timedelta(microseconds=1), 4)]
    df = spark.createDataFrame(events, SCHEMA)
    assert rows(ops.window_snapshot(df, "k", "ts", START)) == [("a", 1)]


@pytest.mark.parametrize("slide", [60, 100, 130])
def test_sliding_counts(spark, slide):
    events = [e for e in random_events(6, 200) if e[1] is not None]
    df = spark.createDataFrame(events, SCHEMA)
    got = ops.sliding_counts(df, "k", "ts", 300, slide)
    plain = (
        df.groupBy("k", F.window("ts", "300 seconds", f"{slide} seconds"))
        .count()
        .select("k", "window.start", "window.end", "count")
    )
    assert rows(got) == rows(plain)


def test_anomalies_from_the_threshold_on(spark):
    counted = spark.createDataFrame(
        [("8", n, START, f"m{n}") for n in (4, 5, 8, 10, 15)],
        "routed_district string, window_count int, event_time timestamp, message_id string",
    )
    counted = counted.select(
        "*",
        F.lit(300).alias("window_seconds"),
        F.lit("THEFT").alias("primary_type"),
        F.lit("C1").alias("case_number"),
        F.lit("B").alias("block"),
        F.lit(41.5).alias("latitude"),
        F.lit(None).alias("longitude"),
    )
    alerts = ops.detect_anomalies(counted, 5)
    assert rows(alerts, "crime_count_in_window", "severity") == [
        (10, "HIGH"),
        (15, "CRITICAL"),
        (5, "LOW"),
        (8, "MEDIUM"),
    ]
    assert len(alerts.columns) == 13
    assert rows(ops.alert_stats(counted, 5)) == [(5, 1, 0, 5, 4)]
