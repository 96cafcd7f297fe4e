"""The streams must give what the batch operators give, however the input arrives."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from helpers import plan, rows

from wardwatch import operators as ops
from wardwatch.sources import event_source, read_table, write_parquet
from wardwatch.sources.events import MESSAGE_SCHEMA
from wardwatch.streaming import alert_query, alert_sink, append_table, held_counts, latest
from wardwatch.streaming import live_counts, open_windows, rolling_count_stream, stage_counters
from wardwatch.streaming import stream_counters, update_table
from wardwatch.plans import views
from wardwatch.plans.feed import stored_feed
from wardwatch.schemas import ALERT_SCHEMA
from wardwatch.streaming.levels import Levels

START = datetime(2024, 3, 1)
NOW = {"availableNow": True}
EVENTS = "k string, ts timestamp, id long, note string"


class Folder:
    """Input files, each written as one and dated in order, and the places of a query."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.files = spark, path, schema, 0
        self.input.mkdir()

    @property
    def input(self):
        return self.path / "in"

    def place(self, name):
        return str(self.path / name)

    def add(self, data):
        staged = self.path / f"staged-{self.files}"
        write_parquet(self.spark.createDataFrame(data, self.schema).coalesce(1), str(staged))
        (part,) = staged.glob("part-*.parquet")
        target = self.input / f"{self.files:03d}.parquet"
        target.write_bytes(part.read_bytes())
        os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1


def run_counts(folder, window=300, out="out", **options):
    def emit(counted, batch_id):
        write_parquet(counted, folder.place(f"{out}/batch_id={batch_id}"))

    stream = (
        folder.spark.readStream.schema(folder.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(folder.input))
    )
    query = rolling_count_stream(
        stream,
        emit,
        key="k",
        ts="ts",
        event_id="id",
        state_dir=folder.place("state"),
        checkpoint_dir=folder.place("checkpoint"),
        window_seconds=window,
        trigger=NOW,
        **options,
    )
    query.awaitTermination()
    return read_table(folder.spark, folder.place(out))


def some_events(n=120, seed=1):
    rng = random.Random(seed)
    at, events = START, []
    for i in range(n):
        at += timedelta(seconds=rng.choice([0, 1, 40, 200]))
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        events.append((key, at, i, f"note {i}"))
    return events


def batch_counts(spark, events, window=300):
    counted = ops.rolling_count(spark.createDataFrame(events, EVENTS), "k", "ts", "id", window)
    return rows(counted, "id", "k", "note", "window_count")


@pytest.mark.parametrize("files", [1, 5])
def test_counts_are_those_of_the_batch(spark, tmp_path, files):
    events = some_events()
    folder = Folder(spark, tmp_path, EVENTS)
    size = -(-len(events) // files)
    for i in range(files):
        folder.add(events[i * size : (i + 1) * size])
    counted = run_counts(folder, marks_per_task=20)
    assert rows(counted, "id", "k", "note", "window_count") == batch_counts(spark, events)


def test_micro_batches_stay_in_the_jvm(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(some_events(30))
    folder.add(some_events(60)[30:])
    plans = []
    query = rolling_count_stream(
        spark.readStream.schema(EVENTS).parquet(str(folder.input)),
        lambda counted, batch_id: plans.append(plan(counted)),
        key="k",
        ts="ts",
        event_id="id",
        state_dir=folder.place("state"),
        checkpoint_dir=folder.place("checkpoint"),
        marks_per_task=10,
        trigger=NOW,
    )
    query.awaitTermination()
    assert plans
    for text in plans:
        assert "Python" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_restart_goes_on_and_repeats_nothing(spark, tmp_path):
    events = some_events()
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(events[:50])
    run_counts(folder)
    folder.add(events[50:])
    run_counts(folder)
    counted = run_counts(folder)
    assert rows(counted, "id", "k", "note", "window_count") == batch_counts(spark, events)


def test_a_repeated_batch_writes_the_same(spark, tmp_path):
    """The last commit is lost, as after a crash before it: the batch runs again."""
    events = some_events(90)
    folder = Folder(spark, tmp_path, EVENTS)
    for i in range(3):
        folder.add(events[i * 30 : i * 30 + 30])
    run_counts(folder)
    commits = tmp_path / "checkpoint" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink(missing_ok=True)
    counted = run_counts(folder)
    assert rows(counted, "id", "k", "note", "window_count") == batch_counts(spark, events)


def test_late_events_within_the_allowance_count_in_order(spark, tmp_path):
    events = some_events(60)
    late = events[20:25]
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(events[:20] + events[25:30])
    folder.add(late + events[30:])
    allowance = int((events[29][1] - events[20][1]).total_seconds()) + 1
    end = events[-1][1] + timedelta(seconds=allowance + 1)
    # Each key is closed by its own events.
    keys = sorted({e[0] for e in events}, key=str)
    folder.add([(k, end, 1000 + n, "end") for n, k in enumerate(keys)])
    counted = run_counts(folder, lateness_seconds=allowance).filter("note != 'end'")
    assert rows(counted, "id", "k", "note", "window_count") == batch_counts(spark, events)


def test_without_an_allowance_events_come_out_on_arrival(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add([("a", START + timedelta(seconds=100), 1, "")])
    folder.add([("a", START, 2, ""), ("a", START + timedelta(seconds=101), 3, "")])
    assert rows(run_counts(folder), "id", "window_count") == [(1, 1), (2, 1), (3, 3)]


def test_a_repeated_id_is_dropped(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add([("a", START, 1, ""), ("a", START, 1, "")])
    folder.add([("a", START, 1, ""), ("a", START + timedelta(seconds=1), 2, "")])
    counted = run_counts(folder, drop_repeats=True)
    assert rows(counted, "id", "window_count") == [(1, 1), (2, 2)]


def test_every_message_counts_by_default(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add([("a", START, 1, ""), ("a", START, 1, "")])
    folder.add([("a", START, 1, "")])
    assert rows(run_counts(folder), "id", "window_count") == [(1, 1), (1, 2), (1, 3)]


def seconds(*times, key="a", first=0):
    return [(key, START + timedelta(seconds=t), first + k, "") for k, t in enumerate(times)]


def test_a_future_time_changes_no_other_key(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(seconds(0) + seconds(10**9, key="b", first=10))
    folder.add(seconds(1, first=1))
    folder.add(seconds(2, first=2))
    assert rows(run_counts(folder), "id", "window_count") == [(0, 1), (1, 2), (10, 1), (2, 3)]


def test_an_event_far_behind_is_no_low_count(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(seconds(0, 1, 1000, 1000))
    folder.add(seconds(2, 1001, first=4))
    counted = run_counts(folder)
    assert rows(counted, "id", "window_count") == [
        (0, 1),
        (1, 2),
        (2, 1),
        (3, 2),
        (4, None),
        (5, 3),
    ]
    counters = stream_counters(spark, folder.place("state"))
    assert rows(counters, "batch_id", "late", "untimed") == [(0, 0, 0), (1, 1, 0)]


def test_late_events_have_an_output(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(seconds(0, 1, 1000, 1000))
    folder.add(seconds(2, 1001, first=4))

    def late(rows, batch_id):
        write_parquet(rows, folder.place(f"late/batch_id={batch_id}"))

    counted = run_counts(folder, late=late)
    assert rows(counted, "id", "window_count") == [(0, 1), (1, 2), (2, 1), (3, 2), (5, 3)]
    assert rows(read_table(spark, folder.place("late")), "id", "note") == [(4, "")]


def test_an_event_behind_by_less_than_a_window_is_exact(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(seconds(0, 1, 290))
    folder.add(seconds(2, first=3))
    assert rows(run_counts(folder), "id", "window_count") == [(0, 1), (1, 2), (2, 3), (3, 3)]


def test_events_without_a_time_are_kept(spark, tmp_path):
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add([("a", START, 1, ""), ("a", None, 2, "x")])
    folder.add([(None, None, 3, "y"), ("a", START, 4, "")])
    counted = run_counts(folder)
    assert rows(counted, "id", "note", "window_count") == [
        (1, "", 1),
        (2, "x", None),
        (3, "y", None),
        (4, "", 2),
    ]
    counters = stream_counters(spark, folder.place("state"))
    assert rows(counters, "batch_id", "untimed") == [(0, 1), (1, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_events_within_the_allowance(spark, tmp_path, seed):
    """Out of order over several batches, with far future times under one key."""
    events = some_events(80, seed)
    order = sorted(events, key=lambda e: e[1] + timedelta(seconds=random.Random(e[2]).randrange(900)))
    far = [("future", START + timedelta(days=9000 + k), 500 + k, "") for k in range(3)]
    folder = Folder(spark, tmp_path, EVENTS)
    for low in range(0, 80, 20):
        folder.add(order[low : low + 20] + far[low // 40 : low // 40 + 1])
    keys = {e[0] for e in events}
    end = max(e[1] for e in events) + timedelta(seconds=2000)
    folder.add([(k, end, 900 + n, "end") for n, k in enumerate(sorted(keys, key=str))])
    counted = run_counts(folder, lateness_seconds=1000)
    counted = counted.filter("note like 'note%'")
    assert rows(counted, "id", "k", "note", "window_count") == batch_counts(spark, events)


def test_state_holds_one_window(spark, tmp_path):
    """And what late events need, here nothing; older rows go when folders are merged."""
    folder = Folder(spark, tmp_path, EVENTS)
    for i in range(9):
        folder.add([("a", START + timedelta(seconds=250 * i), i, "x")])
    run_counts(folder, late_seconds=0)
    log = Levels(spark, folder.place("state/events"))
    kept = rows(log.read(log.newest()), "id", "note")
    assert {(7, None), (8, None)} <= set(kept) and len(kept) < 5


def size(path):
    return sum(file.stat().st_size for file in path.rglob("*.parquet"))


def test_a_trigger_writes_in_proportion_to_its_batch(spark, tmp_path):
    """Twenty batches on one key after one with many keys, which then are silent."""
    folder = Folder(spark, tmp_path, EVENTS)
    rng = random.Random(2)
    names = ["".join(rng.choices("abcdefgh", k=60)) for _ in range(4000)]
    silent = [(k, START, i, "x") for i, k in enumerate(names)]
    folder.add(silent)
    run_counts(folder)
    rows_of = tmp_path / "state" / "events" / "rows"
    first = {path.name: size(path) for path in rows_of.iterdir()}
    written = 0
    for i in range(20):
        folder.add(seconds(i, i, first=10_000 + 2 * i))
    run_counts(folder)
    later = [path for path in rows_of.iterdir() if path.name not in first]
    written = max(size(path) for path in later)
    assert set(first) <= {path.name for path in rows_of.iterdir()}  # carried, not written again
    assert written < 0.1 * sum(first.values())
    # A silent key still counts.
    folder.add([(names[7], START + timedelta(seconds=1), 20_000, "x")])
    counted = run_counts(folder)
    assert rows(counted.filter("id >= 20000"), "id", "window_count") == [(20_000, 2)]
    assert counted.agg({"window_count": "max"}).first()[0] == 40


def test_one_wrong_time_costs_its_key_nothing(spark, tmp_path):
    """An event of 2090 among those of a busy key, which go on in order."""
    events = seconds(*range(0, 500, 10))
    wrong = ("a", START + timedelta(days=24_000), 900, "")
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(events[:25] + [wrong])
    folder.add(events[25:])
    counted = run_counts(folder)
    assert rows(counted, "id", "k", "note", "window_count") == batch_counts(spark, [*events, wrong])
    assert counted.filter("window_count IS NULL").count() == 0


def test_a_wrong_time_lets_no_event_out_early(spark, tmp_path):
    """With an allowance, later events of the key still come before those that wait."""
    folder = Folder(spark, tmp_path, EVENTS)
    order = [0, 10, 20, 40, 30, 60, 50, 80, 70, 90]
    events = seconds(*order)
    wrong = ("a", START + timedelta(days=24_000), 900, "")
    folder.add([events[0], wrong, *events[1:4]])
    folder.add(events[4:])
    counted = run_counts(folder, lateness_seconds=30)
    held = held_counts(
        spark, folder.place("state"), "k", "ts", "id", lateness_seconds=30
    )
    assert counted.filter("id = 900").count() == 0 and held.filter("id = 900").count() == 1
    every = counted.select(held.columns).unionByName(held)
    assert rows(every, "id", "k", "note", "window_count") == batch_counts(spark, [*events, wrong])


def message(i, second, district="8", **fields):
    body = {"case_number": f"C{i}", "primary_type": "THEFT", "district": district, **fields}
    at = START + timedelta(seconds=second)
    return (district, bytearray(json.dumps(body).encode()), at, f"m{i:04d}")


def run_alerts(folder, **options):
    query = alert_query(
        event_source(folder.spark, path=str(folder.input), max_per_batch=1),
        alert_sink(folder.place("table"), folder.place("documents")),
        state_dir=folder.place("state"),
        checkpoint_dir=folder.place("checkpoint"),
        trigger=NOW,
        **options,
    )
    query.awaitTermination()
    return query


@pytest.fixture
def alert_folder(spark, tmp_path):
    folder = Folder(spark, tmp_path, MESSAGE_SCHEMA)
    folder.add([message(i, i * 10, block="B", latitude=41.5) for i in range(4)])
    broken = ("8", bytearray(b"{"), START, "broken")
    listed = ("8", bytearray(b"[1]"), START, "listed")
    folder.add([message(4, 40), message(5, 50), message(6, 60, district="9"), broken, listed])
    folder.add([message(7, 350)])
    return folder


def test_alert_chain(spark, alert_folder):
    run_alerts(alert_folder)
    alerts = read_table(spark, alert_folder.place("table"))
    # Window of 300 s: event 7 at second 350 no longer sees those up to second 50.
    shown = rows(alerts, "latest_case_number", "crime_count_in_window", "severity", "district")
    assert shown == [("C4", 5, "LOW", "8"), ("C5", 6, "LOW", "8")]
    documents = spark.read.json(alert_folder.place("documents"))
    assert rows(documents, "alert_id") == rows(alerts, "alert_id")
    assert rows(alerts, "triggered_at")[0] == (START + timedelta(seconds=40),)


def test_batches_without_alerts_leave_nothing(spark, alert_folder):
    run_alerts(alert_folder)
    batches = sorted(p.name for p in (alert_folder.path / "table").glob("day=*/run=*/*"))
    assert batches == ["batch_id=0", "batch_id=1"]


def test_alerts_of_a_rerun_are_not_doubled(spark, alert_folder):
    run_alerts(alert_folder)
    (alert_folder.path / "checkpoint" / "commits" / "2").unlink()
    (alert_folder.path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    run_alerts(alert_folder)
    run_alerts(alert_folder)
    assert read_table(spark, alert_folder.place("table")).count() == 2


def test_a_new_checkpoint_overwrites_no_alerts(spark, alert_folder):
    run_alerts(alert_folder)
    before = rows(read_table(spark, alert_folder.place("table")), "alert_id")
    for name in ("checkpoint", "state"):
        (alert_folder.path / name).rename(alert_folder.path / f"old-{name}")
    alert_folder.add([message(20 + i, 10_000 + i) for i in range(5)])
    run_alerts(alert_folder)
    after = rows(read_table(spark, alert_folder.place("table")), "alert_id")
    assert set(before) < set(after) and len(after) == 2 * len(before) + 1


def test_feed_reads_the_newest_days_alone(spark, tmp_path):
    table = str(tmp_path / "table")
    shown = [
        (f"A{n}", "T", str(n % 2), 5, 300, 5, "T", f"C{n}", None, None, None)
        + (START + timedelta(hours=8 * n), "LOW" if n % 3 else "HIGH")
        for n in range(60)
    ]
    alerts = spark.createDataFrame(shown, ALERT_SCHEMA)
    alert_sink(table=table)(alerts.limit(0), 0)
    alert_sink(table=table)(alerts, 1)
    alert_sink(table=table)(alerts, 1)  # repeated
    for options in ({}, {"n": 4}, {"severity": "HIGH", "n": 3}, {"district": "1", "severity": "LOW"}):
        found = stored_feed(spark, table, **options)
        assert rows(found) == rows(views.v_alert_feed(alerts, **options))
    days = {path.split("day=")[1][:10] for path in stored_feed(spark, table, n=4).inputFiles()}
    assert days == {"2024-03-20", "2024-03-19"}


def test_counters_of_all_stages(spark, alert_folder):
    run_alerts(alert_folder)
    counters = stage_counters(spark, alert_folder.place("state"))
    names = ["parsed", "malformed", "errors", "routed", "events_checked", "anomalies_detected"]
    assert rows(counters, "batch_id", *names, "alerts_written", "sink_errors") == [
        (0, 4, 0, 0, 4, 4, 0, 0, 0),
        (1, 3, 1, 1, 3, 3, 2, 2, 0),
        (2, 1, 0, 0, 1, 1, 0, 0, 0),
    ]


def test_a_failing_sink_is_counted(spark, alert_folder):
    def sink(alerts, batch_id):
        raise RuntimeError("no place")

    query = alert_query(
        event_source(spark, path=str(alert_folder.input)),
        sink,
        state_dir=alert_folder.place("state"),
        checkpoint_dir=alert_folder.place("checkpoint"),
        trigger=NOW,
    )
    with pytest.raises(Exception, match="no place"):
        query.awaitTermination()
    counters = stage_counters(spark, alert_folder.place("state"))
    assert rows(counters, "anomalies_detected", "alerts_written", "sink_errors") == [(2, 0, 2)]


def test_live_counts_of_a_running_stream(spark, tmp_path):
    """A silent key falls out of the snapshot as the others go on."""
    folder = Folder(spark, tmp_path, EVENTS)
    parts = [
        seconds(0, 10, 20) + seconds(5, key="b", first=10),
        seconds(200, 310, first=20),
        seconds(600, 601, key=None, first=30),
    ]
    for part in parts:
        folder.add(part)
    taken = {}

    def snapshot(live, batch_id):
        taken[batch_id] = rows(live)

    run_counts(folder, snapshot=snapshot)
    assert taken == {
        0: [("a", 3), ("b", 1)],
        1: [("a", 3)],
        2: [(None, 2), ("a", 1)],
    }
    for batch_id, end in enumerate((20, 310, 601)):
        arrived = spark.createDataFrame(sum(parts[: batch_id + 1], []), EVENTS)
        at = START + timedelta(seconds=end)
        assert taken[batch_id] == rows(ops.window_snapshot(arrived, "k", "ts", at))
    now = live_counts(spark, folder.place("state"), "k", "ts")
    assert rows(now) == taken[2]
    later = START + timedelta(seconds=901)
    assert rows(live_counts(spark, folder.place("state"), "k", "ts", as_of=later)) == []


def test_closed_and_open_windows_are_all(spark, tmp_path):
    events = some_events(60)
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(events[:30])
    folder.add(events[30:])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1)
    windows = ops.sliding_counts(stream.parquet(str(folder.input)), "k", "ts")
    place = folder.place("checkpoint")
    append_table(windows, folder.place("out"), place, NOW).awaitTermination()
    closed = read_table(spark, folder.place("out"))
    still_open = open_windows(spark, place, "k")
    assert still_open.count() > 0
    table = spark.createDataFrame(events, EVENTS)
    assert rows(closed.unionByName(still_open)) == rows(ops.sliding_counts(table, "k", "ts"))


def test_counters_are_in_the_progress(spark, alert_folder):
    query = run_alerts(alert_folder)
    counters = [p["observedMetrics"]["parse_stats"] for p in query.recentProgress]
    by_name = [c.asDict() if hasattr(c, "asDict") else c for c in counters]
    assert [c["messages_consumed"] for c in by_name] == [4, 5, 1]
    assert [c["malformed"] for c in by_name] == [0, 1, 0]
    assert [c["errors"] for c in by_name] == [0, 1, 0]


def test_totals_of_changed_keys(spark, tmp_path):
    """Only keys of a batch are written with it, and the latest of each is the total."""
    folder = Folder(spark, tmp_path, EVENTS)
    events = seconds(0, 1) + seconds(2, key="b", first=2) + seconds(3, 4, key=None, first=3)
    folder.add(events)
    folder.add(seconds(9, key="b", first=9))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1)
    totals = ops.key_totals(stream.parquet(str(folder.input)), "k")
    path = folder.place("totals")
    update_table(totals, path, folder.place("checkpoint"), ["k"], NOW).awaitTermination()
    assert rows(latest(spark, path, ["k"])) == [(None, 2), ("a", 2), ("b", 2)]
    assert rows(read_table(spark, f"{path}/rows/1-0"), "k") == [("b",)]


def test_builtin_counts_on_a_stream(spark, tmp_path):
    events = some_events(60)
    folder = Folder(spark, tmp_path, EVENTS)
    folder.add(events[:30])
    folder.add(events[30:])
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1)
    stream = stream.parquet(str(folder.input))
    table = spark.createDataFrame(events, EVENTS)

    def latest(df, name):
        query = df.writeStream.format("memory").queryName(name).outputMode("complete")
        query.trigger(**NOW).start().awaitTermination()
        return rows(spark.table(name))

    totals = latest(ops.key_totals(stream, "k"), "totals")
    assert totals == rows(ops.key_totals(table, "k"))
    sliding = latest(ops.sliding_counts(stream, "k", "ts"), "sliding")
    assert sliding == rows(ops.sliding_counts(table, "k", "ts"))
