"""The rolling count as a streaming query."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardwatch.functions import micros
from wardwatch.operators.rolling import MARKS_PER_TASK, SECOND, rolling_count, window_snapshot
from wardwatch.streaming.levels import Levels

Emit = Callable[[DataFrame, int], None]

# The newest arrivals of the stream that tell how far it has come, and the share of them
# that has to be at or beyond a time before the stream is taken to have come there.
RECENT = 1000
SUPPORT = 0.05
FEWEST = 2

_EARLY = -(2**61)


def rolling_count_stream(
    events: DataFrame,
    emit: Emit,
    key: str,
    ts: str,
    event_id: str,
    state_dir: str,
    checkpoint_dir: str,
    window_seconds: int = 300,
    lateness_seconds: int = 0,
    marks_per_task: int = MARKS_PER_TASK,
    trigger: dict | None = None,
    name: str | None = None,
    late: Emit | None = None,
    late_seconds: int | None = None,
    drop_repeats: bool = False,
    ahead_seconds: int | None = None,
    support: float = SUPPORT,
    snapshot: Emit | None = None,
) -> StreamingQuery:
    """Count every event of a stream in its window and hand it to ``emit(df, batch_id)``.

    Every micro-batch runs the batch operator on its events together with the kept ones of
    their keys that their windows reach. So the counts are those of the batch operator, and
    a key that sends a third of the stream is split over tasks as it is there; keyed state
    would have to pass all of it through one task.

    Without ``lateness_seconds`` an event is emitted when it arrives. With it, an event
    waits until that much later ones of its key have been seen, and events that arrive out
    of order by no more than that are counted as if they had come in order; ``held_counts``
    gives those that still wait. An event that is behind its key by up to ``late_seconds``
    more (a window by default) is emitted at once with the exact count of what has arrived.
    One that is further behind could only get a low count: it goes to ``late(df, batch_id)``,
    or without that to ``emit`` with no count. An event without a time is emitted at once
    with no count. ``stream_counters`` tells how many events were late or had no time.

    How far a key has come is decided by its own events, as far as the stream bears them
    out: the stream has come to the newest time that a share ``support`` of its last
    thousand arrivals, and at least two, have reached, and an event more than
    ``ahead_seconds`` (by default lateness and a window) beyond that moves no clock. It is
    counted like any other and kept until its key gets there. So a wrong time in the future
    costs its key nothing, and holds up no other key.

    What is kept are key, time and id of each key's latest events (the three spans
    together), and whole events that wait, as rows added per batch (``levels``): what a
    trigger writes follows the size of its batch, whatever the number of silent keys. Batch n
    reads what batch n-1 left, and nothing depends on the clock; a repeated batch therefore
    finds its input unchanged and writes the same again. With ``drop_repeats`` an id that was
    seen among the kept events is dropped; otherwise every message counts.

    ``snapshot(df, batch_id)`` gets the live counts after each batch: the keys with events
    in the window that ends at the newest clock of all keys, and how many. A silent key falls
    out of it as the others go on. ``live_counts`` gives the same at any time.
    """
    clock = _Clock(
        key,
        ts,
        window_seconds,
        lateness_seconds,
        window_seconds if late_seconds is None else late_seconds,
        lateness_seconds + window_seconds if ahead_seconds is None else ahead_seconds,
        support,
    )
    carried = [name for name in events.columns if name not in (key, ts, event_id)]

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept_log, clock_log = Levels(spark, f"{state_dir}/events"), Levels(spark, f"{state_dir}/clocks")
        kept = kept_log.read(kept_log.manifest(batch_id - 1))
        left = clock_log.manifest(batch_id - 1)
        reached = clock.newest(clock_log.read(left))
        new = _distinct(batch, event_id) if drop_repeats else batch
        if drop_repeats and kept is not None:
            new = new.join(kept.select(event_id), event_id, "left_anti")
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            recent = _recent(new, ts, event_id, left.note.get("recent", []))
            keys = clock.moved(new, reached, recent).persist(StorageLevel.MEMORY_AND_DISK)
            pool = clock.joined(new, keys)
            is_late = F.coalesce(micros(ts) < F.col("_reached") - clock.allowed, F.lit(False))
            ours = pool.filter(~is_late).withColumn("emitted", F.lit(False))
            if kept is not None:
                needed = clock.joined(kept, keys, "inner").filter(micros(ts) > F.col("_low"))
                needed = needed.withColumn("emitted", clock.settled("_reached"))
                ours = ours.unionByName(needed)
            # Where a message comes again, the one counted before comes first.
            ordered = ours.withColumn("_order", F.struct(F.col(event_id), ~F.col("emitted")))
            counted = rolling_count(ordered, key, ts, "_order", window_seconds, marks_per_task)
            counted = counted.filter(~F.col("emitted") & clock.settled("_newest"))
            counted = counted.drop("emitted", "_order", *clock.COLUMNS)
            beyond = pool.filter(is_late).drop(*clock.COLUMNS)
            if late:
                late(beyond, batch_id)
            elif batch_id > 0:
                counted = counted.unionByName(
                    beyond.withColumns(
                        {
                            "window_count": F.lit(None).cast(counted.schema["window_count"].dataType),
                            "window_seconds": F.lit(window_seconds),
                        }
                    )
                )
            emit(counted, batch_id)
            _count(pool.withColumn("_late", is_late), ts, f"{state_dir}/counters/batch_id={batch_id}")

            def live(rows: DataFrame, newest: str) -> DataFrame:
                """What later events may need: whole while it waits, else key, time and id."""
                settled = clock.settled(newest)
                alive = micros(ts) > F.coalesce(F.col(newest), F.lit(_EARLY)) - clock.span
                return rows.filter(alive).select(
                    key,
                    ts,
                    event_id,
                    *[F.when(~settled, F.col(f"`{name}`")).alias(name) for name in carried],
                )

            def merge(rows: DataFrame) -> DataFrame:
                """Without what has expired."""
                return live(clock.with_clocks(rows, reached), "reached")

            alive = kept_log.add(batch_id, live(pool.filter(~is_late), "_newest"), merge)
            moved = keys.filter("_newest IS NOT NULL AND _newest IS DISTINCT FROM _reached")
            moved = moved.select(F.col("_of").alias(key), F.col("_newest").alias("reached"))
            furthest = keys.agg(F.max("_newest")).first()[0]
            now = max((at for at in (furthest, left.note.get("now")) if at is not None), default=None)
            clock_log.add(batch_id, moved, clock.newest, {"recent": recent, "now": now})
            keys.unpersist()
            rows = kept_log.read(alive)
            if snapshot and now is not None and rows is not None:
                snapshot(clock.live(rows, now), batch_id)
        finally:
            new.unpersist()

    writer = (
        events.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def held_counts(
    spark: SparkSession,
    state_dir: str,
    key: str,
    ts: str,
    event_id: str,
    window_seconds: int = 300,
    lateness_seconds: int = 0,
    marks_per_task: int = MARKS_PER_TASK,
) -> DataFrame | None:
    """The events that still wait for later ones, counted with what has arrived.

    With the rows that the stream has emitted these are all its events. None if nothing is
    kept. To be asked between triggers or when the query has stopped.
    """
    clock = _Clock(key, ts, window_seconds, lateness_seconds, 0, 0, SUPPORT)
    kept_log, clock_log = Levels(spark, f"{state_dir}/events"), Levels(spark, f"{state_dir}/clocks")
    kept = kept_log.read(kept_log.newest())
    if kept is None:
        return None
    reached = clock.newest(clock_log.read(clock_log.newest()))
    known = clock.with_clocks(kept, reached)
    known = known.withColumn("_settled", clock.settled("reached")).drop("reached")
    counted = rolling_count(known, key, ts, event_id, window_seconds, marks_per_task)
    return counted.filter(~F.col("_settled")).drop("_settled")


def live_counts(
    spark: SparkSession,
    state_dir: str,
    key: str,
    ts: str,
    window_seconds: int = 300,
    as_of: datetime | None = None,
) -> DataFrame | None:
    """Keys of a running stream with events in the window up to now, and how many.

    Now is the newest clock of all keys, or ``as_of``, which must not be before it. None
    before any key has a clock.
    """
    log, clocks = Levels(spark, f"{state_dir}/events"), Levels(spark, f"{state_dir}/clocks")
    rows, now = log.read(log.newest()), clocks.newest().note.get("now")
    if rows is None or now is None:
        return None
    end = now if as_of is None else as_of
    return _Clock(key, ts, window_seconds, 0, 0, 0, SUPPORT).live(rows, end)


@dataclass
class _Clock:
    """How far keys have come, in microseconds; a key without a clock has no row or NULL."""

    key: str
    ts: str
    window_seconds: int
    lateness_seconds: int
    late_seconds: int
    ahead_seconds: int
    support: float

    COLUMNS = ("_reached", "_newest", "_low")

    @property
    def allowed(self) -> int:
        return (self.lateness_seconds + self.late_seconds) * SECOND

    @property
    def span(self) -> int:
        return self.allowed + self.window_seconds * SECOND

    def settled(self, newest: str) -> Column:
        """Whether an event waits no longer, by its key's clock in column ``newest``."""
        if not self.lateness_seconds:
            return F.lit(True)
        come = micros(self.ts) <= F.col(newest) - self.lateness_seconds * SECOND
        return F.col(self.ts).isNull() | F.coalesce(come, F.lit(False))

    def live(self, rows: DataFrame, end: int | datetime) -> DataFrame:
        """(key, window_count) of kept events in the window that ends at ``end``."""
        at = F.timestamp_micros(F.lit(end)) if isinstance(end, int) else F.lit(end)
        return window_snapshot(rows, self.key, self.ts, at, self.window_seconds)

    def newest(self, clocks: DataFrame | None) -> DataFrame | None:
        """One row per key."""
        if clocks is None:
            return None
        return clocks.groupBy(self.key).agg(F.max("reached").alias("reached"))

    def horizon(self, recent: list[int]) -> int:
        """The newest time that may move a clock."""
        enough = max(FEWEST, math.ceil(self.support * len(recent)))
        if len(recent) < enough:
            return _EARLY
        return sorted(recent, reverse=True)[enough - 1] + self.ahead_seconds * SECOND

    def moved(self, new: DataFrame, reached: DataFrame | None, recent: list[int]) -> DataFrame:
        """Per key of a batch: its clock before and after, and from when on it needs kept events."""
        at = micros(self.ts)
        keys = new.groupBy(F.col(self.key).alias("_of")).agg(
            F.min(at).alias("_oldest"),
            F.max(F.when(at <= self.horizon(recent), at)).alias("_moves"),
        )
        if reached is None:
            keys = keys.withColumn("_reached", F.lit(None).cast("long"))
        else:
            before = reached.select(
                F.col(self.key).alias("_was"), F.col("reached").alias("_reached")
            )
            keys = keys.join(before, F.col("_of").eqNullSafe(F.col("_was")), "left")
        low = F.greatest(F.col("_oldest"), F.col("_reached") - self.allowed)
        if self.lateness_seconds:
            waiting = F.col("_reached") - self.lateness_seconds * SECOND
            low = F.least(low, F.coalesce(waiting, F.lit(_EARLY)))
        return keys.select(
            "_of",
            "_reached",
            F.greatest("_reached", "_moves").alias("_newest"),
            (low - self.window_seconds * SECOND).alias("_low"),
        )

    def joined(self, rows: DataFrame, keys: DataFrame, how: str = "left") -> DataFrame:
        return rows.join(keys, F.col(self.key).eqNullSafe(F.col("_of")), how).drop("_of")

    def with_clocks(self, rows: DataFrame, reached: DataFrame | None) -> DataFrame:
        """Adds ``reached``."""
        if reached is None:
            return rows.withColumn("reached", F.lit(None).cast("long"))
        return self.joined(rows, reached.withColumnRenamed(self.key, "_of"))


def _recent(new: DataFrame, ts: str, event_id: str, before: list[int]) -> list[int]:
    """Times of the last ``RECENT`` arrivals; of a larger batch, a choice by hash."""
    at = micros(ts)
    chosen = F.xxhash64(F.col(event_id).cast("string"), at)
    times = new.filter(at.isNotNull()).select(at.alias("at"), chosen.alias("chosen"))
    rows = times.orderBy("chosen", "at").limit(RECENT).collect()
    return ([row["at"] for row in rows] + before)[:RECENT]


def stream_counters(spark: SparkSession, state_dir: str) -> DataFrame:
    """Per batch: events of the batch, those too late to count, those without a time."""
    return spark.read.parquet(f"{state_dir}/counters")


def _count(pool: DataFrame, ts: str, path: str) -> None:
    counters = pool.agg(
        F.count("*").alias("pending"),
        F.count_if(F.col("_late")).alias("late"),
        F.count_if(F.col(ts).isNull()).alias("untimed"),
    )
    counters.write.mode("overwrite").parquet(path)


def _distinct(events: DataFrame, event_id: str) -> DataFrame:
    """One event per id; those without an id are all different."""
    other = F.when(F.col(event_id).isNull(), F.monotonically_increasing_id())
    return events.withColumn("_other", other).dropDuplicates([event_id, "_other"]).drop("_other")
