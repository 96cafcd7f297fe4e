"""Counts of events per key over time."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwatch.functions import micros
from wardwatch.session import checkpointed

SECOND = 1_000_000
# A group of this many marks still sorts comfortably in one task.
MARKS_PER_TASK = 2_000_000


def rolling_count(
    events: DataFrame,
    key: str,
    ts: str,
    event_id: str,
    window_seconds: int = 300,
    marks_per_task: int = MARKS_PER_TASK,
) -> DataFrame:
    """Adds ``window_count``: events of the key in ``(ts - window, ts]`` up to this one.

    Events at the same instant count in the order of their ids. An event without a time
    has no count. ``window_seconds`` is added as a column as well.

    Time is cut into blocks as long as the window. Every event leaves two marks: its
    arrival, in its own block, and its expiry one window later, in the next block. The
    events in the window of an event are then the arrivals of its block up to it and
    the block's expiries still to come, so a block needs nothing from outside it. One
    shuffle by (key, block) does: a busy key is spread over all its blocks, and a group
    is as large as two windows of one key.

    A group may still be too large for a task, as when one key bursts or a load stamps
    many events with one instant. The events per (key, block) are counted once, and the
    groups that are too large follow from that. If there are any, all marks are stored with
    the group's size; the large groups are then laid out by range of (key, time, id), which
    cuts them anywhere, also between equal times, and each piece starts from the counts of
    the pieces around it. So the events are read twice, whatever their distribution; store
    those that are costly to derive.
    """
    width = window_seconds * SECOND
    marks = _marks(events, key, ts, event_id, width)
    large = checkpointed(_large_groups(events, key, ts, width, marks_per_task))
    size = large.agg(F.sum("_size")).first()[0]
    if size is None:
        counted = _sweep(marks.withColumn("_before", F.lit(0)), ["_key", "_block"])
    else:
        told = checkpointed(_told_apart(marks, large))
        whole = told.filter(F.col("_size").isNull()).drop("_size")
        cut = told.filter(F.col("_size").isNotNull()).drop("_size")
        counted = _sweep(whole.withColumn("_before", F.lit(0)), ["_key", "_block"]).unionByName(
            _sweep_pieces(cut, math.ceil(size / marks_per_task) + 1)
        )
    return _with_count(counted, events.columns, key, event_id, window_seconds)


def _with_count(
    counted: DataFrame, columns: list[str], key: str, event_id: str, window_seconds: int
) -> DataFrame:
    own = {key: "_key", event_id: "_id"}
    return counted.select(
        *[F.col(own.get(name, f"`{name}`")).alias(name) for name in columns],
        F.when(F.col("_at").isNotNull(), F.col("_count")).alias("window_count"),
        F.lit(window_seconds).alias("window_seconds"),
    )


def _block_start(at: Column, width: int) -> Column:
    return at - F.pmod(at, F.lit(width))


def _large_groups(
    events: DataFrame, key: str, ts: str, width: int, marks_per_task: int
) -> DataFrame:
    """(_large_key, _large_block, _size) of the groups with more marks than a task takes.

    A group has the arrivals of its block and the expiries of the block before.
    """
    at = micros(ts)
    blocks = events.filter(at.isNotNull()).groupBy(
        F.col(key).alias("_large_key"), _block_start(at, width).alias("_start")
    )
    blocks = blocks.agg(F.count("*").alias("_events"))
    ends = F.explode(F.array("_start", F.col("_start") + width)).alias("_large_block")
    sizes = blocks.select("_large_key", ends, "_events").groupBy("_large_key", "_large_block")
    return sizes.agg(F.sum("_events").alias("_size")).filter(F.col("_size") > marks_per_task)


def _told_apart(marks: DataFrame, large: DataFrame) -> DataFrame:
    """Marks with the ``_size`` of their group if it is a large one."""
    same = F.col("_key").eqNullSafe(F.col("_large_key")) & (
        F.col("_block") == F.col("_large_block")
    )
    return marks.join(large, same, "left").drop("_large_key", "_large_block")


def _marks(events: DataFrame, key: str, ts: str, event_id: str, width: int) -> DataFrame:
    """Two rows per event; only the arrival carries the event's other columns."""
    at = micros(ts)
    both = events.select("*", at.alias("_arrival"), (at + width).alias("_expiry")).unpivot(
        [F.col(f"`{name}`") for name in events.columns], ["_arrival", "_expiry"], "_mark", "_at"
    )
    arrival = F.col("_mark") == "_arrival"
    timed = F.col("_at").isNotNull()
    # Events without a time are in no window; their places spread them over groups.
    spread = F.xxhash64(F.monotonically_increasing_id())
    others = [name for name in events.columns if name not in (key, event_id)]
    return both.select(
        F.col(key).alias("_key"),
        F.coalesce(_block_start(F.col("_at"), width), spread).alias("_block"),
        "_at",
        (arrival & timed).cast("int").alias("_arrives"),
        (~arrival & timed).cast("int").alias("_expires"),
        # Expiries keep the id, too: it lets a cut fall between those of one instant.
        F.col(event_id).alias("_id"),
        arrival.alias("_is_event"),
        *[F.when(arrival, F.col(f"`{name}`")).alias(name) for name in others],
    )


def _sweep(marks: DataFrame, group: list[str]) -> DataFrame:
    """Counts at the arrivals of each group; at one instant expiries come first.

    ``_before`` is what a group starts with.
    """
    order = Window.partitionBy(*group).orderBy("_at", "_arrives", "_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to_expire = F.sum("_expires").over(whole) - F.sum("_expires").over(so_far)
    return (
        marks.withColumn("_count", F.sum("_arrives").over(so_far) + to_expire + F.col("_before"))
        .filter("_is_event")
        .drop("_before", "_place")
    )


def _range_pieces(marks: DataFrame, pieces: int) -> DataFrame:
    """Marks with the piece of their group that they lie in, as ``_place``.

    The cut depends on a sample that Spark draws, so it is stored before use: every
    later step, and a retry of it, has to see the same pieces.
    """
    laid = marks.repartitionByRange(pieces, "_key", "_block", "_at", "_arrives", "_id")
    piece = F.spark_partition_id().alias("piece")
    return checkpointed(laid.select("*", F.struct("_key", "_block", piece).alias("_place")))


def _sweep_pieces(marks: DataFrame, pieces: int) -> DataFrame:
    """The same for groups too large for a task, cut into pieces."""
    laid = _range_pieces(marks, pieces)
    totals = laid.groupBy("_place").agg(
        F.sum("_arrives").alias("_arrivals"), F.sum("_expires").alias("_expiries")
    )
    # A group has at most one row per piece here.
    along = Window.partitionBy("_place._key", "_place._block").orderBy("_place.piece")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up_to = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    arrived_before = F.coalesce(F.sum("_arrivals").over(earlier), F.lit(0))
    expire_after = F.sum("_expiries").over(whole) - F.sum("_expiries").over(up_to)
    offsets = totals.select("_place", (arrived_before + expire_after).alias("_before"))
    return _sweep(laid.join(offsets, "_place"), ["_place"])


def window_snapshot(
    events: DataFrame, key: str, ts: str, as_of: datetime | Column, window_seconds: int = 300
) -> DataFrame:
    """Keys with events in ``(as_of - window, as_of]`` and how many."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    end = end.cast("timestamp")
    time = F.col(ts).cast("timestamp")
    start = end - F.expr(f"INTERVAL {int(window_seconds)} SECONDS")
    live = events.filter((time > start) & (time <= end))
    return live.groupBy(key).agg(F.count("*").alias("window_count"))


def sliding_counts(
    events: DataFrame,
    key: str,
    ts: str,
    window_seconds: int = 300,
    slide_seconds: int = 60,
    late: str = "10 minutes",
) -> DataFrame:
    """Events per key in windows that start every ``slide_seconds``.

    On a stream, windows close once the watermark (``late`` behind the newest event) has
    passed. A table is first counted per slide, which divides the rows that overlapping
    windows multiply.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    count = F.count("*")
    if events.isStreaming:
        timed = timed.withWatermark(ts, late)
    elif window_seconds % slide_seconds == 0:
        slide = F.window(ts, f"{slide_seconds} seconds")["start"]
        timed = timed.groupBy(key, slide.alias(ts)).agg(count.alias("_events"))
        count = F.sum("_events")
    span = F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return (
        timed.groupBy(F.col(key), span.alias("_span"))
        .agg(count.alias("event_count"))
        .select(
            key,
            F.col("_span.start").alias("window_start"),
            F.col("_span.end").alias("window_end"),
            "event_count",
        )
    )


def key_totals(events: DataFrame, key: str, name: str = "event_count") -> DataFrame:
    """Events per key so far; on a stream, to be written in update or complete mode."""
    return events.groupBy(key).agg(F.count("*").alias(name))
