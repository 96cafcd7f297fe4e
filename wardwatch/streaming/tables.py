"""Aggregates of a stream, kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardwatch.sources import write_parquet
from wardwatch.streaming.levels import Levels

EVERY = {"processingTime": "10 seconds"}


def append_table(
    counts: DataFrame, path: str, checkpoint_dir: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append groups that the watermark has closed, each once.

    For windowed counts: state holds the windows still open, whatever the stream's age.
    """
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or EVERY))
        .start(path)
    )


def open_windows(spark: SparkSession, checkpoint_dir: str, key: str) -> DataFrame:
    """Windowed counts that the stream of ``append_table`` has not closed yet.

    They are read from the state in its checkpoint, between triggers or when the query has
    stopped; with the table that it has written these are all windows.
    """
    state = spark.read.format("statestore").load(checkpoint_dir)
    return state.select(
        F.col(f"key.`{key}`").alias(key),
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value.count").alias("event_count"),
    )


def replace_table(
    counts: DataFrame, path: str, checkpoint_dir: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the table at ``path`` equal to the counts so far.

    For counts per key: state and table are as large as the number of keys.
    """
    return (
        counts.writeStream.foreachBatch(lambda df, batch_id: write_parquet(df, path))
        .outputMode("complete")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or EVERY))
        .start()
    )


def update_table(
    counts: DataFrame,
    path: str,
    checkpoint_dir: str,
    keys: list[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Add the groups that each batch changed; ``latest`` gives the last state of each.

    What is written per trigger grows with the batch, not with all groups ever seen. Changes
    of several batches are merged to the last of each group (``levels``), so the number of
    folders grows with the logarithm of what was written. Readers always find a table. A
    repeated batch replaces its own changes.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        changes = changed.withColumn("batch_id", F.lit(batch_id).cast("long"))
        Levels(changed.sparkSession, path).add(batch_id, changes, lambda rows: _last(rows, keys))

    return (
        counts.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or EVERY))
        .start()
    )


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """The state of each group after its last change in a table of ``update_table``.

    None before the first change.
    """
    log = Levels(spark, path)
    changes = log.read(log.newest())
    return None if changes is None else _last(changes, keys).drop("batch_id")


def _last(changes: DataFrame, keys: list[str]) -> DataFrame:
    values = [name for name in changes.columns if name not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*values), "batch_id").alias("_last")
    found = changes.groupBy(*keys).agg(last, F.max("batch_id").alias("batch_id"))
    return found.select(*keys, "_last.*", "batch_id")
