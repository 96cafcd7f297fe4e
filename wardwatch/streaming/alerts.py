"""The alert chain: raw messages to stored alerts, as one streaming query."""

from __future__ import annotations

import json
import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wardwatch.operators import detect_anomalies, parse_events, route_events
from wardwatch.operators.alerts import check_counters, route_counters
from wardwatch.operators.messages import parse_counters
from wardwatch.operators.rolling import MARKS_PER_TASK
from wardwatch.sources import files
from wardwatch.streaming.counting import Emit, rolling_count_stream

# Documents keep microseconds, which Spark's own format cuts off.
WHOLE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Where Spark keeps rows without a value of the partition column.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

# Alerts that one task writes, and so the most in a file of the table.
ALERTS_PER_TASK = 250_000

# What an alert shows of the event that raised it.
SHOWN = ["primary_type", "case_number", "block", "latitude", "longitude"]


def alert_query(
    messages: DataFrame,
    sink: Emit,
    state_dir: str,
    checkpoint_dir: str,
    window_seconds: int = 300,
    threshold: int = 5,
    lateness_seconds: int = 0,
    marks_per_task: int = MARKS_PER_TASK,
    trigger: dict | None = None,
    name: str | None = None,
    late: Emit | None = None,
    drop_repeats: bool = False,
    snapshot: Emit | None = None,
) -> StreamingQuery:
    """Parse, route, count per district, detect, and pass the alerts to ``sink``.

    ``messages`` is a stream as ``event_source`` gives it; its ``timestamp`` is the time
    an event counts at. The counters of all stages are stored per batch; ``stage_counters``
    gives them. ``late``, ``drop_repeats`` and ``snapshot`` are those of the rolling count.
    """
    parsed = parse_events(messages).observe(
        "parse_stats", *[column.alias(name) for name, column in parse_counters().items()]
    )
    routed = route_events(parsed).select(
        "routed_district", F.col("timestamp").alias("event_time"), "message_id", *SHOWN
    )

    routed = routed.observe(
        "route_stats", *[column.alias(name) for name, column in route_counters().items()]
    )
    targets: list[Emit] = []
    stages = f"{state_dir}/stages"

    def emit(counted: DataFrame, batch_id: int) -> None:
        spark = counted.sparkSession
        if not targets:
            for_run = getattr(sink, "for_run", None)
            run = _run_id(spark, checkpoint_dir) if for_run else ""
            targets.append(for_run(run) if for_run else sink)
        stored = counted.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            checked = [column.alias(name) for name, column in check_counters(threshold).items()]
            counts = stored.agg(*checked).first().asDict()
            try:
                targets[0](detect_anomalies(stored, threshold), batch_id)
                counts |= {"alerts_written": counts["anomalies_detected"], "sink_errors": 0}
            except Exception:
                counts |= {"alerts_written": 0, "sink_errors": counts["anomalies_detected"]}
                raise
            finally:
                _note(spark, stages, batch_id, "chain", counts)
        finally:
            stored.unpersist()

    listener = _Stages(messages.sparkSession, stages)
    messages.sparkSession.streams.addListener(listener)
    query = rolling_count_stream(
        routed,
        emit,
        key="routed_district",
        ts="event_time",
        event_id="message_id",
        state_dir=state_dir,
        checkpoint_dir=checkpoint_dir,
        window_seconds=window_seconds,
        lateness_seconds=lateness_seconds,
        marks_per_task=marks_per_task,
        trigger=trigger,
        name=name,
        late=late,
        drop_repeats=drop_repeats,
        snapshot=snapshot,
    )
    listener.follow(query)
    return query


class _Stages(StreamingQueryListener):
    """Stores what a query observes, by batch, as long as the query runs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.query = spark, path, None
        self.waiting: list = []

    def follow(self, query: StreamingQuery) -> None:
        self.query = str(query.runId)
        for progress in self.waiting:
            self._store(progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        # The first batch may come before the query is known here.
        self._store(event.progress) if self.query else self.waiting.append(event.progress)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.query:
            self.spark.streams.removeListener(self)

    def _store(self, progress) -> None:
        if str(progress.runId) != self.query:
            return
        for name, row in progress.observedMetrics.items():
            _note(self.spark, self.path, progress.batchId, name, row.asDict())


def _note(spark: SparkSession, path: str, batch_id: int, name: str, counts: dict) -> None:
    files.write_text(spark, f"{path}/batch_id={batch_id}/{name}.json", json.dumps(counts))


def stage_counters(spark: SparkSession, state_dir: str) -> DataFrame:
    """Counters of every stage of a running or ended ``alert_query``, a row per batch.

    Parsed and turned-down messages, routed events and those without a key, events checked,
    anomalies, alerts written and those a failing sink has not taken. A repeated batch
    replaces its row. Waits for what the listeners of the session have still to store.
    """
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    counters = list(parse_counters()) + list(route_counters()) + list(check_counters(1))
    counters += ["alerts_written", "sink_errors"]
    schema = ", ".join(f"{name} long" for name in counters) + ", batch_id long"
    rows = spark.read.schema(schema).json(f"{state_dir}/stages")
    return rows.groupBy("batch_id").agg(*[F.max(name).alias(name) for name in counters])


def _run_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that a query keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint_dir}/metadata").first()[0])["id"]


def alert_sink(
    table: str | None = None, documents: str | None = None, jdbc: dict | None = None
) -> Emit:
    """Store alerts as Parquet table, as JSON documents, over JDBC, or all of them.

    Files of a batch are replaced when the batch is repeated. They lie under the id of the
    query (``run``), which lives in its checkpoint, so a query with another checkpoint only
    adds to the same table. The table is laid out by day first, for ``plans.feed``. A JDBC table cannot replace, so only alerts it does not have are
    appended; it is asked for those between the first and the last of the batch. ``jdbc``
    has ``url``, ``table`` and optional ``properties``.
    """

    def for_run(run: str) -> Emit:
        def write(alerts: DataFrame, batch_id: int) -> None:
            stored = alerts.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                # The first batch is written in any case, so that there is a table to read.
                if batch_id > 0 and stored.isEmpty():
                    return
                place = f"run={run}/batch_id={batch_id}"
                if table:
                    _write_by_day(stored, table, run, batch_id)
                if documents:
                    path = f"{documents}/{place}"
                    stored.write.mode("overwrite").json(
                        path, ignoreNullFields=False, timestampFormat=WHOLE_TIME
                    )
                if jdbc:
                    _append_new(stored, jdbc)
            finally:
                stored.unpersist()

        write.for_run = for_run
        return write

    return for_run("none")


def _write_by_day(alerts: DataFrame, table: str, run: str, batch_id: int) -> None:
    """Replaces the batch's part of each day that it has alerts of.

    The alerts are dealt by range of day first: there are about as many files as days and
    full files, where every task of the count would otherwise add a file to every day.
    """
    count = alerts.count()
    if not count:
        place = f"{table}/day={NO_DAY}/run={run}/batch_id={batch_id}"
        alerts.write.mode("overwrite").parquet(place)
        return
    own = {
        "day": F.date_format("triggered_at", "yyyy-MM-dd"),
        "run": F.lit(run),
        "batch_id": F.lit(batch_id),
    }
    tasks = math.ceil(count / ALERTS_PER_TASK)
    dealt = alerts.withColumns(own).repartitionByRange(tasks, "day", "alert_id")
    writer = dealt.write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*own).parquet(table)


def _append_new(alerts: DataFrame, jdbc: dict) -> None:
    url, table, properties = jdbc["url"], jdbc["table"], jdbc.get("properties", {})
    first, last = alerts.agg(F.min("triggered_at"), F.max("triggered_at")).first()
    if first is None:
        return
    known = alerts.sparkSession.read.jdbc(url, table, properties=properties)
    known = known.filter(F.col("triggered_at").between(F.lit(first), F.lit(last)))
    known = known.select("alert_id")
    alerts.join(known, "alert_id", "left_anti").select(alerts.columns).write.jdbc(
        url, table, mode="append", properties=properties
    )
