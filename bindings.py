"""Queries: the operators and reports of the package over the driver's tables.

Only this file knows the names of those tables. It gives them the column names of the
incident datasets; every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardwatch import operators as ops
from wardwatch.functions import route_key, severity
from wardwatch.plans import batch, cleaning, reports, views
from wardwatch.plans.feed import stored_feed
from wardwatch.schemas import ALERT_SCHEMA, COLUMNS
from wardwatch.session import DEFAULTS, scratch_path
from wardwatch.sources import event_source, read_csv_dataset, read_result, read_table
from wardwatch.sources import write_parquet
from wardwatch.sources.publication import Publication, published
from wardwatch.streaming import alert_query, alert_sink, append_table, held_counts, latest
from wardwatch.streaming import open_windows, rolling_count_stream, stage_counters, update_table

# Users post about twice a day here, so a window of a day and a threshold of two give
# alerts of every severity.
WINDOW = 86_400
SLIDE = 21_600
THRESHOLD = 2
# Longer than the tables' events span.
LATENESS = 40 * 365 * 86_400
DISTRICT = "7"
KIND = "victimization_primary"
AS_OF = datetime(2024, 1, 15, 12, 0, 0)

# The columns of an event, what a count shows, and how far wrong times are ahead.
EVENT = {"key": "routed_district", "ts": "ts", "event_id": "event_id"}
COUNTED = ["event_id", "routed_district", "window_count"]
AHEAD = "INTERVAL 66 YEARS"

# Read what there is, then stop.
NOW = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The driver's tables under the names of the incident datasets."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        for name in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
            spark.conf.set(name, DEFAULTS[name])

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    def crimes(self, *columns: str) -> DataFrame:
        """Orders, with the customer's segment and nation if asked for."""
        rows = self.read("orders")
        values = {
            "case_number": F.col("o_orderkey"),
            "date": F.col("o_orderdate"),
            "primary_type": F.col("n_name"),
            "district": F.col("c_mktsegment"),
        }
        if {"primary_type", "district"} & set(columns):
            customer = self.read("customer")
            rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        if "primary_type" in columns:
            nation = self.read("nation")
            rows = rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return rows.select(*[values[name].alias(name) for name in columns])

    def arrests(self) -> DataFrame:
        """Lines of the orders, several per order; only returned ones have a race."""
        race = F.when(F.col("l_returnflag") == "R", F.col("l_linestatus"))
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("case_number"), race.alias("race")
        )

    def _lines(self, values: dict, columns: tuple[str, ...]) -> DataFrame:
        """Columns of the lines; the district is that of the supplier."""
        rows = self.read("lineitem")
        if "district" in columns:
            supplier = self.read("supplier")
            rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        values = {"district": F.col("s_nationkey"), **values}
        return rows.select(*[values[name].alias(name) for name in columns])

    def placed_crimes(self, *columns: str) -> DataFrame:
        """Lines with a block (part), a district and a community area."""
        values = {
            "block": F.col("l_partkey"),
            "community_area": F.col("l_quantity").cast("int"),
            "arrest": F.col("l_linestatus") == "F",
        }
        return self._lines(values, columns)

    def violence(self, *columns: str) -> DataFrame:
        values = {
            "month": F.month("l_shipdate"),
            "community_area": F.nullif(F.col("l_quantity").cast("int"), F.lit(50)),
            "victimization_primary": F.when(
                F.col("l_returnflag") == "R", reports.HOMICIDE
            ).otherwise(F.col("l_returnflag")),
            "gunshot_injury_i": F.when(F.col("l_linestatus") == "F", reports.GUNSHOT).otherwise(
                "NO"
            ),
        }
        return self._lines(values, columns)

    def offenders(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_name").alias("last"),
            F.col("p_brand").alias("first"),
            F.col("p_partkey").alias("block"),
            F.left("p_type", F.lit(1)).alias("gender"),
            F.col("p_type").alias("race"),
            F.date_add(F.lit("1970-01-01").cast("date"), F.col("p_size")).alias("birth_date"),
            F.col("p_size").alias("height"),
            F.floor("p_retailprice").cast("int").alias("weight"),
            F.when(F.col("p_size") <= 5, "Y").otherwise("N").alias("victim_minor"),
        )

    def stations(self) -> DataFrame:
        region = self.read("region")
        return (
            self.read("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                F.col("n_nationkey").alias("district"),
                F.col("n_name").alias("district_name"),
                F.col("r_name").alias("address"),
            )
        )

    def events(self) -> DataFrame:
        """Events as routed incidents: the user is the district."""
        return self.read("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("user_id").cast("string").alias("routed_district"),
            F.col("event_type").alias("primary_type"),
            F.col("event_id").cast("string").alias("case_number"),
            F.col("props").alias("block"),
            F.col("value").alias("latitude"),
            F.lit(None).cast("double").alias("longitude"),
        )

    def event_rows(self) -> DataFrame:
        """Events as rows of an incident file, all text, with blanks around the district."""
        return self.read("events").select(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_id").cast("string").alias("case_number"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.col("props").alias("block"),
            F.concat(F.col("event_type"), F.lit(" \t")).alias("primary_type"),
            F.when(F.col("event_type") == "click", "TRUE").otherwise("1").alias("arrest"),
            F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")).alias("district"),
            F.col("value").cast("string").alias("latitude"),
            F.lit("n/a").alias("longitude"),
            F.col("ts").cast("timestamp").alias("event_time"),
            F.col("event_type").alias("kind"),
        )

    def messages(self) -> DataFrame:
        """Messages of all events; the event type decides how a message is broken."""
        rows = self.event_rows()
        made = ops.to_event_messages(rows, F.col("event_time"), ("event_time", "id", "kind"))
        body, kind = F.col("value").cast("string"), F.col("kind")
        blank = F.regexp_replace(body, r'"district":"\d+"', '"district":" "')
        zero = F.regexp_replace(body, r'"district":"\d+"', '"district":0')
        broken = (
            F.when(kind == "error", F.rtrim(body, F.lit("}")))
            .when(kind == "signup", F.concat(F.lit("["), body, F.lit("]")))
            .when(kind == "view", blank)
            .when(kind == "purchase", zero)
            .otherwise(body)
        )
        return made.select(
            "key",
            broken.cast("binary").alias("value"),
            F.col("event_time").alias("timestamp"),
            F.lpad("id", 20, "0").alias("message_id"),
        )

    def points(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("vec_id").alias("id"),
            F.col("label").alias("primary_type"),
            F.col("label").alias("district"),
            F.col("embedding")[0].cast("double").alias("latitude"),
            F.col("embedding")[1].cast("double").alias("longitude"),
        )

    # Frames that several queries start from

    def arrest_facts(self, *dims: str) -> DataFrame:
        crimes = self.crimes("case_number", *dims)
        return reports.arrest_facts(crimes, self.arrests(), list(dims))

    def counted(self) -> DataFrame:
        return ops.rolling_count(self.events(), "routed_district", "ts", "event_id", WINDOW)

    def alerts(self) -> DataFrame:
        return ops.detect_anomalies(self.counted(), THRESHOLD, event_id="event_id", time="ts")

    def hotspots(self) -> DataFrame:
        return ops.cluster_sizes(*ops.fit_hotspots(self.points()))

    def labelled_spots(self) -> DataFrame:
        """A table like that of the hotspots with the given labels as clusters."""
        located = ops.located(self.points(), "latitude", "longitude")
        return located.groupBy(F.col("primary_type").alias("cluster_id")).agg(
            F.min("latitude").alias("centroid_latitude"),
            F.min("longitude").alias("centroid_longitude"),
            F.count("*").alias("crime_count"),
        )

    def density(self) -> DataFrame:
        crimes = self.placed_crimes("block", "district")
        return reports.offender_density(self.offenders(), crimes, self.stations())

    def by_type_rates(self) -> DataFrame:
        return reports.rate_by_type(self.arrest_facts("primary_type"))

    def by_district_rates(self) -> DataFrame:
        return reports.rate_by_district(self.arrest_facts("district"))

    def gunshot(self) -> DataFrame:
        return reports.gunshot_overall(self.violence("gunshot_injury_i"))

    def gunshot_by_district(self) -> DataFrame:
        return reports.gunshot_by_district(self.violence("district", "gunshot_injury_i"))

    def violence_by_month(self) -> DataFrame:
        return reports.violence_by_month(self.violence("month", KIND))

    def violence_by_district(self) -> DataFrame:
        return reports.violence_by_district(self.violence("district", KIND))

    def violence_by_community(self) -> DataFrame:
        return reports.violence_by_community(self.violence("community_area", KIND))

    def community_corr(self) -> DataFrame:
        crimes = self.placed_crimes("block", "community_area")
        return reports.community_corr(crimes, self.offenders())

    def by_month(self) -> DataFrame:
        return reports.trends_by_month(self.crimes("date"))

    def by_dow(self) -> DataFrame:
        return reports.trends_by_dow(self.events(), "ts")

    def by_hour(self) -> DataFrame:
        return reports.trends_by_hour(self.events(), "ts")

    def top_rates(self) -> DataFrame:
        return reports.top_types(self.by_type_rates())


def _local(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without a zone, as the driver's tables have them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


def _via_csv(t: Tables, dataset: str, source: DataFrame, values: dict) -> DataFrame:
    """Rows written as CSV of a dataset, read back and cleaned."""
    path = _as_csv(t, dataset, source, values)
    return cleaning.clean(dataset, read_csv_dataset(t.spark, dataset, path)).select(*values)


def _as_csv(t: Tables, dataset: str, source: DataFrame, values: dict) -> str:
    """Write rows as CSV of a dataset, columns not given left empty."""
    columns = COLUMNS[dataset]
    rows = source.select(*[values.get(c, F.lit(None)).cast("string").alias(c) for c in columns])
    path = scratch_path(t.spark, dataset)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


def _millis(column: str):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def csv_arrests(t: Tables) -> DataFrame:
    values = {
        "cb_no": F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
        "case_number": F.col("l_orderkey"),
        "arrest_date": _millis("l_shipdate"),
        "race": F.col("l_linestatus"),
        "charge_1_statute": F.concat(F.lit('say "'), "l_returnflag", F.lit('",\nnext')),
    }
    return _local(_via_csv(t, "arrests", t.read("lineitem"), values), "arrest_date")


def csv_crimes(t: Tables) -> DataFrame:
    values = {
        "id": F.col("event_id"),
        "date": _millis("ts"),
        "block": F.col("props"),
        "primary_type": F.col("event_type"),
        "arrest": F.when(F.col("event_type") == "click", "true")
        .when(F.col("event_type") == "view", "N")
        .otherwise("maybe"),
        "year": F.year("ts"),
        "latitude": F.col("value"),
    }
    return _local(_via_csv(t, "crimes", t.read("events"), values), "date")


def csv_stations(t: Tables) -> DataFrame:
    values = {
        "district": F.lpad(F.col("district").cast("string"), 3, "0"),
        "district_name": F.col("district_name"),
        "address": F.concat("address", F.lit(", "), "district_name"),
    }
    return _via_csv(t, "police_stations", t.stations(), values)


def offender_values(t: Tables) -> tuple[DataFrame, dict]:
    values = {
        "last": F.col("last"),
        "block": F.col("block"),
        "birth_date": F.date_format("birth_date", "MM/dd/yyyy"),
        "height": F.col("height"),
        # Not a whole number: becomes NULL.
        "weight": F.concat(F.col("weight").cast("string"), F.lit(" lb")),
        "victim_minor": F.col("victim_minor"),
    }
    return t.offenders(), values


def csv_offenders(t: Tables) -> DataFrame:
    return _via_csv(t, "sex_offenders", *offender_values(t))


def violence_values(t: Tables) -> tuple[DataFrame, dict]:
    values = {
        "case_number": F.col("o_orderkey"),
        "date": _millis("o_orderdate"),
        "victimization_primary": F.col("o_orderpriority"),
        "month": F.month("o_orderdate"),
        # Without milliseconds: becomes NULL.
        "updated": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "latitude": F.col("o_totalprice"),
    }
    return t.read("orders"), values


def csv_violence(t: Tables) -> DataFrame:
    return _local(_via_csv(t, "violence", *violence_values(t)), "date", "updated")


# Streams: the whole table goes through a streaming query, its output is a table


def _event_stream(t: Tables, run: str) -> DataFrame:
    write_parquet(t.events(), f"{run}/in")
    return t.spark.readStream.schema(t.events().schema).parquet(f"{run}/in")


def _in_parts(
    t: Tables, run: str, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Runs a streaming query over one part after another, each as one batch."""
    for part in parts:
        part.write.mode("append").parquet(f"{run}/in")
        start(t.spark.readStream.schema(part.schema).parquet(f"{run}/in")).awaitTermination()


def stream_totals(t: Tables) -> DataFrame:
    run = scratch_path(t.spark, "totals")
    parts = [t.events().filter(F.pmod("event_id", F.lit(3)) == part) for part in range(3)]
    keys = ["routed_district"]

    def start(events: DataFrame) -> StreamingQuery:
        totals = ops.key_totals(events, *keys)
        return update_table(totals, f"{run}/out", f"{run}/checkpoint", keys, NOW)

    _in_parts(t, run, parts, start)
    return latest(t.spark, f"{run}/out", keys)


def stream_windows(t: Tables) -> DataFrame:
    """Windows that are closed when the stream has been read."""
    run = scratch_path(t.spark, "windows")
    windows = ops.sliding_counts(
        _event_stream(t, run), "routed_district", "ts", WINDOW, SLIDE, "10 minutes"
    )
    append_table(windows, f"{run}/out", f"{run}/checkpoint", NOW).awaitTermination()
    return _local(read_table(t.spark, f"{run}/out"), "window_start", "window_end")


def stream_all_windows(t: Tables) -> DataFrame:
    """Windows that are closed when the stream has been read, and those still open."""
    run = scratch_path(t.spark, "all-windows")
    windows = ops.sliding_counts(
        _event_stream(t, run), "routed_district", "ts", WINDOW, SLIDE, "10 minutes"
    )
    append_table(windows, f"{run}/out", f"{run}/checkpoint", NOW).awaitTermination()
    still_open = open_windows(t.spark, f"{run}/checkpoint", "routed_district")
    every = read_table(t.spark, f"{run}/out").unionByName(still_open)
    return _local(every, "window_start", "window_end")


def stream_snapshots(t: Tables) -> DataFrame:
    """Live counts of a running stream after each of three batches."""
    run = scratch_path(t.spark, "snapshots")

    def snapshot(live: DataFrame, batch_id: int) -> None:
        write_parquet(live, f"{run}/live/batch_id={batch_id}")

    _in_parts(t, run, _by_time(t.events(), "ts"), _count_start(run, snapshot=snapshot))
    return read_table(t.spark, f"{run}/live").withColumn("batch_id", F.col("batch_id").cast("long"))


def stream_stages(t: Tables) -> DataFrame:
    """Counters of all stages of an alert chain, summed over its batches."""
    run = scratch_path(t.spark, "stages")

    def start(arriving: DataFrame) -> StreamingQuery:
        return alert_query(
            arriving,
            alert_sink(table=f"{run}/table"),
            state_dir=f"{run}/state",
            checkpoint_dir=f"{run}/checkpoint",
            window_seconds=WINDOW,
            threshold=THRESHOLD,
            trigger=NOW,
        )

    _in_parts(t, run, _by_time(t.messages(), "timestamp"), start)
    counters = stage_counters(t.spark, f"{run}/state")
    return counters.agg(
        *[F.sum(name).alias(name) for name in counters.columns if name != "batch_id"]
    )


def published_trends(t: Tables) -> DataFrame:
    """A table of the second of two publications."""
    root = scratch_path(t.spark, "published")
    for dated in (t.crimes("date").limit(10), t.crimes("date")):
        with Publication(t.spark, root) as write:
            for name, table in batch.trend_tables(dated).items():
                write(table, name)
    return published(t.spark, root)["crime_trends_by_year"]


def stream_counts(t: Tables) -> DataFrame:
    run = scratch_path(t.spark, "counts")
    _count_start(run)(_event_stream(t, run)).awaitTermination()
    return read_table(t.spark, f"{run}/out").select(*COUNTED)


def _count_start(run: str, **options) -> Callable[[DataFrame], StreamingQuery]:
    def emit(counted: DataFrame, batch_id: int) -> None:
        write_parquet(counted, f"{run}/out/batch_id={batch_id}")

    return lambda events: rolling_count_stream(
        events,
        emit,
        **EVENT,
        state_dir=f"{run}/state",
        checkpoint_dir=f"{run}/checkpoint",
        window_seconds=WINDOW,
        trigger=NOW,
        **options,
    )


def _by_time(rows: DataFrame, ts: str) -> list[DataFrame]:
    """Three parts, as events arrive: before the 11th, before the 21st, and later."""
    day = F.dayofmonth(ts)
    return [rows.filter(part) for part in (day <= 10, (day > 10) & (day <= 20), day > 20)]


def stream_counts_ahead(t: Tables) -> DataFrame:
    """Events as they arrive, one in 200 again on the same key with a time 66 years ahead."""
    run = scratch_path(t.spark, "ahead")
    events = t.events()
    wrong = events.filter(F.pmod("event_id", F.lit(200)) == 0).withColumns(
        {"event_id": -F.col("event_id") - 1, "ts": F.col("ts") + F.expr(AHEAD)}
    )
    _in_parts(t, run, _by_time(events.unionByName(wrong), "ts"), _count_start(run))
    return read_table(t.spark, f"{run}/out").select(*COUNTED)


def stream_counts_shuffled(t: Tables) -> DataFrame:
    """Events out of order over three batches, far future ones under a key of their own.

    Those that still wait for later ones in the end are read from what the query keeps.
    """
    run = scratch_path(t.spark, "shuffled")
    events = t.events()
    ahead = F.col("ts") + F.expr("INTERVAL 70 YEARS")
    future = events.filter(F.pmod("event_id", F.lit(100)) == 0).withColumns(
        {"event_id": -F.col("event_id") - 1, "routed_district": F.lit("none"), "ts": ahead}
    )
    parts = [
        rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part)
        for part in range(3)
        for rows in (events.unionByName(future),)
    ]
    _in_parts(t, run, parts, _count_start(run, lateness_seconds=LATENESS))
    held = held_counts(
        t.spark, f"{run}/state", **EVENT, window_seconds=WINDOW, lateness_seconds=LATENESS
    )
    counted = read_table(t.spark, f"{run}/out").select(*COUNTED).unionByName(held.select(*COUNTED))
    return counted.filter("event_id >= 0")


def _alert_run(t: Tables, **targets: str) -> str:
    run = scratch_path(t.spark, "alerts")
    write_parquet(t.messages(), f"{run}/in")
    alert_query(
        event_source(t.spark, path=f"{run}/in"),
        alert_sink(**{kind: f"{run}/{place}" for kind, place in targets.items()}),
        state_dir=f"{run}/state",
        checkpoint_dir=f"{run}/checkpoint",
        window_seconds=WINDOW,
        threshold=THRESHOLD,
        trigger=NOW,
    ).awaitTermination()
    return run


def stream_alerts_ahead(t: Tables) -> DataFrame:
    """Alerts of messages as they arrive, one in 200 again with a time 66 years ahead."""
    run = scratch_path(t.spark, "alerts-ahead")
    messages = t.messages()
    wrong = messages.filter(F.pmod(F.col("message_id").cast("long"), F.lit(200)) == 0).withColumns(
        {"timestamp": F.col("timestamp") + F.expr(AHEAD), "message_id": F.concat(F.lit("ahead"), "message_id")}
    )

    def start(arriving: DataFrame) -> StreamingQuery:
        return alert_query(
            arriving,
            alert_sink(table=f"{run}/table"),
            state_dir=f"{run}/state",
            checkpoint_dir=f"{run}/checkpoint",
            window_seconds=WINDOW,
            threshold=THRESHOLD,
            trigger=NOW,
        )

    _in_parts(t, run, _by_time(messages.unionByName(wrong), "timestamp"), start)
    alerts = read_table(t.spark, f"{run}/table").select(*ALERT_SCHEMA.names)
    return _local(alerts, "triggered_at")


def stream_alerts(t: Tables) -> DataFrame:
    alerts = read_table(t.spark, _alert_run(t, table="table") + "/table")
    return _local(alerts.select(*ALERT_SCHEMA.names), "triggered_at")


def stream_feed(t: Tables) -> DataFrame:
    """The newest high alerts of a stored table, from its newest days."""
    return stored_feed(t.spark, _alert_run(t, table="table") + "/table", "HIGH")


def csv_rejects(t: Tables) -> DataFrame:
    """Values that two datasets lose when they are typed, and how often."""
    found = None
    for dataset, write in (("sex_offenders", offender_values), ("violence", violence_values)):
        path = _as_csv(t, dataset, *write(t))
        raw = read_csv_dataset(t.spark, dataset, path, keep_corrupt=True)
        lost = cleaning.rejects(dataset, raw)
        found = lost if found is None else found.unionByName(lost)
    return found.groupBy("dataset", "column_name", "value").agg(F.count("*").alias("n"))


def stream_both_targets(t: Tables) -> DataFrame:
    """Table and documents of one run, all fields of both."""
    run = _alert_run(t, table="table", documents="docs")
    stored = {
        "table": read_table(t.spark, f"{run}/table"),
        "documents": t.spark.read.schema(ALERT_SCHEMA).json(f"{run}/docs"),
    }
    table, documents = (
        _local(rows, "triggered_at").select(F.lit(name).alias("target"), *ALERT_SCHEMA.names)
        for name, rows in stored.items()
    )
    return table.unionByName(documents)


def stream_documents(t: Tables) -> DataFrame:
    documents = t.spark.read.json(_alert_run(t, documents="docs") + "/docs")
    counted = documents.groupBy("district", "severity").agg(
        F.count("*").alias("documents"), F.count_distinct("alert_id").alias("alert_ids")
    )
    return counted


def hotspot_checks(t: Tables) -> DataFrame:
    """What is known of any right clustering, whatever its centres.

    Points whose centre is not the nearest are found by measuring every located point
    against the few centres.
    """
    points = t.points()
    model, positions = ops.fit_kmeans(points)
    sizes = ops.cluster_sizes(model, positions)
    labelled = ops.label_points(model, points, ["id"])
    square = [
        (F.col("latitude") - lat) ** 2 + (F.col("longitude") - lon) ** 2
        for lat, lon in model.centres
    ]
    own = F.element_at(F.array(*square), F.col("cluster") + 1)
    wrong = labelled.agg(F.count_if(own > F.least(*square) + 1e-9).alias("n"))
    fit = ops.fit_summary(model, positions)
    counts = {
        "located_points": fit.select("located_points"),
        "clusters": fit.select("clusters"),
        "in_clusters": sizes.agg(F.sum("crime_count")),
        "labelled_points": labelled.agg(F.count("*")),
        "nearer_to_another": wrong,
        "negative_cost": fit.select(F.when(F.col("cost") < 0, 1).otherwise(0)),
    }
    rows = [
        frame.toDF("n").select(F.lit(name).alias("measure"), F.col("n").cast("long").alias("n"))
        for name, frame in counts.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def _batch_places(t: Tables) -> dict[str, DataFrame]:
    crimes = t.placed_crimes("block", "district", "community_area", "arrest")
    violence = t.violence("month", "district", "community_area", KIND, "gunshot_injury_i")
    return batch.place_tables(
        batch.place_facts(crimes), batch.violence_facts(violence), t.offenders(), t.stations()
    )


def _batch_violence(t: Tables) -> dict[str, DataFrame]:
    violence = t.violence("month", "district", "community_area", KIND, "gunshot_injury_i")
    return batch.violence_tables(batch.violence_facts(violence))


def _batch_arrests(t: Tables) -> dict[str, DataFrame]:
    return batch.arrest_tables(t.crimes("case_number", "primary_type", "district"), t.arrests())


def _batch_trends(source: str) -> Callable[[Tables], dict[str, DataFrame]]:
    def build(t: Tables) -> dict[str, DataFrame]:
        dated = t.crimes("date") if source == "crimes" else t.events().withColumnRenamed("ts", "date")
        return batch.trend_tables(dated)

    return build


# Tables of the batch run, from shared counts: the name of the same report made by itself,
# the group of tables, and the table's name in it.
BATCH = {
    "trends_by_year": (_batch_trends("crimes"), "crime_trends_by_year"),
    "trends_by_month": (_batch_trends("crimes"), "crime_trends_by_month"),
    "trends_by_dow": (_batch_trends("events"), "crime_trends_by_day_of_week"),
    "trends_by_hour": (_batch_trends("events"), "crime_trends_by_hour"),
    "rate_by_type": (_batch_arrests, "arrest_rate_by_crime_type"),
    "top_types": (_batch_arrests, "top10_crime_types_by_arrest_rate"),
    "rate_by_district": (_batch_arrests, "arrest_rate_by_district"),
    "matches_by_race": (_batch_arrests, "arrests_by_race"),
    "violence_by_month": (_batch_violence, "violence_by_month"),
    "violence_by_district": (_batch_violence, "violence_by_district"),
    "gunshot_overall": (_batch_violence, "gunshot_injury_proportion"),
    "gunshot_by_district": (_batch_violence, "gunshot_proportion_by_district"),
    "violence_by_community": (_batch_violence, "top_community_areas_by_violence"),
    "density": (_batch_places, "sex_offender_density_by_district"),
    "minor_victims": (_batch_places, "sex_offenders_minor_victims_priority"),
    "district_corr": (_batch_places, "district_arrest_vs_violence_correlation"),
    "community_corr": (_batch_places, "community_offender_vs_crime_correlation"),
}


def _from_batch(name: str) -> Callable[[Tables], DataFrame]:
    group, table = BATCH[name]
    return lambda t: group(t)[table]


# The registry


def _report(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(Tables(spark, folder))


def _kpis(t: Tables) -> DataFrame:
    return views.v_kpis(
        reports.trends_by_year(t.crimes("date")),
        t.alerts(),
        t.hotspots(),
        t.by_district_rates(),
        t.gunshot(),
    )


def _read_result(t: Tables) -> DataFrame:
    return read_result(
        t.spark,
        "SELECT primary_type, total_crimes FROM {rates} WHERE total_crimes >= :least",
        {"least": reports.NOISE_FLOOR},
        rates=t.by_type_rates(),
    )


def _severity(t: Tables) -> DataFrame:
    totals = ops.key_totals(t.events(), "routed_district", "n")
    return totals.select("routed_district", "n", severity("n", 50).alias("severity"))


def _parsed(t: Tables) -> DataFrame:
    parsed = ops.parse_events(t.messages())
    return _local(parsed, "timestamp").drop("date", "description", "location_description")


def _routed(t: Tables) -> DataFrame:
    routed = ops.route_events(ops.parse_events(t.messages()))
    return routed.groupBy("routed_district").agg(F.count("*").alias("events"))


def _route_key(t: Tables) -> DataFrame:
    """Keys of raw text with blanks around it; a junk text of blanks has none."""
    documents = t.read("documents")
    return documents.select("doc_id", route_key(F.concat(F.lit(" \t"), "lang")).alias("routed"))


def _messages(t: Tables) -> DataFrame:
    made = ops.to_event_messages(t.event_rows(), F.col("event_time"))
    return made.select("key", F.col("value").cast("string").alias("value"))


QUERIES: dict[str, Query] = {
    name: _report(build)
    for name, build in {
        # Trends
        "trends_by_year": lambda t: reports.trends_by_year(t.crimes("date")),
        "trends_by_month": lambda t: t.by_month(),
        "trends_by_dow": lambda t: t.by_dow(),
        "trends_by_hour": lambda t: t.by_hour(),
        "trend_facts": lambda t: batch.trend_facts(t.events().withColumnRenamed("ts", "date")),
        # Arrest rates
        "arrest_facts": lambda t: t.arrest_facts("primary_type", "district"),
        "rate_by_type": lambda t: t.by_type_rates(),
        "top_types": lambda t: t.top_rates(),
        "rate_by_district": lambda t: t.by_district_rates(),
        "matches_by_race": lambda t: reports.matches_by_race(t.arrest_facts()),
        # Violence
        "violence_by_month": lambda t: t.violence_by_month(),
        "violence_by_district": lambda t: t.violence_by_district(),
        "gunshot_overall": lambda t: t.gunshot(),
        "gunshot_by_district": lambda t: t.gunshot_by_district(),
        "violence_by_community": lambda t: t.violence_by_community(),
        "violence_facts": lambda t: batch.violence_facts(
            t.violence("month", "district", "community_area", KIND, "gunshot_injury_i")
        ),
        # Lookups, offenders, cross-dataset rates
        "mode_lookup": lambda t: ops.mode_lookup(
            t.placed_crimes("block", "district"), "block", "district"
        ),
        "mode_lookup_community": lambda t: ops.mode_lookup(
            t.placed_crimes("block", "community_area"), "block", "community_area"
        ),
        "density": lambda t: t.density(),
        "minor_victims": lambda t: reports.minor_victims(t.offenders()),
        "district_corr": lambda t: reports.district_corr(
            t.placed_crimes("district", "arrest"), t.violence("district")
        ),
        "community_corr": lambda t: t.community_corr(),
        "place_facts": lambda t: batch.place_facts(
            t.placed_crimes("block", "district", "community_area", "arrest")
        ),
        # Counts over time and alerts
        "rolling_count": lambda t: t.counted().select(
            "event_id", "routed_district", "window_count", "window_seconds"
        ),
        "detect_anomalies": lambda t: _local(t.alerts(), "triggered_at"),
        "alert_stats": lambda t: ops.alert_stats(t.counted(), THRESHOLD),
        "severity": _severity,
        "window_snapshot": lambda t: ops.window_snapshot(
            t.events(), "routed_district", "ts", AS_OF, WINDOW
        ),
        "sliding_counts": lambda t: _local(
            ops.sliding_counts(t.events(), "routed_district", "ts", WINDOW, SLIDE),
            "window_start",
            "window_end",
        ),
        "key_totals": lambda t: ops.key_totals(t.events(), "routed_district"),
        # Messages
        "to_event_messages": _messages,
        "parse_events": _parsed,
        "parse_stats": lambda t: ops.parse_stats(ops.parse_events(t.messages())),
        "route_events": _routed,
        "route_rows": lambda t: ops.route_events(ops.parse_events(t.messages())).select(
            "message_id", "routed_district"
        ),
        "route_key": _route_key,
        # Files through a typed CSV read
        "clean_arrests": csv_arrests,
        "clean_crimes": csv_crimes,
        "clean_stations": csv_stations,
        "clean_offenders": csv_offenders,
        "clean_violence": csv_violence,
        "csv_rejects": csv_rejects,
        # Streams
        "key_totals_stream": stream_totals,
        "sliding_counts_stream": stream_windows,
        "sliding_counts_stream_all": stream_all_windows,
        "window_snapshot_stream": stream_snapshots,
        "stage_counters": stream_stages,
        "published_trends": published_trends,
        "rolling_count_stream": stream_counts,
        "rolling_count_stream_shuffled": stream_counts_shuffled,
        "rolling_count_stream_ahead": stream_counts_ahead,
        "alert_query": stream_alerts,
        "alert_query_ahead": stream_alerts_ahead,
        "alert_documents": stream_documents,
        "alert_both_targets": stream_both_targets,
        # Hotspots
        "hotspot_checks": hotspot_checks,
        "hotspots": lambda t: t.hotspots(),
        "labelled_points": lambda t: ops.label_points(
            ops.fit_hotspots(t.points())[0], t.points(), ["id", "primary_type", "district"]
        ),
        "located_points": lambda t: ops.located(t.points(), "latitude", "longitude"),
        # Views
        "read_result": _read_result,
        "v_kpis": _kpis,
        "v_monthly": lambda t: views.v_monthly(t.by_month()),
        "v_by_hour": lambda t: views.v_by_hour(t.by_hour()),
        "v_by_dow_named": lambda t: views.v_by_dow_named(t.by_dow()),
        "v_peak_hours": lambda t: views.v_peak_hours(t.by_hour()),
        "v_rate_pct_top": lambda t: views.v_rate_pct(t.top_rates(), "primary_type"),
        "v_race": lambda t: views.v_race(reports.matches_by_race(t.arrest_facts())),
        "v_rate_pct_district": lambda t: views.v_rate_pct(
            t.by_district_rates(), "district"
        ),
        "v_rate_pct_all": lambda t: views.v_rate_pct(
            t.by_type_rates(), "primary_type", 2
        ),
        "v_gunshot_overall": lambda t: views.v_gunshot_overall(
            t.gunshot()
        ),
        "v_violence_by_type": lambda t: views.v_violence_by_type(
            t.violence_by_month()
        ),
        "v_violence_top_districts": lambda t: views.v_violence_top_districts(
            t.violence_by_district()
        ),
        "v_gunshot_top": lambda t: views.v_gunshot_top(
            t.gunshot_by_district().withColumn("district", F.col("district").cast("string"))
        ),
        "v_community_top": lambda t: views.v_community_top(
            t.violence_by_community()
        ),
        "v_hotspot_map": lambda t: views.v_hotspot_map(t.hotspots()),
        "v_cluster_stats": lambda t: views.v_cluster_stats(t.hotspots()),
        "v_hotspot_map_by_label": lambda t: views.v_hotspot_map(t.labelled_spots()),
        "v_cluster_stats_by_label": lambda t: views.v_cluster_stats(t.labelled_spots()),
        "v_density_top": lambda t: views.v_density_top(t.density()),
        "v_density_scatter": lambda t: views.v_density_scatter(
            t.community_corr()
        ),
        "v_minor_priority": lambda t: views.v_minor_priority(
            reports.minor_victims(t.offenders())
        ),
        "v_alerts_by_severity": lambda t: views.v_alerts_by_severity(t.alerts()),
        "v_severity_tiles": lambda t: views.v_severity_tiles(t.alerts()),
        "v_alerts_by_district": lambda t: views.v_alerts_by_district(t.alerts()),
        "v_alert_districts": lambda t: views.v_alert_districts(t.alerts()),
        "v_alert_feed": lambda t: views.v_alert_feed(t.alerts()),
        "v_alert_feed_stored": stream_feed,
        "v_alert_feed_critical": lambda t: views.v_alert_feed(t.alerts(), "CRITICAL"),
        "v_alert_feed_filtered": lambda t: views.v_alert_feed(t.alerts(), "LOW", DISTRICT),
        # The batch run
        **{f"batch_{name}": _from_batch(name) for name in BATCH},
    }.items()
}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts per district and severity."""
    return views.v_alerts_by_district(Tables(spark, folder).alerts())
