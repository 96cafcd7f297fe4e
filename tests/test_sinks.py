"""The alert sink; a table file stands in for the JDBC table."""

import json
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from wardwatch.schemas import ALERT_SCHEMA
from wardwatch.sources import read_table, write_parquet
from wardwatch.streaming import alert_sink

START = datetime(2024, 3, 1)


def alerts(spark, *numbers):
    data = [
        (f"A{n}", "HIGH_CRIME_RATE", "8", 5, 300, 5, "T", f"C{n}", None, 41.5, None)
        + (START + timedelta(seconds=n), "LOW")
        for n in numbers
    ]
    return spark.createDataFrame(data, ALERT_SCHEMA)


@pytest.fixture
def jdbc_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "jdbc")
    write_parquet(alerts(spark).withColumn("created_at", F.current_timestamp()), path)

    def read(self, url, table, properties=None):
        return self.parquet(path)

    def write(self, url, table, mode=None, properties=None):
        self.mode(mode).parquet(path)

    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return path


def test_repeated_batches_append_once(spark, jdbc_table):
    write = alert_sink(jdbc={"url": "jdbc:x", "table": "speed_layer_alerts"})
    write(alerts(spark, 1, 2), 0)
    write(alerts(spark, 1, 2), 0)
    write(alerts(spark, 2, 3), 1)
    write(alerts(spark), 2)
    stored = read_table(spark, jdbc_table)
    assert rows(stored, "alert_id") == [("A1",), ("A2",), ("A3",)]


def test_all_targets_get_the_same(spark, tmp_path, jdbc_table):
    table, documents = str(tmp_path / "t"), str(tmp_path / "d")
    write = alert_sink(table, documents, {"url": "jdbc:x", "table": "speed_layer_alerts"})
    write(alerts(spark, 1, 2), 0)
    assert rows(read_table(spark, table), "alert_id") == [("A1",), ("A2",)]
    assert rows(read_table(spark, jdbc_table), "alert_id") == [("A1",), ("A2",)]
    lines = [
        json.loads(line)
        for part in (tmp_path / "d" / "run=none" / "batch_id=0").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    assert {doc["alert_id"] for doc in lines} == {"A1", "A2"}
    assert set(lines[0]) == set(ALERT_SCHEMA.names)
    assert lines[0]["longitude"] is None


def test_another_run_only_adds(spark, tmp_path):
    """Both runs begin at batch 0, the second a day later."""
    path = str(tmp_path / "t")
    alert_sink(path).for_run("first")(alerts(spark, 1, 2), 0)
    alert_sink(path).for_run("second")(alerts(spark, 3), 0)
    alert_sink(path).for_run("second")(alerts(spark, 3), 0)
    stored = read_table(spark, path)
    assert rows(stored, "alert_id") == [("A1",), ("A2",), ("A3",)]


def test_files_of_a_table_do_not_grow_with_the_tasks(spark, tmp_path, monkeypatch):
    """What each of eight tasks has of three days goes into one file a day, or a few full ones."""
    hours = [alerts(spark, *range(day * 86_400, day * 86_400 + 40)) for day in range(3)]
    every = hours[0].union(hours[1]).union(hours[2]).repartition(8).cache()
    path = tmp_path / "t"
    alert_sink(str(path))(every, 0)
    assert sorted(len(list(day.rglob("part-*"))) for day in path.glob("day=*")) == [1, 1, 1]
    monkeypatch.setattr("wardwatch.streaming.alerts.ALERTS_PER_TASK", 20)
    alert_sink(str(path))(every, 1)
    assert 6 <= len(list(path.glob("day=*/run=*/batch_id=1/part-*"))) <= 9
    for batch in (0, 1):
        stored = read_table(spark, str(path)).filter(F.col("batch_id") == batch)
        assert rows(stored, *ALERT_SCHEMA.names) == rows(every)
    every.unpersist()
