"""Tables that are published together: readers see all of one run or all of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardwatch.sources import files

# Runs that stay readable, the published one among them.
KEPT = 2


class Publication:
    """Collects the tables of a run and publishes them when all are written.

    ``with Publication(spark, root) as write: run_batch(inputs, write)``. Every run writes
    into a numbered folder of its own; the last step adds a file that names it. A run that
    fails leaves what was published before, and its number is taken again. One run writes
    at a time. The run before stays, for readers that have begun; older ones go.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __enter__(self) -> Publication:
        self.run = max(_runs(self.spark, self.root), default=0) + 1
        self.tables: list[str] = []
        return self

    def __call__(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/run={self.run}/{name}")
        self.tables.append(name)

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            return
        done = f"{self.root}/published/{self.run}"
        files.write_text(self.spark, done, "\n".join(self.tables))
        for old in _runs(self.spark, self.root):
            if old <= self.run - KEPT:
                files.remove(self.spark, f"{self.root}/published/{old}")
                files.remove(self.spark, f"{self.root}/run={old}")


def _runs(spark: SparkSession, root: str) -> list[int]:
    return [int(name) for name in files.names(spark, f"{root}/published") if name.isdigit()]


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the last whole run; none before the first."""
    runs = _runs(spark, root)
    if not runs:
        return {}
    run = max(runs)
    tables = files.read_text(spark, f"{root}/published/{run}").split("\n")
    return {name: spark.read.parquet(f"{root}/run={run}/{name}") for name in tables if name}
