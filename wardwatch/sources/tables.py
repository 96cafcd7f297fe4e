"""Parquet and JDBC tables, and SQL over result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict | None = None, **options
) -> DataFrame:
    """Read a table. ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` among the options make many executors read ranges of it."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **(properties or {}), **options)
        .load()
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    mode: str = "overwrite",
    keep_definition: bool = False,
    connections: int | None = None,
) -> None:
    """Write a table over JDBC.

    ``keep_definition`` empties the table rather than dropping it, so that grants and
    column types stay. ``connections`` bounds how many tasks write at the same time.
    """
    options = dict(properties or {})
    if keep_definition:
        options["truncate"] = "true"
    if connections:
        options["numPartitions"] = str(connections)
    df.write.jdbc(url=url, table=table, mode=mode, properties=options)


def read_result(
    spark: SparkSession, sql: str, params: dict | list | None = None, **tables: DataFrame
) -> DataFrame:
    """Run SQL over result tables; ``{name}`` in it stands for a frame of ``tables``.

    Values are bound as parameters (``:name`` or ``?``), never pasted into the text.
    """
    return spark.sql(sql, args=params, **tables)
