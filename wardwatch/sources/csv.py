"""CSV files of the published datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardwatch.schemas import CORRUPT, raw_schema


def read_csv_dataset(
    spark: SparkSession,
    dataset: str,
    path: str,
    multi_line: bool = True,
    check_header: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read one dataset with its declared schema; bad numbers become NULL.

    Columns bind by position. ``check_header`` makes a file fail whose header does not
    name the declared columns. Quoted line breaks need ``multi_line``, under which Spark
    cannot split a file: deliver large exports as many files, or turn it off for exports
    that have no line breaks inside quotes, and each file is split as well.
    ``keep_corrupt`` adds the text of records that do not fit the schema, for
    ``plans.cleaning.rejects``.
    """
    schema = raw_schema(dataset)
    if keep_corrupt:
        schema = schema.add(CORRUPT, "string")
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", not check_header)
        .csv(path)
    )
