"""Raw CSV rows to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.schemas import (
    BOOLEANS,
    CORRUPT,
    DATASETS,
    DATE_PATTERN,
    DATES,
    TIMESTAMP_PATTERN,
    TIMESTAMPS,
    raw_schema,
)
from wardwatch.sources import read_csv_dataset, write_parquet


def clean(dataset: str, raw: DataFrame) -> DataFrame:
    """Type the text columns of a dataset; what does not fit the pattern becomes NULL."""
    typed = {
        name: F.try_to_timestamp(F.col(name), F.lit(TIMESTAMP_PATTERN))
        for name in TIMESTAMPS.get(dataset, [])
    }
    typed |= {
        name: F.try_to_date(F.col(name), DATE_PATTERN) for name in DATES.get(dataset, [])
    }
    typed |= {name: F.col(name).try_cast("boolean") for name in BOOLEANS.get(dataset, [])}
    return raw.withColumns(typed) if typed else raw


def rejects(dataset: str, raw: DataFrame) -> DataFrame:
    """(dataset, column_name, value, record): what the typed table has lost, one row each.

    ``raw`` is read with ``keep_corrupt``. A value that is no number, time, date or boolean
    comes with its column. A record that does not fit the schema comes with its text; if all
    its values are right, it has too few or too many fields, and no column is named. Right
    rows leave nothing, so what is stored grows with the faults.
    """
    names = [name for name in raw.columns if name != CORRUPT]
    by_cleaning = [n for of in (TIMESTAMPS, DATES, BOOLEANS) for n in of.get(dataset, [])]
    by_reader = [f.name for f in raw_schema(dataset).fields if f.dataType.typeName() != "string"]
    text = raw.withColumns({f"text {name}": F.col(name) for name in by_cleaning})
    as_text = ", ".join(f"`{name}` string" for name in names)
    texts = F.from_csv(F.col(CORRUPT), as_text, {"escape": '"'})
    rows = clean(dataset, text).withColumn("texts", F.when(F.col(CORRUPT).isNotNull(), texts))

    def lost(name: str, value: Column) -> Column:
        found = F.struct(F.lit(name).alias("column_name"), value.alias("value"))
        return F.when(F.col(name).isNull() & value.isNotNull() & (value != ""), found)

    values = [lost(name, F.col(f"text {name}")) for name in by_cleaning]
    values += [lost(name, F.col(f"texts.`{name}`")) for name in by_reader]
    none = F.struct(*[F.lit(None).cast("string").alias(n) for n in ("column_name", "value")])
    found = F.array_compact(F.array(*values, F.when(F.lit(False), none)))
    found = F.when((F.size(found) == 0) & F.col(CORRUPT).isNotNull(), F.array(none)).otherwise(found)
    rows = rows.select(F.col(CORRUPT).alias("record"), F.explode(found).alias("lost"))
    return rows.select(F.lit(dataset).alias("dataset"), "lost.column_name", "lost.value", "record")


def clean_arrests(raw: DataFrame) -> DataFrame:
    return clean("arrests", raw)


def clean_crimes(raw: DataFrame) -> DataFrame:
    return clean("crimes", raw)


def clean_stations(raw: DataFrame) -> DataFrame:
    return clean("police_stations", raw)


def clean_offenders(raw: DataFrame) -> DataFrame:
    return clean("sex_offenders", raw)


def clean_violence(raw: DataFrame) -> DataFrame:
    return clean("violence", raw)


def clean_all(
    spark: SparkSession, csv_dir: str, table_dir: str, rejects_dir: str | None = None, **options
) -> None:
    """Every dataset from ``<csv_dir>/<name>.csv`` to ``<table_dir>/<name>.parquet``.

    With ``rejects_dir`` also what was lost, at a second reading of the files, to
    ``<rejects_dir>/<name>.parquet``.
    """
    for dataset in DATASETS:
        path = f"{csv_dir}/{dataset}.csv"
        raw = read_csv_dataset(spark, dataset, path, **options)
        write_parquet(clean(dataset, raw), f"{table_dir}/{dataset}.parquet")
        if rejects_dir:
            raw = read_csv_dataset(spark, dataset, path, keep_corrupt=True, **options)
            write_parquet(rejects(dataset, raw), f"{rejects_dir}/{dataset}.parquet")
