"""Small text files on any storage that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces the file; what is there is whole at any time, or for a moment missing."""
    draft, files = _place(spark, f"{path}.draft")
    place, _ = _place(spark, path)
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(place, False)
    files.rename(draft, place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    place, files = _place(spark, path)
    found = files.listStatus(place) if files.exists(place) else []
    return [status.getPath().getName() for status in found]


def remove(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)
