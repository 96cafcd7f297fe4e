"""Compare a Spark result with a DuckDB result: names, types, rows, values."""

import math
import os

import duckdb

TABLES = """
    region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations
""".split()

# DuckDB type of a Spark type; other types are named alike on both sides.
TYPES = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    return (1, str(value))


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(result, connection, sql):
    expected = connection.sql(sql)
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    types = {name: TYPES.get(kind, kind) for name, kind in spark_types.items()}
    oracle = {
        name: str(kind).lower() for name, kind in zip(expected.columns, expected.types)
    }
    assert types == oracle
    ours = _sorted_rows(result.columns, result.collect())
    theirs = _sorted_rows(expected.columns, expected.fetchall())
    assert len(ours) == len(theirs)
    different = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    assert not different, different[:3]
