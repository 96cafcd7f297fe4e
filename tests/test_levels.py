"""Rows of many batches in few folders."""

import math

from helpers import rows

from wardwatch.streaming.levels import Levels
from wardwatch.streaming.tables import _last

SCHEMA = "k string, n long, batch_id long"


def merge(changes):
    return _last(changes, ["k"])


def batch(spark, batch_id, keys):
    return spark.createDataFrame([(k, batch_id * 10, batch_id) for k in keys], SCHEMA).coalesce(1)


def folders(path):
    return sorted(p.name for p in (path / "rows").iterdir())


def test_folders_grow_with_the_logarithm(spark, tmp_path):
    log = Levels(spark, str(tmp_path), fan=3)
    counts = []
    for batch_id in range(20):
        log.add(batch_id, batch(spark, batch_id, ["hot", f"k{batch_id}"]), merge)
        counts.append(len(log.newest().folders))
    assert max(counts) <= 3 * (1 + math.log(40, 3))
    # What only older manifests list is gone.
    assert len(folders(tmp_path)) <= 2 * max(counts)
    expected = [("hot", 190)] + [(f"k{n}", 10 * n) for n in range(20)]
    assert rows(merge(log.read(log.newest())), "k", "n") == sorted(expected)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    log = Levels(spark, str(tmp_path), fan=2)
    for batch_id in range(5):
        log.add(batch_id, batch(spark, batch_id, ["hot"]), merge, {"seen": batch_id})
    before, listed = rows(log.read(log.newest())), log.newest()
    # Cut off before its manifest was there, then once more after.
    for _ in range(2):
        log.add(4, batch(spark, 4, ["hot"]), merge, {"seen": 4})
        assert rows(log.read(log.newest())) == before and log.newest() == listed


def test_batches_without_rows_and_no_batch(spark, tmp_path):
    log = Levels(spark, str(tmp_path))
    assert log.newest().folders == {} and log.read(log.newest()) is None
    log.add(0, spark.createDataFrame([], SCHEMA), merge)
    assert log.read(log.newest()) is None
    log.add(1, batch(spark, 1, ["a"]), merge)
    log.add(2, spark.createDataFrame([], SCHEMA), merge)
    assert rows(log.read(log.newest()), "k") == [("a",)]
