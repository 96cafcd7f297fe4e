"""Readers see all tables of one run."""

import pytest
from helpers import rows

from wardwatch.sources.publication import Publication, published


def table(spark, run):
    return spark.createDataFrame([(run,)], "run long")


def seen(spark, root):
    return {name: rows(df) for name, df in published(spark, root).items()}


def test_readers_see_whole_runs(spark, tmp_path):
    root = str(tmp_path / "out")
    assert published(spark, root) == {}
    for run in range(4):
        with Publication(spark, root) as write:
            before = seen(spark, root)
            write(table(spark, run), "a")
            assert seen(spark, root) == before  # half done
            write(table(spark, run), "b")
        assert seen(spark, root) == {"a": [(run,)], "b": [(run,)]}
    kept = sorted(path.name for path in (tmp_path / "out").glob("run=*"))
    assert kept == ["run=3", "run=4"]


def test_a_failed_run_leaves_what_was_there(spark, tmp_path):
    root = str(tmp_path / "out")
    with Publication(spark, root) as write:
        write(table(spark, 1), "a")
    with pytest.raises(RuntimeError), Publication(spark, root) as write:
        write(table(spark, 2), "a")
        raise RuntimeError
    assert seen(spark, root) == {"a": [(1,)]}
    with Publication(spark, root) as write:
        write(table(spark, 3), "a")
    assert seen(spark, root) == {"a": [(3,)]}


def test_a_reader_goes_on_during_the_next_run(spark, tmp_path):
    root = str(tmp_path / "out")
    with Publication(spark, root) as write:
        write(table(spark, 1), "a")
    held = published(spark, root)["a"]
    with Publication(spark, root) as write:
        write(table(spark, 2), "a")
    assert rows(held) == [(1,)]
