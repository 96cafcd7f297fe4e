"""CSV reading and cleaning on awkward files, tables, and how writers are called."""

from datetime import date, datetime

import pytest
from helpers import rows

from wardwatch.plans import cleaning
from wardwatch.schemas import COLUMNS, DATASETS, clean_schema, raw_schema
from wardwatch.session import scratch_path, shared_dir, sized_for
from wardwatch.sources import (
    event_source,
    read_csv_dataset,
    read_result,
    read_table,
    write_jdbc,
    write_messages,
    write_parquet,
)
from wardwatch.sources.events import MESSAGE_SCHEMA


def csv(tmp_path, dataset, *lines, header=None):
    path = tmp_path / f"{dataset}.csv"
    path.write_text("\n".join([header or ",".join(COLUMNS[dataset]), *lines]) + "\n")
    return str(path)


def test_schemas_have_the_published_widths():
    widths = {name: len(raw_schema(name).fields) for name in DATASETS}
    assert widths == {
        "arrests": 24,
        "crimes": 22,
        "police_stations": 15,
        "sex_offenders": 9,
        "violence": 38,
    }


def test_awkward_rows(spark, tmp_path):
    path = csv(
        tmp_path,
        "sex_offenders",
        'DOE,JO,"1 ""A"" ST",M,W,06/19/1970,510,180,Y',
        'ROE,"AN\nN",2 B ST,F,B,6/1/1970,abc,,',
        "POE,ED",
        "TOE,AL,3 C ST,M,W,1970-06-19,1,2,N,extra,extra",
    )
    cleaned = cleaning.clean_offenders(read_csv_dataset(spark, "sex_offenders", path))
    assert cleaned.schema == clean_schema("sex_offenders")
    doe, roe, poe, toe = cleaned.collect()
    assert doe["block"] == '1 "A" ST' and doe["birth_date"] == date(1970, 6, 19)
    assert roe["first"] == "AN\nN" and roe["height"] is None and roe["weight"] is None
    assert poe["first"] == "ED" and poe["block"] is None
    assert toe["victim_minor"] == "N" and toe["birth_date"] is None


def test_header_is_checked_on_request(spark, tmp_path):
    swapped = ",".join(["first", "last", *COLUMNS["sex_offenders"][2:]])
    path = csv(tmp_path, "sex_offenders", "JO,DOE,b,M,W,,1,2,Y", header=swapped)
    assert read_csv_dataset(spark, "sex_offenders", path).first()["last"] == "JO"
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_dataset(spark, "sex_offenders", path, check_header=True).collect()


@pytest.mark.parametrize(
    "text, flag",
    [("true", True), ("Y", True), ("1", True), ("False", False), ("maybe", None), ("", None)],
)
def test_crime_casts(spark, tmp_path, text, flag):
    row = dict.fromkeys(COLUMNS["crimes"], "")
    row |= {"id": "1", "date": "2026-05-01T23:50:00.250", "updated_on": "2026-05-01"}
    row |= {"arrest": text, "year": "2026", "latitude": "41.5", "district": "008"}
    path = csv(tmp_path, "crimes", ",".join(row.values()))
    crime = cleaning.clean_crimes(read_csv_dataset(spark, "crimes", path)).first()
    assert crime["date"] == datetime(2026, 5, 1, 23, 50, 0, 250_000)
    assert crime["updated_on"] is None
    assert crime["arrest"] is flag
    assert (crime["year"], crime["latitude"], crime["district"]) == (2026, 41.5, "008")


def test_clean_all(spark, tmp_path):
    for dataset in DATASETS:
        csv(tmp_path, dataset, "," * (len(COLUMNS[dataset]) - 1))
    cleaning.clean_all(spark, str(tmp_path), str(tmp_path / "out"))
    for dataset in DATASETS:
        table = read_table(spark, str(tmp_path / "out" / f"{dataset}.parquet"))
        assert table.count() == 1
        assert table.schema == clean_schema(dataset)


def test_parquet_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(5), path)
    write_parquet(spark.range(3), path)
    assert read_table(spark, path).count() == 3


def test_read_result_binds_values(spark):
    table = spark.createDataFrame([("x", 1), ("y'; --", 2)], "name string, n int")
    sql = "SELECT n FROM {t} WHERE name = :name"
    assert read_result(spark, sql, {"name": "y'; --"}, t=table).collect() == [(2,)]


class Recorder:
    """Stands in for a DataFrame and its writer and records the calls."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        if name == "write":
            return self

        def record(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return record


def test_jdbc_writer_options():
    df = Recorder()
    write_jdbc(df, "jdbc:x", "t", {"user": "u"}, keep_definition=True, connections=4)
    properties = {"user": "u", "truncate": "true", "numPartitions": "4"}
    expected = {"url": "jdbc:x", "table": "t", "mode": "overwrite", "properties": properties}
    assert df.calls == [("jdbc", (), expected)]


def test_message_writer_options():
    df = Recorder()
    write_messages(df, "host:9092", "topic")
    names = [name for name, _, _ in df.calls]
    assert names == ["select", "format", "option", "option", "option", "save"]
    assert ("kafka.bootstrap.servers", "host:9092") in [args for _, args, _ in df.calls]


def test_event_source_needs_a_place(spark, tmp_path):
    with pytest.raises(ValueError):
        event_source(spark)
    stream = event_source(spark, path=str(tmp_path))
    assert stream.isStreaming and stream.schema == MESSAGE_SCHEMA


class Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, configured=None, checkpoints=None):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = self
        self.master, self.checkpoints = master, checkpoints

    def getCheckpointDir(self):
        return self.checkpoints

    def setCheckpointDir(self, folder):
        self.checkpoints = folder


def test_choice_of_the_shared_folder(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    assert shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(Session("yarn", None, "hdfs:///set")) == "hdfs:///set"
    assert shared_dir(Session("local[2]")).startswith(str(tmp_path))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))


def test_partitions_grow_with_the_shuffle():
    assert sized_for(10**9) == {"spark.sql.shuffle.partitions": "200"}
    assert sized_for(10 * 1024**4) == {"spark.sql.shuffle.partitions": "40960"}


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_rejected_values_and_records(spark, tmp_path):
    path = tmp_path / "offenders.csv"
    lines = [
        "last,first,block,gender,race,birth_date,height,weight,victim_minor",
        "A,B,1,M,W,01/02/1970,170,80,N",
        'C,"D, ""x""",1,M,W,1970-01-02,tall,80,N',
        "E,F,1,M,W,,,,Y",
        "G,H,1",
        'I,"J\nK",1,M,W,01/02/1970,170,8O,N',
    ]
    path.write_text("\n".join(lines) + "\n")
    raw = read_csv_dataset(spark, "sex_offenders", str(path), keep_corrupt=True)
    found = cleaning.rejects("sex_offenders", raw)
    assert rows(found, "column_name", "value") == [
        (None, None),
        ("birth_date", "1970-01-02"),
        ("height", "tall"),
        ("weight", "8O"),
    ]
    (short,) = found.filter("column_name IS NULL").collect()
    assert short["record"].startswith("G,H,1") and short["dataset"] == "sex_offenders"
    plain = read_csv_dataset(spark, "sex_offenders", str(path))
    assert plain.columns == raw.columns[:-1] and plain.count() == 5
