"""Where rows come from and go to: CSV, Parquet, JDBC, event streams."""

from wardwatch.sources.csv import read_csv_dataset  # noqa: F401
from wardwatch.sources.events import event_source, write_messages  # noqa: F401
from wardwatch.sources.tables import (  # noqa: F401
    read_jdbc,
    read_result,
    read_table,
    write_jdbc,
    write_parquet,
)
