"""The newest alerts of a table that is laid out by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.plans.views import v_alert_feed
from wardwatch.schemas import ALERT_SCHEMA
from wardwatch.sources import files


def stored_feed(
    spark: SparkSession,
    table: str,
    severity: str | None = None,
    district: str | None = None,
    n: int = 100,
) -> DataFrame:
    """``v_alert_feed`` over a table of ``alert_sink``, from the newest days that hold ``n``.

    Days are read from the newest on, twice as many each time, until there are enough
    alerts; older days are neither listed nor read. So a feed that is asked for again and
    again costs what its newest days hold, not what was ever stored.
    """
    days = sorted((d for d in files.names(spark, table) if d.startswith("day=")), reverse=True)
    # Alerts without a time sort last, whatever the name of their folder.
    days.sort(key=lambda day: day.startswith("day=_"))
    taken = 1
    while True:
        alerts = spark.read.schema(ALERT_SCHEMA).option("basePath", table).parquet(
            *[f"{table}/{day}" for day in days[:taken]]
        )
        wanted = alerts
        for name, value in (("severity", severity), ("district", district)):
            if value is not None:
                wanted = wanted.filter(F.col(name) == value)
        if taken >= len(days) or wanted.select("alert_id").limit(n).count() >= n:
            return v_alert_feed(alerts, severity, district, n)
        taken *= 2
