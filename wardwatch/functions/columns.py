"""Column expressions: ratios, labels, keys, severity bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Day numbers run from 1 (Sunday) to 7 (Saturday).
DAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}

# An alert takes the first band whose ratio its count reaches.
SEVERITY_BANDS = [("CRITICAL", 3.0), ("HIGH", 2.0), ("MEDIUM", 1.5)]
LOWEST_SEVERITY = "LOW"
SEVERITIES = [name for name, _ in SEVERITY_BANDS] + [LOWEST_SEVERITY]

UNKNOWN_KEY = "UNKNOWN"
# The white space of Unicode, with the separators among the control characters.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(part: Column | str, whole: Column | str, digits: int = 4, scale: int = 1) -> Column:
    """``part / whole * scale`` rounded; NULL where ``whole`` is zero."""
    quotient = F.try_divide(_col(part), _col(whole))
    return F.round(quotient if scale == 1 else quotient * scale, digits)


def decimal_round(value: Column | str, digits: int) -> Column:
    """Round as decimal, half up, so that 0.45 does not become 0.4 on the way."""
    exact = _col(value).try_cast("decimal(18,6)")
    return F.round(exact, digits).cast(f"decimal(18,{digits})")


def percent(rate: Column | str, digits: int = 1) -> Column:
    """A rate as percentage, rounded as decimal."""
    exact = _col(rate).try_cast("decimal(18,6)") * 100
    return F.round(exact, digits).cast(f"decimal(18,{digits})")


def share_of_total(value: Column | str, digits: int = 1) -> Column:
    """Percentage of the column's own total, half to even; for result tables of few rows."""
    value = _col(value)
    return F.bround(value / F.sum(value).over(Window.partitionBy()) * 100, digits)


def bubble_size(value: Column | str, largest: int = 50) -> Column:
    """``value`` scaled so that the maximum is ``largest``; for result tables of few rows."""
    value = _col(value)
    return value / F.max(value).over(Window.partitionBy()) * largest


def cluster_label(cluster: Column | str, count: Column | str, noun: str = "crimes") -> Column:
    """Caption of a cluster with a thousands separator in the count."""
    return F.format_string(
        f"Cluster %d — %s {noun}", _col(cluster), F.format_number(_col(count), 0)
    )


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Year, month, day of week (1 is Sunday) and hour of a timestamp."""
    ts = _col(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day_of_week": F.dayofweek(ts),
        "hour_of_day": F.hour(ts),
    }


def period_label(year: Column | str, month: Column | str) -> Column:
    """``2024-05``; NULL if either part is."""
    return F.concat(
        _col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0")
    )


def day_name(day_of_week: Column | str) -> Column:
    """Short English name of a day number, NULL for other numbers."""
    pairs = [F.lit(part) for pair in DAY_NAMES.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), _col(day_of_week))


def full_name(last: Column | str, first: Column | str) -> Column:
    """``last, first``; NULL if either part is."""
    return F.concat(_col(last), F.lit(", "), _col(first))


def stamp(ts: Column | str) -> Column:
    """A timestamp as text to the second."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, for timestamps with or without a zone."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def strip(text: Column | str) -> Column:
    """Text without white space around it, line breaks and tabs included."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def route_key(text: Column | str) -> Column:
    """The grouping key of an event: stripped text, or ``UNKNOWN`` for none."""
    stripped = strip(_col(text).cast("string"))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(UNKNOWN_KEY))


def severity(count: Column | str, threshold: int | Column) -> Column:
    """Severity band of a count by how often it holds the threshold."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    times = F.when(threshold > 0, _col(count) / threshold).otherwise(F.lit(0.0))
    band = F.when(F.lit(False), F.lit(LOWEST_SEVERITY))
    for name, least in SEVERITY_BANDS:
        band = band.when(times >= least, name)
    return band.otherwise(LOWEST_SEVERITY)


def alert_id(key: Column | str, event_id: Column | str) -> Column:
    """An id that follows from key and event, so that a replay gives the same one."""
    parts = [F.coalesce(_col(part).cast("string"), F.lit("")) for part in (key, event_id)]
    return F.concat(F.lit("ALERT-"), F.md5(F.concat_ws("|", *parts)))
