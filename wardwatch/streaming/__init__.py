"""Streaming queries over event messages."""

from wardwatch.streaming.alerts import alert_query, alert_sink, stage_counters  # noqa: F401
from wardwatch.streaming.counting import held_counts, live_counts  # noqa: F401
from wardwatch.streaming.counting import rolling_count_stream, stream_counters  # noqa: F401
from wardwatch.streaming.tables import append_table, latest, open_windows  # noqa: F401
from wardwatch.streaming.tables import replace_table, update_table  # noqa: F401
