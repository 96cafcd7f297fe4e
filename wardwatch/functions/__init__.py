"""Column expressions shared by the operators; all stay inside Catalyst."""

from wardwatch.functions.columns import (  # noqa: F401
    alert_id,
    bubble_size,
    calendar_parts,
    cluster_label,
    day_name,
    decimal_round,
    full_name,
    micros,
    percent,
    period_label,
    ratio,
    route_key,
    severity,
    share_of_total,
    stamp,
    strip,
)
