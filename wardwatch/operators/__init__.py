"""DataFrame operators; column names are parameters, plans/ gives them domain names."""

from wardwatch.operators.alerts import alert_stats, detect_anomalies  # noqa: F401
from wardwatch.operators.correlation import correlate  # noqa: F401
from wardwatch.operators.counting import share, tally, trends  # noqa: F401
from wardwatch.operators.hotspots import (  # noqa: F401
    cluster_sizes,
    fit_hotspots,
    fit_kmeans,
    fit_summary,
    label_points,
    located,
)
from wardwatch.operators.lookup import density, mode_lookup  # noqa: F401
from wardwatch.operators.matching import match_facts, match_rate, matches_by  # noqa: F401
from wardwatch.operators.messages import (  # noqa: F401
    parse_events,
    parse_stats,
    route_events,
    to_event_messages,
)
from wardwatch.operators.rolling import (  # noqa: F401
    key_totals,
    rolling_count,
    sliding_counts,
    window_snapshot,
)
