"""SQL over the driver's tables that every query must agree with, by query name."""

from __future__ import annotations

WINDOW_US = 86_400_000_000
SLIDE_US = 21_600_000_000
THRESHOLD = 2

CRIMES = """
    SELECT o_orderkey AS case_number, o_orderdate AS date, n_name AS primary_type,
           c_mktsegment AS district, o_orderstatus = 'F' AS arrest
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
                LEFT JOIN nation ON c_nationkey = n_nationkey
"""
ARRESTS = """
    SELECT l_orderkey AS case_number,
           CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS race
    FROM lineitem
"""
JOINED = f"""
    SELECT c.*, a.race FROM ({CRIMES}) c LEFT JOIN ({ARRESTS}) a
    ON c.case_number = a.case_number
"""
PLACED = """
    SELECT l_partkey AS block, s_nationkey AS district,
           CAST(l_quantity AS INTEGER) AS community_area, l_linestatus = 'F' AS arrest
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
VIOLENCE = """
    SELECT CAST(month(l_shipdate) AS INTEGER) AS month, s_nationkey AS district,
           nullif(CAST(l_quantity AS INTEGER), 50) AS community_area,
           CASE WHEN l_returnflag = 'R' THEN 'HOMICIDE' ELSE l_returnflag END
               AS victimization_primary,
           CASE WHEN l_linestatus = 'F' THEN 'YES' ELSE 'NO' END AS gunshot_injury_i
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
OFFENDERS = """
    SELECT p_name AS last, p_brand AS first, p_partkey AS block, left(p_type, 1) AS gender,
           p_type AS race, DATE '1970-01-01' + p_size AS birth_date, p_size AS height,
           CAST(floor(p_retailprice) AS INTEGER) AS weight,
           CASE WHEN p_size <= 5 THEN 'Y' ELSE 'N' END AS victim_minor
    FROM part
"""
STATIONS = """
    SELECT n_nationkey AS district, n_name AS district_name, r_name AS address
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""
# Events with the key they are counted under, an order for equal times, and what an
# alert shows of them.
EVENTS = """
    SELECT event_id, ts, CAST(user_id AS VARCHAR) AS routed_district,
           CAST(event_id AS VARCHAR) AS message_id, event_type, props, value
    FROM events
"""
# Of the messages only clicks and purchases are good, and a purchase has no district.
GOOD = """
    SELECT event_id, ts,
           CASE WHEN event_type = 'purchase' THEN 'UNKNOWN'
                ELSE CAST(user_id AS VARCHAR) END AS routed_district,
           lpad(CAST(event_id AS VARCHAR), 20, '0') AS message_id, event_type, props, value
    FROM events WHERE event_type IN ('click', 'purchase')
"""


def counted(events: str) -> str:
    return f"""
    SELECT *, CAST(
        count(*) OVER (PARTITION BY routed_district ORDER BY epoch_us(ts)
                       RANGE BETWEEN {WINDOW_US - 1} PRECEDING AND CURRENT ROW)
        - count(*) OVER (PARTITION BY routed_district, ts)
        + row_number() OVER (PARTITION BY routed_district, ts ORDER BY event_id)
        AS BIGINT) AS window_count
    FROM ({events})
    """


def severity(count: str, threshold: int) -> str:
    times = f"CAST({count} AS DOUBLE) / {threshold}"
    return f"""CASE WHEN {times} >= 3 THEN 'CRITICAL' WHEN {times} >= 2 THEN 'HIGH'
               WHEN {times} >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END"""


def alerts(events: str) -> str:
    return f"""
    SELECT 'ALERT-' || md5(routed_district || '|' || message_id) AS alert_id,
           'HIGH_CRIME_RATE' AS alert_type, routed_district AS district,
           window_count AS crime_count_in_window,
           CAST({WINDOW_US // 1_000_000} AS INTEGER) AS window_seconds,
           CAST({THRESHOLD} AS INTEGER) AS threshold, event_type AS latest_crime_type,
           CAST(event_id AS VARCHAR) AS latest_case_number, props AS latest_block,
           value AS latitude, CAST(NULL AS DOUBLE) AS longitude, ts AS triggered_at,
           {severity("window_count", THRESHOLD)} AS severity
    FROM ({counted(events)}) WHERE window_count >= {THRESHOLD}
    """


ALERTS = alerts(EVENTS)


def calendar(source: str, ts: str) -> str:
    return f"""
    SELECT CAST(year({ts}) AS INTEGER) AS year, CAST(month({ts}) AS INTEGER) AS month,
           CAST(dayofweek({ts}) + 1 AS INTEGER) AS day_of_week,
           CAST(hour({ts}) AS INTEGER) AS hour_of_day
    FROM ({source})
    """


def trend(source: str, ts: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) AS crime_count FROM ({calendar(source, ts)}) GROUP BY {keys}"


def arrest_rate(key: str) -> str:
    return f"""
    SELECT {key}, count(*) AS total_crimes, count(race) AS total_arrests,
           round(count(race) / count(*), 4) AS arrest_rate
    FROM ({JOINED}) GROUP BY {key}
    """


def gunshot(keys: str = "") -> str:
    hits = "count(*) FILTER (WHERE gunshot_injury_i = 'YES')"
    return f"""
    SELECT {keys + "," if keys else ""} count(*) AS total_incidents, {hits} AS gunshot_yes,
           round({hits} / count(*), 4) AS gunshot_proportion
    FROM ({VIOLENCE}) {"GROUP BY " + keys if keys else ""}
    """


def mode_lookup(value: str) -> str:
    return f"""
    SELECT block, {value} FROM (
        SELECT block, {value},
               row_number() OVER (PARTITION BY block ORDER BY count(*) DESC, {value}) AS r
        FROM ({PLACED}) WHERE block IS NOT NULL AND {value} IS NOT NULL
        GROUP BY block, {value})
    WHERE r = 1
    """


def offenders_by(area: str) -> str:
    return f"""
    SELECT {area}, count(*) AS offender_count
    FROM ({OFFENDERS}) JOIN ({mode_lookup(area)}) USING (block)
    WHERE {area} IS NOT NULL GROUP BY {area}
    """


def percent(rate: str, digits: int = 1) -> str:
    return f"CAST(round(CAST({rate} AS DECIMAL(18,6)) * 100, {digits}) AS DECIMAL(18,{digits}))"


def rate_pct(rates: str, key: str, digits: int = 1) -> str:
    return f"""
    SELECT {key}, total_crimes, total_arrests, {percent("arrest_rate", digits)} AS arrest_pct
    FROM ({rates})
    """


def feed(where: str, n: int, source: str | None = None) -> str:
    return f"""
    SELECT alert_id, district, severity, crime_count_in_window, window_seconds, threshold,
           latest_crime_type, latest_case_number,
           strftime(triggered_at, '%Y-%m-%d %H:%M:%S') AS triggered_at
    FROM (SELECT * FROM ({source or ALERTS}) {where} ORDER BY triggered_at DESC, alert_id LIMIT {n})
    """


BY_YEAR = trend(CRIMES, "date", "year")
BY_MONTH = trend(CRIMES, "date", "year, month")
BY_DOW = trend("SELECT ts FROM events", "ts", "day_of_week")
BY_HOUR = trend("SELECT ts FROM events", "ts", "hour_of_day")
BY_TYPE = arrest_rate("primary_type")
BY_DISTRICT = arrest_rate("district")
TOP_TYPES = f"""
    SELECT * FROM ({BY_TYPE}) WHERE total_crimes >= 10
    ORDER BY arrest_rate DESC, primary_type LIMIT 10
"""
BY_RACE = f"""
    SELECT race AS arrestee_race, count(*) AS total_arrests FROM ({JOINED})
    WHERE race IS NOT NULL GROUP BY race
"""
VIOLENCE_BY_MONTH = f"""
    SELECT month, victimization_primary, count(*) AS incident_count FROM ({VIOLENCE})
    GROUP BY month, victimization_primary
"""
VIOLENCE_BY_DISTRICT = f"""
    SELECT district, victimization_primary, count(*) AS incident_count FROM ({VIOLENCE})
    GROUP BY district, victimization_primary
"""
VIOLENCE_BY_COMMUNITY = f"""
    SELECT community_area, count(*) AS total_incidents,
           count(*) FILTER (WHERE victimization_primary = 'HOMICIDE') AS homicides,
           count(*) FILTER (WHERE victimization_primary <> 'HOMICIDE') AS non_fatal
    FROM ({VIOLENCE}) WHERE community_area IS NOT NULL GROUP BY community_area
"""
DENSITY = f"""
    SELECT district, offender_count, district_name, address
    FROM ({offenders_by("district")}) LEFT JOIN ({STATIONS}) USING (district)
"""
MINORS = f"SELECT * FROM ({OFFENDERS}) WHERE victim_minor = 'Y'"
COMMUNITY_CORR = f"""
    SELECT community_area, total_crimes, coalesce(offender_count, 0) AS offender_count,
           round(coalesce(offender_count, 0) / total_crimes * 100, 4)
               AS offender_density_per_100_crimes
    FROM (SELECT community_area, count(*) AS total_crimes FROM ({PLACED})
          WHERE community_area IS NOT NULL GROUP BY community_area)
    LEFT JOIN ({offenders_by("community_area")}) USING (community_area)
"""
SLIDING = f"""
    SELECT CAST(user_id AS VARCHAR) AS routed_district,
           make_timestamp((epoch_us(ts) // {SLIDE_US} - i) * {SLIDE_US}) AS window_start,
           make_timestamp((epoch_us(ts) // {SLIDE_US} - i) * {SLIDE_US} + {WINDOW_US})
               AS window_end,
           count(*) AS event_count
    FROM events CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(i)
    GROUP BY ALL
"""
KEY_TOTALS = """
    SELECT CAST(user_id AS VARCHAR) AS routed_district, count(*) AS event_count
    FROM events GROUP BY user_id
"""
SPOTS = """
    SELECT label AS cluster_id, CAST(min(embedding[1]) AS DOUBLE) AS lat,
           CAST(min(embedding[2]) AS DOUBLE) AS lon, count(*) AS crime_count
    FROM embeddings WHERE embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL
    GROUP BY label
"""
MESSAGE_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

ORACLES = {
    "trends_by_year": BY_YEAR,
    "trends_by_month": BY_MONTH,
    "trends_by_dow": BY_DOW,
    "trends_by_hour": BY_HOUR,
    "trend_facts": f"""
        SELECT year, month, day_of_week, hour_of_day, count(*) AS n
        FROM ({calendar("SELECT ts FROM events", "ts")}) GROUP BY ALL
    """,
    "arrest_facts": f"""
        SELECT primary_type, district, race, count(*) AS joined_rows FROM ({JOINED})
        GROUP BY primary_type, district, race
    """,
    "rate_by_type": BY_TYPE,
    "top_types": TOP_TYPES,
    "rate_by_district": BY_DISTRICT,
    "matches_by_race": BY_RACE,
    "violence_by_month": VIOLENCE_BY_MONTH,
    "violence_by_district": VIOLENCE_BY_DISTRICT,
    "gunshot_overall": gunshot(),
    "gunshot_by_district": gunshot("district"),
    "violence_by_community": VIOLENCE_BY_COMMUNITY,
    "violence_facts": f"SELECT *, count(*) AS n FROM ({VIOLENCE}) GROUP BY ALL",
    "mode_lookup": mode_lookup("district"),
    "mode_lookup_community": mode_lookup("community_area"),
    "density": DENSITY,
    "minor_victims": MINORS,
    "district_corr": f"""
        SELECT district, total_crimes, coalesce(total_arrests, 0) AS total_arrests,
               coalesce(total_violence_incidents, 0) AS total_violence_incidents,
               round(coalesce(total_arrests, 0) / total_crimes, 4) AS arrest_rate,
               round(coalesce(total_violence_incidents, 0) / total_crimes, 4) AS violence_rate
        FROM (SELECT district, count(*) AS total_crimes FROM ({PLACED}) GROUP BY district)
        LEFT JOIN (SELECT district, count(*) AS total_arrests FROM ({PLACED})
                   WHERE arrest GROUP BY district) USING (district)
        LEFT JOIN (SELECT district, count(*) AS total_violence_incidents FROM ({VIOLENCE})
                   GROUP BY district) USING (district)
    """,
    "community_corr": COMMUNITY_CORR,
    "place_facts": f"SELECT *, count(*) AS n FROM ({PLACED}) GROUP BY ALL",
    "rolling_count": f"""
        SELECT event_id, routed_district, window_count,
               CAST({WINDOW_US // 1_000_000} AS INTEGER) AS window_seconds
        FROM ({counted(EVENTS)})
    """,
    "detect_anomalies": ALERTS,
    "alert_stats": f"""
        SELECT count(*) AS routed, count(DISTINCT routed_district) AS active_districts,
               count(*) FILTER (WHERE routed_district = 'UNKNOWN') AS unknown_district,
               count(window_count) AS events_checked,
               count(*) FILTER (WHERE window_count >= {THRESHOLD}) AS anomalies_detected
        FROM ({counted(EVENTS)})
    """,
    "severity": f"""
        SELECT CAST(user_id AS VARCHAR) AS routed_district, count(*) AS n,
               {severity("count(*)", 50)} AS severity
        FROM events GROUP BY user_id
    """,
    "window_snapshot": """
        SELECT CAST(user_id AS VARCHAR) AS routed_district, count(*) AS window_count
        FROM events
        WHERE ts > TIMESTAMP '2024-01-14 12:00:00' AND ts <= TIMESTAMP '2024-01-15 12:00:00'
        GROUP BY user_id
    """,
    "sliding_counts": SLIDING,
    "sliding_counts_stream": f"""
        SELECT * FROM ({SLIDING})
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES
    """,
    "key_totals": KEY_TOTALS,
    "key_totals_stream": KEY_TOTALS,
    "to_event_messages": f"""
        SELECT CAST(user_id AS VARCHAR) AS key,
               '{{"id":"' || event_id || '","case_number":"' || event_id || '","date":"'
               || strftime(ts, '%Y-%m-%d') || '","block":"' || replace(props, '"', '\\"')
               || '","primary_type":"' || event_type
               || '","description":"","location_description":"","arrest":'
               || CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END
               || ',"domestic":false,"beat":"","district":"' || user_id
               || '","ward":"","community_area":"","latitude":' || value
               || ',"longitude":null,"ingested_at":"' || {MESSAGE_TIME} || '"}}' AS value
        FROM events
    """,
    "parse_events": f"""
        SELECT CAST(user_id AS VARCHAR) AS key, ts AS timestamp,
               lpad(CAST(event_id AS VARCHAR), 20, '0') AS message_id,
               CASE WHEN readable THEN CAST(event_id AS VARCHAR) ELSE '' END AS id,
               CASE WHEN readable THEN CAST(event_id AS VARCHAR) ELSE '' END AS case_number,
               CASE WHEN readable THEN props ELSE '' END AS block,
               CASE WHEN readable THEN event_type ELSE '' END AS primary_type,
               event_type = 'click' AS arrest, false AS domestic, '' AS beat,
               CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR)
                    WHEN event_type = 'view' THEN ' ' ELSE '' END AS district,
               '' AS ward, '' AS community_area,
               CASE WHEN readable THEN value END AS latitude,
               CAST(NULL AS DOUBLE) AS longitude,
               CASE WHEN readable THEN {MESSAGE_TIME} ELSE '' END AS ingested_at,
               CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'not_object'
                               WHEN 'view' THEN 'missing_fields' END AS rejected
        FROM (SELECT *, event_type NOT IN ('error', 'signup') AS readable FROM events)
    """,
    "parse_stats": """
        SELECT count(*) AS messages_consumed,
               count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS parsed,
               count(*) FILTER (WHERE event_type = 'error') AS malformed,
               count(*) FILTER (WHERE event_type = 'view') AS missing_fields,
               count(*) FILTER (WHERE event_type = 'signup') AS errors
        FROM events
    """,
    "route_events": f"""
        SELECT routed_district, count(*) AS events FROM ({GOOD}) GROUP BY routed_district
    """,
    "route_key": """
        SELECT doc_id, coalesce(nullif(trim(lang), ''), 'UNKNOWN') AS routed FROM documents
    """,
    "clean_arrests": """
        SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS cb_no,
               CAST(l_orderkey AS VARCHAR) AS case_number,
               date_trunc('millisecond', l_shipdate) AS arrest_date, l_linestatus AS race,
               'say "' || l_returnflag || '",' || chr(10) || 'next' AS charge_1_statute
        FROM lineitem
    """,
    "clean_crimes": """
        SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('millisecond', ts) AS date,
               props AS block, event_type AS primary_type,
               CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS arrest,
               CAST(year(ts) AS INTEGER) AS year, value AS latitude
        FROM events
    """,
    "clean_stations": f"""
        SELECT lpad(CAST(district AS VARCHAR), 3, '0') AS district, district_name,
               address || ', ' || district_name AS address
        FROM ({STATIONS})
    """,
    "clean_offenders": f"""
        SELECT last, CAST(block AS VARCHAR) AS block, birth_date, height,
               CAST(NULL AS INTEGER) AS weight, victim_minor
        FROM ({OFFENDERS})
    """,
    "clean_violence": """
        SELECT CAST(o_orderkey AS VARCHAR) AS case_number,
               date_trunc('millisecond', o_orderdate) AS date,
               o_orderpriority AS victimization_primary,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(NULL AS TIMESTAMP) AS updated, o_totalprice AS latitude
        FROM orders
    """,
    "rolling_count_stream": f"""
        SELECT event_id, routed_district, window_count FROM ({counted(EVENTS)})
    """,
    "alert_query": alerts(GOOD),
    "alert_documents": f"""
        SELECT district, severity, count(*) AS documents, count(DISTINCT alert_id) AS alert_ids
        FROM ({alerts(GOOD)}) GROUP BY district, severity
    """,
    "located_points": """
        SELECT vec_id AS id, label AS primary_type, label AS district,
               CAST(embedding[1] AS DOUBLE) AS latitude,
               CAST(embedding[2] AS DOUBLE) AS longitude
        FROM embeddings WHERE embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL
    """,
    "read_result": f"SELECT primary_type, total_crimes FROM ({BY_TYPE}) WHERE total_crimes >= 10",
    "v_kpis": f"""
        SELECT (SELECT CAST(sum(crime_count) AS BIGINT) FROM ({BY_YEAR})) AS total_crimes,
               (SELECT count(*) FROM ({ALERTS})) AS total_alerts,
               (SELECT count(*) FROM ({ALERTS}) WHERE severity = 'CRITICAL') AS critical_alerts,
               (SELECT least(10, count(DISTINCT (embedding[1], embedding[2])))
                FROM embeddings) AS hotspot_count,
               (SELECT district FROM ({BY_DISTRICT}) ORDER BY arrest_rate DESC, district LIMIT 1)
                   AS top_district,
               (SELECT {percent("gunshot_proportion")} FROM ({gunshot()})) AS gunshot_pct
    """,
    "v_monthly": f"""
        SELECT year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period, crime_count
        FROM ({BY_MONTH})
    """,
    "v_by_hour": BY_HOUR,
    "v_by_dow_named": f"""
        SELECT day_of_week, crime_count,
               ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week] AS day_name
        FROM ({BY_DOW})
    """,
    "v_peak_hours": f"""
        SELECT (SELECT hour_of_day FROM ({BY_HOUR}) ORDER BY crime_count DESC, hour_of_day
                LIMIT 1) AS peak_hour,
               (SELECT max(crime_count) FROM ({BY_HOUR})) AS peak_count,
               (SELECT hour_of_day FROM ({BY_HOUR}) ORDER BY crime_count, hour_of_day
                LIMIT 1) AS low_hour,
               (SELECT min(crime_count) FROM ({BY_HOUR})) AS low_count
    """,
    "v_rate_pct_top": rate_pct(TOP_TYPES, "primary_type"),
    "v_race": BY_RACE,
    "v_rate_pct_district": rate_pct(BY_DISTRICT, "district"),
    "v_rate_pct_all": rate_pct(BY_TYPE, "primary_type", 2),
    "v_gunshot_overall": f"""
        SELECT *, {percent("gunshot_proportion")} AS gunshot_pct FROM ({gunshot()})
    """,
    "v_violence_by_type": f"""
        SELECT victimization_primary, CAST(sum(incident_count) AS BIGINT) AS total
        FROM ({VIOLENCE_BY_MONTH}) GROUP BY victimization_primary
    """,
    "v_violence_top_districts": f"""
        SELECT district, CAST(sum(incident_count) AS BIGINT) AS total
        FROM ({VIOLENCE_BY_DISTRICT}) GROUP BY district ORDER BY total DESC, district LIMIT 10
    """,
    "v_gunshot_top": f"""
        SELECT CAST(district AS VARCHAR) AS district, total_incidents, gunshot_yes,
               {percent("gunshot_proportion")} AS gunshot_pct
        FROM ({gunshot("district")}) WHERE district IS NOT NULL
        ORDER BY gunshot_pct DESC, CAST(district AS VARCHAR) LIMIT 15
    """,
    "v_community_top": f"""
        SELECT * FROM ({VIOLENCE_BY_COMMUNITY})
        ORDER BY total_incidents DESC, community_area LIMIT 15
    """,
    "v_hotspot_map_by_label": f"""
        SELECT cluster_id, lat, lon, crime_count,
               crime_count / max(crime_count) OVER () * 50 AS size,
               'Cluster ' || cluster_id || ' — ' || format('{{:,}}', crime_count) || ' crimes'
                   AS label
        FROM ({SPOTS})
    """,
    "v_cluster_stats_by_label": f"""
        SELECT cluster_id, lat, lon, format('{{:,}}', crime_count) AS crimes_assigned,
               round_even(crime_count / sum(crime_count) OVER () * 100, 1) || '%' AS pct_of_total
        FROM ({SPOTS})
    """,
    "v_density_top": f"""
        SELECT district, offender_count FROM ({DENSITY}) WHERE district IS NOT NULL
        ORDER BY offender_count DESC, district LIMIT 15
    """,
    "v_density_scatter": f"""
        SELECT community_area, total_crimes, offender_count,
               CAST(round(CAST(offender_density_per_100_crimes AS DECIMAL(18,6)), 2)
                    AS DECIMAL(18,2)) AS density_per_100
        FROM ({COMMUNITY_CORR}) ORDER BY total_crimes DESC, community_area LIMIT 15
    """,
    "v_minor_priority": f"""
        SELECT last || ', ' || first AS name, block, gender, race, victim_minor
        FROM ({MINORS}) ORDER BY name, block LIMIT 50
    """,
    "v_alerts_by_severity": f"""
        SELECT severity, count(*) AS cnt FROM ({ALERTS}) GROUP BY severity
    """,
    "v_severity_tiles": f"""
        SELECT count(*) FILTER (WHERE severity = 'CRITICAL') AS "CRITICAL",
               count(*) FILTER (WHERE severity = 'HIGH') AS "HIGH",
               count(*) FILTER (WHERE severity = 'MEDIUM') AS "MEDIUM",
               count(*) FILTER (WHERE severity = 'LOW') AS "LOW"
        FROM ({ALERTS})
    """,
    "v_alerts_by_district": f"""
        SELECT district, severity, count(*) AS cnt FROM ({ALERTS})
        WHERE district IS NOT NULL GROUP BY district, severity
    """,
    "v_alert_districts": f"SELECT DISTINCT district FROM ({ALERTS}) WHERE district IS NOT NULL",
    "v_alert_feed": feed("", 100),
    "v_alert_feed_critical": feed("WHERE severity = 'CRITICAL'", 100),
}

# Tables of the batch run are those reports.
BATCH_REPORTS = """
    trends_by_year trends_by_month trends_by_dow trends_by_hour rate_by_type top_types
    rate_by_district matches_by_race violence_by_month violence_by_district gunshot_overall
    gunshot_by_district violence_by_community density minor_victims district_corr
    community_corr
""".split()
ORACLES |= {f"batch_{name}": ORACLES[name] for name in BATCH_REPORTS}

# Every located point is in one of the ten clusters and in the one with the nearest centre.
LOCATED = """
    FROM embeddings WHERE embedding[1] IS NOT NULL AND embedding[2] IS NOT NULL
"""
ORACLES["hotspot_checks"] = f"""
    SELECT 'located_points' AS measure, count(*) AS n {LOCATED}
    UNION ALL SELECT 'in_clusters', count(*) {LOCATED}
    UNION ALL SELECT 'labelled_points', count(*) {LOCATED}
    UNION ALL SELECT 'clusters', least(10, count(DISTINCT (embedding[1], embedding[2]))) {LOCATED}
    UNION ALL SELECT 'nearer_to_another', CAST(0 AS BIGINT)
    UNION ALL SELECT 'negative_cost', CAST(0 AS BIGINT)
"""
ORACLES["rolling_count_stream_shuffled"] = ORACLES["rolling_count_stream"]
ORACLES["v_alert_feed_filtered"] = feed("WHERE severity = 'LOW' AND district = '7'", 100)
ORACLES["alert_both_targets"] = f"""
    SELECT target, a.* FROM ({alerts(GOOD)}) a, (VALUES ('table'), ('documents')) t(target)
"""
ORACLES["route_rows"] = f"SELECT message_id, routed_district FROM ({GOOD})"


def with_ahead(events: str) -> str:
    """The events, and one in 200 again with a time 66 years ahead."""
    return f"""
        SELECT * FROM ({events}) UNION ALL BY NAME
        SELECT * REPLACE (ts + INTERVAL 66 YEARS AS ts, {{changes}}) FROM ({events})
        WHERE event_id % 200 = 0
    """


COUNTED_AHEAD = counted(with_ahead(EVENTS).format(changes="-event_id - 1 AS event_id"))
ORACLES["rolling_count_stream_ahead"] = f"""
    SELECT event_id, routed_district, window_count FROM ({COUNTED_AHEAD})
"""
ORACLES["alert_query_ahead"] = alerts(
    with_ahead(GOOD).format(changes="'ahead' || message_id AS message_id")
)


def clustering(k: int = 10, rounds: int = 20) -> str:
    """CTEs ``positions``, ``points`` and ``centres``: farthest points, then rounds of means."""
    square = "(gx - cx) * (gx - cx) + (gy - cy) * (gy - cy)"
    grid = [f"floor(CAST(embedding[{i}] AS DOUBLE) * 1e9 + 0.5)" for i in (1, 2)]
    ctes = [
        f"points AS (SELECT *, {grid[0]} AS gx, {grid[1]} AS gy {LOCATED})",
        "positions AS MATERIALIZED (SELECT gx, gy, count(*) AS n FROM points GROUP BY gx, gy)",
        """c0 AS MATERIALIZED (
            SELECT 0 AS id, gx AS cx, gy AS cy FROM positions ORDER BY n DESC, gx, gy LIMIT 1)""",
    ]
    for i in range(1, k):
        ctes.append(f"""c{i} AS MATERIALIZED (
            SELECT * FROM c{i - 1} UNION ALL (
                SELECT {i}, gx, gy FROM (
                    SELECT gx, gy, n, min({square}) AS d FROM positions, c{i - 1}
                    GROUP BY gx, gy, n)
                WHERE d > 0 ORDER BY n * d DESC, gx, gy LIMIT 1))""")
    for i in range(k, k + rounds):
        ctes.append(f"""c{i} AS MATERIALIZED (
            SELECT c.id, coalesce(x, cx) AS cx, coalesce(y, cy) AS cy FROM c{i - 1} c LEFT JOIN (
                SELECT id, CAST(sum(CAST(gx AS BIGINT) * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS x,
                       CAST(sum(CAST(gy AS BIGINT) * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS y
                FROM (SELECT gx, gy, n, arg_min(id, {{'d': {square}, 'id': id}}) AS id
                      FROM positions, c{i - 1} GROUP BY gx, gy, n)
                GROUP BY id) m ON m.id = c.id)""")
    ctes.append(f"centres AS (SELECT * FROM c{k + rounds - 1})")
    ctes.append(f"""nearest AS MATERIALIZED (
        SELECT gx, gy, n, arg_min(id, {{'d': {square}, 'id': id}}) AS id
        FROM positions, centres GROUP BY gx, gy, n)""")
    return "WITH " + ", ".join(ctes)


HOTSPOTS = f"""
    {clustering()}
    SELECT CAST(c.id AS INTEGER) AS cluster_id, cx / 1e9 AS centroid_latitude,
           cy / 1e9 AS centroid_longitude, s.n AS crime_count
    FROM centres c LEFT JOIN (
        SELECT id, CAST(sum(n) AS BIGINT) AS n FROM nearest GROUP BY id) s ON s.id = c.id
"""
SHOWN_HOTSPOTS = f"""
    SELECT cluster_id, centroid_latitude AS lat, centroid_longitude AS lon, crime_count
    FROM ({HOTSPOTS})
"""
ORACLES["hotspots"] = HOTSPOTS
ORACLES["labelled_points"] = f"""
    {clustering()}
    SELECT vec_id AS id, label AS primary_type, label AS district,
           CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude,
           CAST(id AS INTEGER) AS cluster
    FROM points JOIN nearest USING (gx, gy)
"""
for name in ("v_hotspot_map", "v_cluster_stats"):
    ORACLES[name] = ORACLES[f"{name}_by_label"].replace(SPOTS, SHOWN_HOTSPOTS)
ORACLES["sliding_counts_stream_all"] = SLIDING
ORACLES["published_trends"] = BY_YEAR
ORACLES["v_alert_feed_stored"] = feed("WHERE severity = 'HIGH'", 100, alerts(GOOD))
ORACLES["csv_rejects"] = """
    SELECT 'sex_offenders' AS dataset, 'weight' AS column_name,
           CAST(floor(p_retailprice) AS INTEGER) || ' lb' AS value, count(*) AS n
    FROM part GROUP BY value
    UNION ALL SELECT 'violence', 'updated', strftime(o_orderdate, '%Y-%m-%d') AS day, count(*)
    FROM orders GROUP BY day
"""
ORACLES["window_snapshot_stream"] = f"""
    WITH ends AS (
        SELECT 0 AS batch_id, max(ts) AS newest FROM events WHERE day(ts) <= 10
        UNION ALL SELECT 1, max(ts) FROM events WHERE day(ts) <= 20
        UNION ALL SELECT 2, max(ts) FROM events
    )
    SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(user_id AS VARCHAR) AS routed_district,
           count(*) AS window_count
    FROM events, ends
    WHERE epoch_us(ts) > epoch_us(newest) - {WINDOW_US} AND ts <= newest GROUP BY ALL
"""
ORACLES["stage_counters"] = f"""
    SELECT (SELECT count(*) FROM events) AS messages_consumed,
           (SELECT count(*) FROM ({GOOD})) AS parsed,
           (SELECT count(*) FROM events WHERE event_type = 'error') AS malformed,
           (SELECT count(*) FROM events WHERE event_type = 'view') AS missing_fields,
           (SELECT count(*) FROM events WHERE event_type = 'signup') AS errors,
           count(*) AS routed, count(*) FILTER (routed_district = 'UNKNOWN') AS unknown_district,
           count(window_count) AS events_checked,
           count(*) FILTER (window_count >= {THRESHOLD}) AS anomalies_detected,
           count(*) FILTER (window_count >= {THRESHOLD}) AS alerts_written,
           CAST(0 AS BIGINT) AS sink_errors
    FROM ({counted(GOOD)})
"""
