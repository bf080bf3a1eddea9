"""The registered queries once more, as SQL over the given tables."""

from __future__ import annotations

# The same reading of the tables as in ``driver_tables``.
_CTE = {
    "ev": """
        SELECT 'osm-' || user_id AS intersection_id,
               make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 1440)
                   AS event_timestamp,
               CASE event_type WHEN 'click' THEN 'GREEN' WHEN 'error' THEN 'RED'
                    WHEN 'purchase' THEN 'YELLOW' WHEN 'signup' THEN 'FLASHING_YELLOW'
                    ELSE 'UNKNOWN' END AS signal_state,
               value AS avg_stop_duration_seconds,
               CAST(json_extract_string(props, '$.k') AS INT) / 2.0 AS avg_vehicle_speed_kmh,
               event_id AS seq, user_id AS number
        FROM events""",
    "win": """
        SELECT intersection_id, number,
               date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS window_end,
               first(signal_state ORDER BY event_timestamp DESC, seq) AS signal_state,
               avg(avg_stop_duration_seconds) AS avg_stop_duration_seconds,
               avg(CAST(avg_vehicle_speed_kmh AS DOUBLE)) AS avg_vehicle_speed_kmh,
               count(*) AS event_count
        FROM ev GROUP BY ALL""",
    "land": """
        SELECT *, window_end + to_seconds(5 + number % 7) AS ingested_at FROM win""",
    "inv": """
        SELECT 'osm-' || (s_suppkey * 2) AS intersection_id, s_name AS display_name,
               -27.13::DOUBLE + (s_suppkey * 37 % 1000) * 0.0001::DOUBLE AS latitude,
               -52.68::DOUBLE + (s_suppkey * 91 % 1000) * 0.0002::DOUBLE AS longitude,
               s_suppkey AS osm_node_id, 'osm' AS source
        FROM supplier""",
    "core": """
        SELECT land.intersection_id, display_name, window_end, signal_state,
               avg_stop_duration_seconds, avg_vehicle_speed_kmh, event_count, ingested_at,
               (avg_stop_duration_seconds > 75.0 AND avg_vehicle_speed_kmh < 5.0)
                   AS is_severe_bottleneck,
               latitude, longitude
        FROM land LEFT JOIN inv ON land.intersection_id = inv.intersection_id""",
    "latest": """
        SELECT * FROM core
        QUALIFY row_number() OVER (
            PARTITION BY intersection_id ORDER BY window_end DESC, ingested_at DESC) = 1""",
    "items": """
        SELECT inv.intersection_id,
               CASE WHEN l.intersection_id IS NULL THEN inv.display_name
                    ELSE l.display_name END AS display_name,
               coalesce(l.signal_state, 'UNKNOWN') AS signal_state,
               l.avg_stop_duration_seconds, l.avg_vehicle_speed_kmh,
               coalesce(l.is_severe_bottleneck, false) AS is_severe_bottleneck,
               coalesce(strftime(l.window_end, '%Y-%m-%dT%H:%M:%SZ'), '1970-01-01T00:00:00Z')
                   AS window_end,
               coalesce(l.latitude, inv.latitude) AS latitude,
               coalesce(l.longitude, inv.longitude) AS longitude
        FROM inv LEFT JOIN latest l ON inv.intersection_id = l.intersection_id""",
    "bad_land": """
        SELECT * REPLACE (
            CASE WHEN number % 50 = 1 AND minute(window_end) % 10 = 0 THEN NULL
                 WHEN number % 50 = 2 AND minute(window_end) % 10 = 0 THEN 'BLUE'
                 ELSE signal_state END AS signal_state)
        FROM land, generate_series(
            1, CASE WHEN number % 50 = 3 AND minute(window_end) % 10 = 0 THEN 2 ELSE 1 END)""",
    "bad_inv": """
        SELECT * REPLACE (
            CASE osm_node_id % 20 WHEN 1 THEN intersection_id || ' x' ELSE intersection_id END
                AS intersection_id,
            CASE osm_node_id % 20 WHEN 2 THEN NULL ELSE display_name END AS display_name,
            CASE osm_node_id % 20 WHEN 5 THEN 95.0::DOUBLE ELSE latitude END AS latitude,
            CASE osm_node_id % 20 WHEN 6 THEN -181.0::DOUBLE ELSE longitude END AS longitude,
            CASE osm_node_id % 20 WHEN 7 THEN 'survey' ELSE source END AS source)
        FROM inv, generate_series(1, CASE osm_node_id % 20 WHEN 4 THEN 2 ELSE 1 END)""",
    "raw": """
        SELECT seq, CASE seq % 100
                   WHEN 3 THEN 'missing_field' WHEN 13 THEN 'extra_key'
                   WHEN 23 THEN 'bad_event_id' WHEN 33 THEN 'bad_intersection_id'
                   WHEN 43 THEN 'bad_source' WHEN 53 THEN 'bad_state'
                   WHEN 63 THEN 'bad_speed' WHEN 73 THEN 'bad_stop_duration'
                   WHEN 83 THEN 'malformed' WHEN 93 THEN 'bad_timestamp' ELSE '' END AS reasons,
               intersection_id || CASE WHEN seq % 100 = 33 THEN ' x' ELSE '' END AS raw_id,
               '00000000-0000-4000-8000-' || lpad(lower(hex(seq)), 12, '0') AS event_id,
               strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS to_second,
               strftime(event_timestamp, '.%f') AS fraction,
               CASE WHEN seq % 100 = 53 THEN 'BLUE' ELSE signal_state END AS raw_state,
               CASE WHEN seq % 100 = 73 THEN '"' || avg_stop_duration_seconds || '"'
                    ELSE avg_stop_duration_seconds::VARCHAR END AS raw_stop,
               CASE WHEN seq % 100 = 63 THEN '-1'
                    ELSE avg_vehicle_speed_kmh::DOUBLE::VARCHAR END AS raw_speed
        FROM ev""",
    "doc": """
        SELECT seq, reasons, raw_id,
               '{"event_id":"' || CASE WHEN seq % 100 = 23 THEN 'not-a-uuid' ELSE event_id END
               || '","intersection_id":"' || raw_id || '","environment":{"timestamp":"'
               || CASE WHEN seq % 100 = 93 THEN '14:30' ELSE to_second || fraction || 'Z' END
               || '","source":"' || CASE WHEN seq % 100 = 43 THEN 'other' ELSE 'simulator' END
               || '"}' || CASE WHEN seq % 100 = 3 THEN '' ELSE
                   ',"telemetry":{"current_signal_state":"' || raw_state
                   || '","avg_stop_duration_seconds":' || raw_stop
                   || ',"avg_vehicle_speed_kmh":' || raw_speed || '}' END
               || CASE WHEN seq % 100 = 13 THEN ',"extra":1' ELSE '' END || '}' AS whole,
               CASE WHEN seq % 100 = 83 THEN whole[1:20] ELSE whole END AS sent,
               '{"event_id":"' || event_id || '","intersection_id":"' || raw_id
               || '","environment":{"timestamp":"' || to_second
               || CASE WHEN fraction = '.000000' THEN '' ELSE fraction END
               || 'Z","source":"simulator"},"telemetry":{"current_signal_state":"' || raw_state
               || '","avg_stop_duration_seconds":' || raw_stop
               || ',"avg_vehicle_speed_kmh":' || raw_speed || '}}' AS normalised,
               CASE WHEN reasons = 'malformed' THEN 'unknown' ELSE raw_id END AS key
        FROM raw""",
    "totals": """
        SELECT (SELECT max(window_end) FROM core) AS newest,
               (SELECT count(*) FROM items) AS listed,
               (SELECT count(*) FROM items WHERE window_end <> '1970-01-01T00:00:00Z')
                   AS reporting,
               (SELECT min(l.window_end) FROM latest l JOIN inv USING (intersection_id))
                   AS oldest_listed""",
}
_NEEDS = {
    "ev": [],
    "win": ["ev"],
    "land": ["win"],
    "inv": [],
    "core": ["land", "inv"],
    "latest": ["core"],
    "items": ["inv", "latest"],
    "bad_land": ["land"],
    "bad_inv": ["inv"],
    "raw": ["ev"],
    "doc": ["raw"],
    "totals": ["core", "latest", "items"],
}

_AVERAGES = """round(avg_stop_duration_seconds, 6) AS avg_stop_duration_seconds,
    round(avg_vehicle_speed_kmh, 6) AS avg_vehicle_speed_kmh"""
_PLACE = "round(latitude, 6) AS latitude, round(longitude, 6) AS longitude"
_LANDING = f"intersection_id, window_end, signal_state, {_AVERAGES}, event_count, ingested_at"
_WINDOW = f"intersection_id, window_end, signal_state, {_AVERAGES}, event_count"
_CORE = f"""intersection_id, display_name, window_end, signal_state, {_AVERAGES}, event_count,
    ingested_at, is_severe_bottleneck, {_PLACE},
    CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN round(longitude, 6) END
        AS point_longitude,
    CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN round(latitude, 6) END
        AS point_latitude"""
_LANDING_COLUMNS = (
    "intersection_id",
    "window_end",
    "signal_state",
    "avg_stop_duration_seconds",
    "avg_vehicle_speed_kmh",
    "event_count",
)
_INVENTORY_COLUMNS = ("intersection_id", "display_name", "latitude", "longitude")
_STATES = "('GREEN', 'RED', 'YELLOW', 'FLASHING_YELLOW', 'UNKNOWN')"
_LATE_LOAD = "TIMESTAMP '2024-01-01 00:30:05'"
_STATUS = f"""intersection_id, display_name, signal_state, {_AVERAGES}, is_severe_bottleneck,
    window_end, round(longitude, 6) AS location_longitude,
    round(latitude, 6) AS location_latitude"""
_STATUS_OF_LATEST = _STATUS.replace(
    "    window_end,", "    strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end,"
).replace(
    " is_severe_bottleneck,", " coalesce(is_severe_bottleneck, false) AS is_severe_bottleneck,"
)


def _with(*names: str, select: str) -> str:
    """``select`` behind the definitions it needs, each once and in order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(f"{name} AS ({_CTE[name]})" for name in wanted)
    return f"WITH {ctes} {select.strip()}"


def _daily(sql: str) -> str:
    """The same over the events as they are, without the squeeze into half an hour."""
    return sql.replace("// 1440", "// 1")


def _health(as_of: str, *, contract: bool = False) -> str:
    since = "oldest_listed" if contract else "newest"
    old = "STALE" if contract else "UNKNOWN"
    return _with(
        "totals",
        select=f"""
        SELECT CASE WHEN known AND lag <= 120 THEN 'ok' ELSE 'degraded' END AS status,
               CASE WHEN NOT known THEN 'UNKNOWN' WHEN lag <= 120 THEN 'FRESH'
                    ELSE '{old}' END AS freshness_status,
               CASE WHEN known THEN round(lag, 6) ELSE 0.0::DOUBLE END AS max_lag_seconds,
               listed AS intersection_count
        FROM (SELECT *, newest IS NOT NULL AND reporting > 0 AS known,
                     greatest(0.0::DOUBLE, (epoch_us(TIMESTAMP '{as_of}') - epoch_us({since}))
                         / 1e6::DOUBLE) AS lag
              FROM totals)""",
    )


_WINDOWS = _with("win", select=f"SELECT {_WINDOW} FROM win")
_LABELS = """
    SELECT intersection_id, coalesce(nullif(display_name, ''), intersection_id) AS title,
           CASE WHEN silent THEN 'Sem telemetria' ELSE
               CASE signal_state WHEN 'GREEN' THEN 'Verde' WHEN 'RED' THEN 'Vermelho'
                    WHEN 'YELLOW' THEN 'Amarelo' WHEN 'FLASHING_YELLOW' THEN 'Amarelo intermitente'
                    WHEN 'UNKNOWN' THEN 'Desconhecido' ELSE signal_state END END AS state_label,
           coalesce(floor(avg_stop_duration_seconds + 0.5)::BIGINT || 's parada', '—')
               AS stop_label,
           coalesce(floor(avg_vehicle_speed_kmh + 0.5)::BIGINT || ' km/h', '—') AS speed_label,
           CASE WHEN is_severe_bottleneck THEN 'Gargalo' END AS tag,
           CASE WHEN silent THEN 'Sem telemetria recente'
                WHEN is_severe_bottleneck THEN '⚠ Gargalo severo' END AS notice,
           CASE signal_state WHEN 'GREEN' THEN '#22c55e' WHEN 'RED' THEN '#ef4444'
                WHEN 'YELLOW' THEN '#eab308' WHEN 'FLASHING_YELLOW' THEN '#f97316'
                ELSE '#94a3b8' END AS fill_color,
           CASE WHEN is_severe_bottleneck THEN '#dc2626' ELSE '#ffffff' END AS stroke_color,
           CASE WHEN is_severe_bottleneck THEN 11 ELSE 8 END AS radius,
           CASE WHEN is_severe_bottleneck THEN 3 ELSE 2 END AS stroke_weight,
           0.95::DOUBLE AS fill_opacity,
           CASE WHEN is_severe_bottleneck THEN 'bottleneck-marker' ELSE 'signal-marker' END
               AS marker_class,
           concat(state_label, ' · ', stop_label, ' · ', speed_label) AS summary
    FROM (SELECT *, window_end = '1970-01-01T00:00:00Z' AS silent FROM items)"""


ORACLES: dict[str, str] = {
    "event_verdicts": _with("doc", select="SELECT seq, reasons FROM doc"),
    "event_valid": _with(
        "doc",
        select="SELECT 'traffic-events' AS topic, key, normalised AS value "
        "FROM doc WHERE reasons = ''",
    ),
    "event_dlq": _with(
        "doc",
        select="SELECT 'traffic-events-dlq' AS topic, key, sent AS value "
        "FROM doc WHERE reasons <> ''",
    ),
    "event_lines": _with(
        "doc",
        select="""SELECT CASE reasons WHEN '' THEN normalised
                   WHEN 'malformed' THEN '{"dlq":"' || replace(sent, '"', '\\"') || '"}'
                   ELSE '{"dlq":' || sent || '}' END AS value FROM doc""",
    ),
    "invalid_rate": _with(
        "doc",
        select="""SELECT count(*) AS event_count,
                   count(*) FILTER (reasons <> '') AS invalid_count,
                   round(avg((reasons <> '')::INT), 6) AS invalid_share,
                   avg((reasons <> '')::INT) <= 0.001 AS within_limit FROM doc""",
    ),
    "flatten_events": _with(
        "raw",
        select=f"""SELECT ev.intersection_id, event_timestamp, signal_state,
                   round(avg_stop_duration_seconds, 6) AS avg_stop_duration_seconds,
                   round(avg_vehicle_speed_kmh::DOUBLE, 6) AS avg_vehicle_speed_kmh,
                   event_id, ev.seq
                   FROM ev JOIN raw ON ev.seq = raw.seq WHERE reasons = ''""",
    ),
    "dedup_events": _WINDOWS,
    "window_aggregate": _WINDOWS,
    "last_state": _with(
        "win",
        select="""SELECT intersection_id, window_end - INTERVAL 1 MINUTE AS window_start,
                   window_end, signal_state FROM win""",
    ),
    "landing_rows": _with(
        "win", select=f"SELECT {_WINDOW}, {_LATE_LOAD} AS ingested_at FROM win"
    ),
    "landing_scan": _with(
        "land", select=f"SELECT {_LANDING} FROM land ORDER BY intersection_id, window_end"
    ),
    "landing_upsert": _with(
        "win",
        select=f"""SELECT {_WINDOW}, CASE WHEN window_end <= TIMESTAMP '2024-01-01 00:15:00'
                   THEN TIMESTAMP '2024-01-01 00:15:35' ELSE {_LATE_LOAD} END AS ingested_at
                   FROM win""",
    ),
    "landing_snapshot": _with(
        "win",
        select=f"""SELECT {_WINDOW}, CASE WHEN window_end <= TIMESTAMP '2024-01-01 00:15:00'
                   THEN TIMESTAMP '2024-01-01 00:15:35' ELSE {_LATE_LOAD} END AS ingested_at
                   FROM win""",
    ),
    "stream_window_aggregate": _with(
        "win", select=f"SELECT {_WINDOW}, {_LATE_LOAD} AS ingested_at FROM win"
    ),
    "log_reused_checkpoint": _with(
        "win", select=f"SELECT {_WINDOW}, {_LATE_LOAD} AS ingested_at FROM win"
    ),
    "stream_restarts": _with(
        "win", select=f"SELECT {_WINDOW}, {_LATE_LOAD} AS ingested_at FROM win"
    ),
    "stream_dedup": _with(
        "win", select=f"SELECT {_WINDOW}, {_LATE_LOAD} AS ingested_at FROM win"
    ),
    "stream_late": _with(
        "win", select=f"SELECT {_WINDOW}, {_LATE_LOAD} AS ingested_at FROM win"
    ),
    "stream_late_events": _with(
        "ev",
        select="""SELECT seq, intersection_id, event_timestamp, signal_state FROM ev
                   WHERE minute(event_timestamp) < 24""",
    ),
    "stream_latest": _with(
        "core",
        select=f"""SELECT * REPLACE ({_LATE_LOAD} AS ingested_at) FROM (
                   SELECT {_CORE} FROM core
                   QUALIFY row_number() OVER (
                       PARTITION BY intersection_id ORDER BY window_end DESC) = 1)""",
    ),
    "stream_core": _with(
        "core",
        select=f"SELECT * REPLACE ({_LATE_LOAD} AS ingested_at) FROM (SELECT {_CORE} FROM core)",
    ),
    "stream_core_versions": _with(
        "core",
        select=f"""SELECT * EXCLUDE (later, gone) REPLACE (
                       {_LATE_LOAD} AS ingested_at,
                       CASE WHEN NOT later THEN display_name
                            WHEN NOT gone THEN 'new ' || display_name END AS display_name,
                       {", ".join(
                           f"CASE WHEN NOT (later AND gone) THEN {c} END AS {c}"
                           for c in ("latitude", "longitude", "point_latitude", "point_longitude")
                       )})
                   FROM (SELECT {_CORE}, minute(window_end - INTERVAL 1 MINUTE) >= 16 AS later,
                                CAST(substr(intersection_id, 5) AS INT) // 2 % 3 = 0 AS gone
                         FROM core)""",
    ),
    "stream_routing": _with(
        "doc",
        select="""SELECT CASE reasons WHEN '' THEN 'traffic-events'
                   ELSE 'traffic-events-dlq' END AS topic, key,
                   CASE reasons WHEN '' THEN normalised ELSE sent END AS value FROM doc""",
    ),
    "ties_from_text": _with(
        "win",
        select=f"SELECT * REPLACE (3 * event_count AS event_count) FROM (SELECT {_WINDOW} FROM win)",
    ),
    "staging": _with("land", select=f"SELECT {_LANDING} FROM land"),
    "core": _with("core", select=f"SELECT {_CORE} FROM core"),
    "core_points": _with(
        "core",
        select="""SELECT intersection_id, window_end, round(longitude, 6) AS point_longitude,
                   round(latitude, 6) AS point_latitude FROM core""",
    ),
    "core_inner": _with(
        "core",
        select=f"SELECT {_CORE} FROM core WHERE display_name IS NOT NULL",
    ),
    "core_merge": _with("core", select=f"SELECT {_CORE} FROM core"),
    "core_rebuild_then_merge": _with("core", select=f"SELECT {_CORE} FROM core"),
    "core_merge_late": _daily(_with("core", select=f"SELECT {_CORE} FROM core")),
    "landing_corrected": _with("land", select=f"SELECT {_LANDING} FROM land"),
    "log_two_runs": _with("land", select=f"SELECT {_LANDING} FROM land"),
    "dedup_null_ids": _WINDOWS,
    "inventory_csv": _with(
        "inv",
        select=f"SELECT intersection_id, display_name, {_PLACE}, osm_node_id, source FROM inv",
    ),
    "severe_bottlenecks": _with(
        "core",
        select=f"SELECT intersection_id, window_end, {_AVERAGES} FROM core "
        "WHERE is_severe_bottleneck",
    ),
    "orphan_report": _with(
        "land",
        "inv",
        select="""SELECT land.intersection_id, count(*) AS orphan_row_count,
                   min(window_end) AS first_seen_window, max(window_end) AS last_seen_window
                   FROM land LEFT JOIN inv ON land.intersection_id = inv.intersection_id
                   WHERE inv.intersection_id IS NULL GROUP BY land.intersection_id""",
    ),
    "core_counts": _with(
        "core",
        select="""SELECT count(*) AS core_rows, max(window_end) AS newest_window,
                   count(*) FILTER (is_severe_bottleneck) AS severe_rows,
                   count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS rows_without_place
                   FROM core""",
    ),
    "latest_status": _with("latest", select=f"SELECT {_CORE} FROM latest"),
    "latest_advanced": _with("latest", select=f"SELECT {_CORE} FROM latest"),
    "status_rows": _with("latest", select=f"SELECT {_STATUS_OF_LATEST} FROM latest"),
    "status_list": _with("items", select=f"SELECT {_STATUS} FROM items"),
    "status_list_orphans": _with(
        "items",
        select=f"""SELECT {_STATUS} FROM items UNION ALL
                   SELECT {_STATUS_OF_LATEST} FROM latest
                   WHERE intersection_id NOT IN (SELECT intersection_id FROM inv)""",
    ),
    "status_list_plain": _with("latest", select=f"SELECT {_STATUS_OF_LATEST} FROM latest"),
    "status_bottlenecks": _with(
        "items",
        select=f"""SELECT * FROM (SELECT {_STATUS} FROM (SELECT * REPLACE (
                   coalesce(avg_stop_duration_seconds > 20.0 AND avg_vehicle_speed_kmh < 30.0,
                            false) AS is_severe_bottleneck) FROM items))
                   WHERE is_severe_bottleneck""",
    ),
    "status_by_id": _with(
        "items",
        select=f"""SELECT asked.intersection_id, s.* EXCLUDE (intersection_id),
                   CASE WHEN s.intersection_id IS NULL THEN 'NOT_FOUND' END AS code,
                   CASE WHEN s.intersection_id IS NULL
                        THEN 'Unknown intersection: ' || asked.intersection_id END AS message
                   FROM (SELECT 'osm-' || c_custkey AS intersection_id FROM customer) asked
                   LEFT JOIN (SELECT {_STATUS} FROM items) s
                   ON asked.intersection_id = s.intersection_id""",
    ),
    "status_of_one": _with(
        "items", select=f"SELECT {_STATUS} FROM items WHERE intersection_id = 'osm-4'"
    ),
    "list_counts": _with(
        "items",
        select="""SELECT count(*) AS listed,
                   count(*) FILTER (window_end <> '1970-01-01T00:00:00Z') AS reporting,
                   count(*) FILTER (is_severe_bottleneck) AS bottlenecks FROM items""",
    ),
    "popup_measures": _with(
        "items",
        select="""SELECT intersection_id,
                   coalesce(printf('%.1f', round(avg_stop_duration_seconds, 1)), '—') AS popup_stop,
                   coalesce(printf('%.1f', round(avg_vehicle_speed_kmh, 1)), '—') AS popup_speed
                   FROM items""",
    ),
    "status_json": _with(
        "items",
        select="""SELECT intersection_id,
                   '[intersection_id, display_name, signal_state, '
                   || CASE WHEN avg_stop_duration_seconds IS NULL THEN ''
                      ELSE 'avg_stop_duration_seconds, avg_vehicle_speed_kmh, ' END
                   || 'is_severe_bottleneck, window_end, location]' AS fields,
                   signal_state, window_end, round(latitude, 6) AS latitude FROM items""",
    ),
    "status_labels": _with("items", select=_LABELS),
    "extent": _with(
        "items",
        select="""SELECT round(min(latitude), 6) AS south, round(min(longitude), 6) AS west,
                   round(max(latitude), 6) AS north, round(max(longitude), 6) AS east,
                   count(latitude) AS placed_items FROM items""",
    ),
    "landing_lag": _with(
        "land",
        select="""SELECT max(window_end) AS newest_window,
                   greatest(0.0::DOUBLE, (epoch_us(TIMESTAMP '2024-01-01 00:31:00')
                       - epoch_us(max(window_end))) / 1e6::DOUBLE) AS max_landing_lag_seconds
                   FROM land""",
    ),
    "health": _health("2024-01-01 00:31:00"),
    "health_stale": _health("2024-01-01 00:40:00"),
    "health_contract": _health("2024-01-01 00:40:00", contract=True),
    "health_labels": _with(
        "totals",
        select="""SELECT freshness_status, listed AS intersection_count,
                   CASE freshness_status WHEN 'FRESH' THEN 'Dados atualizados'
                        ELSE 'Sem dados' END AS freshness_label,
                   CASE freshness_status WHEN 'FRESH'
                        THEN 'Atraso máximo: ' || lag || 's' END AS lag_title,
                   'health-' || lower(freshness_status) AS badge_class,
                   listed || CASE listed WHEN 1 THEN ' cruzamento' ELSE ' cruzamentos' END
                       AS count_label
                   FROM (SELECT listed, lag, CASE WHEN reporting > 0 AND lag <= 120
                             THEN 'FRESH' ELSE 'UNKNOWN' END AS freshness_status
                         FROM (SELECT *, greatest(0, date_diff('second', newest,
                                   TIMESTAMP '2024-01-01 00:31:00')) AS lag FROM totals))""",
    ),
    "snapshot_diff": _with(
        "land",
        select="""
        , old AS (SELECT intersection_id, signal_state, window_end
                  FROM (SELECT * FROM land WHERE window_end <= TIMESTAMP '2024-01-01 00:15:00'
                        QUALIFY row_number() OVER (
                            PARTITION BY intersection_id ORDER BY window_end DESC) = 1)
                  WHERE avg_stop_duration_seconds > 20.0 AND avg_vehicle_speed_kmh < 30.0),
          new AS (SELECT intersection_id, signal_state, window_end
                  FROM (SELECT * FROM land
                        QUALIFY row_number() OVER (
                            PARTITION BY intersection_id ORDER BY window_end DESC) = 1)
                  WHERE avg_stop_duration_seconds > 20.0 AND avg_vehicle_speed_kmh < 30.0)
        SELECT coalesce(new.intersection_id, old.intersection_id) AS intersection_id,
               CASE WHEN old.intersection_id IS NULL THEN 'added'
                    WHEN new.intersection_id IS NULL THEN 'removed'
                    WHEN old.signal_state IS NOT DISTINCT FROM new.signal_state
                     AND old.window_end IS NOT DISTINCT FROM new.window_end THEN 'unchanged'
                    ELSE 'changed' END AS change,
               old.signal_state AS old_signal_state, old.window_end AS old_window_end,
               new.signal_state AS new_signal_state, new.window_end AS new_window_end
        FROM old FULL JOIN new ON old.intersection_id = new.intersection_id""",
    ),
    "inventory_from_extract": """
        SELECT 'osm-' || s_suppkey AS intersection_id,
               CASE s_suppkey % 6 WHEN 0 THEN s_name WHEN 1 THEN 'pt ' || s_name
                    WHEN 2 THEN 'R' || s_suppkey WHEN 3 THEN 'C' || s_suppkey
                    WHEN 4 THEN 'Semáforo ' || s_suppkey || ' (forward)'
                    ELSE 'Semáforo ' || s_suppkey END AS display_name,
               round(-27.0::DOUBLE - s_suppkey % 1000 / 30000.0::DOUBLE, 6) AS latitude,
               round(-52.0::DOUBLE - s_suppkey % 1000 / 7000.0::DOUBLE, 6) AS longitude,
               s_suppkey AS osm_node_id, 'osm' AS source
        FROM supplier WHERE s_nationkey <> 3 AND s_suppkey % 7 < 5
          AND -27.0::DOUBLE - s_suppkey % 1000 / 30000.0::DOUBLE BETWEEN -27.12::DOUBLE AND -27.0::DOUBLE
          AND -52.0::DOUBLE - s_suppkey % 1000 / 7000.0::DOUBLE BETWEEN -52.1::DOUBLE AND -52.0::DOUBLE""",
    "inventory_in_bbox": _with(
        "inv",
        select=f"""SELECT intersection_id, display_name, {_PLACE}, osm_node_id, source FROM inv
                   WHERE latitude BETWEEN -27.12::DOUBLE AND -27.06::DOUBLE
                     AND longitude BETWEEN -52.67::DOUBLE AND -52.56::DOUBLE""",
    ),
    "inventory_violations": _with(
        "bad_inv",
        select="""SELECT intersection_id, osm_node_id,
                   CASE osm_node_id % 20 WHEN 1 THEN 'bad_intersection_id'
                        WHEN 2 THEN 'missing_field' WHEN 5 THEN 'bad_latitude'
                        WHEN 6 THEN 'bad_longitude' WHEN 7 THEN 'bad_source' END AS reasons
                   FROM bad_inv WHERE osm_node_id % 20 IN (1, 2, 5, 6, 7)""",
    ),
    "dq_not_null": _with(
        "bad_land",
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_count "
            "FROM bad_land"
            for name in _LANDING_COLUMNS
        ),
    ),
    "dq_report": _with(
        "bad_land",
        "bad_inv",
        select=" UNION ALL ".join(
            [
                f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{column}' "
                f"AS column_name, count(*) FILTER ({column} IS NULL) AS failures FROM {source}"
                for table, source, columns in (
                    ("landing", "bad_land", _LANDING_COLUMNS),
                    ("staging", "bad_land", _LANDING_COLUMNS[:3]),
                    ("inventory", "bad_inv", _INVENTORY_COLUMNS),
                )
                for column in columns
            ]
            + [
                f"SELECT '{table}', 'accepted_values', '{column}', count(*) "
                f"FILTER ({column} NOT IN {values}) FROM {source}"
                for table, source, column, values in (
                    ("landing", "bad_land", "signal_state", _STATES),
                    ("staging", "bad_land", "signal_state", _STATES),
                    ("inventory", "bad_inv", "source", "('osm', 'manual_fallback')"),
                )
            ]
            + [
                f"SELECT '{table}', 'unique', '{keys}', count(*) FROM (SELECT 1 FROM {source} "
                f"GROUP BY {keys} HAVING count(*) > 1)"
                for table, source, keys in (
                    ("landing", "bad_land", "intersection_id,window_end"),
                    ("inventory", "bad_inv", "intersection_id"),
                )
            ]
            + [
                """SELECT 'core', 'not_null', 'is_severe_bottleneck', count(*) FILTER (
                       (avg_stop_duration_seconds > 75.0 AND avg_vehicle_speed_kmh < 5.0) IS NULL)
                   FROM bad_land LEFT JOIN bad_inv USING (intersection_id)"""
            ]
        ),
    ),
    "dq_null_rows": _with(
        "bad_inv",
        select="""SELECT intersection_id, osm_node_id, 'display_name' AS null_columns
                   FROM bad_inv WHERE display_name IS NULL""",
    ),
    "dq_accepted_values": _with(
        "bad_land",
        "bad_inv",
        select="""SELECT 'signal_state' AS column_name, signal_state AS value,
                   count(*) AS row_count FROM bad_land WHERE signal_state NOT IN
                   ('GREEN', 'RED', 'YELLOW', 'FLASHING_YELLOW', 'UNKNOWN') GROUP BY ALL
                   UNION ALL
                   SELECT 'source', source, count(*) FROM bad_inv
                   WHERE source NOT IN ('osm', 'manual_fallback') GROUP BY ALL""",
    ),
    "dq_unique_grain": _with(
        "bad_land",
        select="""SELECT intersection_id, window_end, count(*) AS copies FROM bad_land
                   GROUP BY ALL HAVING count(*) > 1""",
    ),
    "dq_unique_inventory": _with(
        "bad_inv",
        select="""SELECT intersection_id, count(*) AS copies FROM bad_inv
                   GROUP BY ALL HAVING count(*) > 1""",
    ),
    "dq_freshness": _with(
        "land",
        select="""SELECT newest_load, age AS age_seconds,
                   CASE WHEN age IS NULL OR age > 600 THEN 'error' WHEN age > 180 THEN 'warn'
                        ELSE 'pass' END AS verdict
                   FROM (SELECT max(ingested_at) AS newest_load,
                         greatest(0.0::DOUBLE, (epoch_us(TIMESTAMP '2024-01-01 00:34:11')
                             - epoch_us(max(ingested_at))) / 1e6::DOUBLE) AS age
                         FROM land WHERE window_end >= TIMESTAMP '2023-12-31 00:34:11')""",
    ),
    "dq_outside_bbox": _with(
        "inv",
        select=f"""SELECT intersection_id, display_name, {_PLACE}, osm_node_id, source FROM inv
                   WHERE NOT (latitude BETWEEN -27.12::DOUBLE AND -27.06::DOUBLE
                          AND longitude BETWEEN -52.67::DOUBLE AND -52.56::DOUBLE)""",
    ),
    "dq_point_roundtrip": _with(
        "core",
        "bad_inv",
        select="""SELECT c.intersection_id, count(*) FILTER (c.latitude IS NULL) AS missing,
                   round(max(greatest(abs(c.latitude - b.latitude),
                                      abs(c.longitude - b.longitude))), 6) AS point_error
                   FROM core c JOIN bad_inv b ON c.intersection_id = b.intersection_id
                   GROUP BY c.intersection_id, b.osm_node_id
                   HAVING point_error > 1e-6 OR missing > 0""",
    ),
    "silent_ids": _with(
        "ev",
        "inv",
        select="""SELECT intersection_id FROM inv
                   WHERE intersection_id NOT IN (SELECT intersection_id FROM ev)""",
    ),
    "rate_gaps": _with(
        "ev",
        select="""SELECT intersection_id, before AS gap_start, event_timestamp AS gap_end,
                   round((epoch_us(event_timestamp) - epoch_us(before)) / 1e6::DOUBLE, 6)
                       AS gap_seconds
                   FROM (SELECT intersection_id, event_timestamp, lag(event_timestamp) OVER (
                             PARTITION BY intersection_id ORDER BY event_timestamp) AS before
                         FROM ev)
                   WHERE event_timestamp - before > INTERVAL 10 SECONDS""",
    ),
    "lag_p95": _with(
        "land",
        select="""SELECT count(*) AS row_count, round(quantile_cont(lag, 0.95), 6) AS p95_seconds,
                   quantile_cont(lag, 0.95) <= 180 AS within_limit
                   FROM (SELECT (epoch_us(ingested_at) + number % 1000 * 1001
                                 - epoch_us(window_end)) / 1e6::DOUBLE AS lag FROM land)""",
    ),
    "event_lag_p95": _with(
        "land",
        select="""SELECT count(*) AS row_count, round(quantile_cont(lag, 0.95), 6) AS p95_seconds,
                   quantile_cont(lag, 0.95) <= 120 AS within_limit
                   FROM (SELECT (epoch_us(ingested_at) - epoch_us(event_timestamp)) / 1e6::DOUBLE
                                AS lag
                         FROM ev JOIN land ON ev.intersection_id = land.intersection_id
                          AND date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE
                              = land.window_end)""",
    ),
}
