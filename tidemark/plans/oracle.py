"""DuckDB oracle SQL, one statement per ``catalog.QUERIES`` key.

Plain ANSI-style SQL over the driver's pre-registered views. The derived views
(``cart``, ``catalog``, ``server_events``, ``thresholds``, arrival order) are CTEs
with the same definitions as ``tidemark.sources.views``. Buckets use
``make_timestamp(epoch_us arithmetic)`` so results stay plain TIMESTAMP whatever
the DuckDB session time zone is.
"""

from __future__ import annotations

H = 3_600_000_000

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

CART = f"""cart AS (
  SELECT event_id,
         CASE WHEN event_type = 'purchase' THEN 'AddToShoppingCartEvent'
              ELSE 'RemovedFromShoppingCartEvent' END AS event_type,
         user_id,
         'sku_' || CAST({K} // 10 AS VARCHAR) AS sku,
         {K} % 10 AS quantity,
         ts AS time
  FROM events WHERE event_type IN ('purchase', 'error'))"""

ADDS = "adds AS (SELECT * FROM cart WHERE event_type = 'AddToShoppingCartEvent')"

CATALOG = f"""catalog AS (
  SELECT event_id, 'ProductDetailsViewed' AS event_type, user_id,
         CAST({K} AS VARCHAR) AS product_id, ts AS time
  FROM events WHERE event_type = 'view')"""

SERVER = """server_events AS (
  SELECT event_id,
         CASE WHEN event_type = 'signup' THEN 'PlayerRegistered'
              WHEN event_type = 'click' THEN 'PlayerOnline'
              ELSE event_type END AS event_type,
         user_id AS player_id, ts
  FROM events)"""

HASH8 = "CAST(('0x' || substr(md5(coalesce(CAST(user_id AS VARCHAR), '')), 1, 8))::BIGINT % 8 AS INTEGER)"

EDGE = """l AS (
  SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id % 7 END AS grp, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts FROM events),
control AS (
  SELECT CASE WHEN event_id % 13 <> 0 THEN user_id % 7 END AS grp, CASE WHEN event_id % 29 <> 0 THEN date_trunc('day', ts)::TIMESTAMP END AS eff,
         event_id % 50 AS threshold, event_id AS control_id
  FROM events WHERE event_type = 'signup')"""

# Thresholds 2,0,4,5,6,3 effective every 5 days from 2024-01-06.
THRESHOLDS = """thresholds AS (
  SELECT * FROM (VALUES (2, TIMESTAMP '2024-01-06 00:00:00'), (0, TIMESTAMP '2024-01-11 00:00:00'),
                        (4, TIMESTAMP '2024-01-16 00:00:00'), (5, TIMESTAMP '2024-01-21 00:00:00'),
                        (6, TIMESTAMP '2024-01-26 00:00:00'), (3, TIMESTAMP '2024-01-31 00:00:00'))
         AS t(threshold, effective_ts))"""


def bucket(ts: str, width: int, plus: int = 0) -> str:
    return f"make_timestamp((epoch_us({ts}) // {width}) * {width} + {plus})"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f')"


def _sessions(keys: list[str], gap: int) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    kcols = "".join(f"{k}, " for k in keys)
    group = ", ".join([*keys, "sid"])
    return f"""
WITH s AS (
  SELECT {kcols}ts, event_type,
         CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {gap}
              THEN 1 ELSE 0 END AS st,
         event_id
  FROM events
  WINDOW w AS ({part}ORDER BY ts, event_id)),
g AS (
  SELECT *, sum(st) OVER ({part}ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s)
SELECT {kcols}min(ts) AS session_start,
       make_timestamp(epoch_us(max(ts)) + {gap}) AS session_end,
       count(*) AS events,
       count(*) FILTER (WHERE event_type = 'signup') AS registrations
FROM g GROUP BY {group}"""


def _count_trigger(purging: bool) -> str:
    size = "CAST(5 AS BIGINT)" if purging else "rn"
    return f"""
WITH {CART},
w AS (
  SELECT {bucket('time', 24 * H)} AS window_start, {bucket('time', 24 * H, 24 * H)} AS window_end,
         row_number() OVER (PARTITION BY epoch_us(time) // {24 * H} ORDER BY time, event_id) AS rn
  FROM cart)
SELECT window_start, window_end, CAST(rn // 5 AS BIGINT) AS firing, {size} AS pane_size
FROM w WHERE rn % 5 = 0"""


def _interval(inclusive: bool) -> str:
    lo, hi = (">=", "<=") if inclusive else (">", "<")
    return f"""
WITH {CART}, {ADDS}, {CATALOG}
SELECT a.user_id, a.event_id AS cart_event_id, c.event_id AS catalog_event_id,
       a.time AS cart_time, c.time AS catalog_time
FROM adds a JOIN catalog c ON a.user_id = c.user_id
 AND epoch_us(c.time) - epoch_us(a.time) {lo} {-2 * H}
 AND epoch_us(c.time) - epoch_us(a.time) {hi} {2 * H}"""


def _recent_list_ttl(rows: str, key: str, ttl: int, period: int, shown: str) -> str:
    """Lists of ``rows`` (event_id, key, moment): a row an hour (``ttl``) or more after the one before begins a new list, and so does every ``period``-th."""
    return f"""
n AS (SELECT *, row_number() OVER w AS rn, epoch_us(moment) - epoch_us(lag(moment) OVER w) AS idle FROM {rows}
      WINDOW w AS (PARTITION BY {key} ORDER BY moment NULLS FIRST, event_id)),
b AS (SELECT *, max(CASE WHEN rn = 1 OR idle >= {ttl} THEN rn END) OVER (PARTITION BY {key} ORDER BY rn ROWS UNBOUNDED PRECEDING) AS life FROM n),
g AS (SELECT *, list(CAST(event_id AS VARCHAR)) OVER (PARTITION BY {key}, life, (rn - life) // {period} ORDER BY rn ROWS UNBOUNDED PRECEDING) AS lst FROM b)
SELECT event_id, {shown}, CAST(len(lst) AS INTEGER) AS list_size, array_to_string(lst, ', ') AS items FROM g"""


_ARRIVAL = "event_id // 20, (event_id * 7) % 20, event_id"

_LATE = f"""
WITH a AS (
  SELECT event_id, ts, row_number() OVER (ORDER BY {_ARRIVAL}) AS arrival_seq FROM events),
m AS (
  SELECT event_id, ts,
         (epoch_us(ts) // 1800000000) * 1800000000 AS wstart,
         max(epoch_us(ts)) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - {H} AS wm
  FROM a)"""

_SQL = {
    "tumbling_type_counts": f"""
SELECT {bucket('ts', 3 * H)} AS window_start, {bucket('ts', 3 * H, 3 * H)} AS window_end,
       count(*) FILTER (WHERE event_type = 'signup') AS registrations, count(*) AS events
FROM events GROUP BY 1, 2""",

    "tumbling_by_type": f"""
WITH {SERVER}
SELECT event_type, {bucket('ts', 3 * H)} AS window_start, {bucket('ts', 3 * H, 3 * H)} AS window_end,
       count(*) AS n
FROM server_events GROUP BY 1, 2, 3""",

    "sliding_counts": f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {3 * H}) AS window_end,
       count(*) FILTER (WHERE event_type = 'signup') AS registrations, count(*) AS events
FROM (SELECT (epoch_us(ts) // {H} - o) * {H} AS s, event_type
      FROM events CROSS JOIN range(3) AS r(o)) GROUP BY s""",

    "window_value_stats": f"""
SELECT {bucket('ts', 3 * H)} AS window_start, {bucket('ts', 3 * H, 3 * H)} AS window_end,
       count(*) AS n, round(sum(value), 6) AS total_value, round(sum(value) / count(*), 6) AS mean_value
FROM events GROUP BY 1, 2""",

    "registration_windows": f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {2 * H}) AS window_end,
       count(*) AS registrations
FROM (SELECT (epoch_us(ts) // {H} - o) * {H} AS s
      FROM events CROSS JOIN range(2) AS r(o) WHERE event_type = 'signup') GROUP BY s""",

    "busiest_window": f"""
SELECT make_timestamp(s) AS window_start, make_timestamp(s + {2 * H}) AS window_end,
       count(*) AS registrations
FROM (SELECT (epoch_us(ts) // {H} - o) * {H} AS s
      FROM events CROSS JOIN range(2) AS r(o) WHERE event_type = 'signup') GROUP BY s
ORDER BY registrations DESC, window_start ASC LIMIT 1""",

    "session_by_user": _sessions(["user_id"], H),
    "session_all": _sessions([], 5 * 60 * 1_000_000),

    "global_every_10": """
SELECT seen, registrations FROM (
  SELECT row_number() OVER w AS seen,
         CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS registrations
  FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE seen % 10 = 0""",

    "count_trigger": _count_trigger(False),
    "count_trigger_purging": _count_trigger(True),

    "rolling_reduce": """
SELECT event_id, event_id % 2 = 0 AS is_even,
       CAST(sum(event_id) OVER (PARTITION BY event_id % 2 = 0 ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS running_sum
FROM events""",

    "reduce_final": """
SELECT event_id % 2 = 0 AS is_even, CAST(sum(event_id) AS VARCHAR) AS total FROM events GROUP BY 1""",

    "running_count_by_user": f"""
WITH {CART}
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY time, event_id) AS n FROM cart""",

    "running_type_map": """
WITH t AS (SELECT DISTINCT event_type AS ty FROM events WHERE event_type IS NOT NULL),
c AS (
  SELECT event_id, user_id, ty,
         sum(CASE WHEN event_type = ty THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, ty ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
  FROM events CROSS JOIN t)
SELECT event_id, user_id, string_agg(ty || '=' || CAST(n AS VARCHAR), ', ' ORDER BY ty) FILTER (WHERE n > 0) AS counts
FROM c GROUP BY event_id, user_id""",

    "recent_list_by_user": f"""
WITH {CART},
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time, event_id) AS rn FROM cart),
l AS (
  SELECT event_id, user_id,
         list(CAST(event_id AS VARCHAR)) OVER (PARTITION BY user_id, (rn - 1) // 11 ORDER BY rn
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lst
  FROM n)
SELECT event_id, user_id, CAST(len(lst) AS INTEGER) AS list_size, array_to_string(lst, ', ') AS items FROM l""",

    "recent_list_ttl": f"WITH {CART}, c AS (SELECT event_id, user_id, time AS moment FROM cart), {_recent_list_ttl('c', 'user_id', H, 11, 'user_id')}",
    "recent_list_ttl_edge_cases": f"""WITH {EDGE}, c AS (SELECT event_id, grp, ts AS moment FROM l),
{_recent_list_ttl('c', 'grp', H // 6, 3, 'coalesce(grp, -1)::BIGINT AS grp')}""",

    "high_quantity_counter": f"""
WITH {CART}
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY time, event_id) AS n
FROM cart WHERE event_type = 'AddToShoppingCartEvent' AND quantity > 5""",

    "fizzbuzz": "SELECT event_id + 1 AS n FROM events WHERE (event_id + 1) % 15 = 0",

    "fizzbuzz_labels": """
SELECT event_id + 1 AS n,
       CASE WHEN (event_id + 1) % 15 = 0 THEN 'fizzbuzz' WHEN (event_id + 1) % 3 = 0 THEN 'fizz'
            WHEN (event_id + 1) % 5 = 0 THEN 'buzz' ELSE CAST(event_id + 1 AS VARCHAR) END AS output
FROM events""",

    "map_filter": "SELECT event_id AS n, event_id * 2 AS doubled FROM events WHERE event_id % 2 = 0",

    "fan_out_pair": """
SELECT event_id, event_id % 20 AS m FROM events
UNION ALL SELECT event_id, event_id % 20 + 1 AS m FROM events""",

    "fan_out_range": """
SELECT event_id, CAST(r.m AS BIGINT) AS m FROM events CROSS JOIN LATERAL range(1, event_id % 20) AS r(m)""",

    "explode_quantity": f"""
WITH {CART}, {ADDS}
SELECT event_id, user_id, sku, CAST(u.unit AS INTEGER) AS unit
FROM adds CROSS JOIN LATERAL range(1, quantity + 1) AS u(unit)""",

    "threshold_alerts": f"""
WITH {CART}, {ADDS}
SELECT event_id, user_id, quantity,
       'User ' || CAST(user_id AS VARCHAR) || ' attempting to purchase ' || CAST(quantity AS VARCHAR)
       || ' items of ' || sku || ' when threshold is 2' AS message
FROM adds WHERE quantity > 2""",

    "side_output_main": f"WITH {CART} SELECT * FROM cart WHERE NOT coalesce(user_id = 1, false)",
    "side_output_side": f"WITH {CART} SELECT * FROM cart WHERE user_id = 1",

    "person_codec_roundtrip": """
SELECT c_custkey, c_name || ',' || CAST(c_nationkey AS VARCHAR) AS wire,
       split_part(c_name || ',' || CAST(c_nationkey AS VARCHAR), ',', 1) AS name,
       CAST(split_part(c_name || ',' || CAST(c_nationkey AS VARCHAR), ',', 2) AS INTEGER) AS age
FROM customer""",

    "rich_map": "SELECT event_id AS n, event_id * 10 AS n10 FROM events",

    "event_entities": """
SELECT event_id, concat_ws('|', 'player', CAST(user_id AS VARCHAR), event_type) AS entity, epoch_us(ts) // 1000 AS millis FROM events""",

    "text_sink_roundtrip": f"""
WITH {CART}
SELECT CASE WHEN event_type = 'AddToShoppingCartEvent' THEN 'Add(' ELSE 'Remove(' END || coalesce(CAST(event_id AS VARCHAR), 'null') || ','
       || coalesce(CAST(user_id AS VARCHAR), 'null') || ',' || coalesce(CAST(quantity AS VARCHAR), 'null') || ')' AS line FROM cart""",

    "person_codec_quarantine": """
WITH w AS (
  SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN c_name WHEN c_custkey % 7 = 0 THEN c_name || ',x' || CAST(c_nationkey AS VARCHAR)
                         WHEN c_custkey % 5 = 0 THEN c_name || ',Jr,' || CAST(c_nationkey AS VARCHAR) WHEN c_custkey % 13 = 0 THEN NULL
                         ELSE c_name || ',' || CAST(c_nationkey AS VARCHAR) END AS value FROM customer),
p AS (SELECT c_custkey, value, split_part(value, ',', 1) AS name, TRY_CAST(nullif(split_part(value, ',', 2), '') AS INTEGER) AS age FROM w)
SELECT c_custkey, CASE WHEN age IS NOT NULL THEN name END AS name, CAST(age AS VARCHAR) AS age, CASE WHEN age IS NULL THEN value END AS corrupt FROM p""",

    "partition_skew": f"""
WITH {CART},
p AS (SELECT 'hash' AS partitioner, {HASH8} AS partition FROM cart UNION ALL SELECT 'last', 7 FROM cart),
c AS (SELECT partitioner, partition, count(*) AS rows FROM p GROUP BY 1, 2)
SELECT partitioner, partition, rows, round(rows / sum(rows) OVER w, 6) AS share, round(max(rows) OVER w / (sum(rows) OVER w / 8.0), 6) AS skew
FROM c WINDOW w AS (PARTITION BY partitioner)""",

    "partition_placement": f"WITH {CART} SELECT {HASH8} AS partition, count(*) AS rows FROM cart GROUP BY 1",

    "asof_edge_cases": f"""
WITH {EDGE},
c AS (SELECT grp, eff, arg_max(threshold, control_id) AS threshold FROM control WHERE eff IS NOT NULL GROUP BY 1, 2),
u AS (SELECT grp, ts AS moment, 1 AS side, event_id, NULL::BIGINT AS threshold FROM l UNION ALL SELECT grp, eff, 0, NULL, threshold FROM c),
f AS (SELECT *, last_value(threshold IGNORE NULLS) OVER (PARTITION BY grp ORDER BY moment NULLS FIRST, side
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS found FROM u)
SELECT event_id, coalesce(grp, -1)::BIGINT AS grp, coalesce(found, -1)::BIGINT AS threshold FROM f WHERE side = 1""",

    "running_count_edge_cases": f"""
WITH {EDGE}
SELECT event_id, coalesce(grp, -1)::BIGINT AS grp, row_number() OVER (PARTITION BY grp ORDER BY ts NULLS FIRST, event_id) AS n FROM l""",

    "session_edge_cases": f"""
WITH {EDGE},
s AS (SELECT *, CASE WHEN ts IS NULL THEN -1 ELSE sum(new) OVER (PARTITION BY grp ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) END AS sid
      FROM (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY grp ORDER BY ts NULLS FIRST, event_id) > 600000000 THEN 1 ELSE 0 END AS new FROM l))
SELECT coalesce(grp, -1)::BIGINT AS grp, coalesce(min(ts)::VARCHAR, 'none') AS session_start, coalesce((max(ts) + INTERVAL 10 MINUTE)::VARCHAR, 'none') AS session_end, count(*) AS events FROM s GROUP BY grp, sid""",

    "union_sources": f"""
WITH {CART}
SELECT event_id, event_type, user_id, 'kafka_' || sku AS sku, quantity, time
FROM cart WHERE event_type = 'AddToShoppingCartEvent'
UNION ALL
SELECT event_id, event_type, user_id, 'files_' || sku AS sku, quantity, time
FROM cart WHERE event_type = 'RemovedFromShoppingCartEvent'""",

    "window_join": f"""
WITH {CART}, {ADDS}, {CATALOG}
SELECT a.user_id, {bucket('a.time', 6 * H)} AS window_start, {bucket('a.time', 6 * H, 6 * H)} AS window_end,
       a.event_id AS cart_event_id, c.event_id AS catalog_event_id,
       'User ' || CAST(a.user_id AS VARCHAR) || ' browsed at ' || {iso('c.time')}
       || ' and bought at ' || {iso('a.time')} AS message
FROM adds a JOIN catalog c ON a.user_id = c.user_id
 AND epoch_us(a.time) // {6 * H} = epoch_us(c.time) // {6 * H}""",

    "interval_join": _interval(False),
    "interval_join_inclusive": _interval(True),

    "running_ratio": """
WITH u AS (
  SELECT event_id, ts, 0 AS source FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT event_id, ts, 1 AS source FROM events WHERE event_type = 'view'),
c AS (
  SELECT event_id, source,
         sum(CASE WHEN source = 0 THEN 1 ELSE 0 END) OVER w AS f,
         sum(CASE WHEN source = 1 THEN 1 ELSE 0 END) OVER w AS s
  FROM u WINDOW w AS (ORDER BY ts, source, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, source, round(f * 100.0 / (f + s), 6) AS ratio FROM c""",

    "dynamic_threshold_alerts": f"""
WITH {CART}, {ADDS}, {THRESHOLDS},
j AS (
  SELECT a.*, coalesce(t.threshold, 0) AS threshold
  FROM adds a ASOF LEFT JOIN thresholds t ON a.time >= t.effective_ts)
SELECT event_id, user_id, quantity, threshold,
       'User ' || CAST(user_id AS VARCHAR) || ' attempting to purchase ' || CAST(quantity AS VARCHAR)
       || ' items of ' || sku || ' when threshold is ' || CAST(threshold AS VARCHAR) AS message
FROM j WHERE quantity > threshold""",

    "dynamic_threshold_large": f"""
WITH {CART}, {ADDS}, c AS (SELECT ts AS eff, arg_max(event_id % 7, event_id) AS threshold FROM events WHERE event_type = 'signup' AND ts IS NOT NULL GROUP BY 1)
SELECT a.event_id, a.user_id, a.quantity, coalesce(c.threshold, 0)::BIGINT AS threshold
FROM adds a ASOF LEFT JOIN c ON a.time >= c.eff WHERE a.quantity > coalesce(c.threshold, 0)""",

    "late_events": _LATE + """
SELECT event_id, ts, make_timestamp(wstart + 1800000000) AS window_end, make_timestamp(wm) AS watermark
FROM m WHERE wstart + 1800000000 <= wm""",

    "late_window_counts": _LATE + """
SELECT make_timestamp(wstart) AS window_start, make_timestamp(wstart + 1800000000) AS window_end,
       count(*) AS events
FROM m WHERE NOT coalesce(wstart + 1800000000 <= wm, false) GROUP BY wstart""",

    "late_events_periodic": f"""
WITH e AS (SELECT event_id, ts, event_id // 20 * 4 + event_id * 7 % 20 // 5 AS tick FROM events),
t AS (SELECT tick, max(epoch_us(ts)) AS latest FROM e GROUP BY 1),
w AS (SELECT tick, max(latest) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {H} AS wm FROM t)
SELECT event_id, ts, {bucket('ts', H // 2, H // 2)} AS window_end, make_timestamp(wm) AS watermark
FROM e JOIN w USING (tick) WHERE epoch_us(ts) // {H // 2} * {H // 2} + {H // 2} <= wm""",

    "accumulator_top_values": """
WITH v AS (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, floor(value)::BIGINT AS v, count(*) AS n FROM events GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, day ORDER BY v DESC) AS r FROM v WHERE v IS NOT NULL)
SELECT event_type, day, coalesce(string_agg(r.v || 'x' || r.n, ', ' ORDER BY r.r), '') AS top
FROM (SELECT DISTINCT event_type, day FROM v) k LEFT JOIN r USING (event_type, day) WHERE coalesce(r.r, 1) <= 3 GROUP BY 1, 2""",

    "sequence_sources": """
SELECT s.n, CASE event_type WHEN 'purchase' THEN 'AddToShoppingCartEvent' WHEN 'error' THEN 'RemovedFromShoppingCartEvent' WHEN 'view' THEN 'ProductDetailsViewed' ELSE 'none' END AS record,
       CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 ELSE -1 END::BIGINT AS seq
FROM (SELECT unnest(range((SELECT min(event_id) FROM events), (SELECT max(event_id) + 1 FROM events))) AS n) s LEFT JOIN events ON n = event_id""",

    "layout_report": f"""
WITH {CART} SELECT layout, count(event_id) AS rows, true AS within, true AS even FROM (VALUES ('dealt'), ('narrowed')) AS t(layout) CROSS JOIN cart GROUP BY layout""",
}


# Streaming twins equal their batch twins: a closing row at the end of the replay lets every window be emitted.
_STREAMING = {
    "streaming_count_trigger": _SQL["count_trigger"],
    "streaming_rolling_reduce": _SQL["rolling_reduce"],
    "streaming_tumbling_counts": _SQL["tumbling_type_counts"],
    "streaming_sliding_counts": _SQL["sliding_counts"],
    "streaming_session_by_user": _SQL["session_by_user"],
    "streaming_interval_join": _SQL["interval_join"],
    "streaming_window_join": f"""
WITH {CART}, {ADDS}, {CATALOG}
SELECT a.user_id, {bucket('a.time', 6 * H)} AS window_start, {bucket('a.time', 6 * H, 6 * H)} AS window_end,
       a.event_id AS cart_event_id, c.event_id AS catalog_event_id
FROM adds a JOIN catalog c ON a.user_id = c.user_id
 AND epoch_us(a.time) // {6 * H} = epoch_us(c.time) // {6 * H}""",
    "streaming_running_count": _SQL["running_count_by_user"],
    "streaming_restart": _SQL["running_count_by_user"],
    "streaming_restart_state": _SQL["running_count_by_user"],
    "streaming_initial_state": _SQL["running_count_by_user"],
    "streaming_count_edge_cases": _SQL["running_count_edge_cases"],
    "streaming_recent_list_ttl": _SQL["recent_list_ttl"],
    "streaming_recent_list_ttl_blocked": _SQL["recent_list_ttl"],
    "streaming_timer_windows": _SQL["tumbling_type_counts"],
    "streaming_session_all": _SQL["session_all"],
    "streaming_session_blocked": _SQL["session_by_user"],
    "streaming_running_ratio": _SQL["running_ratio"],
    "streaming_global_every_10": _SQL["global_every_10"],
    "streaming_line_log": """
SELECT 'Event(' || CAST(event_id AS VARCHAR) || ',' || event_type || ')' AS line FROM events WHERE event_type = 'purchase'""",
    "streaming_map_state": f"""
WITH {CART}, t AS (SELECT DISTINCT event_type AS ty FROM cart),
c AS (SELECT event_id, user_id, ty, sum(CASE WHEN event_type = ty THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, ty ORDER BY time, event_id ROWS UNBOUNDED PRECEDING) AS n
      FROM cart CROSS JOIN t)
SELECT event_id, user_id, string_agg(ty || '=' || CAST(n AS VARCHAR), ', ' ORDER BY ty) FILTER (WHERE n > 0) AS counts FROM c GROUP BY event_id, user_id""",
    "streaming_count_trigger_purging": _SQL["count_trigger_purging"],
    "streaming_source_watermark": _SQL["tumbling_type_counts"],
    "streaming_lines": """
SELECT 'Event(' || CAST(event_id AS VARCHAR) || ',' || event_type || ')' AS line FROM events WHERE event_type = 'purchase'""",
    "streaming_late_counts": f"""
WITH a AS (
  SELECT ts, event_id * 4 // (SELECT max(event_id) + 1 FROM events WHERE ts IS NOT NULL)
             + CASE WHEN event_id % 40 = 0 THEN 2 WHEN event_id % 20 = 0 THEN 1 ELSE 0 END AS batch
  FROM events WHERE ts IS NOT NULL),
m AS (SELECT b.batch, max(epoch_us(a.ts)) AS seen FROM (SELECT DISTINCT batch FROM a) b LEFT JOIN a ON a.batch <= b.batch - 2 GROUP BY b.batch)
SELECT {bucket('ts', H // 2)} AS window_start, {bucket('ts', H // 2, H // 2)} AS window_end, count(*) AS events
FROM a JOIN m ON a.batch = m.batch
WHERE NOT coalesce(epoch_us(ts) // {H // 2} * {H // 2} + {H // 2} <= seen - {H}, false) GROUP BY 1, 2""",
    "streaming_side_outputs": f"""
WITH {CART} SELECT *, CASE WHEN coalesce(user_id = 1, false) THEN 'side' ELSE 'main' END AS output FROM cart""",
    "streaming_ingest_windows": f"""
SELECT {bucket('ingest_ts', H)} AS window_start, {bucket('ingest_ts', H, H)} AS window_end, count(*) AS events
FROM (SELECT make_timestamp(epoch_us(ts) + (event_id * 7 % 20) * 1000000) AS ingest_ts FROM events WHERE ts IS NOT NULL) GROUP BY 1, 2""",
    "streaming_type_map": _SQL["running_type_map"],
    "streaming_recent_list": _SQL["recent_list_by_user"],
    "streaming_high_quantity": _SQL["high_quantity_counter"],
    "streaming_dynamic_threshold": f"""
WITH {CART}, {ADDS}, {THRESHOLDS}
SELECT a.event_id, a.user_id, a.quantity, coalesce(t.threshold, 0) AS threshold
FROM adds a ASOF LEFT JOIN thresholds t ON a.time >= t.effective_ts
WHERE a.quantity > coalesce(t.threshold, 0)""",
}


_STREAMING["streaming_control_stream"] = _STREAMING["streaming_dynamic_threshold"]
_SQL["dynamic_threshold_alerts_scan"] = _SQL["dynamic_threshold_alerts"]
_SQL["asof_edge_cases_scan"] = _SQL["asof_edge_cases"]


def oracle_sql() -> dict[str, str]:
    out = {k: v.strip() for k, v in _SQL.items()}
    out.update({k: v.strip() for k, v in _STREAMING.items()})
    return out
