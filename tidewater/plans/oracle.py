"""Independent SQL for every query in ``catalog.py`` (DuckDB dialect).

Written from the definitions, not from the Spark code: derived inputs are computed
straight from the tables (the log oracle never parses a line, the ride oracle uses
the cell numbers rather than coordinates, hours come from a fixed -5 h offset,
which is exact for January), and iterative graph results come from recursive CTEs.
Ranks are compared as ``floor(rank * 1e6 + 0.137)`` on both sides.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared CTEs

EV = r"""
ev AS (
  SELECT *,
    event_id % 53 = 0 AS junk, event_id % 7 = 0 AS dash, event_id % 61 = 7 AS badsize,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    '/' || event_type || '/' || CAST(user_id % 10 AS VARCHAR) AS endpoint,
    CASE WHEN event_id % 9 = 4 THEN '' ELSE 'HTTP/1.0' END AS protocol,
    CAST(CASE WHEN event_type = 'error' THEN (CASE WHEN event_id % 2 = 0 THEN 500 ELSE 404 END)
         WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 403
         WHEN event_type = 'view' AND event_id % 4 = 1 THEN 304
         ELSE 200 END AS INTEGER) AS responseCode,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400' AS dateTime
  FROM events)"""

LOGS = EV + r""",
logs AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) || '.example.net' AS ipAddress, '-' AS clientIdentd, '-' AS userId,
    dateTime, CAST(epoch(date_trunc('second', ts)) AS DOUBLE) + 14400 AS timestamp,
    strftime(ts, '%Y-%m-%d') AS date, method, endpoint, protocol, responseCode,
    CAST(CASE WHEN dash THEN 0 ELSE floor(value * 100) END AS INTEGER) AS contentSize,
    CAST(isodow(ts) - 1 AS INTEGER) AS dayOfWeek
  FROM ev WHERE NOT junk AND (dash OR NOT badsize))"""

PER_USER_DAY = LOGS + """,
per AS (SELECT dayOfWeek, ipAddress, count(*) AS c FROM logs GROUP BY 1, 2)"""

WORDS_WS = r"""SELECT w AS word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS w FROM documents)
WHERE w <> '' GROUP BY w"""

WORDS_RE = r"""SELECT w AS word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS w FROM documents)
WHERE w <> '' GROUP BY w"""

WORDS_STRIP = r"""SELECT trim(w, '.,;:?!-') AS word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS w FROM documents)
WHERE w <> '' GROUP BY 1"""

RECS = """
recs AS (
  SELECT c_custkey AS id, CAST(trunc(c_acctbal) AS INTEGER) AS score,
    '  <row Id="' || CAST(c_custkey AS VARCHAR) || '" Reputation="' || CAST(CAST(trunc(c_acctbal) AS INTEGER) AS VARCHAR)
    || '" DisplayName="' || c_name || '" />' AS value
  FROM customer WHERE c_acctbal >= 0)"""

CELLS = "[71436, 71688, 71191, 70945, 70190, 70686, 70000, 70001]"
RIDES = f"""
terms AS (SELECT * FROM (VALUES ('TERMINAL_1', 71436), ('TERMINAL_2', 71688), ('TERMINAL_3', 71191),
                                ('TERMINAL_4', 70945), ('TERMINAL_5', 70190), ('TERMINAL_6', 70686)) t(terminal, grid)),
rides AS (
  SELECT event_id AS ride_id, event_id % 2 = 0 AS is_start, ts AS start_time, ts + INTERVAL 20 MINUTE AS end_time,
    CAST({CELLS}[user_id % 8 + 1] AS INTEGER) AS start_cell,
    CAST({CELLS}[(user_id * 7) % 8 + 1] AS INTEGER) AS end_cell
  FROM events),
rt AS (
  SELECT r.*, s.terminal AS start_terminal, e.terminal AS end_terminal,
    CAST(hour(start_time - INTERVAL 5 HOUR) AS INTEGER) AS start_hour,
    CAST(hour(end_time - INTERVAL 5 HOUR) AS INTEGER) AS end_hour
  FROM rides r LEFT JOIN terms s ON s.grid = r.start_cell LEFT JOIN terms e ON e.grid = r.end_cell),
tev AS (
  SELECT ride_id, is_start, CASE WHEN is_start THEN start_time ELSE end_time END AS event_time,
    CASE WHEN is_start THEN start_terminal ELSE end_terminal END AS terminal,
    CASE WHEN is_start THEN start_hour ELSE end_hour END AS hour
  FROM rt)"""


def _hourly(where: str = "TRUE") -> str:
    return f"""hourly AS (
  SELECT date_trunc('hour', event_time) AS window_start, terminal, count(*) AS n
  FROM tev WHERE terminal IS NOT NULL AND {where} GROUP BY 1, 2)"""


def _busiest() -> str:
    return """SELECT window_start, terminal, CAST(hour(window_start - INTERVAL 5 HOUR) AS INTEGER) AS hour, n
FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, terminal) AS rn FROM hourly)
WHERE rn = 1"""


def _hourly_report() -> str:
    return """SELECT window_start, terminal, CAST(hour(window_start - INTERVAL 5 HOUR) AS INTEGER) AS hour, n
FROM hourly"""


ENDS = """,
e11 AS (SELECT *, CASE WHEN start_terminal IS NOT NULL THEN start_time ELSE end_time END AS et FROM rt),
ends AS (
  SELECT ride_id, et, start_terminal AS terminal, start_hour AS hour FROM e11 WHERE start_terminal IS NOT NULL
  UNION ALL
  SELECT ride_id, et, end_terminal, end_hour FROM e11 WHERE end_terminal IS NOT NULL),
both_hourly AS (SELECT date_trunc('hour', et) AS window_start, terminal, hour, count(*) AS n FROM ends GROUP BY 1, 2, 3)"""

TRIPS = """
starts AS (SELECT event_id // 2 AS trip, ts AS start_time, user_id AS start_user FROM events WHERE event_id % 2 = 0),
ends AS (SELECT event_id // 2 AS trip, ts AS end_time, user_id AS end_user FROM events WHERE event_id % 2 = 1)"""
TRIP_JOIN = """
SELECT s.trip, start_time, start_user, end_time, end_user FROM starts s {how} JOIN ends e
  ON e.trip = s.trip AND end_time >= start_time AND end_time <= start_time + INTERVAL 4 MINUTE"""

# Events in six slots of their arrival; the watermark of a slot is the largest time of the
# slots before it less a minute.
LATE = """
arriving AS (SELECT event_id, ts, date_trunc('hour', ts) AS window_start,
               epoch_us(ts + CASE WHEN event_id % 17 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END) AS came FROM events),
slotted AS (SELECT *, ((came - (SELECT min(came) FROM arriving)) * 6) //
                      ((SELECT max(came) FROM arriving) - (SELECT min(came) FROM arriving) + 1) AS slot FROM arriving),
tops AS (SELECT slot, max(ts) AS top FROM slotted GROUP BY slot),
marks AS (SELECT slot, max(top) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 60 SECOND AS watermark
          FROM tops),
judged AS (SELECT *, coalesce(window_start + INTERVAL 1 HOUR <= watermark, FALSE) AS late FROM slotted JOIN marks USING (slot))"""

MIX = "(l_suppkey * 31 + l_linenumber * 17 + l_orderkey)"
GE = f"""
ge AS (SELECT l_partkey AS src, {MIX} % (SELECT count(*) FROM part) AS dst, CAST(l_quantity AS INTEGER) AS w
       FROM lineitem)"""
RE = f"""
re AS (SELECT l_partkey AS src, ({MIX} % ((SELECT count(*) FROM part) // 2)) * 2 AS dst FROM lineitem),
rverts AS (SELECT src AS id FROM re UNION SELECT dst FROM re)"""


def _key(expr: str = "rank") -> str:
    return f"CAST(floor({expr} * 1e6 + 0.137) AS BIGINT) AS rank_e6"


PR_PREGEL = "WITH RECURSIVE" + RE + """,
deg AS (SELECT src, count(*) AS outDeg FROM re GROUP BY src),
w AS (SELECT re.src, re.dst, CAST(1 AS DOUBLE) / deg.outDeg AS weight FROM re JOIN deg USING (src)),
r(it, id, rank) AS (
  SELECT 0, id, CAST(0.15 AS DOUBLE) FROM rverts
  UNION ALL
  SELECT r.it + 1, w.dst, 0.15 + 0.85 * sum(r.rank * w.weight)
  FROM r JOIN w ON w.src = r.id WHERE r.it < 20 GROUP BY r.it, w.dst),
pr AS (SELECT id, arg_max(rank, it) AS rank FROM r GROUP BY id)"""

PR_JOIN = "WITH RECURSIVE" + RE + """,
de AS (SELECT DISTINCT src, dst FROM re),
deg AS (SELECT src, count(*) AS outDeg FROM de GROUP BY src),
adj AS (SELECT de.src, de.dst, deg.outDeg FROM de JOIN deg USING (src)),
r(it, id, rank) AS (
  SELECT 0, src, CAST(1.0 AS DOUBLE) FROM deg
  UNION ALL
  SELECT r.it + 1, adj.dst, 0.15 + 0.85 * sum(r.rank / adj.outDeg)
  FROM r JOIN adj ON adj.src = r.id WHERE r.it < 20 GROUP BY r.it, adj.dst),
pr AS (SELECT id, rank FROM r WHERE it = 20)"""

# Synchronous iteration until max |new - old| <= 1e-4. Every vertex joins its own
# row through a self entry, so the recursive table is read once per step.
PR_CONV = "WITH RECURSIVE" + RE + """,
deg AS (SELECT src, count(*) AS outDeg FROM re GROUP BY src),
adjx AS (SELECT re.src, re.dst, deg.outDeg, FALSE AS self FROM re JOIN deg USING (src)
         UNION ALL SELECT id, id, 1, TRUE FROM rverts),
r(it, id, rank, delta) AS (
  SELECT 0, id, CAST(1.0 AS DOUBLE), CAST(1e9 AS DOUBLE) FROM rverts
  UNION ALL
  SELECT it, id, rank, max(abs(rank - old)) OVER () FROM (
    SELECT r.it + 1 AS it, x.dst AS id,
      0.15 + 0.85 * coalesce(sum(CASE WHEN NOT x.self THEN r.rank / x.outDeg END), 0) AS rank,
      max(CASE WHEN x.self THEN r.rank END) AS old
    FROM r JOIN adjx x ON x.src = r.id
    WHERE r.delta > 1e-4
    GROUP BY r.it, x.dst)),
pr AS (SELECT id, rank FROM r WHERE it = (SELECT max(it) FROM r))"""


def _components(edges: str, verts: str) -> str:
    return f"""WITH RECURSIVE {edges},
und AS (SELECT src AS a, dst AS b FROM ge0 WHERE src <> dst UNION SELECT dst, src FROM ge0 WHERE src <> dst),
verts AS ({verts}),
cc(id, comp) USING KEY (id) AS (
  SELECT id, id FROM verts
  UNION
  SELECT u.b AS id, min(c.comp) AS comp
  FROM cc c JOIN und u ON u.a = c.id JOIN recurring.cc r ON r.id = u.b
  GROUP BY u.b, r.comp HAVING min(c.comp) < r.comp)"""


SUB_EDGES = f"""ge0 AS (SELECT src, dst FROM ({GE.strip()[len('ge AS '):]}) g
  WHERE src IN (SELECT p_partkey FROM part WHERE p_size > 30) AND dst IN (SELECT p_partkey FROM part WHERE p_size > 30))"""
ALL_EDGES = f"""ge0 AS (SELECT src, dst FROM ({GE.strip()[len('ge AS '):]}) g)"""


# ---------------------------------------------------------------- the statements

ORACLE: dict[str, str] = {
    # sources and sinks
    "src_text": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "src_vertices": "SELECT p_partkey AS id, p_name AS name FROM part",
    "repartitioned": "SELECT 7 AS partitions, 7 AS used, count(*) AS n FROM lineitem",
    "src_json": "SELECT * FROM customer",
    "src_json_inferred": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "src_delimited": "SELECT c_name AS name, c_nationkey AS age FROM customer",
    "sink_text_roundtrip": "SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name AS value FROM customer",
    "sink_tsv_roundtrip": "SELECT o_custkey AS key, count(*) AS value FROM orders GROUP BY 1",
    # projections and filters
    "proj_select": "SELECT c_name, c_mktsegment FROM customer",
    "proj_arith": "SELECT c_name, c_acctbal + 1 AS acctbal_plus_one FROM customer",
    "proj_concat": "SELECT 'customer/' || c_name AS line FROM customer WHERE c_acctbal BETWEEN 1500 AND 4200",
    "sql_filter_range": "SELECT c_name, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1500 AND 4200",
    "sql_filter_eq": "WITH " + LOGS + "\nSELECT ipAddress, method, endpoint FROM logs WHERE responseCode = 403",
    "filter_predicate": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000",
    "map_scalar": "SELECT l_orderkey, l_linenumber, pow(l_quantity, 2) AS sq FROM lineitem",
    "map_to_array": "SELECT l_orderkey, l_linenumber, range(0, CAST(l_linenumber AS BIGINT)) AS xs FROM lineitem",
    "flatmap_range": "SELECT l_orderkey, l_linenumber, unnest(range(0, CAST(l_linenumber AS BIGINT))) AS x FROM lineitem",
    # key-value
    "kv_keys_values": "SELECT 'key' AS part, c_name AS item FROM customer "
                      "UNION ALL SELECT 'value', CAST(c_nationkey AS VARCHAR) FROM customer",
    "kv_map_both": "SELECT c_name || '/next' AS k, c_nationkey + 1 AS v FROM customer",
    "kv_map_values": "SELECT c_name AS k, pow(c_nationkey, 2) AS v FROM customer",
    "kv_lookup": "SELECT o_orderkey FROM orders WHERE o_custkey = 10",
    "kv_group_list": "SELECT l_orderkey, list_sort(list(l_partkey)) AS parts FROM lineitem GROUP BY 1",
    "kv_reduce_sum": "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1",
    "kv_reduce_general": "SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1",
    "kv_reduce_builtin": "SELECT l_suppkey, bit_xor(CAST(l_partkey AS BIGINT)) AS mixed FROM lineitem GROUP BY 1",
    "sample_n": "SELECT c_custkey, c_name FROM customer ORDER BY sha256('7:' || c_custkey || chr(31) || c_name), c_custkey LIMIT 10",
    "kv_as_map": """SELECT l_orderkey, map(list(l_linenumber ORDER BY l_linenumber), list(p ORDER BY l_linenumber)) AS parts
FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS p FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
    "cogroup_lists": """WITH a AS (SELECT l_orderkey AS orderkey, list_sort(list(l_linenumber)) AS lv FROM lineitem GROUP BY 1),
b AS (SELECT o_orderkey AS orderkey, list_sort(list(o_orderstatus)) AS rv FROM orders GROUP BY 1)
SELECT coalesce(a.orderkey, b.orderkey) AS orderkey,
  coalesce(a.lv, CAST([] AS INTEGER[])) AS left_values, coalesce(b.rv, CAST([] AS VARCHAR[])) AS right_values
FROM a FULL JOIN b ON a.orderkey = b.orderkey""",
    # joins
    "join_inner": "WITH b AS ({b}), u AS ({u}) SELECT c_custkey, c_name, o_orderkey, o_custkey FROM b JOIN u ON c_custkey + 50 = o_custkey",
    "join_left": "WITH b AS ({b}), u AS ({u}) SELECT c_custkey, c_name, o_orderkey, o_custkey FROM b LEFT JOIN u ON c_custkey + 50 = o_custkey",
    "join_right": "WITH b AS ({b}), u AS ({u}) SELECT c_custkey, c_name, o_orderkey, o_custkey FROM b RIGHT JOIN u ON c_custkey + 50 = o_custkey",
    "join_full": "WITH b AS ({b}), u AS ({u}) SELECT c_custkey, c_name, o_orderkey, o_custkey FROM b FULL JOIN u ON c_custkey + 50 = o_custkey",
    "join_left_semi": "WITH b AS ({b}), u AS ({u}) SELECT c_custkey, c_name FROM b WHERE c_custkey + 50 IN (SELECT o_custkey FROM u)",
    "join_left_anti": "WITH b AS ({b}), u AS ({u}) SELECT c_custkey, c_name FROM b WHERE NOT EXISTS (SELECT 1 FROM u WHERE o_custkey = c_custkey + 50)",
    # aggregates
    "agg_count": "SELECT count(*) AS n FROM lineitem",
    "group_count_null_key": """SELECT c.c_nationkey, count(*) AS count FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey + 50
GROUP BY 1""",
    # text
    "wordcount_whitespace": WORDS_WS,
    "wordcount_regex": WORDS_RE,
    "wordcount_stripped": WORDS_STRIP,
    "wordcount_vocab": f"SELECT count(*) AS n FROM ({WORDS_STRIP})",
    "topk_words": f"SELECT word, count FROM ({WORDS_STRIP}) ORDER BY count DESC, word LIMIT 20",
    "topk_long_words": f"""SELECT word, count FROM ({WORDS_STRIP})
ORDER BY CASE WHEN length(word) < 5 THEN 0 ELSE count END DESC, word LIMIT 20""",
    "udtf_tokenize": WORDS_RE,
    # access log
    "log_parse": "WITH " + LOGS + """
SELECT ipAddress, clientIdentd, userId, dateTime, timestamp, date, method, endpoint, protocol, responseCode, contentSize
FROM logs""",
    "log_rejects": "WITH " + EV + """
SELECT CASE WHEN junk THEN '#junk ' || CAST(event_id AS VARCHAR)
  ELSE 'u' || CAST(user_id AS VARCHAR) || '.example.net - - [' || dateTime || '] "' || method || ' ' || endpoint
       || CASE WHEN event_id % 9 = 4 THEN '' ELSE ' HTTP/1.0' END || '" ' || CAST(responseCode AS VARCHAR) || ' n/a' END AS value
FROM ev WHERE junk OR (badsize AND NOT dash)""",
    "agg_distinct_clients": "WITH " + LOGS + "\nSELECT count(*) AS n FROM (SELECT DISTINCT ipAddress FROM logs)",
    "agg_min_avg_max": "WITH " + LOGS + """
SELECT min(contentSize) AS min_size, avg(contentSize) AS avg_size, max(contentSize) AS max_size FROM logs""",
    "status_counts": "WITH " + LOGS + "\nSELECT responseCode, count(*) AS count FROM logs GROUP BY 1",
    "status_share": "WITH " + LOGS + """
SELECT responseCode,
  CAST(round(CAST(CAST(count(*) * 100 AS DOUBLE) / (SELECT count(*) FROM logs) AS DECIMAL(38, 10)), 2) AS DOUBLE) AS count
FROM logs GROUP BY 1""",
    "status_class_counts": "WITH " + LOGS + """
SELECT CAST(floor(responseCode / 100) AS INTEGER) AS statusClass, count(*) AS count FROM logs GROUP BY 1""",
    "topk_users": "WITH " + LOGS + """
SELECT ipAddress, count(*) AS count FROM logs GROUP BY 1 ORDER BY count DESC, ipAddress LIMIT 10""",
    "weekday_counts": "WITH " + LOGS + "\nSELECT dayOfWeek, count(*) AS count FROM logs GROUP BY 1",
    "access_by_user_weekday": "WITH " + LOGS + "\nSELECT ipAddress, dayOfWeek, count(*) AS count FROM logs GROUP BY 1, 2",
    "gold_access": "WITH " + LOGS + """,
gold AS (SELECT ipAddress FROM logs GROUP BY 1 ORDER BY count(*) DESC, ipAddress LIMIT 10)
SELECT l.ipAddress, l.dayOfWeek, count(*) AS count FROM logs l JOIN gold g ON g.ipAddress = l.ipAddress GROUP BY 1, 2""",
    "group_max": "WITH " + PER_USER_DAY + "\nSELECT dayOfWeek, max(c) AS count FROM per GROUP BY 1",
    "most_active_per_weekday": "WITH " + PER_USER_DAY + """
SELECT ipAddress, dayOfWeek, c AS count FROM per p
WHERE c = (SELECT max(c) FROM per q WHERE q.dayOfWeek = p.dayOfWeek)""",
    "udf_weekday": "WITH " + LOGS + "\nSELECT dateTime, dayOfWeek FROM logs",
    # attribute lines and top-k
    "xml_attributes": """SELECT CAST(c_custkey AS VARCHAR) AS Id,
  CASE WHEN c_acctbal >= 0 THEN CAST(CAST(trunc(c_acctbal) AS INTEGER) AS VARCHAR) END AS Reputation,
  c_name AS DisplayName FROM customer""",
    "xml_attribute_map": """SELECT CAST(c_custkey AS VARCHAR) AS Id,
  CASE WHEN c_acctbal >= 0 THEN CAST(CAST(trunc(c_acctbal) AS INTEGER) AS VARCHAR) END AS Reputation,
  'renamed' AS DisplayName, CASE WHEN c_acctbal >= 0 THEN 3 ELSE 2 END AS n FROM customer""",
    "topk_distinct_key": "WITH " + RECS + """
SELECT score, CAST(max(id) AS VARCHAR) AS id, arg_max(value, id) AS value FROM recs GROUP BY score ORDER BY score DESC LIMIT 10""",
    "topk_records": "WITH " + RECS + "\nSELECT CAST(id AS VARCHAR) AS id, score, value FROM recs ORDER BY score DESC, recs.id LIMIT 10",
    # rides
    "grid_cell": "WITH " + RIDES + "\nSELECT ride_id, start_cell, end_cell FROM rides",
    "hour_of_day_tz": "WITH " + RIDES + "\nSELECT ride_id, start_hour, end_hour FROM rt",
    "rides_event_time": "WITH " + RIDES + """
SELECT ride_id, CASE WHEN start_terminal IS NOT NULL THEN start_time ELSE end_time END AS event_time FROM rt""",
    "rides_terminal_events": "WITH " + RIDES + """
SELECT ride_id, terminal, CAST(1 AS BIGINT) AS n, hour FROM tev WHERE terminal IS NOT NULL""",
    "stream_terminal_events": "WITH " + RIDES + """
SELECT ride_id, terminal, CAST(1 AS BIGINT) AS n, hour FROM tev WHERE terminal IS NOT NULL""",
    "rides_either_endpoint": "WITH " + RIDES + """
SELECT ride_id, is_start, start_terminal, end_terminal FROM rt WHERE start_terminal IS NOT NULL OR end_terminal IS NOT NULL""",
    "rides_start_at_terminal": "WITH " + RIDES + """
SELECT ride_id, start_terminal AS terminal, CAST(1 AS BIGINT) AS n, start_hour AS hour FROM rt WHERE start_terminal IS NOT NULL""",
    "rides_first_endpoint": "WITH " + RIDES + """
SELECT ride_id, coalesce(start_terminal, end_terminal) AS terminal,
  CASE WHEN start_terminal IS NOT NULL THEN start_hour ELSE end_hour END AS hour
FROM rt WHERE start_terminal IS NOT NULL OR end_terminal IS NOT NULL""",
    "rides_both_endpoints": "WITH " + RIDES + ENDS + "\nSELECT window_start, terminal, hour, n FROM both_hourly",
    "stream_rides_hourly": "WITH " + RIDES + ENDS + "\nSELECT window_start, terminal, hour, n FROM both_hourly",
    "rides_terminal_hourly": "WITH " + RIDES + ",\n" + _hourly() + "\n" + _hourly_report(),
    "stream_terminal_events_hourly": "WITH " + RIDES + ",\n" + _hourly() + "\n" + _hourly_report(),
    "rides_busiest_hour": "WITH " + RIDES + ",\n" + _hourly() + "\n" + _busiest(),
    "stream_busiest_per_hour": "WITH " + RIDES + ",\n" + _hourly() + "\n" + _busiest(),
    "rides_busiest_departures_hour": "WITH " + RIDES + ",\n" + _hourly("is_start") + "\n" + _busiest(),
    "stream_busiest_departures_hour": "WITH " + RIDES + ",\n" + _hourly("is_start") + "\n" + _busiest(),
    "stream_chained_busiest": "WITH " + RIDES + ",\n" + _hourly() + "\n" + _busiest(),
    "stream_chained_busiest_departures": "WITH " + RIDES + ",\n" + _hourly("is_start") + "\n" + _busiest(),
    "stream_rides_gzip": "WITH " + RIDES + ENDS + "\nSELECT window_start, terminal, hour, n FROM both_hourly",
    "stream_three_tasks": "WITH " + RIDES + f"""
SELECT 'terminal visits' AS result, * FROM (WITH {_hourly()} {_hourly_report()})
UNION ALL SELECT 'busiest', * FROM (WITH {_hourly()} {_busiest()})
UNION ALL SELECT 'busiest departures', * FROM (WITH {_hourly("is_start")} {_busiest()})""",
    "stream_join_rides": "WITH " + TRIPS + TRIP_JOIN.format(how="LEFT"),
    "stream_join_rides_inner": "WITH " + TRIPS + TRIP_JOIN.format(how="INNER"),
    "stream_cogroup": "WITH " + TRIPS + """,
both_sides AS (SELECT start_time AS came, start_user AS user_id, CAST(trip AS VARCHAR) AS l, NULL AS r FROM starts
               UNION ALL SELECT end_time, end_user, NULL, CAST(trip AS VARCHAR) FROM ends)
SELECT date_trunc('day', came) AS window_start, user_id,
  coalesce(list(l ORDER BY l) FILTER (WHERE l IS NOT NULL), []) AS left_values,
  coalesce(list(r ORDER BY r) FILTER (WHERE r IS NOT NULL), []) AS right_values
FROM both_sides GROUP BY 1, 2""",
    "stream_late_rows": "WITH " + LATE + "\nSELECT event_id, ts, window_start, watermark FROM judged WHERE late",
    "stream_late_counts": "WITH " + LATE + """
SELECT window_start, count(*) FILTER (WHERE NOT late) AS on_time, count(*) FILTER (WHERE late) AS late FROM judged GROUP BY 1""",
    "stream_running_total": """SELECT event_id, event_type,
  count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS so_far FROM events""",
    "stream_running_wordcount": r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\W+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM w)
SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS count FROM words""",
    "tumbling_count": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "busiest_per_hour": """SELECT window_start, event_type, n FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, event_type) AS rn
  FROM (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2))
WHERE rn = 1""",
    "stream_wordcount": WORDS_RE,
    # graphs
    "graph_load": "WITH " + GE + "\nSELECT src, dst FROM ge",
    "graph_edges_distinct": "WITH " + GE + "\nSELECT DISTINCT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM ge",
    "graph_triplets": "WITH " + GE + """
SELECT e.src, e.dst, s.p_name || ' likes ' || d.p_name AS line
FROM ge e JOIN part s ON s.p_partkey = e.src JOIN part d ON d.p_partkey = e.dst""",
    "graph_vertex_filter": "SELECT p_partkey AS id, p_name AS name, p_size AS age FROM part WHERE p_size > 30",
    "graph_edge_filter": "WITH " + GE + "\nSELECT src, dst, w FROM ge WHERE w > 5",
    "graph_in_degrees": "WITH " + GE + "\nSELECT dst AS id, count(*) AS inDeg FROM ge GROUP BY 1",
    "graph_out_degrees": "WITH " + GE + "\nSELECT src AS id, count(*) AS outDeg FROM ge GROUP BY 1",
    "graph_subgraph": "WITH " + GE + """,
keep AS (SELECT p_partkey FROM part WHERE p_size > 30)
SELECT src, dst, w FROM ge WHERE src IN (SELECT p_partkey FROM keep) AND dst IN (SELECT p_partkey FROM keep)""",
    "graph_user_degrees": "WITH " + GE + """,
i AS (SELECT dst AS id, count(*) AS inDeg FROM ge GROUP BY 1),
o AS (SELECT src AS id, count(*) AS outDeg FROM ge GROUP BY 1)
SELECT p.p_partkey AS id, p.p_name AS name, i.inDeg, coalesce(o.outDeg, 0) AS outDeg
FROM part p JOIN i ON i.id = p.p_partkey LEFT JOIN o ON o.id = p.p_partkey""",
    "graph_edge_weights": "WITH " + RE + """,
deg AS (SELECT src, count(*) AS outDeg FROM re GROUP BY src)
SELECT re.src, re.dst, CAST(1 AS DOUBLE) / deg.outDeg AS weight FROM re JOIN deg USING (src)""",
    "graph_neighbors": "WITH " + GE + "\nSELECT src AS id, dst AS neighbor FROM ge",
    "graph_triangles": "WITH " + GE + """,
und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM ge WHERE src <> dst),
tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM und x JOIN und y ON y.a = x.b JOIN und z ON z.a = x.a AND z.b = y.b),
per AS (SELECT id, count(*) AS c FROM (SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY id),
verts AS (SELECT src AS id FROM ge UNION SELECT dst FROM ge)
SELECT v.id, CAST(coalesce(per.c, 0) AS BIGINT) AS triangles FROM verts v LEFT JOIN per ON per.id = v.id""",
    "graph_bfs_levels": "WITH RECURSIVE" + GE + """,
bfs(id, level) USING KEY (id) AS (
  SELECT (SELECT min(src) FROM ge), 0
  UNION
  SELECT e.dst, min(b.level) + 1
  FROM bfs b JOIN ge e ON e.src = b.id LEFT JOIN recurring.bfs r ON r.id = e.dst
  WHERE r.id IS NULL GROUP BY e.dst)
SELECT id, CAST(level AS INTEGER) AS level FROM bfs""",
    "graph_components": _components(ALL_EDGES, "SELECT src AS id FROM ge0 UNION SELECT dst FROM ge0")
        + "\nSELECT id, comp AS component FROM cc",
    "graph_subgraph_by_edge": "WITH " + GE + """
SELECT src, dst, w FROM ge WHERE w > 5 AND src IN (SELECT p_partkey FROM part WHERE p_size > 30)
  AND dst IN (SELECT p_partkey FROM part WHERE p_size > 30)""",
    "graph_subgraph_components": _components(SUB_EDGES, "SELECT p_partkey AS id FROM part WHERE p_size > 30")
        + "\nSELECT p.p_partkey AS id, p.p_name AS name, cc.comp AS component FROM part p JOIN cc ON cc.id = p.p_partkey",
    "pagerank_pregel": PR_PREGEL + f"\nSELECT id, {_key()} FROM pr",
    "pagerank_join_iterative": PR_JOIN + f"\nSELECT id, {_key()} FROM pr",
    "pagerank_converged": PR_CONV + f"\nSELECT id, {_key()} FROM pr",
    "pagerank_residual": PR_CONV.replace("0.15 + 0.85", "0.5 + 0.5").replace("1e-4", "1e-12")
        + "\nSELECT id, CAST(floor(rank * 1000 + 0.137) AS BIGINT) AS rank_e3 FROM pr",
    "pagerank_named": PR_CONV + f"\nSELECT pr.id, p.p_name AS name, {_key('pr.rank')} FROM pr JOIN part p ON p.p_partkey = pr.id",
    "pagerank_top10": PR_JOIN + f"\nSELECT id, {_key()} FROM pr ORDER BY rank DESC, id LIMIT 10",
    "pagerank_contributions": "WITH " + RE + """,
de AS (SELECT DISTINCT src, dst FROM re),
deg AS (SELECT src, count(*) AS outDeg FROM de GROUP BY src)
SELECT de.src, de.dst, CAST(1.0 AS DOUBLE) / deg.outDeg AS contrib FROM de JOIN deg USING (src)""",
}

_B = "SELECT c_custkey, c_name FROM customer"
_U = "SELECT o_orderkey, o_custkey FROM orders"
for _k in [k for k in ORACLE if k.startswith("join_")]:
    ORACLE[_k] = ORACLE[_k].replace("{b}", _B).replace("{u}", _U)
