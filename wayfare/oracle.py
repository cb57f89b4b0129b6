"""The same queries in DuckDB SQL, written independently: row by row along the log where
the Spark form takes a shorter way."""

from __future__ import annotations

from wayfare.operators.folds import NAMES_PER_PART

TRIPS = """trips AS (
  SELECT event_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS route_id,
         CAST(user_id AS VARCHAR) AS passenger_name,
         CAST(NULL AS VARCHAR) AS origin, CAST(NULL AS VARCHAR) AS destination,
         event_type AS transport_type
  FROM events)"""

ROUTES = """routes AS (
  SELECT p_partkey AS seq, p_partkey % 100 AS route_id, p_name AS origin, p_name AS destination,
         p_type AS type, p_brand AS operator, p_size AS capacity,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes((p_partkey // 100) * 60 + p_partkey % 100) AS effective_ts
  FROM part)"""

# every trip with the running count of its route, in log order and in event time, and the latest
# version of every route
CHANGELOG = """u AS (
  SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY event_id) AS n FROM trips)"""
TIMELINE = """u AS (
  SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY ts, event_id) AS n FROM trips)"""
LATEST = "lc AS (SELECT * FROM routes QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY seq DESC) = 1)"
# the latest version of every route whose last record, which a capacity ending in 0 brings about, is no removal
LIVE = """lc AS (SELECT * FROM routes QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY seq DESC) = 1
  AND capacity % 10 <> 0)"""
UPDATES = """o AS (
  SELECT u.*, lc.type, lc.operator, lc.capacity, CAST(n AS DOUBLE) / capacity AS occ FROM u JOIN lc USING (route_id))"""
ASOF = """a AS (
  SELECT u.*, r.seq, r.type, r.operator, r.capacity
  FROM u ASOF JOIN routes r ON u.route_id = r.route_id AND u.ts >= r.effective_ts)"""
HOURS = """h AS (
  SELECT date_trunc('hour', ts) AS window_start, type, sum(occ) AS total, count(*) AS updates,
         arg_min(occ, event_id) AS first_occ, max(event_id) AS last_at
  FROM o GROUP BY ALL)"""

SHIPMENTS = """s AS (
  SELECT l_shipdate AS ts, l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
         l_suppkey AS supplier_key, l_partkey AS route_id, l_returnflag AS transport_type,
         CAST(o_custkey AS VARCHAR) AS passenger_name,
         row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LATE_SHIPMENTS = """l AS (
  SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR <= stream_time AS late FROM (
    SELECT l_shipdate AS ts, l_partkey % 5 AS source_partition, l_orderkey AS order_key, l_linenumber AS line_number,
           l_partkey AS part_key, l_suppkey AS supplier_key, l_returnflag AS transport_type,
           max(l_shipdate) OVER (PARTITION BY l_partkey % 5
                                 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS stream_time
    FROM lineitem))"""

_TYPE = ("CASE {0} % 5 WHEN 0 THEN 'Bus' WHEN 1 THEN 'Taxi' WHEN 2 THEN 'Train' WHEN 3 THEN 'Metro' "
         "ELSE 'Scooter' END")
SUPPLIERS = f"""suppliers AS (
  SELECT s_suppkey AS id, s_name AS name, {_TYPE.format('s_nationkey')} AS type FROM supplier)"""
SUPPLIER_CHANGES = f"""supplier_changes AS (
  SELECT s_suppkey AS id, s_name || ' (closed)' AS name, {_TYPE.format('s_nationkey')} AS type
  FROM supplier WHERE s_acctbal < 0
  UNION ALL
  SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey), c_name,
         {_TYPE.format('c_nationkey')}
  FROM customer)"""
ROUTE_CHANGES = f"""route_changes AS (
  SELECT CAST(n_nationkey AS BIGINT) AS route_id, n_name AS origin, n_name AS destination,
         {_TYPE.format('n_nationkey')} AS type, 'Operator' || substr('ABC', n_nationkey % 3 + 1, 1) AS operator,
         n_nationkey + 1 AS capacity
  FROM nation
  UNION ALL
  SELECT NULL, r_name, r_name, {_TYPE.format('r_regionkey')},
         'Operator' || substr('ABC', r_regionkey % 3 + 1, 1), r_regionkey + 1
  FROM region)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _percent(trips: str, seats: str) -> str:
    return f"CASE WHEN {seats} = 0 THEN 0.0 ELSE CAST({trips} AS DOUBLE) / {seats} * 100 END"


def _two_decimals(x: str) -> str:
    """Rounded half up on the shortest decimal form of the double."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 2)) AS VARCHAR)"


def _top(table: str, key: str, count: str = "trips") -> str:
    return f"""SELECT {key}, count(*) AS {count} FROM {table} WHERE {key} IS NOT NULL
GROUP BY {key} ORDER BY count(*) DESC, max(%s) LIMIT 1"""


def _names(per_part: int) -> str:
    return _with(TRIPS) + f"""SELECT route_id, part, string_agg(passenger_name, ', ' ORDER BY event_id) AS passengers
FROM (SELECT *, (row_number() OVER (PARTITION BY route_id ORDER BY event_id) - 1) // {per_part} AS part FROM trips)
GROUP BY route_id, part"""


Q = {
    4: _names(NAMES_PER_PART),
    5: _with(ROUTES) + "SELECT route_id, CAST(sum(capacity) AS BIGINT) AS seats FROM routes GROUP BY route_id",
    6: _with(TRIPS, ROUTES) + f"""SELECT route_id, passengers, seats, {_percent('passengers', 'seats')} AS occupancy_pct
FROM (SELECT route_id, count(*) AS passengers FROM trips GROUP BY route_id)
JOIN (SELECT route_id, CAST(sum(capacity) AS BIGINT) AS seats FROM routes GROUP BY route_id) USING (route_id)""",
    7: _with(TRIPS) + "SELECT count(*) AS total_passengers FROM trips HAVING count(*) > 0",
    8: _with(ROUTES) + "SELECT CAST(sum(capacity) AS BIGINT) AS total_seats FROM routes HAVING count(*) > 0",
    9: _with(TRIPS, ROUTES) + f"""SELECT total_passengers, total_seats,
  {_percent('total_passengers', 'total_seats')} AS occupancy_pct
FROM (SELECT count(*) AS total_passengers FROM trips HAVING count(*) > 0),
     (SELECT CAST(sum(capacity) AS BIGINT) AS total_seats FROM routes HAVING count(*) > 0)""",
    10: _with(TRIPS) + """SELECT transport_type, count(*) AS passengers, count(*) AS trips,
  CAST(count(*) AS DOUBLE) / count(*) AS avg_passengers
FROM trips WHERE transport_type IS NOT NULL GROUP BY transport_type""",
    11: _with(TRIPS) + _top("trips", "transport_type", "passengers") % "event_id",
    12: _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES) + """SELECT type, route_id, occ AS occupancy FROM o
QUALIFY row_number() OVER (PARTITION BY type ORDER BY occ, event_id) = 1""",
    13: _with(TRIPS) + """SELECT date_trunc('hour', ts) AS window_start, transport_type, count(*) AS trips
FROM trips GROUP BY ALL ORDER BY trips DESC, max(event_id) LIMIT 1""",
    14: _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES, """w AS (
  SELECT date_trunc('hour', ts) AS window_start, type, event_id,
         sum(occ) OVER (PARTITION BY type, date_trunc('hour', ts) ORDER BY event_id) AS total
  FROM o)""") + "SELECT window_start, type, total AS occupancy FROM w ORDER BY total, event_id LIMIT 1",
    15: _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES) + """SELECT operator, route_id, occ AS occupancy FROM o
WHERE operator IS NOT NULL ORDER BY occ DESC, event_id LIMIT 1""",
    16: _with(TRIPS) + _top("trips", "passenger_name") % "event_id",
}

_RESULT_ROWS = {
    4: ("ResultsPassengersPerRoute", "CAST(route_id AS VARCHAR)", "passengers"),
    5: ("ResultsAvailableSeatsPerRoute", "CAST(route_id AS VARCHAR)", "CAST(seats AS VARCHAR)"),
    6: ("ResultsOccupancyPercentagePerRoute", "CAST(route_id AS VARCHAR)", _two_decimals("occupancy_pct") + " || '%'"),
    7: ("ResultsTotalPassengerCount", "'total'", "CAST(total_passengers AS VARCHAR)"),
    8: ("ResultsTotalSeatingAvailable", "'total'", "CAST(total_seats AS VARCHAR)"),
    9: ("ResultsTotalOccupancyPercentage", "'total'", _two_decimals("occupancy_pct") + " || '%'"),
    10: ("ResultsAveragePassengersPerTransportType", "transport_type", _two_decimals("avg_passengers")),
    11: ("ResultsHighestTransportType", "'highest'", "transport_type || '->' || passengers"),
    12: ("ResultsLeastOccupancyPerTransportType", "type",
         "'RouteId: ' || route_id || ' -> Occupancy: ' || CAST(occupancy AS VARCHAR)"),
    13: ("ResultsMostUsedTransportType", "'mostused'", "transport_type || '->' || trips"),
    14: ("ResultsLeastOccupiedTransportType", "'least occupied transport type'",
         "type || ' -> ' || CAST(occupancy AS VARCHAR)"),
    15: ("ResultsMostOccupiedOperator", "'MostOccupiedOperator'", "operator || ' -> ' || CAST(occupancy AS VARCHAR)"),
    16: ("ResultsMostTripsPassenger", "'mosttrips'", "passenger_name || '->' || trips"),
}

RESULT_ROWS = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS result_table, {key} AS id, {'part' if query == 4 else 'CAST(0 AS BIGINT)'} AS part, "
    f"{text} AS result FROM ({Q[query]})"
    for query, (table, key, text) in _RESULT_ROWS.items()
)

_LATEST_ROUTE = "SELECT route_id, origin, destination, type, operator, capacity FROM lc"
_TYPES = "('Bus', 'Taxi', 'Train', 'Metro', 'Scooter')"

SQL = {
    "q04_passengers_per_route": Q[4],
    "q05_seats_per_route": Q[5],
    "q06_occupancy_per_route": Q[6],
    "q07_total_passengers": Q[7],
    "q08_total_seats": Q[8],
    "q09_total_occupancy": Q[9],
    "q10_avg_passengers_per_type": Q[10],
    "q11_top_type": Q[11],
    "q12_least_occupied_route": _with(TRIPS, ROUTES, LATEST) + """SELECT type, route_id, occupancy FROM (
  SELECT lc.type, route_id, CAST(n AS DOUBLE) / lc.capacity AS occupancy
  FROM (SELECT route_id, count(*) AS n FROM trips GROUP BY route_id) JOIN lc USING (route_id))
QUALIFY row_number() OVER (PARTITION BY type ORDER BY occupancy, route_id) = 1""",
    "q12_least_occupied_route_changelog": Q[12],
    "q12_least_occupied_route_asof": _with(TRIPS, ROUTES, TIMELINE, ASOF)
    + """SELECT type, route_id, CAST(n AS DOUBLE) / capacity AS occupancy FROM a
QUALIFY row_number() OVER (PARTITION BY type ORDER BY CAST(n AS DOUBLE) / capacity, ts, event_id) = 1""",
    "q13_top_hourly_type_all": Q[13],
    "q13_top_hourly_type_latest": _with(TRIPS) + """SELECT date_trunc('hour', ts) AS window_start, transport_type,
  count(*) AS trips FROM trips GROUP BY ALL ORDER BY window_start DESC, trips DESC, max(event_id) LIMIT 1""",
    "q14_least_occupied_type_all": _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES, HOURS)
    + "SELECT window_start, type, round(total, 6) AS occupancy FROM h ORDER BY round(total, 12), last_at LIMIT 1",
    "q14_least_occupied_type_latest": _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES, HOURS)
    + """SELECT window_start, type, round(total, 6) AS occupancy FROM h
ORDER BY window_start DESC, round(total, 12), last_at LIMIT 1""",
    "q14_least_occupied_type_changelog": Q[14],
    "q15_top_operator": Q[15],
    "q16_top_passenger": Q[16],
    "q06_shipments": _with(SHIPMENTS) + f"""SELECT route_id, passengers, seats,
  {_percent('passengers', 'seats')} AS occupancy_pct
FROM (SELECT route_id, count(*) AS passengers FROM s GROUP BY route_id)
JOIN (SELECT p_partkey AS route_id, CAST(p_size AS BIGINT) AS seats FROM part) USING (route_id)""",
    "q11_shipments": _with(SHIPMENTS) + _top("s", "transport_type", "passengers") % "place",
    "q13_shipments": _with(SHIPMENTS) + """SELECT date_trunc('hour', ts) AS window_start, transport_type,
  count(*) AS trips FROM s GROUP BY ALL ORDER BY trips DESC, max(place) LIMIT 1""",
    "q15_shipments": _with(SHIPMENTS) + """SELECT p_brand AS operator, route_id, CAST(n AS DOUBLE) / p_size AS occupancy
FROM (SELECT route_id, count(*) AS n, max(place) AS place FROM s GROUP BY route_id)
JOIN part ON p_partkey = route_id ORDER BY occupancy DESC, place LIMIT 1""",
    "q16_shipments": _with(SHIPMENTS) + _top("s", "passenger_name") % "place",
    "trips_scan": _with(TRIPS)
    + "SELECT event_id, ts, route_id, passenger_name, origin, destination, transport_type FROM trips",
    "routes_scan": _with(ROUTES)
    + "SELECT seq, route_id, origin, destination, type, operator, capacity, effective_ts FROM routes",
    "decode_json_events": _with(TRIPS)
    + "SELECT event_id, ts, route_id, passenger_name, origin, destination, transport_type FROM trips",
    "encode_json_events": _with(ROUTES) + """SELECT seq, CAST(route_id AS VARCHAR) AS key,
  CAST(json_object('routeId', route_id, 'origin', origin, 'destination', destination, 'type', type,
                   'operator', operator, 'capacity', capacity) AS VARCHAR) AS value FROM routes""",
    "supplier_snapshot": _with(SUPPLIERS) + "SELECT id, name, type FROM suppliers",
    "capacity_snapshot": "SELECT p_size AS capacity FROM part",
    "list_suppliers": _with(SUPPLIERS) + "SELECT id, name, type FROM suppliers",
    "list_routes": _with(ROUTES, LATEST)
    + "SELECT seq, route_id, origin, destination, type, operator, capacity, effective_ts FROM lc",
    "lookup_supplier": _with(SUPPLIERS) + "SELECT id, name, type FROM suppliers WHERE id = 7",
    "lookup_route": _with(ROUTES, LATEST) + """SELECT seq, route_id, origin, destination, type, operator, capacity,
  effective_ts FROM lc WHERE route_id = 42""",
    "results_scan": RESULT_ROWS,
    "result_rows": RESULT_ROWS,
    "result_envelope": f"""SELECT CAST(route_id AS VARCHAR) AS key,
  '{{"schema":{{"type":"struct","fields":[{{"field":"id","type":"string"}},{{"field":"result","type":"string"}}],'
  || '"optional":false,"name":"ResultsAvailableSeatsPerRoute"}},"payload":{{"id":"' || route_id
  || '","result":"' || seats || '"}}}}' AS value
FROM ({Q[5]})""",
    "upsert_results": f"""SELECT CAST(route_id AS VARCHAR) AS id, CAST(seats AS VARCHAR) AS result FROM ({Q[5]})
UNION ALL SELECT 'total', CAST(total_seats AS VARCHAR) FROM ({Q[8]})""",
    "upsert_routes": _with(ROUTES, LATEST, ROUTE_CHANGES, """changed AS (
  SELECT coalesce(route_id, (SELECT max(route_id) FROM lc)
                  + row_number() OVER (PARTITION BY route_id IS NULL ORDER BY capacity)) AS route_id,
         origin, destination, type, operator, capacity FROM route_changes)""") + f"""{_LATEST_ROUTE}
WHERE route_id NOT IN (SELECT route_id FROM changed)
UNION ALL SELECT route_id, origin, destination, type, operator, capacity FROM changed""",
    "upsert_suppliers": _with(SUPPLIERS, SUPPLIER_CHANGES) + """SELECT id, name, type FROM suppliers
WHERE id NOT IN (SELECT id FROM supplier_changes)
UNION ALL SELECT id, name, type FROM supplier_changes""",
    "latest_per_key": _with(TRIPS) + """SELECT passenger_name, event_id, ts, route_id, transport_type FROM trips
QUALIFY row_number() OVER (PARTITION BY passenger_name ORDER BY event_id DESC) = 1""",
    "route_table": _with(ROUTES, LATEST)
    + "SELECT seq, route_id, origin, destination, type, operator, capacity FROM lc",
    "validate_routes": _with(ROUTES, ROUTE_CHANGES) + f"""SELECT *, CASE
  WHEN route_id IS NULL THEN 'route_id is null' WHEN origin IS NULL THEN 'origin is null'
  WHEN destination IS NULL THEN 'destination is null' WHEN type IS NULL THEN 'type is null'
  WHEN operator IS NULL THEN 'operator is null' WHEN capacity IS NULL THEN 'capacity is null'
  WHEN type NOT IN {_TYPES} THEN 'type not allowed: ' || type
  WHEN operator NOT IN ('OperatorA', 'OperatorB', 'OperatorC') THEN 'operator not allowed: ' || operator
  END AS violation
FROM (SELECT route_id, origin, destination, type, operator, capacity FROM routes
      UNION ALL SELECT * FROM route_changes)""",
    "validate_suppliers": _with(SUPPLIERS) + f"""SELECT *, CASE
  WHEN name IS NULL THEN 'name is null' WHEN type IS NULL THEN 'type is null'
  WHEN type NOT IN {_TYPES} THEN 'type not allowed: ' || type END AS violation
FROM (SELECT id, name, type FROM suppliers
      UNION ALL SELECT s_suppkey, s_name || ' (closed)', {_TYPE.format('s_nationkey')} FROM supplier WHERE s_acctbal < 0
      UNION ALL SELECT NULL, c_name, {_TYPE.format('c_nationkey')} FROM customer
      UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer)""",
    "trip_counts": _with(TRIPS) + """SELECT route_id, count(*) AS trips, min(event_id) AS first_at,
  max(event_id) AS last_at FROM trips GROUP BY route_id""",
    "avg_per_group": """SELECT l_returnflag, sum(l_quantity) AS total, count(l_quantity) AS n,
  sum(l_quantity) / count(l_quantity) AS average FROM lineitem GROUP BY l_returnflag""",
    "trip_count_changelog": _with(TRIPS, CHANGELOG) + "SELECT event_id, ts, route_id, n AS trips_so_far FROM u",
    "lookup_current": _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES) + """SELECT event_id, route_id,
  n AS trips_so_far, type, operator, capacity, occ AS occupancy FROM o""",
    "lookup_asof": _with(TRIPS, ROUTES, TIMELINE, ASOF) + """SELECT event_id, route_id, n AS trips_so_far, seq, type,
  operator, capacity FROM a""",
    "hourly_type_counts": _with(TRIPS) + """SELECT date_trunc('hour', ts) AS window_start, transport_type,
  count(*) AS trips, min(event_id) AS first_at, max(event_id) AS last_at FROM trips GROUP BY ALL""",
    "hourly_type_occupancy": _with(TRIPS, ROUTES, CHANGELOG, LATEST, UPDATES, HOURS) + """SELECT window_start, type,
  round(total, 6) AS occupancy, updates, first_occ AS first_occupancy FROM h""",
    "late_events": _with(TRIPS, """t AS (
  SELECT event_id, ts, route_id, transport_type, route_id % 5 AS source_partition,
         max(ts) OVER (PARTITION BY route_id % 5 ORDER BY event_id) AS stream_time FROM trips)""")
    + "SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR <= stream_time AS late FROM t",
    "late_shipments": _with(LATE_SHIPMENTS)
    + "SELECT ts, source_partition, order_key, line_number, part_key, supplier_key, stream_time, late FROM l",
    "hourly_on_time_shipments": _with(LATE_SHIPMENTS) + """SELECT date_trunc('hour', ts) AS window_start,
  transport_type, count(*) AS trips FROM l WHERE NOT late GROUP BY ALL""",
    "update_times": """SELECT l_partkey AS route_id, l_orderkey AS order_key, l_linenumber AS line_number,
  l_partkey AS part_key, l_suppkey AS supplier_key, l_shipdate AS ts,
  max(l_shipdate) OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS update_ts
FROM lineitem""",
    "keyed_fold": _with(TRIPS) + """SELECT route_id, count(*) AS trips,
  arg_min(passenger_name, event_id) AS first_passenger, arg_max(passenger_name, event_id) AS last_passenger
FROM trips GROUP BY route_id""",
    "parse_occupancy_text": _with(TRIPS, ROUTES, LATEST) + """SELECT route_id, type,
  CAST(n AS DOUBLE) / capacity AS occupancy
FROM (SELECT route_id, count(*) AS n FROM trips GROUP BY route_id) JOIN lc USING (route_id)""",
    "stream_hourly_type_counts": _with(TRIPS) + """SELECT date_trunc('hour', ts) AS window_start, transport_type,
  count(*) AS trips FROM trips GROUP BY ALL""",
    "stream_closed_hours": _with(TRIPS) + """SELECT date_trunc('hour', ts) AS window_start, transport_type,
  count(*) AS trips FROM trips WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM trips)
GROUP BY ALL""",
    "stream_occupancy_per_route": Q[6],
    "stream_top_type": Q[11],
    "stream_results": RESULT_ROWS,
}
SQL["stream_least_occupied_route"] = SQL["q12_least_occupied_route"]

SQL |= {
    "q04_passengers_per_route_in_parts": _names(40),
    "trip_count_changelog_sliced": SQL["trip_count_changelog"],
    "lookup_current_salted": SQL["lookup_current"],
    "q12_least_occupied_route_asof_sliced": SQL["q12_least_occupied_route_asof"],
    "lookup_asof_sliced": SQL["lookup_asof"],
    "late_events_sliced": SQL["late_events"],
    "keyed_fold_in_chunks": SQL["keyed_fold"],
    "decode_json_log": SQL["decode_json_events"],
    "stream_occupancy_per_route_in_batches": SQL["stream_occupancy_per_route"],
    "stream_top_type_in_batches": SQL["stream_top_type"],
    "stream_hourly_type_counts_in_batches": SQL["stream_hourly_type_counts"],
    "stream_trip_count_changelog": SQL["trip_count_changelog"],
    "stream_trip_count_changelog_sliced": SQL["trip_count_changelog"],
    "stream_least_occupied_changelog": Q[12],
    "stream_hourly_on_time_shipments": SQL["hourly_on_time_shipments"],
}

SQL |= {
    "route_table_with_removals": _with(ROUTES, LIVE) + """SELECT 2 * seq AS seq, route_id, origin, destination, type,
  operator, capacity FROM lc""",
    "upsert_removals": _with(ROUTES, LIVE) + "SELECT route_id, type, operator, capacity FROM lc",
    "q12_least_occupied_route_with_removals": SQL["q12_least_occupied_route"].replace(LATEST, LIVE),
    "q15_top_operator_with_removals": Q[15].replace(LATEST, LIVE),
    "q06_changelog": _with(TRIPS, ROUTES, """both_logs AS (
  SELECT route_id, effective_ts AS ts, 0 AS kind, seq AS place, capacity AS seats FROM routes
  UNION ALL SELECT route_id, ts, 1, event_id, 0 FROM trips)""", """totals AS (
  SELECT route_id, ts, kind, place, CAST(sum(kind) OVER w AS BIGINT) AS passengers,
         CAST(sum(seats) OVER w AS BIGINT) AS seats, sum(1 - kind) OVER w AS versions
  FROM both_logs WINDOW w AS (PARTITION BY route_id ORDER BY ts, kind, place ROWS UNBOUNDED PRECEDING))""")
    + f"""SELECT route_id, ts, kind, place, passengers, seats, {_percent('passengers', 'seats')} AS occupancy_pct
FROM totals WHERE passengers > 0 AND versions > 0""",
    "stream_results_with_removals": "\nUNION ALL\n".join(
        f"SELECT '{_RESULT_ROWS[q][0]}' AS result_table, {_RESULT_ROWS[q][1]} AS id, CAST(0 AS BIGINT) AS part, "
        f"{_RESULT_ROWS[q][2]} AS result FROM ({Q[q].replace(LATEST, LIVE)})" for q in (12, 15)
    ),
}
SQL["stream_q06_changelog"] = SQL["q06_changelog"]

SQL |= {
    "keyed_fold_without_merge": _with(TRIPS, CHANGELOG) + """SELECT route_id,
  CAST(sum(CASE WHEN (last - n) % 2 = 0 THEN event_id ELSE -event_id END) AS BIGINT) AS difference
FROM (SELECT *, max(n) OVER (PARTITION BY route_id) AS last FROM u) GROUP BY route_id""",
    "decode_json_strict": _with(TRIPS) + """SELECT event_id, CASE WHEN transport_type <> 'error' THEN route_id END AS route_id,
  CASE WHEN transport_type <> 'error' THEN transport_type END AS transport_type, transport_type = 'error' AS refused,
  CASE WHEN transport_type = 'error' THEN 'delay, note' END AS unknown_fields FROM trips""",
    "poll_suppliers": _with(SUPPLIERS, SUPPLIER_CHANGES, """second AS (
  SELECT * FROM (SELECT * FROM suppliers WHERE id NOT IN (SELECT id FROM supplier_changes)
                 UNION ALL SELECT * FROM supplier_changes) WHERE id % 10 <> 0)""") + """SELECT
  coalesce(b.id, a.id) AS id, b.name, b.type,
  CASE WHEN a.id IS NULL THEN 'inserted' WHEN b.id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM suppliers a FULL JOIN second b ON a.id = b.id
WHERE a.id IS NULL OR b.id IS NULL OR a.name <> b.name OR a.type <> b.type""",
    "observe_metrics": """SELECT 'trips' AS name, count(*) AS rows_in, max(event_id) AS last_at FROM events
UNION ALL SELECT 'type_trips', count(*), NULL FROM events UNION ALL SELECT 'route_trips', count(*), NULL FROM events
UNION ALL SELECT 'route_latest', count(*), NULL FROM part""",
}

# the events are one file and so one batch, in which a route's updates are seen as one
SQL["stream_least_occupied_updates"] = _with(TRIPS, ROUTES, LATEST) + """SELECT lc.type, CAST(n AS DOUBLE) / lc.capacity
  AS occupancy, "at", route_id
FROM (SELECT route_id, count(*) AS n, max(event_id) AS "at" FROM trips GROUP BY route_id) JOIN lc USING (route_id)
QUALIFY row_number() OVER (PARTITION BY lc.type ORDER BY CAST(n AS DOUBLE) / lc.capacity, "at") = 1"""
