"""The same queries as SQL for another engine; times are without a zone and local time is three hours behind."""

from __future__ import annotations

from .queries import REFERENCE
from .fixtures import AS_OF

R2 = 2 * 6_371_000.0
EV = "ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"


def _pos(near: bool = False) -> str:
    last = "abs(k - 30) * 5" if near else "(99 - k) * 5"
    return f"""{EV}, pos AS (SELECT CAST(user_id % 10 AS VARCHAR) || '-10' AS linha_lt, user_id AS veiculo_id, CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END AS linha_sentido, user_id % 5 = 0 AS is_circular, ts AS veiculo_ts,
  date_trunc('minute', ts) AS extracao_ts, CAST(-23.55 + (k - 50) * 0.4 AS DOUBLE) AS veiculo_lat, CAST(-46.63 + ((k * 7) % 100 - 50) * 0.4 AS DOUBLE) AS veiculo_long, CAST(k * 5 AS DOUBLE) AS distance_to_first_stop,
  CAST({last} AS DOUBLE) AS distance_to_last_stop, CAST(CASE WHEN user_id % 37 = 0 THEN 0 ELSE 1000 + 10 * (user_id % 50) END AS DOUBLE) AS trip_linear_distance, event_id FROM ev)"""


#: The dimension by its rule: a trip's two directions are one group; each end is the stop struct with the least or greatest sequence; the second direction shows the first one's.
_STOP = "{'id': s_suppkey, 'name': s_name, 'lat': CAST(-23.9 + (s_suppkey % 70) * 0.01 AS DOUBLE), 'lon': CAST(-46.9 + (s_suppkey % 60) * 0.01 AS DOUBLE)}"
_SIDES = ", ".join(f"{f}(stop, n) FILTER (WHERE way = {way}) AS {name}{way}" for f, name in (("arg_min", "a"), ("arg_max", "z")) for way in (0, 1))
_ENDS = ", ".join(f"{end}.{part} AS {side}_stop_{part}" for end, side in (("a", "first"), ("z", "last")) for part in ("id", "name", "lat", "lon"))
DETAILS = f"""calls AS (SELECT l_orderkey // 2 AS pair, l_orderkey % 2 AS way, l_linenumber AS n, min(CASE WHEN l_orderkey % 10 < 2 THEN 1 + l_orderkey % 7 ELSE l_suppkey END) AS halt FROM lineitem GROUP BY ALL),
pairs AS (SELECT pair, {_SIDES} FROM (SELECT pair, way, n, {_STOP} AS stop FROM calls JOIN supplier ON s_suppkey = halt) GROUP BY pair),
ways AS (SELECT pair || '-10-' || way AS trip_id, coalesce(a0, a1) AS a, coalesce(z0, z1) AS z FROM pairs, (VALUES (0), (1)) AS v(way) WHERE way = 1 OR a0 IS NOT NULL),
det AS (SELECT trip_id, {_ENDS}, round(sqrt((a.lat - z.lat) ** 2 + (a.lon - z.lon) ** 2) * 106428) AS trip_linear_distance, a.id = z.id AS is_circular FROM ways)"""


def _hav(a: str, b: str, c: str, d: str) -> str:
    x = f"(sin(radians({c} - {a}) / 2) * sin(radians({c} - {a}) / 2) + cos(radians({a})) * cos(radians({c})) * sin(radians({d} - {b}) / 2) * sin(radians({d} - {b}) / 2))"
    return f"({R2} * atan2(sqrt({x}), sqrt(1 - {x})))"


def _secs(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 1e6)"


def _speed(p: str, q: str) -> str:
    """Between prefixes of lat, lon and ts columns."""
    s = _secs(f"{p}ts", f"{q}ts")
    return f"CASE WHEN {s} > 0 THEN {_hav(f'{p}lat', f'{p}lon', f'{q}lat', f'{q}lon')} / {s} * 3.6 END"


W = "(PARTITION BY linha_lt, veiculo_id ORDER BY veiculo_ts)"
SAN = f"""s0 AS (SELECT *, {", ".join(f"{f}({c}) OVER {W} AS {p}{n}" for f, p in (("lag", "p"), ("lead", "n")) for c, n in (("veiculo_lat", "lat"), ("veiculo_long", "lon"), ("veiculo_ts", "ts")))}, veiculo_lat AS clat, veiculo_long AS clon, veiculo_ts AS cts FROM pos),
s1 AS (SELECT *, {_speed("p", "c")} AS speed_in, {_speed("c", "n")} AS speed_out, {_speed("p", "n")} AS speed_across FROM s0),
s2 AS (SELECT *, coalesce(speed_in > 120 AND speed_out > 120 AND speed_across <= 120, false) AS cand FROM s1),
s3 AS (SELECT *, sum(CASE WHEN cand THEN 0 ELSE 1 END) OVER {W} AS island FROM s2),
s4 AS (SELECT *, cand AND (row_number() OVER (PARTITION BY linha_lt, veiculo_id, island ORDER BY veiculo_ts) - 1) % 2 = 1 AS spike FROM s3),
san AS (SELECT * FROM s4 WHERE NOT spike)"""
NON = f"""n0 AS (SELECT *, distance_to_first_stop < 100 AS f, distance_to_last_stop < 100 AS l, row_number() OVER {W} AS i FROM san WHERE NOT is_circular),
n1 AS (SELECT *, f OR l AS a, max(CASE WHEN i = 1 AND (f OR l) THEN 1 ELSE 0 END) OVER (PARTITION BY linha_lt, veiculo_id) AS gate, sum(CASE WHEN f OR l THEN 1 ELSE 0 END) OVER {W} AS leg FROM n0),
n2 AS (SELECT *, min(CASE WHEN NOT a THEN linha_sentido END) OVER (PARTITION BY linha_lt, veiculo_id, leg) AS lo, max(CASE WHEN NOT a THEN linha_sentido END) OVER (PARTITION BY linha_lt, veiculo_id, leg) AS hi FROM n1),
n3 AS (SELECT *, lag(i) OVER {W} AS pi, lag(veiculo_ts) OVER {W} AS start_ts, lag(trip_linear_distance) OVER {W} AS dist, lag(lo) OVER {W} AS plo, lag(hi) OVER {W} AS phi, sum(CASE WHEN f <> l THEN 1 ELSE 0 END) OVER {W} AS grp FROM n2 WHERE a),
n4 AS (SELECT *, coalesce(i - pi > 1, false) AS g FROM n3 WHERE grp > 0),
n5 AS (SELECT *, (max(CASE WHEN f <> l THEN CASE WHEN f THEN 1 ELSE 0 END END) OVER (PARTITION BY linha_lt, veiculo_id, grp) + sum(CASE WHEN g AND f AND l THEN 1 ELSE 0 END) OVER (PARTITION BY linha_lt, veiculo_id, grp ORDER BY veiculo_ts)) % 2 AS d FROM n4),
n6 AS (SELECT *, lag(d) OVER {W} AS pd FROM n5),
n7 AS (SELECT *, row_number() OVER {W} AS rn FROM n6 WHERE g AND d <> pd),
non AS (SELECT linha_lt, veiculo_id, start_ts, veiculo_ts AS end_ts, CASE WHEN pd = 1 THEN 1 ELSE 2 END AS direction, coalesce(plo = phi AND plo <> CASE WHEN pd = 1 THEN 1 ELSE 2 END, false) AS discrepancy, false AS is_circular, dist AS distance_meters FROM n7 WHERE gate = 1 OR rn > 1)"""
CIR = f"""c0 AS (SELECT *, distance_to_first_stop < 100 OR distance_to_last_stop < 100 AS a FROM san WHERE is_circular),
c1 AS (SELECT *, max(CASE WHEN a THEN 1 ELSE 0 END) OVER {W} AS synced FROM c0),
c2 AS (SELECT *, lag(a) OVER {W} AS pa, lag(linha_sentido) OVER {W} AS ps FROM c1 WHERE synced = 1),
c3 AS (SELECT *, last_value(CASE WHEN pa IS NULL OR a OR linha_sentido <> ps THEN {{'t': veiculo_ts, 'y': veiculo_lat, 'x': veiculo_long}} END IGNORE NULLS) OVER {W} AS st, {{'t': veiculo_ts, 'y': veiculo_lat, 'x': veiculo_long}} AS here FROM c2),
c4 AS (SELECT *, lag(st) OVER {W} AS fr, lag(here) OVER {W} AS pv FROM c3),
c5 AS (SELECT *, linha_sentido <> ps AS turned, CASE WHEN linha_sentido <> ps THEN pv ELSE here END AS en FROM c4 WHERE NOT pa AND (linha_sentido <> ps OR a)),
cir AS (SELECT linha_lt, veiculo_id, fr.t AS start_ts, en.t AS end_ts, CASE WHEN turned THEN ps ELSE linha_sentido END AS direction, false AS discrepancy, true AS is_circular, {_hav("fr.y", "fr.x", "en.y", "en.x")} AS distance_meters FROM c5)"""


def _materialised(source: str) -> str:
    return f"""m0 AS (SELECT *, CAST(floor({_secs("start_ts", "end_ts")}) AS INTEGER) AS duration_seconds, max(CASE WHEN NOT is_circular AND coalesce(distance_meters, 0) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY linha_lt, veiculo_id) AS failed FROM {source}),
m1 AS (SELECT *, CASE WHEN duration_seconds > 0 THEN distance_meters / duration_seconds * 3.6 ELSE 0.0 END AS avg_speed_kmh FROM m0),
mat AS (SELECT linha_lt || '-' || CASE direction WHEN 1 THEN '0' WHEN 2 THEN '1' ELSE '999' END AS trip_id, linha_lt, veiculo_id AS vehicle_id, start_ts AS trip_start_time, end_ts AS trip_end_time, duration_seconds, is_circular, CAST(direction AS INTEGER) AS direction, discrepancy, distance_meters, avg_speed_kmh,
  CASE WHEN failed = 1 THEN 'group_failed' WHEN avg_speed_kmh > 80 THEN 'too_fast' END AS left_out FROM m1)"""


TRIP = "trip_id, vehicle_id, trip_start_time, trip_end_time, duration_seconds, is_circular, direction, round(distance_meters, 4) AS distance_meters, round(avg_speed_kmh, 4) AS avg_speed_kmh"
BOTH = f"{_pos()}, {SAN}, {NON}, {CIR}, alls AS (SELECT * FROM non UNION ALL SELECT * FROM cir), {_materialised('alls')}"
METRICS = """met AS (SELECT (SELECT count(*) FROM pos) AS positions, (SELECT count(*) FROM s4 WHERE spike) AS spikes, (SELECT count(DISTINCT (linha_lt, veiculo_id)) FROM pos) AS groups_total, count(*) AS trips_detected, count(*) FILTER (left_out IS NULL) AS trips_total,
  count(*) FILTER (left_out IS NULL AND is_circular) AS trips_circular, count(*) FILTER (left_out IS NULL AND NOT is_circular) AS trips_non_circular, count(*) FILTER (left_out = 'too_fast') AS trips_too_fast, count(*) FILTER (discrepancy AND coalesce(left_out, '') <> 'group_failed') AS discrepancies,
  count(DISTINCT (linha_lt, vehicle_id)) FILTER (left_out = 'group_failed') AS groups_failed FROM mat)"""
FIN = f"""{EV}, fin AS (SELECT CAST(user_id % 10 AS VARCHAR) || '-10-' || CAST(k % 2 AS VARCHAR) AS trip_id, user_id AS vehicle_id, ts AS trip_start_time, CAST(60 + k * 30 AS INTEGER) AS duration_seconds, ts + to_seconds(60 + k * 30) AS trip_end_time, user_id % 5 = 0 AS is_circular,
  CAST(500 + k * 100 + value AS DOUBLE) AS distance_meters, CAST(500 + k * 100 + value AS DOUBLE) / (60 + k * 30) * 3.6 AS avg_speed_kmh, date_trunc('day', ts) AS logic_date FROM ev)"""


def _key(ts: str) -> str:
    return f"CAST(strftime({ts} - INTERVAL 3 HOUR, '%Y%m%d%H') AS INTEGER)"


def _facts(source: str = "fin") -> str:
    return f"""fac AS (SELECT trip_id, vehicle_id, left(trip_id, length(trip_id) - 2) AS route_id, CASE right(trip_id, 1) WHEN '0' THEN 1 WHEN '1' THEN 2 END AS direction, trip_start_time AS started_at, trip_end_time AS ended_at, duration_seconds, is_circular, distance_meters, avg_speed_kmh,
  {_key("trip_start_time")} AS started_at_time_dim_key, {_key("trip_end_time")} AS ended_at_time_dim_key, logic_date FROM {source}),
dim AS (SELECT CAST(strftime(day_, '%Y%m%d') AS INTEGER) * 100 + h AS time_key, CAST(day_ AS DATE) AS date_actual, CAST(month(day_) AS INTEGER) AS month, CAST(day(day_) AS INTEGER) AS day, CAST(h AS INTEGER) AS hour_of_day, CAST(isodow(day_) AS INTEGER) AS weekday, isodow(day_) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(date_trunc('day', min(trip_start_time) - INTERVAL 3 HOUR), date_trunc('day', max(trip_end_time) - INTERVAL 3 HOUR), INTERVAL 1 DAY)) AS day_ FROM {source}) CROSS JOIN (SELECT unnest(range(24)) AS h)),
sta AS (SELECT * FROM fac JOIN dim ON started_at_time_dim_key = time_key)"""


FACTS = f"{FIN}, {_facts()}"


def _one(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18, 6)), 1) AS DOUBLE)"


P50, P95 = "quantile_cont(duration_seconds, 0.5)", "quantile_cont(duration_seconds, 0.95)"
PANEL = f"SELECT route_id, {_one(P50 + ' / 60')} AS median_duration_minutes, {_one(P95 + ' / 60')} AS p95_duration_minutes, count(*) AS trip_count FROM sta GROUP BY route_id HAVING count(*) >= "
ENR = f"""{_pos()}, {DETAILS}, e0 AS (SELECT p.linha_lt, p.linha_sentido, p.veiculo_id, p.event_id, CASE WHEN p.event_id % 7 <> 0 THEN p.veiculo_lat END AS lat, p.veiculo_long AS lon, p.linha_lt || '-' || CASE p.linha_sentido WHEN 1 THEN '0' ELSE '1' END AS trip_id FROM pos p),
e1 AS (SELECT e0.*, d.trip_id AS known, CASE WHEN lat IS NULL OR first_stop_lat IS NULL THEN -1.0 ELSE round({_hav("lat", "lon", "first_stop_lat", "first_stop_lon")}) END AS distance_to_first_stop, CASE WHEN lat IS NULL OR last_stop_lat IS NULL THEN -1.0 ELSE round({_hav("lat", "lon", "last_stop_lat", "last_stop_lon")}) END AS distance_to_last_stop FROM e0 LEFT JOIN det d ON d.trip_id = e0.trip_id),
enr AS (SELECT *, CASE WHEN known IS NULL THEN 'transform_error:trip_details_missing' WHEN distance_to_first_stop = -1 OR distance_to_last_stop = -1 THEN 'transform_error:distance_calculation' END AS invalid_reason FROM e1)"""
RULES = """ru AS (SELECT *, list_filter([CASE WHEN l_shipdate IS NULL THEN 'expect_column_values_to_not_be_null:l_shipdate' END, CASE WHEN l_quantity < 2 OR l_quantity > 45 THEN 'expect_column_values_to_be_between:l_quantity' END, CASE WHEN l_discount > 0.09 THEN 'expect_column_values_to_be_between:l_discount' END,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'expect_column_values_to_be_in_set:l_returnflag' END], lambda r: r IS NOT NULL) AS reasons FROM lineitem)"""
SUMS = """su AS (SELECT o_orderpriority AS pipeline, CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'P' THEN 'WARN' ELSE 'PASS' END AS status, o_custkey % 20 AS items_failed, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 1 - (o_orderkey % 50) / 1000 END AS acceptance_rate, o_orderdate AS received_at, o_orderkey AS seq FROM orders)"""
RAWS = "raws AS (SELECT date_trunc('minute', veiculo_ts) AS taken, veiculo_id % 16 AS slice, * FROM pos)"
FLEET = f"lat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY veiculo_id ORDER BY veiculo_ts DESC) AS n, linha_lt || CASE linha_sentido WHEN 1 THEN '-0' WHEN 2 THEN '-1' END AS trip_id FROM pos) WHERE n = 1)"


def _windows(extra: str = "") -> str:
    """Each event in the four windows of an hour that end on a quarter after it."""
    return f"{EV}, win AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) + to_minutes(15 * s) AS tick FROM ev CROSS JOIN (SELECT unnest(range(1, 5)) AS s){extra})"


def _latest_run() -> str:
    return f"""{SUMS}, d0 AS (SELECT su.*, t.* EXCLUDE (pipeline) FROM su LEFT JOIN (VALUES ('1-URGENT', 500, 0.2, 3, true, true), ('2-HIGH', 60, 0.5, 3, true, true), ('3-MEDIUM', 10000, 1.0, 2, true, true), ('5-LOW', 60, 0.5, 3, false, false)) t(pipeline, mi, mr, mc, nf, nw) ON t.pipeline = su.pipeline),
d1 AS (SELECT *, epoch(date_trunc('second', received_at)) AS sec, count(*) OVER o AS n FROM d0 WINDOW o AS (PARTITION BY pipeline ORDER BY received_at, seq)),
d2 AS (SELECT *, least(n - coalesce(max(CASE WHEN status <> 'WARN' THEN n END) OVER (PARTITION BY pipeline ORDER BY received_at, seq), 0), count(*) OVER w) AS run, sum(items_failed) OVER w AS items, avg(1 - coalesce(acceptance_rate, 0)) OVER w AS ratio FROM d1 WINDOW w AS (PARTITION BY pipeline ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW))"""


ORACLE_SQL: dict[str, str] = {
    "trips_noncircular": f"WITH {_pos()}, {SAN}, {NON}, {_materialised('non')} SELECT {TRIP} FROM mat WHERE left_out IS NULL",
    "trips_noncircular_overlap": f"WITH {_pos(True)}, {SAN}, {NON}, {_materialised('non')} SELECT {TRIP} FROM mat WHERE left_out IS NULL",
    "trips_circular": f"WITH {_pos()}, {SAN}, {CIR}, {_materialised('cir')} SELECT {TRIP} FROM mat WHERE left_out IS NULL",
    "trips_all_with_discrepancy": f"WITH {BOTH} SELECT {TRIP}, discrepancy, left_out FROM mat",
    "trips_segmented": f"WITH {BOTH} SELECT {TRIP}, discrepancy, left_out FROM mat",
    "extraction_metrics": f"WITH {BOTH}, {METRICS} SELECT * FROM met",
    "p50_p95_route_from_positions": f"WITH {BOTH}, src AS (SELECT *, trip_end_time AS logic_date FROM mat WHERE left_out IS NULL), {_facts('src')} {PANEL} 1",
    "sanitize_spikes": f"WITH {_pos()}, {SAN} SELECT linha_lt, veiculo_id, veiculo_ts, round(speed_in, 2) AS speed_in, round(speed_out, 2) AS speed_out, round(speed_across, 2) AS speed_across FROM s4 WHERE spike",
    "terminal_distances": f"WITH {ENR} SELECT event_id, trip_id, distance_to_first_stop, distance_to_last_stop, invalid_reason FROM enr",
    "nearest_quality_split": f"WITH {ENR} SELECT linha_lt, invalid_reason, count(*) AS n FROM enr GROUP BY ALL",
    "transform_metrics": f"""WITH {ENR} SELECT count(*) AS total_vehicles, count(*) FILTER (invalid_reason IS NULL) AS valid_vehicles, count(*) FILTER (invalid_reason IS NOT NULL) AS invalid_vehicles, count(DISTINCT linha_lt) AS total_lines, round(count(*) FILTER (invalid_reason IS NULL) / count(*) * 100, 2) AS quality_score,
  count(DISTINCT trip_id) FILTER (invalid_reason IS NOT NULL) AS invalid_trips, count(veiculo_id) FILTER (invalid_reason IS NOT NULL) AS invalid_vehicle_ids, count(DISTINCT linha_lt) FILTER (invalid_reason IS NOT NULL) AS lines_with_invalid, count(*) FILTER (invalid_reason = 'transform_error:distance_calculation') AS distance_errors FROM enr""",
    "transform_issues": f"""WITH {ENR}, x AS (SELECT 'invalid_vehicle' AS kind, CAST(veiculo_id AS VARCHAR) AS value FROM enr WHERE invalid_reason IS NOT NULL UNION ALL SELECT 'invalid_trip', trip_id FROM enr WHERE invalid_reason IS NOT NULL)
  SELECT kind, value, count(*) AS n FROM x WHERE value IS NOT NULL GROUP BY ALL""",
    "trip_details": f"WITH {DETAILS} SELECT * REPLACE (round(first_stop_lat, 6) AS first_stop_lat, round(first_stop_lon, 6) AS first_stop_lon, round(last_stop_lat, 6) AS last_stop_lat, round(last_stop_lon, 6) AS last_stop_lon) FROM det",
    "trip_details_refined": f"WITH {DETAILS}, x AS (SELECT *, is_circular AND trip_id LIKE '%-0' AS z, is_circular AND trip_id LIKE '%-1' AS o FROM det) SELECT trip_id, "
    + ", ".join(f"CASE WHEN NOT {f} THEN {'round(' * (p in ('lat', 'lon'))}{s}_stop_{p}{', 6)' * (p in ('lat', 'lon'))} END AS {s}_stop_{p}" if p != "name" else f"CASE WHEN {f} THEN 'Parada intermediaria' ELSE {s}_stop_name END AS {s}_stop_name" for s, f in (("first", "o"), ("last", "z")) for p in ("id", "name", "lat", "lon"))
    + ", trip_linear_distance, is_circular FROM x",
    "flatten_snapshot": f"WITH {_pos()}, {RAWS} SELECT taken AS extracao_ts, linha_lt, linha_sentido, veiculo_id, veiculo_ts, round(veiculo_lat, 4) AS veiculo_lat, round(veiculo_long, 4) AS veiculo_long, linha_lt || '-' || CASE linha_sentido WHEN 1 THEN '0' ELSE '1' END AS trip_id FROM raws",
    "payload_reconciliation": f"WITH {_pos()}, {RAWS} SELECT strftime(taken, '%Y-%m-%dT%H:%M:00') AS extracted_at, count(DISTINCT (slice, linha_lt, linha_sentido)) AS lines, count(*) AS announced, count(*) AS listed FROM raws GROUP BY taken",
    "rules_valid": f"WITH {RULES} SELECT * EXCLUDE (reasons) FROM ru WHERE len(reasons) = 0",
    "rules_invalid": f"WITH {RULES} SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, array_to_string(reasons, '; ') AS invalid_reason FROM ru WHERE len(reasons) > 0",
    "suite_exceptions": f"""WITH {RULES}, c AS (SELECT count(*) AS n FROM ru WHERE l_quantity < 2 OR l_quantity > 45) SELECT CAST(5 AS BIGINT) AS total_checks, CAST(3 - CASE WHEN c.n > 0 THEN 1 ELSE 0 END AS BIGINT) AS expectations_successful, CAST(CASE WHEN c.n > 0 THEN 1 ELSE 0 END AS BIGINT) AS expectations_with_violations,
  CAST(2 AS BIGINT) AS expectations_failed_due_to_exceptions, c.n AS rows_failed, (SELECT count(*) FROM ru) AS total_rows, 'expect_column_values_to_not_be_null:no column l_missing; expect_column_values_to_be_between:no parameter absent' AS exceptions FROM c""",
    "rules_summary": f"""WITH {RULES}, c AS (SELECT r, count(*) AS n FROM (SELECT unnest(reasons) AS r FROM ru) GROUP BY r), v AS (SELECT count(*) + 1 AS n, string_agg(r || '=' || n, '; ' ORDER BY r) AS reasons FROM c)
  SELECT CAST(6 AS BIGINT) AS total_checks, 6 - v.n AS expectations_successful, v.n AS expectations_with_violations, (SELECT count(*) FROM ru WHERE len(ru.reasons) > 0) AS rows_failed, (SELECT count(*) FROM ru) AS total_rows, v.reasons FROM v""",
    "acceptance_policy": f"WITH {RULES}, r AS (SELECT count(*) FILTER (len(reasons) = 0) / count(*) AS x FROM ru) SELECT round(x, 6) AS acceptance_rate, CASE WHEN x >= 0.98 THEN 'WARN' ELSE 'FAIL' END AS status FROM r",
    "unique_violations": "SELECT o_orderkey, o_custkey, 'expect_column_values_to_be_unique:o_custkey' AS invalid_reason FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
    "compound_unique_violations": "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, 'expect_compound_columns_to_be_unique:l_orderkey,l_linenumber' AS invalid_reason FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    "freshness_check": f"WITH {_pos()}, x AS (SELECT round((epoch_us(TIMESTAMP '{REFERENCE}') - epoch_us(max(veiculo_ts))) / 60e6, 2) AS m FROM pos) SELECT m AS observed_lag_minutes, CASE WHEN m > 30 THEN 'FAIL' WHEN m > 10 THEN 'WARN' ELSE 'PASS' END AS status FROM x",
    "gap_check": f"""WITH {_pos()}, r AS (SELECT DISTINCT extracao_ts AS t FROM pos WHERE extracao_ts >= TIMESTAMP '{REFERENCE}' - INTERVAL 60 MINUTE), g AS (SELECT (epoch_us(t) - epoch_us(lag(t) OVER (ORDER BY t))) / 60e6 AS g FROM r), a AS (SELECT count(*) AS n, round(max(g), 2) AS m FROM g)
  SELECT n AS distinct_extracao_ts, m AS max_gap_minutes, CASE WHEN n < 2 OR m > 15 THEN 'FAIL' WHEN m > 5 THEN 'WARN' ELSE 'PASS' END AS status FROM a""",
    "trip_quality_checks": f"""WITH {BOTH}, {METRICS}, w AS (SELECT round((epoch_us(max(extracao_ts)) - epoch_us(min(extracao_ts))) / 60e6, 2) AS m FROM pos), q AS (SELECT m, trips_total, round(groups_failed / groups_total, 4) AS r, CASE WHEN m > 60 AND trips_total = 0 THEN 'WARN' ELSE 'PASS' END AS z, CASE WHEN m > 60 AND trips_total < 5 THEN 'WARN' ELSE 'PASS' END AS l FROM met, w)
  SELECT m AS effective_window_minutes, trips_total, r AS group_failure_rate, z AS zero_trips, l AS low_trip_count, CASE WHEN r > 0.05 THEN 'WARN' ELSE 'PASS' END AS group_failures, CASE WHEN 'WARN' IN (z, l) OR r > 0.05 THEN 'WARN' ELSE 'PASS' END AS status FROM q""",
    "fact_quality_checks": f"""WITH {FACTS}, m AS (SELECT count(*) AS persisted_facts, count(*) FILTER (duration_seconds < 0) AS negative_duration, count(*) FILTER (distance_meters < 0) AS negative_distance, count(*) FILTER (started_at > ended_at) AS time_incoherent, count(*) FILTER (avg_speed_kmh NOT BETWEEN 0 AND 80) AS implausible_speed,
  (SELECT count(*) FROM fin) AS finished_trips_read, (SELECT count(*) FROM fac WHERE started_at_time_dim_key NOT IN (SELECT time_key FROM dim) OR ended_at_time_dim_key NOT IN (SELECT time_key FROM dim)) AS uncovered_dim_keys FROM fac),
  s AS (SELECT *, (finished_trips_read - persisted_facts) / finished_trips_read AS loss_rate, CASE WHEN uncovered_dim_keys > 0 THEN 'FAIL' ELSE 'PASS' END AS coverage, CASE WHEN negative_duration + negative_distance + time_incoherent + implausible_speed > 0 THEN 'FAIL' ELSE 'PASS' END AS value_domain FROM m)
  SELECT * REPLACE (round(loss_rate, 6) AS loss_rate), CASE WHEN loss_rate > 0.05 THEN 'FAIL' WHEN loss_rate > 0.01 THEN 'WARN' ELSE 'PASS' END AS completeness, CASE WHEN 'FAIL' IN (coverage, value_domain) OR loss_rate > 0.05 THEN 'FAIL' WHEN loss_rate > 0.01 THEN 'WARN' ELSE 'PASS' END AS status FROM s""",
    "dim_time": f"WITH {FACTS} SELECT * FROM dim",
    "trip_facts": f"WITH {FACTS} SELECT * FROM fac",
    "trip_facts_incremental": f"WITH {FACTS} SELECT * FROM fac WHERE logic_date = TIMESTAMP '{AS_OF}' AND vehicle_id % 2 <> 0",
    "finished_trips_incremental": f"WITH {FIN} SELECT trip_id, vehicle_id, trip_start_time, trip_end_time, duration_seconds FROM fin WHERE trip_end_time > (SELECT max(trip_end_time) FROM fin WHERE trip_end_time < TIMESTAMP '{AS_OF}')",
    "uncovered_dim_keys": f"WITH {FACTS}, h AS (SELECT time_key FROM dim WHERE hour_of_day % 5 <> 0 OR day % 2 = 0) SELECT trip_id, vehicle_id, started_at, started_at_time_dim_key, ended_at_time_dim_key FROM fac WHERE NOT EXISTS (SELECT 1 FROM h WHERE time_key = started_at_time_dim_key) OR NOT EXISTS (SELECT 1 FROM h WHERE time_key = ended_at_time_dim_key)",
    "retention_keep": f"WITH {FACTS} SELECT route_id, count(*) AS n, min(started_at) AS oldest FROM fac WHERE started_at >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY GROUP BY route_id",
    "pending_ledger": "SELECT 'posicoes_onibus-' || o_orderkey || '.json' AS filename, o_orderdate AS created_at FROM orders WHERE NOT (o_orderkey % 3 <> 0 AND o_orderstatus <> 'P')",
    "queue_metrics": """WITH q AS (SELECT date_trunc('day', o_orderdate) AS d, o_orderkey AS k, o_orderstatus AS s FROM orders), p AS (SELECT * FROM q WHERE s = 'P'), r AS (SELECT d, CASE s WHEN 'F' THEN 'failed' ELSE 'success' END AS state FROM q WHERE s <> 'P' AND k % 3 = 0),
  t AS (SELECT x.d, state FROM (SELECT DISTINCT d FROM p) x LEFT JOIN r ON r.d = x.d)
  SELECT (SELECT count(*) FROM p) AS pending_requests_total, (SELECT count(DISTINCT d) FROM p) AS pending_logical_dates_total, count(*) FILTER (state IS NULL) AS state_no_run, CAST(0 AS BIGINT) AS state_queued, CAST(0 AS BIGINT) AS state_running, count(*) FILTER (state = 'success') AS state_success,
  count(*) FILTER (state = 'failed') AS state_failed, CAST(0 AS BIGINT) AS state_other, (SELECT count(*) FROM q WHERE k % 4 = 0) AS outcome_triggered, (SELECT count(*) FROM q WHERE k % 4 = 1) AS outcome_skipped_running, (SELECT count(*) FROM q WHERE k % 4 = 2) AS outcome_skipped_existing, (SELECT count(*) FROM q WHERE k % 4 = 3) AS outcome_failed FROM t""",
    "queue_summary": "SELECT o_orderstatus AS state, count(*) AS requests, count(DISTINCT date_trunc('day', o_orderdate)) AS logical_dates FROM orders GROUP BY 1",
    "kpis_today": f"WITH {FACTS} SELECT count(*) AS trips_completed_today, count(DISTINCT route_id) AS active_routes_today, count(DISTINCT vehicle_id) AS active_vehicles_today FROM fac JOIN dim ON ended_at_time_dim_key = time_key WHERE date_actual = DATE '{AS_OF}'",
    "latest_batch": f"WITH {FACTS} SELECT max(logic_date) AS latest_batch_ts, count(*) FILTER (logic_date = (SELECT max(logic_date) FROM fac)) AS latest_batch_trip_count FROM fac",
    "freq_route_hour_dir": f"WITH {FACTS} SELECT route_id, direction, hour_of_day, is_circular, count(*) AS trip_count FROM sta GROUP BY ALL",
    "freq_filtered": f"WITH {FACTS} SELECT route_id, direction, hour_of_day, is_circular, count(*) AS trip_count FROM sta WHERE date_actual BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND direction = 1 AND NOT is_weekend AND NOT is_circular GROUP BY ALL",
    "p50_p95_route": f"WITH {FACTS} {PANEL} 5",
    "p50_p95_route_direction": f"WITH {FACTS} SELECT route_id, direction, is_circular, round({P50}, 4) AS median_duration_seconds, round({P95}, 4) AS p95_duration_seconds, count(*) AS trip_count FROM fac GROUP BY ALL",
    "today_vs_baseline": f"""WITH {FACTS}, y AS (SELECT route_id, date_actual, {P50} AS m FROM sta WHERE weekday = isodow(DATE '{AS_OF}') AND date_actual >= DATE '{AS_OF}' - 28 AND date_actual < DATE '{AS_OF}' GROUP BY ALL), b AS (SELECT route_id, avg(m) AS m FROM y GROUP BY route_id), t AS (SELECT route_id, {P50} AS m FROM sta WHERE date_actual = DATE '{AS_OF}' GROUP BY route_id)
  SELECT t.route_id, {_one("t.m / 60")} AS today_median_minutes, {_one("b.m / 60")} AS baseline_median_minutes, CAST(round(CAST((t.m - b.m) / nullif(b.m, 0) * 100 AS DECIMAL(18, 6)), 2) AS DOUBLE) AS deviation_pct FROM t LEFT JOIN b USING (route_id)""",
    "today_vs_pooled": f"""WITH {FACTS}, h AS (SELECT route_id, is_circular, {P50} AS m FROM sta WHERE weekday = isodow(DATE '{AS_OF}') AND date_actual >= DATE '{AS_OF}' - 28 AND date_actual < DATE '{AS_OF}' GROUP BY ALL), t AS (SELECT route_id, is_circular, {P50} AS m FROM sta WHERE date_actual = DATE '{AS_OF}' GROUP BY ALL)
  SELECT t.route_id, t.is_circular, t.m AS today_median_seconds, h.m AS historical_median_seconds, CAST(round(CAST((t.m - h.m) / nullif(h.m, 0) * 100 AS DECIMAL(18, 6)), 2) AS DOUBLE) AS deviation_pct FROM t LEFT JOIN h ON h.route_id = t.route_id""",
    "duration_by_hour": f"WITH {FACTS} SELECT hour_of_day, {_one('avg(duration_seconds) / 60')} AS avg_duration_minutes, count(*) AS trip_count FROM sta GROUP BY ALL",
    "speed_by_hour": f"WITH {FACTS} SELECT hour_of_day, round(avg(avg_speed_kmh), 6) AS avg_speed_kmh, count(*) AS trip_count FROM sta GROUP BY ALL",
    "speed_by_route_hour": f"WITH {FACTS} SELECT route_id, hour_of_day, is_circular, round(avg(avg_speed_kmh), 6) AS avg_speed_kmh, count(*) AS trip_count FROM sta GROUP BY ALL",
    "route_summary": f"WITH {FACTS}, {DETAILS} SELECT route_id, first_stop_name, last_stop_name, det.is_circular, count(*) AS total_trips, {_one(P50 + ' / 60')} AS median_duration_minutes, round(avg(avg_speed_kmh), 6) AS avg_speed_kmh, round(stddev_samp(duration_seconds) / nullif(avg(duration_seconds), 0), 6) AS duration_consistency FROM sta JOIN det USING (trip_id) WHERE route_id = '3-10' GROUP BY ALL",
    "reliability_by_route": f"WITH {FACTS} SELECT route_id, is_circular, round(stddev_samp(duration_seconds) / nullif(avg(duration_seconds), 0), 6) AS reliability_index, count(*) AS trip_count FROM fac GROUP BY ALL",
    "p50_p95_route_sketched": f"WITH {FACTS} SELECT route_id, {_one('quantile_disc(duration_seconds, 0.5) / 60')} AS median_duration_minutes, {_one('quantile_disc(duration_seconds, 0.95) / 60')} AS p95_duration_minutes, count(*) AS trip_count FROM sta GROUP BY route_id HAVING count(*) >= 5",
    "live_table": f"WITH {_pos()}, {FLEET} SELECT veiculo_ts, veiculo_id, round(veiculo_lat, 4) AS veiculo_lat, round(veiculo_long, 4) AS veiculo_long, linha_lt, linha_sentido FROM lat WHERE veiculo_ts >= (SELECT max(extracao_ts) FROM pos) - INTERVAL 24 HOUR",
    "latest_positions": f"WITH {_pos()}, {FLEET} SELECT veiculo_ts, veiculo_id, round(veiculo_lat, 4) AS veiculo_lat, round(veiculo_long, 4) AS veiculo_long, linha_lt, linha_sentido, trip_id FROM lat",
    "live_fleet": f"WITH {_pos()}, {FLEET}, {DETAILS} SELECT veiculo_id, linha_lt, linha_sentido, round(veiculo_lat, 4) AS veiculo_lat, round(veiculo_long, 4) AS veiculo_long, veiculo_ts, first_stop_name, last_stop_name, det.is_circular FROM lat LEFT JOIN det ON det.trip_id = lat.trip_id",
    "live_fleet_of_line": f"WITH {_pos()}, {FLEET}, {DETAILS} SELECT veiculo_id, linha_lt, linha_sentido, round(veiculo_lat, 4) AS veiculo_lat, round(veiculo_long, 4) AS veiculo_long, veiculo_ts, first_stop_name, last_stop_name, det.is_circular FROM lat LEFT JOIN det ON det.trip_id = lat.trip_id WHERE linha_lt = '3-10' AND linha_sentido = 1",
    "live_freshness_of_line": f"WITH {_pos()}, {FLEET} SELECT count(*) AS active_vehicle_count, max(veiculo_ts) AS latest_snapshot_ts, CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(veiculo_ts))) AS BIGINT) AS snapshot_age_seconds FROM lat WHERE linha_lt = '3-10'",
    "live_freshness": f"WITH {_pos()}, {FLEET} SELECT count(*) AS active_vehicle_count, max(veiculo_ts) AS latest_snapshot_ts, CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(veiculo_ts))) AS BIGINT) AS snapshot_age_seconds FROM lat",
    "trip_monitor": f"WITH {FACTS} SELECT route_id, CASE WHEN hour_of_day < 6 THEN 'night' WHEN hour_of_day < 12 THEN 'morning' WHEN hour_of_day < 18 THEN 'afternoon' ELSE 'evening' END AS period, count(*) AS trips, min(started_at) AS first_start, max(ended_at) AS last_end, round(avg(duration_seconds), 6) AS avg_duration_seconds FROM sta WHERE started_at >= TIMESTAMP '2024-01-20' GROUP BY ALL",
    "vehicle_inventory": f"WITH {_pos()} SELECT linha_lt, veiculo_id, count(*) AS n, min(veiculo_ts) AS first_ts, max(veiculo_ts) AS last_ts, min(linha_sentido) AS min_sentido, max(linha_sentido) AS max_sentido FROM pos GROUP BY ALL",
    "explore_vehicle": f"WITH {_pos()} SELECT veiculo_id, veiculo_ts, linha_sentido, round(veiculo_lat, 4) AS veiculo_lat, round(veiculo_long, 4) AS veiculo_long FROM pos WHERE linha_lt = '3-10' AND hour(veiculo_ts) BETWEEN 6 AND 9",
    "event_rate": f"WITH {_windows()} SELECT tick, event_type, count(*) AS n FROM win GROUP BY ALL",
    "metric_over_time": f"WITH {_windows()} SELECT tick, event_type, round(avg(value), 8) AS avg_value, round(max(value), 8) AS max_value, round(sum(value), 8) AS sum_value, round(arg_max(value, (ts, event_id)), 8) AS last_value FROM win GROUP BY ALL",
    "acceptance_ratio_window": f"WITH {_windows()}, r AS (SELECT tick, coalesce(sum(value) FILTER (event_type <> 'error'), 0) / nullif(sum(value), 0) AS ratio FROM win GROUP BY tick) SELECT tick, round(ratio, 4) AS ratio FROM r WHERE ratio < 0.98",
    "absence_alerts": f"WITH {_windows()} SELECT tick FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-30', INTERVAL 15 MINUTE)) AS tick) WHERE tick NOT IN (SELECT tick FROM win WHERE event_type = 'purchase')",
    "alerts_by_execution": f"WITH {_windows()}, c AS (SELECT tick, user_id, count(*) FILTER (event_type = 'error') AS n_first, count(*) FILTER (event_type = 'view' AND value > 20) AS n_second FROM win GROUP BY tick, user_id) SELECT * FROM c WHERE n_first >= 2 OR n_second >= 2",
    "threshold_alerts": f"WITH {_windows()} SELECT tick, event_type, round(max(value), 4) AS max_value FROM win GROUP BY ALL HAVING max(value) > 60",
    "event_listing": f"WITH {EV} SELECT event_id, ts, event_type, value FROM ev WHERE event_type IN ('error', 'signup')",
    "cumulative_warn": f"""WITH {SUMS}, n AS (SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY received_at DESC, seq DESC) AS n FROM su), a AS (SELECT pipeline, CAST(sum(items_failed) AS BIGINT) AS items_failed, avg(1 - coalesce(acceptance_rate, 0)) AS r, coalesce(min(n) FILTER (status <> 'WARN'), count(*) + 1) - 1 AS consecutive_warn FROM n WHERE n <= 100 GROUP BY pipeline)
  SELECT pipeline, items_failed, round(r, 4) AS avg_failed_ratio, consecutive_warn, items_failed >= 500 OR r >= 0.02 OR consecutive_warn >= 3 AS cumulative_warn FROM a""",
    "notification_decision": f"""WITH {_latest_run()} SELECT pipeline, seq, status, CASE WHEN status = 'PASS' THEN 'stored:pass_status' WHEN mi IS NULL THEN 'ignored:unknown_pipeline' WHEN status = 'FAIL' AND nf THEN 'sent:fail' WHEN status = 'WARN' AND nw AND (items >= mi OR ratio >= mr OR run >= mc) THEN 'sent:cumulative_warn' ELSE 'stored' END AS decision FROM d2""",
    "notification_decision_since": f"""WITH {_latest_run()} SELECT pipeline, seq, status, CASE WHEN status = 'PASS' THEN 'stored:pass_status' WHEN mi IS NULL THEN 'ignored:unknown_pipeline' WHEN status = 'FAIL' AND nf THEN 'sent:fail' WHEN status = 'WARN' AND nw AND (items >= mi OR ratio >= mr OR run >= mc) THEN 'sent:cumulative_warn' ELSE 'stored' END AS decision FROM d2 WHERE received_at >= DATE '1995-06-17'""",
    "correlation_id_lists": f"WITH {EV}, i AS (SELECT user_id, list_sort(list(DISTINCT CAST(event_id AS VARCHAR))) AS l FROM ev GROUP BY user_id) SELECT user_id, array_to_string(l[1:50], ',') AS ids, CAST(len(l) AS INTEGER) AS total, len(l) > 50 AS truncated FROM i",
}
