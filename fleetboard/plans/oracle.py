"""DuckDB SQL with the meaning of each query, written from the definitions.

The leading CTEs rebuild the transit-shaped views of ``feeds.py``.
"""

from __future__ import annotations

from fleetboard.operators.paging import PAGE_SECONDS, PAGE_SIZE
from fleetboard.plans.maintained import AFTER_S, BEFORE_S, LATE_S, POLL_DAYS, TTL_S
from fleetboard.plans.queries import POS_HORIZON, POS_NOW, SELECTED, TRIP_HORIZON, TRIP_NOW


def _local(seconds: str, zone: str = "America/Chicago") -> str:
    return f"strftime(timezone('{zone}', to_timestamp({seconds})), '%Y-%m-%d %H:%M:%S')"


def _trip(number: str) -> str:
    return f"CAST(CASE WHEN {number} % 7 = 0 THEN {number} + 1000000000 ELSE {number} END AS VARCHAR)"


def _page(number: str, size: int) -> str:
    return f"CAST(coalesce(floor({number} / {size}), -1) AS BIGINT) AS page"


VIEWS = f"""
pos AS (
  SELECT CAST(user_id AS VARCHAR) AS id,
         CASE WHEN event_id % 17 <> 0 THEN {_trip("(user_id * 10 + day(ts) % 10)")} END AS trip_id,
         CASE WHEN event_id % 17 <> 0 THEN strftime(ts, '%Y%m%d') END AS start_date,
         CASE WHEN event_id % 17 <> 0 THEN event_type END AS route_id,
         CAST(CAST(value AS FLOAT) AS DOUBLE) AS lat, CAST(CAST(-value AS FLOAT) AS DOUBLE) AS lon,
         CAST(event_id % 360 AS DOUBLE) AS bearing, event_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts_sec, event_id % 101 AS pct, event_id AS seq
  FROM events),
upd AS (
  SELECT {_trip("l_orderkey")} AS id,
         CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 3600 + l_partkey % 3600 AS ts_sec,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS seq,
         '0' || l_linenumber || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':00' AS start_time,
         l_partkey % 23 AS n, l_partkey, l_suppkey, l_linenumber, l_returnflag,
         CAST(l_quantity AS BIGINT) AS qty
  FROM lineitem),
stu AS (
  SELECT id, ts_sec, seq, i + 1 AS idx, CAST(l_suppkey + i * 3 AS VARCHAR) AS stop_id,
         l_returnflag = 'R' AND i = n - 1 AS arrival_only,
         ts_sec - (l_suppkey % 7) * 400 + i * (60 + qty) AS t,
         CASE WHEN l_linenumber % 3 <> 0 AND NOT (l_partkey % 5 = 0 AND i = 0)
              THEN l_partkey % 121 - 60 + i * 7 END AS d
  FROM (SELECT *, unnest(range(n)) AS i FROM upd)),
trips AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS shape_id,
         o_orderpriority AS route, c_mktsegment AS headsign
  FROM orders JOIN customer ON o_custkey = c_custkey),
stops AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
         CAST(s_nationkey AS VARCHAR) AS lat, CAST(-s_nationkey AS VARCHAR) AS lon
  FROM supplier),
calls AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_suppkey AS VARCHAR) AS stop_id,
         CAST(l_linenumber AS BIGINT) AS stop_sequence FROM lineitem),
points AS (
  SELECT CAST(o_custkey AS DOUBLE) AS shape, o_orderkey AS pt, {_page("o_orderkey", PAGE_SIZE)},
         o_orderkey % 360 - 180 AS lon, o_orderkey % 180 - 90 AS lat FROM orders)"""

LATEST = """
lpos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_sec DESC, seq DESC) AS rn FROM pos)
  WHERE rn = 1),
lupd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_sec DESC, seq DESC) AS rn FROM upd)
  WHERE rn = 1)"""

def _next(looked_at: str = "") -> str:
    return f"""
ahead AS (
  SELECT s.id, s.ts_sec, s.seq, min(s.idx) AS idx FROM stu s JOIN lupd u USING (id, ts_sec, seq)
  WHERE {looked_at} NOT s.arrival_only AND s.t + coalesce(s.d, 0) >= s.ts_sec GROUP BY ALL),
nxt AS (
  SELECT u.id, u.start_time, u.ts_sec,
         CASE WHEN a.idx IS NULL THEN '0' ELSE CAST(a.idx AS VARCHAR) END AS stop_sequence,
         CASE WHEN a.idx IS NULL THEN '0' ELSE c.stop_id END AS stop_id,
         CASE WHEN a.idx IS NULL THEN 0 ELSE c.t + c.d - u.ts_sec END AS approach,
         CAST(f.d AS VARCHAR) AS delay
  FROM lupd u LEFT JOIN ahead a USING (id, ts_sec, seq)
  LEFT JOIN stu c ON c.id = u.id AND c.ts_sec = u.ts_sec AND c.seq = u.seq AND c.idx = a.idx
  LEFT JOIN stu f ON f.id = u.id AND f.ts_sec = u.ts_sec AND f.seq = u.seq AND f.idx = 1 AND NOT f.arrival_only)"""


NEXT = _next()

BOARD = f"""
board AS (
  SELECT p.id, p.trip_id AS "tripId", t.shape_id AS "shapeId", t.route AS "routeName",
         t.headsign AS "tripHeadSign", strftime(strptime(p.start_date, '%Y%m%d'), '%Y-%m-%d') AS "startDate",
         n.start_time AS "startTime", p.lat AS latitude, p.lon AS longitude,
         {_local("p.ts_sec")} AS "updateTime",
         coalesce(n.stop_sequence, '0') AS "nextStopSequence", coalesce(n.stop_id, '0') AS "nextStopId",
         s.stop_name AS "nextStopName",
         CASE WHEN n.id IS NULL THEN 0 ELSE n.approach END AS "nextStopApproachSec",
         n.delay AS "nextStopDelay", {_local(str(POS_NOW))} AS "ingestionTime", p.ts_sec AS "updateSec"
  FROM lpos p LEFT JOIN nxt n ON p.trip_id = n.id LEFT JOIN trips t ON p.trip_id = t.trip_id
  LEFT JOIN stops s ON coalesce(n.stop_id, '0') = s.stop_id
  WHERE {POS_NOW} - p.ts_sec < {POS_HORIZON})"""


PLACED = f"""
placed AS (
  SELECT p.id, p.trip_id, t.shape_id AS "shapeId" FROM lpos p LEFT JOIN trips t USING (trip_id)
  WHERE {POS_NOW} - p.ts_sec < {POS_HORIZON})"""


def _entries(source: str) -> str:
    return f"""
entries AS (
  SELECT s.stop_id AS "stopId", {_local("s.ts_sec")} AS "updateTime", s.ts_sec AS "updateSec", s.id,
         t.route AS "routeName", t.headsign AS "tripHeadSign", {_local("s.t")} AS "arrivalTime",
         CAST(s.d AS VARCHAR) AS delay, {_page("s.t", PAGE_SECONDS)}
  FROM stu s JOIN {source} u USING (id, ts_sec, seq) JOIN trips t ON s.id = t.trip_id
  WHERE NOT s.arrival_only AND s.t + coalesce(s.d, 0) >= s.ts_sec AND {TRIP_NOW} - s.ts_sec < {TRIP_HORIZON})"""


def _counted(keys: str) -> str:
    return f"""
counted AS (
  SELECT {keys}, id, "routeName", "tripHeadSign", "arrivalTime", delay,
         count(*) AS n, max("updateSec") AS "updateSec" FROM entries GROUP BY ALL)"""


_INFO = """
  CAST(to_json(list(struct_pack(id := id, "routeName" := "routeName", "tripHeadSign" := "tripHeadSign",
                           "arrivalTime" := "arrivalTime", delay := delay, n := n)
               ORDER BY id NULLS FIRST, "routeName" NULLS FIRST, "tripHeadSign" NULLS FIRST,
                        "arrivalTime" NULLS FIRST, delay NULLS FIRST, n)) AS VARCHAR) AS info"""

_GROUPS = f"""
groups AS (
  SELECT "stopId", "updateTime", page, max("updateSec") AS "updateSec", {_INFO}
  FROM counted GROUP BY "stopId", "updateTime", page)"""

_BOARD_COLUMNS = """g."stopId", s.stop_name AS "stopName", s.lat AS "stopLat", s.lon AS "stopLon",
       g."updateTime", g."updateSec", g.page, g.info"""

_ONE_PER_TRIP = [VIEWS, LATEST, _entries("lupd")]


def _sql(select: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


_POSITION = """id, trip_id AS "tripId", start_date AS "startDate", lat AS latitude, ts_sec AS "updateSec",
  'bus ' || id AS label, pct AS "occupancyPercentage", seq"""
_LOOKUP = """SELECT p.trip_id AS "tripId", p.seq, p.id, t.shape_id AS "shapeId", t.route AS "routeName",
  t.headsign AS "tripHeadSign" FROM pos p {} JOIN trips t ON p.trip_id = t.trip_id"""
_CALL = "CAST(d AS VARCHAR) AS delay"
_PATH = """string_agg(CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR), ' ' ORDER BY pt) AS path"""

_VEHICLE_BOARD = _sql("SELECT * FROM board", VIEWS, LATEST, NEXT, BOARD)
_STOP_BOARD = _sql(
    f"""SELECT {_BOARD_COLUMNS} FROM groups g LEFT JOIN stops s ON g."stopId" = s.stop_id
QUALIFY g."updateTime" = first_value(g."updateTime") OVER (
  PARTITION BY g."stopId" ORDER BY g."updateSec" DESC, g."updateTime" DESC)""",
    *_ONE_PER_TRIP, _counted('"stopId", "updateTime", page'), _GROUPS,
)
_LIVE = _sql(
    f"SELECT {_POSITION} FROM lpos WHERE {POS_NOW} - ts_sec <= {POS_HORIZON - 1}", VIEWS, LATEST
)
_COUNTS = _sql("SELECT * FROM counted", VIEWS, _entries("upd"), _counted('"stopId", "updateTime"'))

_POLL = f"CAST((day(ts) - 1) // {POLL_DAYS} AS INT)"

_CHANGES = f"""
WITH s AS (SELECT user_id, poll, max(event_id) AS event_id FROM (
    SELECT user_id, event_id, unnest(range({_POLL}, {30 // POLL_DAYS + 1})) AS poll FROM events) GROUP BY ALL),
v AS (SELECT user_id, poll, CASE WHEN event_type <> 'error' THEN event_id END AS now
  FROM s JOIN events USING (user_id, event_id)),
c AS (SELECT poll, now, lag(now) OVER (PARTITION BY user_id ORDER BY poll) AS before FROM v)
SELECT poll, CASE WHEN before IS NULL THEN 'insert' WHEN now IS NULL THEN 'delete' ELSE 'change' END AS kind, count(*) AS n
FROM c WHERE now IS DISTINCT FROM before GROUP BY ALL"""

# A vehicle ends where a watermark passes it before the poll of its next row.
_EXPIRY = f"""
WITH e AS (SELECT user_id, event_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec, {_POLL} AS poll FROM events),
n AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, poll ORDER BY sec DESC, event_id DESC) = 1),
w AS (SELECT poll, max(max(sec)) OVER (ORDER BY poll) - {LATE_S} AS mark FROM e GROUP BY poll),
q AS (SELECT *, lead(poll) OVER (PARTITION BY user_id ORDER BY poll) AS later FROM n)
SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS value, sec AS seconds FROM q
UNION ALL
SELECT CAST(user_id AS VARCHAR), NULL, sec + {TTL_S} FROM q WHERE event_type <> 'error' AND EXISTS (
  SELECT 1 FROM w WHERE w.poll >= q.poll AND q.sec + {TTL_S} <= w.mark AND (q.later IS NULL OR w.poll + 1 < q.later))"""

_INTERVAL = f"""
WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
v AS (SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS "tripId", sec AS "updateSec"
  FROM e WHERE event_id % 2 = 0)
SELECT id, "tripId", "updateSec", u.sec AS "feedSec", u.event_id AS "tripSeq"
FROM v LEFT JOIN e u ON u.event_id % 2 = 1 AND CAST(u.user_id AS VARCHAR) = "tripId"
  AND u.sec BETWEEN "updateSec" - {BEFORE_S} AND "updateSec" + {AFTER_S}
QUALIFY row_number() OVER (PARTITION BY id ORDER BY u.sec DESC NULLS LAST, u.event_id DESC) = 1"""

ORACLE: dict[str, str] = {
    "replay_polls": f"SELECT event_id, user_id, {_POLL} AS poll FROM events WHERE {_POLL} BETWEEN 1 AND 3",
    "stream_stop_weights": _sql("SELECT * FROM counted", *_ONE_PER_TRIP, _counted('"stopId", "updateTime"')),
    "stream_board_changes": _CHANGES,
    "redeployed_changes": _CHANGES,
    "levelled_changes": """SELECT CAST(user_id AS VARCHAR) AS key, CAST(max(event_id) AS VARCHAR) AS value FROM events
GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error'""",
    "maintained_vehicle_board": _VEHICLE_BOARD,
    "maintained_stop_board": _STOP_BOARD,
    "stream_expiry": _EXPIRY,
    "stream_interval_join": _INTERVAL,
    "committed_archive": f"SELECT event_id, user_id, event_type, {_POLL} AS poll FROM events",
    "ingest_counts": _sql(
        f"""SELECT count(*) AS rows, count(*) FILTER (seq % 5 = 0) AS corrupt,
       count(*) FILTER (seq % 5 <> 0 AND {POS_NOW} - ts_sec < {POS_HORIZON}) AS fresh,
       count(*) FILTER (seq % 5 <> 0 AND {POS_NOW} - ts_sec >= {POS_HORIZON}) AS late,
       max(ts_sec) FILTER (seq % 5 <> 0) AS newest, min(ts_sec) FILTER (seq % 5 <> 0) AS oldest FROM pos""",
        VIEWS,
    ),
    "bucketed_lookup": _sql(_LOOKUP.format(""), VIEWS),
    "parse_vehicle_json": _sql(f"SELECT {_POSITION} FROM pos", VIEWS),
    "parse_trip_json": _sql(
        """SELECT u.id, u.ts_sec AS "feedSec", u.seq, u.start_time AS "startTime", u.n AS stops,
       s.stop_id AS "firstStop", CAST(s.idx AS VARCHAR) AS "firstSequence"
FROM upd u LEFT JOIN stu s ON s.id = u.id AND s.ts_sec = u.ts_sec AND s.seq = u.seq AND s.idx = 1""",
        VIEWS,
    ),
    "quarantine": _sql(
        "SELECT seq, CASE WHEN seq % 5 <= 1 THEN 'bad' ELSE 'good' END AS fate FROM pos", VIEWS
    ),
    "explode_feed_messages": """SELECT '{"id":"' || (user_id + i) || '"}' AS key,
       '{"id":"' || (user_id + i) || '","vehicle":{"timestamp":"' || event_id || '"}}' AS value
FROM (SELECT *, unnest(range(event_id % 5)) AS i FROM events)""",
    "explode_feed_quarantine": """SELECT event_id AS seq, CASE WHEN event_id % 5 = 0 THEN 0 ELSE 2 END AS messages,
       CASE WHEN event_id % 5 = 0 THEN 'bad' ELSE 'good' END AS fate FROM events""",
    "lookup_csv": _sql(
        """SELECT 'trip' AS kind, trip_id AS id, headsign AS name, shape_id AS more FROM trips
UNION ALL SELECT 'stop', stop_id, stop_name, lat FROM stops""",
        VIEWS,
    ),
    "archive_by_date": _sql(
        f"""SELECT id, trip_id AS "tripId", strftime(strptime(start_date, '%Y%m%d'), '%Y-%m-%d') AS "startDate",
       {_local("ts_sec")} AS "updateTime", event_type AS "occupancyStatus" FROM pos""",
        VIEWS,
    ),
    "latest_vehicle": _sql(f"SELECT {_POSITION} FROM lpos", VIEWS, LATEST),
    "latest_trip_update": _sql(
        'SELECT id, ts_sec AS "feedSec", seq, start_time AS "startTime", n AS stops FROM lupd',
        VIEWS, LATEST,
    ),
    "lookup_trips_left": _sql(_LOOKUP.format("LEFT"), VIEWS),
    "lookup_trips_inner": _sql(_LOOKUP.format(""), VIEWS),
    "trip_stop_entries": _sql(
        f"""SELECT id, ts_sec AS "feedSec", seq, idx, stop_id AS "stopId",
       CASE WHEN NOT arrival_only THEN t END AS "departureSec", CASE WHEN arrival_only THEN t END AS "arrivalSec",
       CASE WHEN NOT arrival_only THEN {_CALL.split(" AS delay")[0]} END AS delay FROM stu""",
        VIEWS,
    ),
    "upcoming_stops": _sql(
        f"""SELECT id, ts_sec AS "feedSec", seq, stop_id AS "stopId", t AS "arrivalSec", {_CALL} FROM stu
WHERE NOT arrival_only AND t + coalesce(d, 0) >= ts_sec""",
        VIEWS,
    ),
    "next_stop": _sql(
        """SELECT id, start_time AS "startTime", ts_sec AS "feedSec", stop_sequence AS "stopSequence",
       stop_id AS "stopId", approach AS "approachSec", delay FROM nxt""",
        VIEWS, LATEST, NEXT,
    ),
    "next_stop_first20": _sql(
        """SELECT id, start_time AS "startTime", ts_sec AS "feedSec", stop_sequence AS "stopSequence",
       stop_id AS "stopId", approach AS "approachSec", delay FROM nxt""",
        VIEWS, LATEST, _next("s.idx <= 20 AND"),
    ),
    "next_stop_options": _sql(
        """SELECT u.id, u.ts_sec AS "feedSec", u.seq, CAST(a.idx AS VARCHAR) AS "stopSequence", a.stop_id AS "stopId",
       a.t + coalesce(a.d, 0) - a.ts_sec AS "approachSec",
       CASE WHEN NOT a.arrival_only THEN CAST(a.d AS VARCHAR) END AS delay
FROM upd u LEFT JOIN (
  SELECT * FROM stu WHERE t + coalesce(d, 0) >= ts_sec
  QUALIFY row_number() OVER (PARTITION BY id, ts_sec, seq ORDER BY idx) = 1) a
ON a.id = u.id AND a.ts_sec = u.ts_sec AND a.seq = u.seq""",
        VIEWS,
    ),
    "next_stop_names": _sql(
        """SELECT n.id, n.stop_id AS "stopId", s.stop_name AS "stopName"
FROM nxt n LEFT JOIN stops s ON n.stop_id = s.stop_id""",
        VIEWS, LATEST, NEXT,
    ),
    "fresh_vehicles": _sql(
        f"SELECT {_POSITION} FROM pos WHERE {POS_NOW} - ts_sec < {POS_HORIZON}", VIEWS
    ),
    "fresh_trips": _sql(
        f'SELECT id, ts_sec AS "feedSec", seq FROM upd WHERE {TRIP_NOW} - ts_sec < {TRIP_HORIZON}', VIEWS
    ),
    "local_times": _sql(
        f"""SELECT seq, {_local("ts_sec")} AS chicago,
       {_local("ts_sec + seq * 3600", "Europe/Berlin")} AS berlin FROM pos""",
        VIEWS,
    ),
    "start_dates": """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS "startDate"
FROM events""",
    "service_hours": _sql(
        """SELECT seq, ts_sec AS "updateSec" FROM pos
WHERE hour(timezone('America/Chicago', to_timestamp(ts_sec))) BETWEEN 5 AND 23""",
        VIEWS,
    ),
    "vehicle_board": _VEHICLE_BOARD,
    "board_upserts": _VEHICLE_BOARD,
    "stream_vehicle_board": _VEHICLE_BOARD,
    "snapshot_to_boards": _VEHICLE_BOARD,
    "stop_board_groups": _sql(
        f"""SELECT {_BOARD_COLUMNS} FROM groups g LEFT JOIN stops s ON g."stopId" = s.stop_id""",
        *_ONE_PER_TRIP, _counted('"stopId", "updateTime", page'), _GROUPS,
    ),
    "stop_board_latest": _STOP_BOARD,
    "stream_stop_board": _STOP_BOARD,
    "stop_board_merged": _sql(
        f"""SELECT {_BOARD_COLUMNS} FROM (
  SELECT "stopId", page, max("updateSec") AS "updateSec", {_local('max("updateSec")')} AS "updateTime", {_INFO}
  FROM counted GROUP BY "stopId", page) g LEFT JOIN stops s ON g."stopId" = s.stop_id""",
        *_ONE_PER_TRIP, _counted('"stopId", page'),
    ),
    "stop_board_multiplicity": _COUNTS,
    "stream_stop_counts": _COUNTS,
    "vehicle_archive": _sql(
        f"""SELECT id, trip_id AS "tripId", strftime(strptime(start_date, '%Y%m%d'), '%Y-%m-%d') AS "startDate",
       route_id AS "routeId", lat AS latitude, lon AS longitude, bearing, {_local("ts_sec")} AS "updateTime",
       id AS "vehicleLabel", event_type AS "occupancyStatus", pct AS "occupancyPercentage" FROM pos""",
        VIEWS,
    ),
    "compact_topic": """SELECT key, seq, event_id FROM (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, CAST(event_id AS VARCHAR) AS event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'""",
    "live_vehicles": _LIVE,
    "stream_live_vehicles": _LIVE,
    "relay_rows": _LIVE,
    "roster": _sql(
        """SELECT id, "routeName", "startTime", "tripHeadSign", "nextStopName",
       CAST(ceil(coalesce("nextStopApproachSec", 0) / 60.0) AS BIGINT) AS "etaMinutes" FROM board ORDER BY id""",
        VIEWS, LATEST, NEXT, BOARD,
    ),
    "eta_of_trips": _sql(
        """SELECT id, CAST(ceil(coalesce(approach, 0) / 60.0) AS BIGINT) AS "etaMinutes",
       CAST(ceil(approach / 60.0) AS BIGINT) AS "etaOrNull" FROM nxt""",
        VIEWS, LATEST, NEXT,
    ),
    "feed_status": _sql(
        f"""SELECT count(*) AS vehicles, count(*) = 0 AS "isEmpty", max({_local("ts_sec")}) AS "lastUpdate"
FROM lpos WHERE {POS_NOW} - ts_sec <= {POS_HORIZON - 1}""",
        VIEWS, LATEST,
    ),
    "trip_stop_lists": _sql(
        f"""SELECT trip_id, page, string_agg(repeat(stop_id || ',', n - 1) || stop_id, ',' ORDER BY stop_sequence, stop_id) AS stop_ids,
       CAST(to_json(list(struct_pack(stop_sequence := stop_sequence, stop_id := stop_id, n := n)
                    ORDER BY stop_sequence, stop_id)) AS VARCHAR) AS stops
FROM (SELECT trip_id, stop_sequence, stop_id, {_page("stop_sequence", PAGE_SIZE)}, count(*) AS n FROM calls GROUP BY ALL)
GROUP BY trip_id, page""",
        VIEWS,
    ),
    "route_shapes": _sql(
        f"""SELECT shape, page, {_PATH},
       '{{"type":"Feature","properties":{{}},"geometry":{{"type":"LineString","coordinates":[' ||
       string_agg('[' || lon || '.0,' || lat || '.0]', ',' ORDER BY pt) || ']}}}}' AS feature
FROM points GROUP BY shape, page""",
        VIEWS,
    ),
    "routes_in_use": _sql(
        f"""SELECT shape, page, {_PATH} FROM points
WHERE shape IN (SELECT CAST("shapeId" AS DOUBLE) FROM placed) GROUP BY shape, page""",
        VIEWS, LATEST, PLACED,
    ),
    "vehicle_route": _sql(
        f"""SELECT '{SELECTED}' AS id, shape, page, {_PATH} FROM points
WHERE shape IN (SELECT CAST("shapeId" AS DOUBLE) FROM placed WHERE id = '{SELECTED}') GROUP BY shape, page""",
        VIEWS, LATEST, PLACED,
    ),
    "flag_trip_stops": _sql(
        f"""SELECT s.stop_id, s.stop_name, EXISTS (
  SELECT 1 FROM calls c JOIN placed p ON c.trip_id = p.trip_id
  WHERE p.id = '{SELECTED}' AND c.stop_id = s.stop_id) AS "onTrip" FROM stops s""",
        VIEWS, LATEST, PLACED,
    ),
    "stream_trip_join": _sql(
        """SELECT p.id, p.trip_id AS "tripId", p.ts_sec AS "updateSec", n.ts_sec AS "feedSec",
       n.start_time AS "startTime", coalesce(n.stop_sequence, '0') AS "stopSequence",
       coalesce(n.stop_id, '0') AS "stopId", CASE WHEN n.id IS NULL THEN 0 ELSE n.approach END AS "approachSec",
       n.delay FROM lpos p LEFT JOIN nxt n ON p.trip_id = n.id""",
        VIEWS, LATEST, NEXT,
    ),
}
