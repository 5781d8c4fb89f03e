"""DuckDB SQL equal to the registered queries, on the driver's raw tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

STATUS = """status AS (
  SELECT event_id AS status_id, user_id AS station_key, ts AS polled_at,
         date_trunc('second', ts) AS last_reported,
         CAST(floor(value) AS INTEGER) % 31 AS bikes,
         CAST(floor((CAST(floor(value) AS INTEGER) % 31) / 3.0) AS INTEGER) AS ebikes,
         30 - CAST(floor(value) AS INTEGER) % 31 AS docks,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         event_type <> 'error' AS is_renting, event_type <> 'signup' AS is_returning,
         event_type, value
  FROM events)"""

STATIONS = """stations AS (
  SELECT c AS station_key, 'S' || c AS station_id, name, 'N' || c AS short_name,
         CASE WHEN c % 17 <> 0 THEN CAST(20 + c % 40 AS INTEGER) END AS capacity,
         CAST(40.60 AS DOUBLE) + CAST(0.25 AS DOUBLE) * u * u AS lat,
         CAST(-74.05 AS DOUBLE) + CAST(0.25 AS DOUBLE) * v * v AS lon,
         region_id
  FROM (SELECT c_custkey AS c, c_name AS name, CAST(c_nationkey AS VARCHAR) AS region_id,
               CAST((31 * c_custkey * c_custkey + 7919 * c_custkey) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE) AS u,
               CAST((37 * c_custkey * c_custkey + 104729 * c_custkey) % 10009 AS DOUBLE) / CAST(10009 AS DOUBLE) AS v
        FROM customer))"""

TRIPS = """trips AS (
  SELECT l_shipdate + to_seconds((l_partkey * 37) % 86400) AS started_at,
         l_shipdate + to_seconds((l_partkey * 37) % 86400)
           + to_seconds(60 + CAST(floor(l_extendedprice) AS INTEGER) % 3600) AS ended_at,
         l_suppkey AS start_station_key, l_partkey % 150 AS end_station_key,
         60 + CAST(floor(l_extendedprice) AS INTEGER) % 3600 AS duration_s,
         l_quantity * 100 AS meters,
         CASE WHEN l_linestatus = 'F' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
         CASE WHEN l_discount < CAST(0.05 AS DOUBLE) THEN 'member' ELSE 'casual' END AS member_casual,
         CASE WHEN l_returnflag = 'A' THEN 'modelled' ELSE 'observed' END AS source
  FROM lineitem)"""

LANDING = """landing AS (
  SELECT date_trunc('hour', polled_at) AS polled_at, 'S' || station_key AS station_id, last_reported,
         bikes AS num_bikes_available, ebikes AS num_ebikes_available, docks AS num_docks_available,
         k % 4 AS num_bikes_disabled, k % 3 AS num_docks_disabled, 1 AS is_installed,
         CAST(is_renting AS INTEGER) AS is_renting, CAST(is_returning AS INTEGER) AS is_returning
  FROM status)"""

INCOMING = """changed AS (
  SELECT station_id, station_key AS c,
         CASE WHEN station_key % 5 = 0 THEN name || ' (new)' ELSE name END AS name,
         short_name || 'x' AS short_name,
         CASE WHEN station_key % 13 = 0 THEN 0 WHEN station_key % 11 = 0 THEN lat + CAST(0.001 AS DOUBLE) ELSE lat END AS lat,
         lon, CASE WHEN station_key % 7 = 0 THEN 99 ELSE capacity END AS capacity, 'moved' AS region_id
  FROM stations),
incoming AS (
  SELECT * FROM changed
  UNION ALL SELECT 'T' || station_id, c, name, short_name, lat, lon, capacity, region_id FROM changed WHERE c % 10 = 0)"""

CHANGED = """replica AS (
  SELECT station_key, CASE WHEN station_key % 6 = 0 THEN name || ' v3'
                           WHEN station_key % 3 = 0 THEN name || ' v2' ELSE name END AS name, capacity
  FROM stations WHERE station_key % 10 <> 0)"""

DELTAS = """deltas AS (
  SELECT station_key, polled_at, status_id, bikes,
         bikes - lag(bikes) OVER w AS delta,
         CAST(epoch_us(polled_at) - epoch_us(lag(polled_at) OVER w) AS DOUBLE) / 1e6 AS gap_seconds
  FROM status WINDOW w AS (PARTITION BY station_key ORDER BY polled_at, status_id))"""

DEPARTED = "CAST(sum(CASE WHEN delta < 0 THEN -delta ELSE 0 END) AS BIGINT)"
ARRIVED = "CAST(sum(CASE WHEN delta > 0 THEN delta ELSE 0 END) AS BIGINT)"
SINCE = "TIMESTAMP '2024-01-15 00:00:00'"

_PARTS = {
    "status": ([], STATUS),
    "stations": ([], STATIONS),
    "trips": ([], TRIPS),
    "landing": (["status"], LANDING),
    "incoming": (["stations"], INCOMING),
    "replica": (["stations"], CHANGED),
    "deltas": (["status"], DELTAS),
}


def with_views(names: str, sql: str, recursive: bool = False) -> str:
    """Prefix ``sql`` with the common table expressions it names."""
    seen: list[str] = []

    def add(name: str) -> None:
        if name in seen:
            return
        for need in _PARTS[name][0]:
            add(need)
        seen.append(name)

    for name in names.split():
        add(name)
    head = ",\n".join(_PARTS[n][1] for n in seen)
    word = "WITH RECURSIVE" if recursive else "WITH"
    glue = ",\n" if sql.lstrip().startswith(",") else "\n"
    body = sql.lstrip().lstrip(",")
    return f"{word} {head}{glue}{body}"


def ratio(num: str, den: str, digits: int, scale: int = 1) -> str:
    """Half-away rounding of ``scale * num / den`` on integers, as in the operators."""
    unit = 10**digits
    num, den = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    whole = f"(({2 * unit * scale} * abs({num}) + nullif({den}, 0)) // (2 * nullif({den}, 0)))"
    signed = f"(CASE WHEN {num} < 0 THEN -{whole} ELSE {whole} END)"
    return f"(CAST({signed} AS DOUBLE) / CAST({unit} AS DOUBLE))"


def mean(column: str, digits: int) -> str:
    return ratio(f"sum({column})", f"count({column})", digits)


def half_up(value: str, digits: int = 0) -> str:
    unit = 10**digits
    return f"(floor(CAST({value} AS DOUBLE) * {unit} + CAST(0.5 AS DOUBLE)) / CAST({unit} AS DOUBLE))"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def draw(*parts: str) -> str:
    text = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


HOUR = "CAST(hour(polled_at) AS INTEGER)"

# ---- feeds, ingestion and the dimension ------------------------------------------

ORACLES["parse_status"] = with_views("landing", "SELECT * FROM landing")
ORACLES["parse_stations"] = with_views(
    "stations",
    "SELECT station_id, name, short_name, lat, lon, coalesce(capacity, 0) AS capacity, region_id FROM stations",
)
ORACLES["replace_stations"] = ORACLES["parse_stations"]
_FEEDS = """SELECT l.language, f.name, url || f.suffix AS url
FROM pages
JOIN (VALUES ('station_status', '/status'), ('station_information', '/stations')) f(name, suffix) ON true
JOIN (VALUES ('en'), ('fr'), ('')) l(language) ON (page_id % 3 = 0) = (l.language = '')"""
ORACLES["feed_catalog"] = _FEEDS
ORACLES["feed_lookup"] = _FEEDS + " WHERE f.name = 'station_status' AND l.language <> 'fr'"
_COLLAPSED = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY polled_at, station_id ORDER BY last_reported DESC,
    num_bikes_available DESC, num_ebikes_available DESC, num_docks_available DESC,
    num_bikes_disabled DESC, num_docks_disabled DESC, is_installed DESC, is_renting DESC, is_returning DESC) AS rn
  FROM landing) WHERE rn = 1"""
ORACLES["landing_collapsed"] = with_views("landing", _COLLAPSED)
ORACLES["assign_keys"] = with_views(
    "incoming",
    """SELECT station_id, station_key FROM stations
UNION ALL
SELECT station_id, (SELECT max(station_key) FROM stations) + row_number() OVER (ORDER BY station_id)
FROM incoming WHERE station_id NOT IN (SELECT station_id FROM stations)""",
)
ORACLES["upsert_stations"] = with_views(
    "incoming",
    """, placed AS (SELECT * FROM incoming WHERE lat <> 0 AND lon <> 0),
joined AS (
  SELECT s.*, p.station_id IS NOT NULL AND (s.name IS DISTINCT FROM p.name
           OR s.capacity IS DISTINCT FROM p.capacity OR s.lat IS DISTINCT FROM p.lat
           OR s.lon IS DISTINCT FROM p.lon) AS moved,
         p.name AS n_name, p.capacity AS n_capacity, p.lat AS n_lat, p.lon AS n_lon
  FROM stations s LEFT JOIN placed p USING (station_id))
SELECT station_key, station_id, CASE WHEN moved THEN n_name ELSE name END AS name, short_name,
       CASE WHEN moved THEN n_lat ELSE lat END AS lat, CASE WHEN moved THEN n_lon ELSE lon END AS lon,
       CASE WHEN moved THEN n_capacity ELSE capacity END AS capacity, region_id,
       CASE WHEN moved THEN 'update' ELSE 'same' END AS _change
FROM joined
UNION ALL
SELECT (SELECT max(station_key) FROM stations) + row_number() OVER (ORDER BY station_id),
       station_id, name, short_name, lat, lon, capacity, region_id, 'insert'
FROM placed WHERE station_id NOT IN (SELECT station_id FROM stations)""",
)
_LOAD = f"""FROM landing l {{join}} WHERE l.polled_at > (
  SELECT max(polled_at) FROM status WHERE polled_at <= {SINCE})"""
ORACLES["incremental_load"] = with_views(
    "landing stations",
    """SELECT s.station_key, l.polled_at, l.last_reported, num_bikes_available, num_ebikes_available,
  num_docks_available, num_bikes_disabled, num_docks_disabled, l.is_installed = 1 AS is_installed,
  l.is_renting = 1 AS is_renting, l.is_returning = 1 AS is_returning """
    + _LOAD.format(join="JOIN stations s USING (station_id)"),
)
ORACLES["incremental_load_logged"] = ORACLES["incremental_load"]
ORACLES["unmatched_landing"] = with_views(
    "landing stations",
    "SELECT l.* "
    + _LOAD.format(join="ANTI JOIN (FROM stations WHERE capacity IS NOT NULL) s USING (station_id)"),
)
ORACLES["apply_cdc"] = with_views("replica", "SELECT * FROM replica")
ORACLES["retain_trips"] = with_views(
    "trips",
    """SELECT source, count(*) AS trips, min(started_at) AS oldest FROM trips
WHERE started_at >= (SELECT max(started_at) FROM trips) - INTERVAL 180 DAY GROUP BY source""",
)
ORACLES["retain_landing"] = with_views(
    "landing",
    """SELECT CAST(CAST(polled_at AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM landing
WHERE polled_at >= (SELECT max(polled_at) FROM landing) - INTERVAL 10 DAY GROUP BY 1""",
)
ORACLES["retain_logged"] = with_views(
    "landing",
    f"""SELECT CAST(CAST(polled_at AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM ({_COLLAPSED})
WHERE polled_at >= (SELECT max(polled_at) FROM landing) - INTERVAL 10 DAY GROUP BY 1""",
)
ORACLES["trip_archive"] = with_views(
    "trips stations",
    """SELECT member_casual, count(*) AS trips, min(started_at) AS first, max(ended_at) AS last,
  count(DISTINCT start_station_key) AS origins, count(DISTINCT end_station_key) AS destinations,
  count(s.lat) AS placed, min(o.lat) AS south, max(s.lon) AS east
FROM trips LEFT JOIN stations s ON s.station_key = end_station_key
  LEFT JOIN stations o ON o.station_key = start_station_key GROUP BY 1""",
)
ORACLES["document_summary"] = with_views(
    "status",
    """SELECT count(*) AS documents, count(*) FILTER (epoch(hour) // 3600 % 7 = 0) AS unreadable
FROM (SELECT DISTINCT date_trunc('hour', polled_at) AS hour, status_id // 256 FROM status)""",
)
ORACLES["landing_summary"] = with_views(
    "landing",
    """SELECT count(*) AS status_rows, count(DISTINCT polled_at) AS snapshots,
  count(DISTINCT station_id) AS stations, min(polled_at) AS first, max(polled_at) AS last FROM landing""",
)

# ---- latest state, snapshots and summaries ---------------------------------------

_LATEST = """, latest AS (
  SELECT DISTINCT ON (station_key) * FROM status ORDER BY station_key, polled_at DESC, status_id DESC)
"""
ORACLES["latest_state"] = with_views(
    "status",
    _LATEST
    + "SELECT station_key, polled_at, bikes AS num_bikes_available, docks AS num_docks_available FROM latest",
)
ORACLES["newest_snapshot"] = with_views(
    "status",
    f"""SELECT count(*) AS stations, {big("sum(bikes)")} AS bikes, {big("sum(ebikes)")} AS ebikes,
  {big("sum(docks)")} AS docks FROM status WHERE polled_at = (SELECT max(polled_at) FROM status)""",
)
ORACLES["dim_profile"] = with_views(
    "stations",
    f"""SELECT count(*) AS stations, count(*) AS with_geometry,
  printf('%.3f', min(lat)) || ' .. ' || printf('%.3f', max(lat)) AS lat_range,
  printf('%.3f', min(lon)) || ' .. ' || printf('%.3f', max(lon)) AS lon_range,
  {big("sum(capacity)")} AS total_docks FROM stations""",
)
ORACLES["fact_profile"] = with_views(
    "status",
    """SELECT count(*) AS rows, count(DISTINCT station_key) AS stations_seen,
  count(DISTINCT polled_at) AS polls, strftime(min(polled_at), '%Y-%m-%d %H:%M:%S') AS first_poll,
  strftime(max(polled_at), '%Y-%m-%d %H:%M:%S') AS last_poll,
  CAST(round_even(((SELECT epoch_us(max(polled_at)) FROM status) - epoch_us(max(polled_at))) / 1e6, 0) AS INTEGER) AS seconds_behind
FROM status WHERE NOT is_returning""",
)
ORACLES["fact_profile_whole"] = with_views(
    "status trips",
    """SELECT count(*) AS rows, count(DISTINCT station_key) AS stations_seen,
  count(DISTINCT polled_at) AS polls, strftime(min(polled_at), '%Y-%m-%d %H:%M:%S') AS first_poll,
  strftime(max(polled_at), '%Y-%m-%d %H:%M:%S') AS last_poll,
  CAST(round_even(((SELECT epoch_us(max(started_at)) FROM trips) - epoch_us(max(polled_at))) / 1e6, 0) AS INTEGER) AS seconds_behind
FROM status""",
)
ORACLES["recent_polls"] = with_views(
    "status",
    f"""SELECT strftime(polled_at, '%H:%M:%S') AS poll, stations, bikes_out_there, free_docks FROM (
  SELECT polled_at, count(*) AS stations, {big("sum(bikes)")} AS bikes_out_there, {big("sum(docks)")} AS free_docks
  FROM status GROUP BY 1 ORDER BY 1 DESC LIMIT 10)""",
)


def _wkt(value: str) -> str:
    fixed = f"printf('%.4f', round_even({value} / CAST(0.0001 AS DOUBLE), 0) * CAST(0.0001 AS DOUBLE))"
    return f"rtrim(rtrim({fixed}, '0'), '.')"


ORACLES["empty_now"] = with_views(
    "status stations",
    _LATEST
    + f"""SELECT s.name, bikes, docks, 'POINT(' || {_wkt("s.lon")} || ' ' || {_wkt("s.lat")} || ')' AS point
FROM latest l JOIN stations s USING (station_key) WHERE bikes = 0
ORDER BY s.capacity DESC NULLS LAST, station_key LIMIT 10""",
)
ORACLES["station_map"] = with_views(
    "status stations",
    _LATEST
    + """SELECT station_key, name, capacity, lon, lat, coalesce(bikes, 0) AS bikes,
  coalesce(ebikes, 0) AS ebikes, coalesce(docks, 0) AS docks
FROM stations LEFT JOIN latest USING (station_key)""",
)
ORACLES["station_features"] = with_views(
    "status stations",
    _LATEST
    + """SELECT name, capacity, coalesce(bikes, 0) AS bikes, coalesce(ebikes, 0) AS ebikes,
  coalesce(docks, 0) AS docks, lon, lat FROM stations LEFT JOIN latest USING (station_key)""",
)
ORACLES["trip_summary"] = with_views(
    "trips",
    f"""SELECT source, count(*) AS trips, strftime(min(started_at), '%Y-%m-%d %H:%M') AS first,
  strftime(max(started_at), '%Y-%m-%d %H:%M') AS last, {half_up("avg(duration_s)")} AS avg_seconds,
  {half_up("avg(meters)")} AS avg_meters FROM trips GROUP BY source""",
)

# ---- aggregates ------------------------------------------------------------------

ORACLES["system_pulse"] = with_views(
    "status",
    f"""SELECT {HOUR} AS hour_utc, count(DISTINCT polled_at) AS polls,
  {mean("bikes", 1)} AS avg_bikes_at_dock, {mean("docks", 1)} AS avg_free_docks FROM status GROUP BY 1""",
)
ORACLES["fleet_by_hour"] = with_views(
    "status",
    f"""SELECT {HOUR} AS hour_utc, count(*) AS observations,
  {mean("bikes", 1)} AS avg_bikes, {mean("docks", 1)} AS avg_free_docks FROM status GROUP BY 1""",
)
_JOINED = "FROM status ss JOIN stations st USING (station_key) GROUP BY name"
ORACLES["busiest_stations"] = with_views(
    "status stations",
    f"""SELECT name, count(*) AS observations, {mean("bikes", 1)} AS avg_bikes, max(bikes) AS peak_bikes,
  min(bikes) AS trough_bikes {_JOINED} HAVING count(*) >= 5 ORDER BY peak_bikes DESC, name LIMIT 15""",
)
_NO_BIKES = ratio("count(*) FILTER (WHERE bikes = 0)", "count(*)", 1, 100)
_NO_DOCKS = ratio("count(*) FILTER (WHERE docks = 0)", "count(*)", 1, 100)
ORACLES["stranding_rate"] = with_views(
    "status stations",
    f"""SELECT name, count(*) AS observations, {_NO_BIKES} AS pct_no_bikes, {_NO_DOCKS} AS pct_no_docks
{_JOINED} HAVING count(*) >= 5 ORDER BY pct_no_bikes DESC, name LIMIT 15""",
)
ORACLES["ebike_share"] = with_views(
    "status",
    f"""SELECT date_trunc('hour', polled_at) AS hour_utc, {big("sum(bikes)")} AS bikes, {big("sum(ebikes)")} AS ebikes,
  {ratio("sum(ebikes)", "sum(bikes)", 1, 100)} AS pct_electric
FROM status GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
)
ORACLES["out_of_service"] = with_views(
    "status",
    f"""SELECT date_trunc('hour', polled_at) AS hour_utc, {big("sum(k % 4)")} AS bikes_disabled,
  {big("sum(k % 3)")} AS docks_disabled, count(*) FILTER (WHERE NOT is_renting) AS station_polls_not_renting,
  count(*) FILTER (WHERE NOT is_returning) AS station_polls_not_returning
FROM status GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
)
_NET = ratio("count(*) FILTER (WHERE docks = 0) - count(*) FILTER (WHERE bikes = 0)", "count(*)", 1, 100)
ORACLES["pressure_features"] = with_views(
    "status stations",
    f"""SELECT name, lon, lat, observations, pct_no_bikes, pct_no_docks, net FROM (
  SELECT station_key, count(*) AS observations, {_NO_BIKES} AS pct_no_bikes, {_NO_DOCKS} AS pct_no_docks,
         {_NET} AS net FROM status GROUP BY station_key) JOIN stations USING (station_key)""",
)
ORACLES["stranding_pressure"] = with_views(
    "status stations",
    f"""SELECT station_key, name, lon, lat, observations, pct_no_bikes, pct_no_docks, net FROM (
  SELECT station_key, count(*) AS observations, {_NO_BIKES} AS pct_no_bikes, {_NO_DOCKS} AS pct_no_docks,
         {_NET} AS net FROM status GROUP BY station_key) JOIN stations USING (station_key)""",
)
_TRIP_AVG = f"{half_up('avg(duration_s)')} AS avg_seconds, {half_up('avg(meters)')} AS avg_meters"
ORACLES["trip_hours"] = with_views(
    "trips",
    f"SELECT CAST(hour(started_at) AS INTEGER) AS hour_utc, source, count(*) AS trips, {_TRIP_AVG} FROM trips GROUP BY 1, 2",
)
ORACLES["trip_pairs"] = with_views(
    "trips stations",
    f"""SELECT a.name AS from_station, b.name AS to_station, count(*) AS trips, {mean("duration_s", 0)} AS avg_seconds
FROM trips t JOIN stations a ON a.station_key = t.start_station_key
JOIN stations b ON b.station_key = t.end_station_key
GROUP BY 1, 2 ORDER BY trips DESC, 1, 2 LIMIT 20""",
)
ORACLES["rider_mix"] = with_views(
    "trips",
    f"""SELECT member_casual, rideable_type, trips, avg_seconds, avg_meters,
  {ratio("trips", "everything", 1, 100)} AS pct
FROM (SELECT *, sum(trips) OVER () AS everything FROM (
  SELECT member_casual, rideable_type, count(*) AS trips, {_TRIP_AVG} FROM trips GROUP BY 1, 2))""",
)
_OD = """od AS (
  SELECT start_station_key, end_station_key, count(*) AS trips FROM trips
  WHERE started_at > (SELECT max(started_at) FROM trips) - INTERVAL 365 DAY
  GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY trips DESC, 1, 2 LIMIT 600)"""
ORACLES["od_pairs"] = with_views("trips", f", {_OD} SELECT * FROM od")
ORACLES["ingest_buckets"] = with_views(
    "status",
    """SELECT time_bucket(INTERVAL 10 MINUTE, polled_at) AS bucket, count(*) AS rows,
  strftime(time_bucket(INTERVAL 10 MINUTE, polled_at), '%H:%M') AS at FROM status
WHERE polled_at > (SELECT max(polled_at) FROM status) - INTERVAL 48 HOUR GROUP BY 1""",
)
ORACLES["system_level"] = with_views(
    "status",
    f"""SELECT polled_at, {big("sum(bikes)")} AS bikes, strftime(polled_at, '%H:%M') AS at FROM status
WHERE polled_at > (SELECT max(polled_at) FROM status) - INTERVAL 48 HOUR GROUP BY polled_at""",
)
ORACLES["fleet_hour_spine"] = with_views(
    "status",
    f"""SELECT lpad(CAST(g AS VARCHAR), 2, '0') AS hour, coalesce(bikes, 0) AS bikes
FROM range(24) t(g) LEFT JOIN (
  SELECT hour(polled_at) AS h, {mean("bikes", 2)} AS bikes FROM status GROUP BY 1) ON h = g""",
)
ORACLES["dry_distribution"] = with_views(
    "status",
    """, per AS (SELECT 100.0 * count(*) FILTER (WHERE bikes = 0) / count(*) AS pct FROM status
  GROUP BY station_key HAVING count(*) >= 10)
SELECT CASE WHEN pct = 0 THEN 'never' WHEN pct < 5 THEN 'under 5%' WHEN pct < 20 THEN '5–20%'
            WHEN pct < 50 THEN '20–50%' WHEN pct < 100 THEN '50–99%' ELSE 'always' END AS bucket,
       CASE WHEN pct = 0 THEN 1 WHEN pct < 5 THEN 2 WHEN pct < 20 THEN 3
            WHEN pct < 50 THEN 4 WHEN pct < 100 THEN 5 ELSE 6 END AS ord,
       count(*) AS stations
FROM per GROUP BY 1, 2""",
)


def _weekdays(where: str) -> str:
    return with_views(
        "trips",
        f"""SELECT lpad(CAST(hour(local) AS VARCHAR), 2, '0') AS hour,
  count(*) FILTER (WHERE isodow(local) < 6) AS weekday, count(*) FILTER (WHERE isodow(local) >= 6) AS weekend
FROM (SELECT timezone('America/New_York', timezone('UTC', started_at)) AS local FROM trips {where}) GROUP BY 1""",
    )


_RECENT_TRIPS = "WHERE started_at > (SELECT max(started_at) FROM trips) - INTERVAL 90 DAY"
ORACLES["weekday_weekend"] = _weekdays(_RECENT_TRIPS)
ORACLES["weekday_weekend_all"] = _weekdays("")
ORACLES["duration_hist"] = with_views(
    "trips",
    f"""SELECT CASE WHEN duration_s < 300 THEN '0–5' WHEN duration_s < 600 THEN '5–10'
  WHEN duration_s < 900 THEN '10–15' WHEN duration_s < 1800 THEN '15–30'
  WHEN duration_s < 3600 THEN '30–60' ELSE '60+' END AS bucket,
  CASE WHEN duration_s < 300 THEN 1 WHEN duration_s < 600 THEN 2 WHEN duration_s < 900 THEN 3
  WHEN duration_s < 1800 THEN 4 WHEN duration_s < 3600 THEN 5 ELSE 6 END AS ord, count(*) AS trips
FROM trips {_RECENT_TRIPS} GROUP BY 1, 2""",
)
ORACLES["hour_rollup"] = with_views(
    "status",
    f"""SELECT date_trunc('hour', polled_at) AS hour, count(*) AS observations, {big("sum(bikes)")} AS bikes,
  {big("sum(ebikes)")} AS ebikes FROM status GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
)
ORACLES["count_snapshots"] = "SELECT count(*) AS snapshots FROM events"
ORACLES["observations_by_station"] = with_views(
    "status stations",
    f"""SELECT name, count(*) AS observations, {mean("bikes", 1)} AS avg_bikes {_JOINED}
ORDER BY observations DESC, name LIMIT 10""",
)


def _ms(engine: str) -> str:
    total = f"sum(CAST(value AS DECIMAL(18,3))) FILTER (WHERE kind = 'agg' AND engine = '{engine}')"
    return f"CAST(round(coalesce({total}, 0), 1) AS DOUBLE)"


ORACLES["log_summary"] = with_views(
    "status",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE kind = 'agg') AS aggregates,
  count(*) FILTER (WHERE kind = 'agg' AND engine = 'remote') AS pushed_down,
  count(*) FILTER (WHERE kind = 'agg' AND engine = 'local') AS run_locally,
  {_ms("remote")} AS ms_remote, {_ms("local")} AS ms_local,
  {big("sum(CASE WHEN k % 2 = 0 THEN k ELSE 0 END)")} AS rows_crossed
FROM (SELECT *, CASE WHEN event_type = 'view' THEN 'map' ELSE 'agg' END AS kind,
             CASE WHEN event_type = 'click' THEN 'remote' ELSE 'local' END AS engine FROM status)""",
)

# ---- snapshots to events ---------------------------------------------------------

ORACLES["snapshot_deltas"] = with_views(
    "deltas", "SELECT station_key, polled_at, delta, gap_seconds FROM deltas"
)
ORACLES["hourly_flows"] = with_views(
    "deltas",
    f"""SELECT date_trunc('hour', polled_at) AS hour_utc, {DEPARTED} AS bikes_departed, {ARRIVED} AS bikes_arrived,
  count(*) FILTER (WHERE abs(delta) >= 5) AS likely_rebalance_events
FROM deltas WHERE delta IS NOT NULL AND gap_seconds < 43200 GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
)
ORACLES["station_flows"] = with_views(
    "deltas stations",
    f"""SELECT name, {DEPARTED} AS departed, {ARRIVED} AS arrived, {DEPARTED} - {ARRIVED} AS net_drain
FROM deltas JOIN stations USING (station_key) WHERE delta IS NOT NULL AND gap_seconds < 43200
GROUP BY name ORDER BY departed DESC, name LIMIT 15""",
)
ORACLES["total_departures"] = with_views("deltas", f"SELECT {DEPARTED} AS departed FROM deltas")
ORACLES["delta_listing"] = with_views(
    "deltas",
    """SELECT station_key, polled_at, bikes AS num_bikes_available, delta FROM deltas
ORDER BY station_key, polled_at, status_id LIMIT 200""",
)
ORACLES["delta_by_level"] = with_views(
    "status",
    """SELECT station_key, bikes AS num_bikes_available,
  bikes - lag(bikes) OVER (PARTITION BY station_key ORDER BY bikes, polled_at, status_id) AS delta
FROM status ORDER BY station_key, bikes, polled_at, status_id LIMIT 200""",
)
_COVERED = "((epoch_us(max(polled_at)) - epoch_us(min(polled_at))) // 1000000)"
ORACLES["flow_balance"] = with_views(
    "deltas",
    f"""SELECT gross_out, gross_in, gross_in - gross_out AS net, {ratio("covered", "3600", 1)} AS covered_hours,
  {ratio("gross_out", "covered", 0, 86400)} AS implied_per_day
FROM (SELECT {DEPARTED} AS gross_out, {ARRIVED} AS gross_in, {_COVERED} AS covered FROM deltas)""",
)
_LEFT = f"""left_dock AS (
  SELECT station_key, polled_at, status_id, least(-delta, 8) AS n FROM (
    SELECT station_key, polled_at, status_id,
           bikes - lag(bikes) OVER (PARTITION BY station_key ORDER BY polled_at, status_id) AS delta
    FROM status WHERE polled_at > {SINCE} - INTERVAL 1 DAY)
  WHERE delta < 0 AND polled_at > {SINCE})"""
ORACLES["departures"] = with_views("status", f", {_LEFT} SELECT * FROM left_dock")
ORACLES["departing_bikes"] = with_views(
    "status",
    f", {_LEFT} SELECT station_key, polled_at, CAST(unnest(range(1, n + 1)) AS INTEGER) AS unit FROM left_dock",
)
ORACLES["thinned_departures"] = with_views(
    "deltas",
    f"""SELECT station_key, status_id, unit FROM (
  SELECT station_key, status_id, CAST(unnest(range(1, least(-delta, 8) + 1)) AS INTEGER) AS unit
  FROM deltas WHERE delta < 0) WHERE {draw("'keep'", "status_id", "unit")} < CAST(0.55 AS DOUBLE)""",
)

# ---- data quality and reconciliation ---------------------------------------------

ORACLES["duplicate_status"] = with_views(
    "landing",
    "SELECT station_id, polled_at, count(*) AS copies FROM landing GROUP BY 1, 2 HAVING count(*) > 1",
)
ORACLES["orphan_facts"] = with_views(
    "status stations",
    """SELECT station_key, count(*) AS facts FROM status
WHERE station_key NOT IN (SELECT station_key FROM stations WHERE capacity IS NOT NULL) GROUP BY 1""",
)
ORACLES["freshness"] = with_views(
    "status",
    """SELECT CAST(round_even((epoch_us(a) - epoch_us(newest)) / 1e6, 0) AS INTEGER) AS seconds_old, rows,
  (epoch_us(a) - epoch_us(newest)) / 1e6 < 300 AS ok
FROM (SELECT max(polled_at) AS a, max(polled_at) FILTER (WHERE NOT is_renting) AS newest,
  count(*) FILTER (WHERE NOT is_renting) AS rows FROM status)""",
)
ORACLES["freshness_whole"] = with_views(
    "status trips",
    """SELECT CAST(round_even((epoch_us(a) - epoch_us(newest)) / 1e6, 0) AS INTEGER) AS seconds_old, rows,
  (epoch_us(a) - epoch_us(newest)) / 1e6 < 300 AS ok
FROM (SELECT (SELECT max(started_at) FROM trips) AS a, max(polled_at) AS newest, count(*) AS rows FROM status)""",
)
ORACLES["reconcile_counts"] = with_views(
    "landing",
    """SELECT 'fact' AS side, count(*) AS rows FROM status
UNION ALL SELECT 'landing', count(DISTINCT (polled_at, station_id)) FROM landing""",
)
ORACLES["reconcile_rows"] = with_views(
    "replica",
    """, base AS (SELECT station_key, name, capacity FROM stations)
SELECT *, 'only_a' AS side, CAST(1 AS BIGINT) AS copies FROM (FROM base EXCEPT ALL FROM replica)
UNION ALL SELECT *, 'only_b', 1 FROM (FROM replica EXCEPT ALL FROM base)""",
)
ORACLES["reconcile_tree"] = with_views(
    "status",
    """, facts AS (SELECT status_id, station_key, polled_at, bikes AS num_bikes_available FROM status),
once AS (SELECT status_id, station_key, polled_at, CASE WHEN status_id % 997 = 0 THEN num_bikes_available + 1
  ELSE num_bikes_available END AS num_bikes_available FROM facts WHERE status_id % 1009 <> 5),
copy AS (FROM once UNION ALL FROM once WHERE status_id % 1013 = 7)
SELECT *, 'only_a' AS side, CAST(1 AS BIGINT) AS copies FROM (FROM facts EXCEPT ALL FROM copy)
UNION ALL SELECT *, 'only_b', 1 FROM (FROM copy EXCEPT ALL FROM facts)""",
)
ORACLES["check_report"] = with_views(
    "status stations trips",
    """, n AS (SELECT
  (SELECT count(*) FROM (SELECT 1 FROM status GROUP BY station_key, polled_at HAVING count(*) > 1)) AS dup,
  (SELECT count(DISTINCT station_key) FROM status WHERE station_key NOT IN (SELECT station_key FROM stations)) AS orphan,
  (SELECT count(*) FROM stations WHERE capacity IS NULL) AS no_cap)
SELECT name, ok, detail, CASE WHEN ok THEN '' ELSE hint END AS hint FROM (
  SELECT 'no duplicate snapshots' AS name, dup = 0 AS ok, dup || ' duplicated' AS detail, 'collapse the landing rows' AS hint FROM n
  UNION ALL SELECT 'no orphan facts', orphan = 0, orphan || ' orphans', 'load the dimension first' FROM n
  UNION ALL SELECT 'data is arriving', age < 300, CAST(age AS INTEGER) || ' s old', 'look at the poller' FROM (
    SELECT round_even((epoch_us((SELECT max(started_at) FROM trips)) - epoch_us(max(polled_at))) / 1e6, 0) AS age FROM status)
  UNION ALL SELECT 'every capacity known', no_cap = 0, no_cap || ' without capacity', 'fill the station list' FROM n)""",
)
ORACLES["poll_gaps"] = with_views(
    "status",
    """SELECT * FROM (
  SELECT lag(polled_at) OVER w AS after, polled_at AS until,
         CAST(epoch_us(polled_at) - epoch_us(lag(polled_at) OVER w) AS DOUBLE) / 1e6 AS gap_seconds
  FROM (SELECT DISTINCT polled_at FROM status) WINDOW w AS (ORDER BY polled_at))
WHERE gap_seconds > 1800""",
)

# ---- spatial ---------------------------------------------------------------------

RADIUS_M = "CAST(6371008.8 AS DOUBLE)"


def metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    dlat, dlon = f"(radians({lat2} - {lat1}) / 2)", f"(radians({lon2} - {lon1}) / 2)"
    return (
        f"(2 * {RADIUS_M} * asin(sqrt(least(sin({dlat}) * sin({dlat}) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * sin({dlon}) * sin({dlon}), 1))))"
    )


def degrees(a: str, b: str) -> str:
    dx, dy = f"({a}.lon - {b}.lon)", f"({a}.lat - {b}.lat)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


MERCATOR_X = "(CAST(6378137 AS DOUBLE) * radians(lon))"
MERCATOR_Y = "(CAST(6378137 AS DOUBLE) * ln(tan(CAST(0.7853981633974483 AS DOUBLE) + radians(lat) / 2)))"


def knn(k: int, order: str) -> str:
    return f"""near AS (
  SELECT * FROM (
    SELECT a.station_key, b.station_key AS neighbour_key,
           CAST(row_number() OVER (PARTITION BY a.station_key ORDER BY {order}, b.station_key) AS INTEGER) AS rank,
           {metres("a.lon", "a.lat", "b.lon", "b.lat")} AS meters
    FROM stations a JOIN stations b ON a.station_key <> b.station_key) WHERE rank <= {k})"""


ORACLES["point_columns"] = with_views(
    "incoming",
    f"""SELECT station_id, 'POINT(' || {_wkt("lon")} || ' ' || {_wkt("lat")} || ')' AS wkt,
  round({MERCATOR_X}, 3) AS x, round({MERCATOR_Y}, 3) AS y FROM incoming WHERE lat <> 0 AND lon <> 0""",
)
ORACLES["trip_distances"] = with_views(
    "trips stations",
    f"""SELECT start_station_key, end_station_key, trips,
  {half_up(metres("a.lon", "a.lat", "b.lon", "b.lat"), 3)} AS metres
FROM (SELECT start_station_key, end_station_key, count(*) AS trips FROM trips GROUP BY 1, 2)
JOIN stations a ON a.station_key = start_station_key JOIN stations b ON b.station_key = end_station_key""",
)
ORACLES["nearest_to_largest"] = with_views(
    "stations",
    f""", anchor AS (SELECT * FROM stations ORDER BY capacity DESC NULLS LAST, station_key LIMIT 1)
SELECT a.name AS busiest_station, s.name AS alternative,
  {half_up(metres("a.lon", "a.lat", "s.lon", "s.lat"))} AS metres
FROM anchor a JOIN stations s ON s.lon <> a.lon OR s.lat <> a.lat
ORDER BY {degrees("a", "s")}, s.station_key LIMIT 5""",
)
ORACLES["knn_join"] = with_views(
    "stations",
    f", {knn(60, degrees('a', 'b'))} SELECT station_key, neighbour_key, rank, {half_up('meters', 3)} AS meters FROM near",
)
ORACLES["knn_join_metres"] = with_views(
    "stations",
    f""", {knn(10, metres("a.lon", "a.lat", "b.lon", "b.lat"))}
SELECT station_key, neighbour_key, rank, {half_up("meters", 3)} AS meters FROM near""",
)
_PLACE = metres("CAST(-74.0 AS DOUBLE)", "CAST(40.65 AS DOUBLE)", "lon", "lat")
ORACLES["within_radius"] = with_views(
    "stations", f"SELECT station_key, name FROM stations WHERE {_PLACE} <= 2000"
)
ORACLES["radius_agg"] = with_views(
    "status stations",
    f"""SELECT count(*) AS observations, {mean("bikes", 1)} AS avg_bikes
FROM status JOIN stations USING (station_key) WHERE {_PLACE} <= 5000""",
)
ORACLES["within_radius_placed"] = ORACLES["within_radius"]
ORACLES["radius_agg_placed"] = ORACLES["radius_agg"]
ORACLES["agg_by_keys"] = with_views(
    "status stations",
    f"""SELECT count(*) AS observations, {mean("bikes", 1)} AS avg_bikes
FROM status JOIN stations USING (station_key) WHERE capacity >= 40""",
)

# Gift wrapping: from the westernmost station, always the next one by turning angle.
HULL = """pts AS (SELECT DISTINCT lon, lat FROM stations),
wrap(i, lon, lat, heading) AS (
  SELECT * FROM (SELECT 0, lon, lat, -pi() / 2 FROM pts ORDER BY lon, lat LIMIT 1)
  UNION ALL
  SELECT i + 1, nxt.lon, nxt.lat, nxt.heading FROM (
    SELECT w.i, min({'turn': fmod(atan2(p.lat - w.lat, p.lon - w.lon) - w.heading + 4 * pi(), 2 * pi()),
                     'far': -((p.lon - w.lon) * (p.lon - w.lon) + (p.lat - w.lat) * (p.lat - w.lat)),
                     'lon': p.lon, 'lat': p.lat, 'heading': atan2(p.lat - w.lat, p.lon - w.lon)}) AS nxt
    FROM wrap w JOIN pts p ON p.lon <> w.lon OR p.lat <> w.lat GROUP BY w.i)
  WHERE (nxt.lon, nxt.lat) NOT IN (SELECT (lon, lat) FROM pts ORDER BY lon, lat LIMIT 1)),
hull AS (SELECT i, lon, lat FROM wrap),
loop AS (SELECT lon, lat, coalesce(lead(lon) OVER (ORDER BY i), first(lon) OVER (ORDER BY i)) AS lon2,
                coalesce(lead(lat) OVER (ORDER BY i), first(lat) OVER (ORDER BY i)) AS lat2 FROM hull)"""
_SPHERE_TERM = "radians(lon2 - lon) * (2 + sin(radians(lat)) + sin(radians(lat2)))"
_SPHERE_AREA = f"(abs(sum({_SPHERE_TERM})) * ({RADIUS_M} * {RADIUS_M} / 2 / 1e6))"
ORACLES["convex_hull"] = with_views("stations", f", {HULL} SELECT i, lon, lat FROM hull", recursive=True)
ORACLES["network_density"] = with_views(
    "stations",
    f""", {HULL}, area AS (SELECT {_SPHERE_AREA} AS km2 FROM loop), n AS (SELECT count(*) AS stations FROM stations)
SELECT {half_up("km2", 2)} AS network_km2, stations, {half_up("stations / km2", 2)} AS stations_per_km2
FROM area, n""",
    recursive=True,
)
# Cells as half-planes (a x + b y <= c, seen from the station): the nearest 90 bisectors and the hull.
# Corners that all of them keep and that no station at all is nearer to are the ring.
CELLS = f"""{HULL},
site AS (SELECT lon, lat, row_number() OVER (ORDER BY lon, lat) AS id FROM pts),
plane AS (
  SELECT s.id, o.lon - s.lon AS a, o.lat - s.lat AS b, ((o.lon - s.lon) ** 2 + (o.lat - s.lat) ** 2) / 2 AS c
  FROM site s JOIN site o ON o.id <> s.id
  QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY (o.lon - s.lon) ** 2 + (o.lat - s.lat) ** 2, o.id) <= 90
  UNION ALL
  SELECT id, e.lat2 - e.lat, e.lon - e.lon2,
         (e.lat2 - e.lat) * (e.lon - s.lon) + (e.lon - e.lon2) * (e.lat - s.lat) FROM site s CROSS JOIN loop e),
unit AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY a, b) AS l,
                a / sqrt(a * a + b * b) AS a, b / sqrt(a * a + b * b) AS b, c / sqrt(a * a + b * b) AS c FROM plane),
crossing AS (
  SELECT id, p.l AS l, q.l AS m, (p.c * q.b - q.c * p.b) / (p.a * q.b - q.a * p.b) AS x,
         (p.a * q.c - q.a * p.c) / (p.a * q.b - q.a * p.b) AS y
  FROM unit p JOIN unit q USING (id) WHERE p.l < q.l AND abs(p.a * q.b - q.a * p.b) > 1e-12),
kept AS (SELECT id, x, y FROM crossing JOIN unit u USING (id)
         GROUP BY id, crossing.l, crossing.m, x, y HAVING max(u.a * x + u.b * y - u.c) <= 1e-12),
corner AS (SELECT id, s.lon + x AS lon, s.lat + y AS lat FROM kept k JOIN site s USING (id)
  WHERE NOT EXISTS (SELECT 1 FROM site o
    WHERE (o.lon - s.lon - x) ** 2 + (o.lat - s.lat - y) ** 2 < x * x + y * y - 1e-12)),
turned AS (SELECT id, lon, lat, atan2(lat - avg(lat) OVER (PARTITION BY id), lon - avg(lon) OVER (PARTITION BY id)) AS t
           FROM corner),
edge AS (SELECT id, lon, lat, coalesce(lead(lon) OVER w, first(lon) OVER w) AS lon2,
                coalesce(lead(lat) OVER w, first(lat) OVER w) AS lat2
         FROM turned WINDOW w AS (PARTITION BY id ORDER BY t, lon, lat)),
cell AS (SELECT id, {_SPHERE_AREA} AS km2 FROM edge GROUP BY id),
area AS (SELECT station_key, name, capacity, coalesce(km2, 0) AS km2, {half_up("coalesce(km2, 0)", 3)} AS service_km2
         FROM stations JOIN site USING (lon, lat) LEFT JOIN cell USING (id))"""
ORACLES["service_areas"] = with_views(
    "stations",
    f""", {CELLS} SELECT name, capacity, service_km2 FROM area
ORDER BY service_km2 DESC NULLS LAST, station_key LIMIT 10""",
    recursive=True,
)
ORACLES["service_area_features"] = with_views(
    "stations", f", {CELLS} SELECT name, capacity, service_km2 AS km2 FROM area WHERE km2 > 0", recursive=True
)
_W = "CAST(0.004 AS DOUBLE)"
ORACLES["polygon_areas"] = with_views(
    "stations",
    f""", edges AS (
  SELECT station_key, lon + a AS lon, lat + b AS lat, lon + a2 AS lon2, lat + b2 AS lat2
  FROM stations, (VALUES ({_W}, 0, 0, {_W}), (0, {_W}, -{_W}, 0), (-{_W}, 0, 0, -{_W}), (0, -{_W}, {_W}, 0)) c(a, b, a2, b2))
SELECT station_key AS polygon_id, {half_up(_SPHERE_AREA, 6)} AS km2 FROM edges GROUP BY station_key""",
)
_E2 = "CAST(0.0066943799901413165 AS DOUBLE)"  # of the WGS 84 spheroid


def _authalic(lat: str) -> str:
    s = f"sin(radians({lat}))"
    return (
        f"((1 - {_E2}) / 2 * ({s} / (1 - {_E2} * {s} * {s}) + "
        f"ln((1 + sqrt({_E2}) * {s}) / (1 - sqrt({_E2}) * {s})) / (2 * sqrt({_E2}))))"
    )


ORACLES["polygon_areas_spheroid"] = with_views(
    "stations",
    f""", edges AS (
  SELECT station_key, lon + a AS lon, lat + b AS lat, lon + a2 AS lon2, lat + b2 AS lat2
  FROM stations, (VALUES ({_W}, 0, 0, {_W}), (0, {_W}, -{_W}, 0), (-{_W}, 0, 0, -{_W}), (0, -{_W}, {_W}, 0)) c(a, b, a2, b2))
SELECT station_key AS polygon_id,
  {half_up(f"abs(sum(radians(lon2 - lon) * ({_authalic('lat')} + {_authalic('lat2')}))) * 6378137.0 * 6378137.0 / 2e6", 6)} AS km2
FROM edges GROUP BY station_key""",
)
DBSCAN = f"""xy AS (SELECT station_key, {MERCATOR_X} AS x, {MERCATOR_Y} AS y FROM stations),
nb AS (SELECT a.station_key AS a, b.station_key AS b FROM xy a JOIN xy b
       ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 400),
core AS (SELECT a AS c FROM nb GROUP BY a HAVING count(*) >= 5),
links AS (SELECT a, b FROM nb WHERE a IN (FROM core) AND b IN (FROM core)),
reach(c, r) AS (SELECT c, c FROM core UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.r),
label AS (SELECT c, min(r) AS label FROM reach GROUP BY c),
clustered AS (
  SELECT s.station_key, coalesce(any_value(own.label), min(l.label)) AS cluster
  FROM stations s LEFT JOIN label own ON own.c = s.station_key
  LEFT JOIN nb ON nb.a = s.station_key LEFT JOIN label l ON l.c = nb.b GROUP BY s.station_key)"""
ORACLES["density_clusters"] = with_views("stations", f", {DBSCAN} SELECT * FROM clustered", recursive=True)
ORACLES["cluster_sizes"] = with_views(
    "stations",
    f""", {DBSCAN}, sizes AS (SELECT cluster, count(*) AS stations FROM clustered GROUP BY 1
  ORDER BY stations DESC, cluster NULLS LAST LIMIT 10)
SELECT coalesce(CAST(cluster AS VARCHAR), 'unclustered') AS cluster, stations FROM sizes""",
    recursive=True,
)
_STEP = "CAST(0.005 AS DOUBLE)"
ORACLES["service_grid"] = with_views(
    "stations",
    f""", edge AS (SELECT min(lon) AS lon0, max(lon) AS lon1, min(lat) AS lat0, max(lat) AS lat1 FROM stations),
cells AS (
  SELECT i, j, lon0 + (i + CAST(0.5 AS DOUBLE)) * {_STEP} AS lon, lat0 + (j + CAST(0.5 AS DOUBLE)) * {_STEP} AS lat
  FROM edge, range(CAST(greatest(ceil((lon1 - lon0) / {_STEP}), 1) AS BIGINT)) a(i),
       range(CAST(greatest(ceil((lat1 - lat0) / {_STEP}), 1) AS BIGINT)) b(j)),
owner AS (SELECT i, j, c.lat, min({{'d': {degrees("c", "s")}, 'k': s.station_key}}).k AS station_key
          FROM cells c, stations s GROUP BY i, j, c.lat)
SELECT station_key, count(*) AS cells, {half_up(f"sum((sin(radians(lat + {_STEP} / 2)) - sin(radians(lat - {_STEP} / 2))) * radians({_STEP}) * ({RADIUS_M} * {RADIUS_M} / 1e6))", 6)} AS km2
FROM owner GROUP BY station_key""",
)
ORACLES["points_in_polygons"] = with_views(
    "stations",
    f"""SELECT p.station_key AS polygon_id, s.station_key FROM stations p JOIN stations s
  ON abs(s.lon - p.lon) + abs(s.lat - p.lat) < {_W}""",
)
ORACLES["polygon_cover"] = with_views(
    "stations",
    f"""SELECT p.station_key AS polygon_id, s.station_key FROM stations p JOIN stations s
  ON abs(s.lon - p.lon) + abs(s.lat - p.lat) < {_W}
UNION ALL SELECT -1, station_key FROM stations
WHERE lon > -74.045 AND lon < -73.82 AND lat < 40.83 AND
  lat > CASE WHEN lon < -73.95 THEN 40.605 + (lon + 74.045) / 0.095 * 0.045 ELSE 40.65 - (lon + 73.95) / 0.13 * 0.045 END""",
)
ORACLES["flow_lines"] = with_views(
    "trips stations",
    f""", {_OD} SELECT start_station_key, end_station_key, a.name AS from_name, b.name AS to_name, trips,
  {half_up(metres("a.lon", "a.lat", "b.lon", "b.lat") + " / 1000", 2)} AS km,
  a.lon AS from_lon, a.lat AS from_lat, b.lon AS to_lon, b.lat AS to_lat
FROM od JOIN stations a ON a.station_key = start_station_key JOIN stations b ON b.station_key = end_station_key""",
)



def _geodesic(rounds: int = 8) -> str:
    """``a b metres`` on the WGS 84 spheroid from ``ends`` (``a b lon1 lat1 lon2 lat2``); a subquery per round."""
    f, minor = "CAST(0.0033528106647474805 AS DOUBLE)", "CAST(6356752.314245179 AS DOUBLE)"
    keep = "a, b, s1, c1, s2, c2, apart"
    arc = f"""SELECT {keep}, sqrt(power(c2 * sin(lam), 2) + power(c1 * s2 - s1 * c2 * cos(lam), 2)) AS sine,
  s1 * s2 + c1 * c2 * cos(lam) AS cosine, atan2(sine, cosine) AS sigma,
  CASE WHEN sine > 0 THEN c1 * c2 * sin(lam) / sine ELSE 0 END AS sina, 1 - sina * sina AS cos2a,
  cosine - CASE WHEN cos2a > 1e-24 THEN 2 * s1 * s2 / cos2a ELSE 0 END AS m, {f} / 16 * cos2a * (4 + {f} * (4 - 3 * cos2a)) AS c"""
    rows = f"""SELECT a, b, atan((1 - {f}) * tan(radians(lat1))) AS u1, atan((1 - {f}) * tan(radians(lat2))) AS u2,
  sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, radians(lon2 - lon1) AS apart, apart AS lam FROM ends"""
    for _ in range(rounds):
        rows = f"""SELECT {keep}, apart + (1 - c) * {f} * sina * (sigma + c * sine * (m + c * cosine * (2 * m * m - 1))) AS lam
FROM ({arc} FROM ({rows}))"""
    return f"""SELECT a, b, cos2a * (power(CAST(6378137 AS DOUBLE), 2) - power({minor}, 2)) / power({minor}, 2) AS u2,
  1 + u2 / 16384 * (4096 + u2 * (u2 * (320 - 175 * u2) - 768)) AS scale, u2 / 1024 * (256 + u2 * (u2 * (74 - 47 * u2) - 128)) AS bend,
  {minor} * scale * (sigma - bend * sine * (m + bend / 4 * (cosine * (2 * m * m - 1)
    - bend / 6 * m * (4 * sine * sine - 3) * (4 * m * m - 3)))) AS metres
FROM ({arc} FROM ({rows}))"""


ORACLES["flow_geodesics"] = with_views(
    "trips stations",
    f""", {_OD}, ends AS (
  SELECT start_station_key AS a, end_station_key AS b, x.lon AS lon1, x.lat AS lat1, y.lon AS lon2, y.lat AS lat2
  FROM od JOIN stations x ON x.station_key = start_station_key JOIN stations y ON y.station_key = end_station_key)
SELECT a AS start_station_key, b AS end_station_key, {half_up("metres", 3)} AS metres FROM ({_geodesic()})""",
)
ORACLES["flow_features"] = with_views(
    "trips stations",
    f""", {_OD} SELECT a.name AS from_name, b.name AS to_name, trips,
  {half_up(metres("a.lon", "a.lat", "b.lon", "b.lat") + " / 1000", 2)} AS km,
  a.lon AS from_lon, a.lat AS from_lat, b.lon AS to_lon, b.lat AS to_lat
FROM od JOIN stations a ON a.station_key = start_station_key JOIN stations b ON b.station_key = end_station_key""",
)

# ---- weighted choice and profiles --------------------------------------------------

POOL = f"""{knn(60, degrees("a", "b"))},
cum AS (
  SELECT station_key AS s, neighbour_key AS e, meters,
         sum(exp(-meters / 1500)) OVER (PARTITION BY station_key ORDER BY neighbour_key ROWS UNBOUNDED PRECEDING) AS run,
         sum(exp(-meters / 1500)) OVER (PARTITION BY station_key) AS tot,
         lead(neighbour_key) OVER (PARTITION BY station_key ORDER BY neighbour_key) AS nxt FROM near),
pool AS (
  SELECT s AS start_station_key, e AS end_station_key, meters,
         coalesce(lag(run / tot) OVER (PARTITION BY s ORDER BY e), 0) AS w_lo,
         CASE WHEN nxt IS NULL THEN 1 ELSE run / tot END AS w_hi FROM cum)"""
ORACLES["decay_pool"] = with_views(
    "stations",
    f""", {POOL} SELECT start_station_key, end_station_key, {half_up("meters", 3)} AS meters,
  {half_up("w_lo", 9)} AS w_lo, {half_up("w_hi", 9)} AS w_hi FROM pool""",
)
CDF = """cdf AS (
  SELECT station_key, CAST(run - cap AS DOUBLE) / CAST(tot AS DOUBLE) AS w_lo, CAST(run AS DOUBLE) / CAST(tot AS DOUBLE) AS w_hi FROM (
    SELECT station_key, coalesce(capacity, 1) AS cap,
           sum(coalesce(capacity, 1)) OVER (ORDER BY station_key ROWS UNBOUNDED PRECEDING) AS run,
           sum(coalesce(capacity, 1)) OVER () AS tot FROM stations))"""
ORACLES["capacity_cdf"] = with_views("stations", f", {CDF} SELECT * FROM cdf")
ORACLES["origin_draws"] = with_views(
    "status stations",
    f""", {CDF} SELECT status_id, cdf.station_key
FROM (SELECT status_id, {draw("'origin'", "status_id")} AS u FROM status) JOIN cdf ON u >= w_lo AND u < w_hi""",
)
ORACLES["expected_od"] = with_views(
    "deltas stations",
    f""", {POOL}, gone AS (
  SELECT station_key AS start_station_key, {big("sum(least(-delta, 8))")} AS n FROM deltas WHERE delta < 0 GROUP BY 1)
SELECT start_station_key, end_station_key, n, {half_up("n * (w_hi - w_lo)", 6)} AS expected
FROM pool JOIN gone USING (start_station_key)""",
)


ORACLES["trip_attributes"] = with_views(
    "trips",
    f"""SELECT rideable_type, member_casual, count(*) AS trips, {big("sum(duration_s)")} AS seconds,
  {half_up("avg(duration_s)")} AS avg_seconds, {half_up("sum(meters) / sum(duration_s)", 3)} AS metres_per_second
FROM trips GROUP BY 1, 2""",
)
ORACLES["observed_trips"] = with_views(
    "deltas trips",
    f""", gone AS (
  SELECT station_key, {big("sum(least(-delta, 8))")} AS departures FROM deltas WHERE delta < 0 GROUP BY 1),
counted AS (SELECT start_station_key AS station_key, count(*) AS trips FROM trips GROUP BY 1),
pair AS (SELECT station_key, coalesce(departures, 0) AS departures, coalesce(trips, 0) AS trips
         FROM gone FULL JOIN counted USING (station_key))
SELECT *, {ratio("trips", "departures", 3)} AS trips_per_departure FROM pair""",
)
PROFILE = """hours AS (
  SELECT CAST(t AS DATE) AS day, CAST(hour(t) AS INTEGER) AS h, isodow(t) >= 6 AS weekend, count(*) AS n
  FROM (SELECT timezone('America/New_York', timezone('UTC', started_at)) AS t FROM trips) GROUP BY 1, 2, 3),
grid AS (SELECT weekend, CAST(h AS INTEGER) AS h FROM (SELECT DISTINCT weekend FROM hours), range(24) r(h)),
profile AS (
  SELECT weekend, h, CAST(coalesce(sum(n), 0) AS BIGINT) AS trips,
         CAST(coalesce(sum(n), 0) AS DOUBLE) / sum(sum(n)) OVER (PARTITION BY weekend) AS share
  FROM grid LEFT JOIN hours USING (weekend, h) GROUP BY 1, 2)"""
ORACLES["hour_profile"] = with_views(
    "trips", f", {PROFILE} SELECT weekend, h, trips, {half_up('share', 9)} AS share FROM profile"
)
ORACLES["apportion"] = with_views(
    "trips",
    f""", {PROFILE}, days AS (SELECT day, weekend, sum(n) AS of_day FROM hours GROUP BY 1, 2),
typical AS (SELECT avg(of_day) AS m FROM days),
season AS (SELECT dayofyear(day) AS doy, avg(of_day) / (SELECT m FROM typical) AS season FROM days GROUP BY 1),
week AS (SELECT weekend, avg(of_day) / (SELECT m FROM typical) AS week FROM days GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, p.h, {half_up("m * season * week * share", 6)} AS expected,
  CAST(coalesce(n, 0) AS BIGINT) AS trips,
  timezone('UTC', timezone('America/New_York', CAST(day AS TIMESTAMP) + to_hours(p.h))) AS starts_at
FROM days JOIN season ON doy = dayofyear(day) JOIN week USING (weekend) JOIN profile p USING (weekend)
  CROSS JOIN typical LEFT JOIN (SELECT day, h, n FROM hours) c USING (day, h)""",
)
ORACLES["local_instants"] = with_views(
    "trips",
    """SELECT date_trunc('hour', timezone('UTC', timezone('America/New_York', started_at))) AS hour, count(*) AS trips
FROM trips GROUP BY 1""",
)

# ---- streaming ------------------------------------------------------------------------

ORACLES["stream_landing"] = ORACLES["landing_collapsed"]
ORACLES["stream_sync"] = with_views(
    "landing",
    f"""SELECT station_id, polled_at, last_reported, num_bikes_available,
  is_renting = 1 AS is_renting, is_returning = 1 AS is_returning FROM ({_COLLAPSED})""",
)
ORACLES["stream_poll_totals"] = with_views(
    "status",
    f"""SELECT polled_at, count(*) AS stations, {big("sum(bikes)")} AS bikes, {big("sum(ebikes)")} AS ebikes,
  {big("sum(docks)")} AS docks FROM status GROUP BY polled_at""",
)
ORACLES["stream_hour_rollup"] = ORACLES["hour_rollup"]
ORACLES["stream_cdc"] = ORACLES["apply_cdc"]
ORACLES["stream_departures"] = with_views(
    "deltas",
    "SELECT station_key, polled_at, status_id, least(-delta, 8) AS n FROM deltas WHERE delta < 0",
)
ORACLES["stream_departures_shuffled"] = ORACLES["stream_departures"]
