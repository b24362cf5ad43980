"""The registered queries as SQL for DuckDB, written from the events table and not from the Spark code.

Averages are integer arithmetic on hundredths and windows are integer arithmetic on microseconds, so that both
engines agree to the last digit. Timestamps are compared as ISO text.
"""

from __future__ import annotations

REPLAY_SEQ = 1 << 40


def iso(ts: str) -> str:
    return (
        f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
    )


def iso_s(epoch_seconds: str) -> str:
    return f"strftime(make_timestamp(({epoch_seconds}) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')"


def avg4(total: str, count: str) -> str:
    return f"((200 * {total} + {count}) // (2 * {count})) / 10000.0"


def raw(warmer: str = "1", extra: str = "") -> str:
    return f"""
raw AS (
  SELECT CASE WHEN event_id % 101 <> 100 THEN user_id + 1 END AS truck_id,
         CASE WHEN event_id % 89 <> 88 THEN round(value - 5 + copy * {warmer}, 2) END AS temperature,
         CASE WHEN event_id % 97 = 96 THEN 'not-a-timestamp'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') ||
                   CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+00:00' ELSE '' END END AS "timestamp",
         CASE WHEN event_id % 3 <> 2 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS fuel_level,
         CASE WHEN event_id % 4 <> 3 THEN 25 + (event_id % 2400) / 100 END AS latitude,
         CASE WHEN event_id % 4 <> 3 THEN -125 + (event_id % 5800) / 100 END AS longitude,
         event_id + copy * {REPLAY_SEQ} AS seq,
         ts + to_seconds(2 * copy) AS arrival,
         CASE WHEN event_id % 97 <> 96 THEN ts END AS event_time{extra}
  FROM events, (VALUES (0), (1)) AS deliveries(copy)
)"""


FIRSTS = """
firsts AS (
  SELECT * FROM raw WHERE truck_id IS NOT NULL AND "timestamp" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY truck_id, "timestamp" ORDER BY seq) = 1
)"""

ACCEPTED = """
accepted AS (SELECT * FROM firsts WHERE temperature IS NULL OR temperature > 0)"""

NORM = """
norm AS (
  SELECT truck_id, CAST(round(temperature * 100) AS BIGINT) AS centi, event_time, "timestamp", seq
  FROM firsts WHERE temperature > 0 AND event_time IS NOT NULL
)"""


def base(*parts: str) -> str:
    return "WITH " + ",".join(parts)


NORMALIZED = (raw(), FIRSTS, NORM)


def tumbling(size: int, source: str = "norm", keys: str = "truck_id") -> str:
    return f"""
  SELECT {keys}, 'tumbling' AS window_type, (epoch_us(event_time) // {size * 1000000}) * {size} AS w,
         {size} AS size, sum(centi)::BIGINT AS s, count(*) AS n
  FROM {source} GROUP BY ALL"""


def hopping(size: int, step: int, source: str = "norm", keys: str = "truck_id") -> str:
    """Start of the latest hop at or before the reading, minus k hops, while the window still covers it."""
    hops = -(-size // step)
    return f"""
  SELECT {keys}, 'hopping' AS window_type,
         (epoch_us(event_time) // {step * 1000000} - k) * {step} AS w,
         {size} AS size, sum(centi)::BIGINT AS s, count(*) AS n
  FROM {source}, range(0, {hops}) AS h(k)
  WHERE epoch_us(event_time) < ((epoch_us(event_time) // {step * 1000000} - k) * {step} + {size}) * 1000000
  GROUP BY ALL"""


def windows(size: int, step: int, source: str = "norm", keys: str = "truck_id") -> str:
    return f"windows AS ({tumbling(size, source, keys)} UNION ALL {hopping(size, step, source, keys)})"


def wire(source: str = "windows", keys: str = "truck_id", where: str = "") -> str:
    return f"""
SELECT {keys}, window_type, {iso_s('w')} AS window_start, {iso_s('w + size')} AS window_end,
       {avg4('s', 'n')} AS average_temperature, n AS reading_count
FROM {source} {where}"""


RUNNING = """
running AS (
  SELECT truck_id, seq,
         (sum(centi) OVER p)::BIGINT AS s, count(*) OVER p AS n
  FROM norm WINDOW p AS (PARTITION BY truck_id ORDER BY seq ROWS UNBOUNDED PRECEDING)
)"""

TOTALS = f"""
totals AS (
  SELECT truck_id, sum(centi)::BIGINT / 100.0 AS "sum", count(*) AS "count",
         {avg4('sum(centi)::BIGINT', 'count(*)')} AS average
  FROM norm GROUP BY truck_id
)"""

# Writes whose count is a multiple of seven delete; a truck is live when its last write is none of those.
LIVE = f"""
live AS (
  SELECT truck_id, s / 100.0 AS "sum", n AS "count", {avg4('s', 'n')} AS average
  FROM (SELECT * FROM running QUALIFY row_number() OVER (PARTITION BY truck_id ORDER BY seq DESC) = 1)
  WHERE n % 7 <> 0
)"""

JSON_NUMBER = "CASE WHEN {0} IS NULL THEN 'null' ELSE CAST({0} AS VARCHAR) END"


def average_json(where: str = "") -> str:
    return f"""
SELECT CAST(truck_id AS VARCHAR) AS key,
       '{{"truck_id":' || truck_id || ',"window_type":"' || window_type ||
       '","window_start":"' || {iso_s('w')} || '","window_end":"' || {iso_s('w + size')} ||
       '","average_temperature":' || CAST({avg4('s', 'n')} AS VARCHAR) || ',"reading_count":' || n ||
       ',"computed_at":"' || {iso_s('w + size')} || '"}}' AS value
FROM windows {where}"""


READING_JSON = f"""
'{{"truck_id":' || {JSON_NUMBER.format('truck_id')} || ',"temperature":' || {JSON_NUMBER.format('temperature')} ||
',"timestamp":"' || "timestamp" || '","fuel_level":' || {JSON_NUMBER.format('fuel_level')} ||
',"latitude":' || {JSON_NUMBER.format('latitude')} || ',"longitude":' || {JSON_NUMBER.format('longitude')} || '}}'
"""

STAGED = """
staged AS (
  SELECT raw.*,
         CASE WHEN raw.truck_id IS NULL OR raw."timestamp" IS NULL THEN 'no_key'
              WHEN row_number() OVER (PARTITION BY raw.truck_id, raw."timestamp" ORDER BY raw.seq) > 1
                THEN 'duplicate'
              WHEN temperature <= 0 THEN 'filtered'
              ELSE 'accepted' END AS stage
  FROM raw
)"""


def last_known(column: str) -> str:
    return f"arg_max({column}, seq) FILTER (WHERE {column} IS NOT NULL) AS {column}"


LATEST = f"""
latest AS (
  SELECT truck_id, arg_max_null(temperature, seq) AS last_temperature,
         arg_max("timestamp", seq) AS last_timestamp,
         {last_known('fuel_level')}, {last_known('latitude')}, {last_known('longitude')}
  FROM accepted GROUP BY truck_id
)"""

# The second fleet of the roster: customers as trucks, orders as readings, windows of a day and of six-hour hops.
ORDER_WINDOWS = f"""
orders_norm AS (
  SELECT o_custkey AS truck_id, CAST(floor(o_totalprice / 1000 * 100 + 0.5) AS BIGINT) AS centi,
         o_orderdate AS event_time
  FROM orders
), order_windows AS ({tumbling(86400, 'orders_norm')} UNION ALL {hopping(86400, 21600, 'orders_norm')}),
order_averages AS (
  SELECT truck_id, window_type, {avg4('s', 'n')} AS average, n, w + size AS closed,
         (w + size) * 2000000 + CASE window_type WHEN 'tumbling' THEN 1 ELSE 0 END AS seq
  FROM order_windows
)"""


def by_truck_averages(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT truck_id,
         arg_max(average, seq) FILTER (WHERE window_type = 'tumbling') AS tumbling_avg,
         arg_max(average, seq) FILTER (WHERE window_type = 'hopping') AS hopping_avg,
         sum(n)::BIGINT AS reading_count,
         coalesce(sum(n) FILTER (WHERE window_type = 'tumbling'), 0)::BIGINT AS tumbling_count,
         arg_min(average, seq) AS first_average,
         {iso_s('arg_min(closed, seq)')} AS first_computed_at
  FROM {source} GROUP BY truck_id
)"""


ROSTER = f"""
roster AS (
  SELECT coalesce(l.truck_id, a.truck_id) AS truck_id,
         CASE WHEN l.truck_id IS NOT NULL THEN last_temperature ELSE first_average END AS last_temperature,
         CASE WHEN l.truck_id IS NOT NULL THEN last_timestamp ELSE first_computed_at END AS last_timestamp,
         fuel_level, latitude, longitude, tumbling_avg, hopping_avg,
         coalesce(reading_count, 0) AS reading_count, coalesce(tumbling_count, 0) AS tumbling_count,
         'active' AS status
  FROM latest l FULL OUTER JOIN order_latest a ON l.truck_id = a.truck_id
)"""
ROSTER_PARTS = (
    raw(), FIRSTS, ACCEPTED, LATEST, ORDER_WINDOWS, by_truck_averages("order_averages", "order_latest"), ROSTER
)

ANOMALY_COLUMNS = """truck_id, temperature, "timestamp", 'High Temperature Alert' AS type,
       CASE WHEN temperature > 45 THEN 'critical' ELSE 'warning' END AS severity, seq"""


def stage_rate(window: int, refresh: int, averages: bool) -> str:
    """Every refresh step whose trailing window holds an event."""
    aggregates = """
  UNION ALL SELECT (w + size) * 1000000, 'aggregate' FROM windows""" if averages else ""
    return f"""
stamped AS (
  SELECT epoch_us(arrival) AS us, stage FROM staged WHERE stage <> 'no_key'{aggregates}
), samples AS (
  SELECT (us // {refresh * 1000000} + 1 + k) * {refresh} AS sampled_at, stage
  FROM stamped, range(0, {window // refresh}) AS h(k)
), rates AS (
  SELECT sampled_at, round(count(*) FILTER (WHERE stage = 'accepted') / {window}.0, 2) AS ingestion_rate,
         round(count(*) FILTER (WHERE stage = 'filtered') / {window}.0, 2) AS filter_rate,
         round(count(*) FILTER (WHERE stage = 'duplicate') / {window}.0, 2) AS duplicate_rate,
         round(count(*) FILTER (WHERE stage = 'aggregate') / {window}.0, 2) AS aggregate_rate
  FROM samples GROUP BY sampled_at
)"""


def counter(window: int, having: str = "") -> str:
    return f"""
WITH samples AS (
  SELECT event_type AS metric, ts, CAST(max(event_id % 1000) AS DOUBLE) AS value FROM events GROUP BY ALL {having}
), grown AS (
  SELECT *, CASE WHEN lag(value) OVER o IS NULL THEN 0.0
                 WHEN value >= lag(value) OVER o THEN value - lag(value) OVER o ELSE value END AS increase
  FROM samples WINDOW o AS (PARTITION BY metric ORDER BY ts)
)
SELECT metric, {iso('ts')} AS ts, value,
       sum(increase) OVER (PARTITION BY metric ORDER BY epoch_us(ts)
                           RANGE BETWEEN {window * 1000000} PRECEDING AND CURRENT ROW) / {window}.0 AS rate
FROM grown"""


ALERTS = """
WITH gauges AS (
  SELECT 'kafka_connected' AS metric, ts, max(CASE WHEN value < 40 THEN 0.0 ELSE 1.0 END) AS value
  FROM events GROUP BY ts
  UNION ALL SELECT 'workers_running', ts, max(floor(value / 30)) FROM events GROUP BY ts
  UNION ALL SELECT 'anomalies', ts, max(value) FROM events GROUP BY ts
), judged AS (
  SELECT CASE metric WHEN 'kafka_connected' THEN 'KafkaDown' WHEN 'workers_running' THEN 'NoWorkers'
                     ELSE 'HighAnomalies' END AS alert,
         CASE metric WHEN 'anomalies' THEN 'info' ELSE 'warning' END AS severity,
         metric, ts, CAST(value AS DOUBLE) AS value,
         CASE metric WHEN 'kafka_connected' THEN 60 ELSE 120 END AS hold,
         CASE metric WHEN 'anomalies' THEN value > 20 ELSE value = 0 END AS active
  FROM gauges
), runs AS (
  SELECT *, count(*) FILTER (WHERE NOT active) OVER (PARTITION BY metric ORDER BY ts) AS run FROM judged
), started AS (
  SELECT *, CASE WHEN active THEN min(ts) FILTER (WHERE active) OVER (PARTITION BY metric, run) END AS since
  FROM runs
), states AS (
  SELECT alert, severity, metric, ts, value, since,
         CASE WHEN NOT active THEN 'inactive'
              WHEN epoch_us(ts) - epoch_us(since) >= hold * 1000000 THEN 'firing' ELSE 'pending' END AS state
  FROM started
)"""

DATASET = """
WITH dataset AS (
  SELECT CASE WHEN event_id % 101 <> 100 THEN 'UNIT-' || user_id END AS truck_id,
         CASE WHEN event_id % 89 <> 88 THEN round(value - 25, 2) END AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS fuel,
         25 + (event_id % 2400) / 100 AS latitude, -125 + (event_id % 5800) / 100 AS longitude,
         strftime(ts, '%d-%m-%Y %H:%M') AS "timestamp", date_trunc('minute', ts) AS event_time
  FROM events
)"""


def once(warmed: str, counted: str) -> str:
    return f"""{base(raw('0'), f'''
valid AS (SELECT * FROM raw WHERE truck_id IS NOT NULL AND temperature > 0 AND event_time IS NOT NULL)''')}
SELECT {counted} AS counted, count(DISTINCT (truck_id, "timestamp")) AS distinct_sent,
       count(*) AS total_sent, '{warmed}' AS verdict FROM valid"""


HALF_WAY = """
ends AS (SELECT (user_id + 1) % 20 AS part, max(event_id) // 2 AS until FROM events GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "read_telemetry": f"""{base(raw())}
SELECT truck_id, temperature, "timestamp", fuel_level, latitude, longitude,
       coalesce(truck_id % 20, 0) * 281474976710656 + seq AS seq, {iso('arrival')} AS arrival FROM raw""",
    "write_averages": f"{base(*NORMALIZED, windows(21600, 3600))}{average_json()}",
    "read_averages_log": f"""{base(*NORMALIZED, windows(86400, 21600))}
SELECT truck_id, window_type, {iso_s('w')} AS window_start, {iso_s('w + size')} AS window_end,
       {avg4('s', 'n')} AS average_temperature, n AS reading_count, {iso_s('w + size')} AS computed_at
FROM windows""",
    "write_changelog": f"""{base(*NORMALIZED, RUNNING)}
SELECT 'truck:' || truck_id AS key,
       '{{"sum":' || CAST(s / 100.0 AS VARCHAR) || ',"count":' || n || '}}' AS value, seq FROM running""",
    "read_changelog_log": f"""{base(*NORMALIZED, RUNNING)}
SELECT 'truck:' || truck_id AS key, s / 100.0 AS "sum", n AS "count", seq FROM running""",
    "read_log_from_offsets": f"""{base(raw(), HALF_WAY)}
SELECT truck_id, temperature, "timestamp", coalesce(truck_id % 20, 0) * 281474976710656 + seq AS seq
FROM raw LEFT JOIN ends ON part = coalesce(truck_id % 20, 0) WHERE seq > coalesce(until, -1)""",
    "read_log_from_time": f"""{base(raw())}
SELECT truck_id, temperature, "timestamp", coalesce(truck_id % 20, 0) * 281474976710656 + seq AS seq FROM raw
WHERE epoch_us(arrival) >= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events)""",
    "fleet_csv": f"""{DATASET}
SELECT * EXCLUDE (event_time), {iso('event_time')} AS event_time FROM dataset""",
    "schema_versions": f"""{base(raw())}
SELECT 'old' AS reader, truck_id, temperature, "timestamp", CAST(NULL AS DOUBLE) AS fuel_level,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM raw
UNION ALL
SELECT 'new', truck_id, temperature, "timestamp", CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
       CAST(NULL AS DOUBLE) FROM raw""",
    "keyed_partitions": f"""{base(raw())}
SELECT truck_id, CAST(1 AS BIGINT) AS partitions, true AS in_range, count(*) AS readings
FROM raw WHERE truck_id IS NOT NULL GROUP BY truck_id""",
    "json_codec": f"""{base(raw())}
SELECT CAST(truck_id AS VARCHAR) AS key, {READING_JSON} AS value, fuel_level FROM raw""",
    "state_keys": f"""{base(raw())}
SELECT DISTINCT truck_id, 'truck:' || truck_id AS key, truck_id AS decoded FROM raw WHERE truck_id IS NOT NULL""",
    "temperature_filtered": f"{base(raw())} SELECT seq, truck_id, temperature FROM raw WHERE temperature > 0",
    "event_times": f"""{base(raw())} SELECT seq, "timestamp", {iso('event_time')} AS event_time FROM raw""",
    "normalized": f"""{base(*NORMALIZED)}
SELECT truck_id, centi / 100.0 AS temperature_c, {iso('event_time')} AS event_time, "timestamp", seq FROM norm""",
    "rejected_readings": f"""{base(raw())}, judged AS (
  SELECT seq, truck_id, temperature, "timestamp",
         CASE WHEN truck_id IS NULL THEN 'no truck' WHEN temperature IS NULL THEN 'no temperature'
              WHEN temperature <= 0 THEN 'temperature not above zero'
              WHEN event_time IS NULL THEN 'timestamp unreadable' END AS reason
  FROM raw
)
SELECT * FROM judged WHERE reason IS NOT NULL""",
    "validate_messages": """
WITH judged AS (
  SELECT event_id, CASE
    WHEN event_id % 43 = 42 OR event_id % 31 = 30 THEN 'missing truck_id'
    WHEN event_id % 37 = 36 THEN 'missing temperature'
    WHEN event_id % 41 = 40 THEN 'missing timestamp'
    WHEN event_id % 11 = 10 OR event_id % 13 = 12 THEN 'truck_id is not an integer'
    WHEN event_id % 17 = 16 OR event_id % 19 = 18 THEN 'temperature is not a number'
    WHEN event_id % 23 <> 22 AND event_id % 29 = 28 THEN 'timestamp is not text'
    WHEN round(value - 5, 2) NOT BETWEEN -20 AND 60 THEN 'temperature out of range'
    WHEN event_id % 23 = 22 THEN 'timestamp is not ISO-8601' END AS reason
  FROM events
)
SELECT event_id, reason IS NULL AS is_valid, reason FROM judged""",
    "validate_contract": f"""{base(raw())}
SELECT seq, truck_id IS NOT NULL AND temperature IS NOT NULL AND "timestamp" IS NOT NULL AS in_contract FROM raw""",
    "contract_split": f"""{base(raw())}
SELECT truck_id, count(*) FILTER (WHERE truck_id IS NOT NULL AND temperature IS NOT NULL) AS sent,
       count(*) FILTER (WHERE truck_id IS NULL OR temperature IS NULL) AS set_aside
FROM raw GROUP BY truck_id""",
    "dedup": f"""{base(raw(), FIRSTS)} SELECT truck_id, "timestamp", temperature, fuel_level, seq FROM firsts""",
    "stages": f"""{base(raw(), STAGED)} SELECT seq, truck_id, "timestamp", stage FROM staged""",
    "tumbling_averages": f"{base(*NORMALIZED, 'windows AS (' + tumbling(300) + ')')}{wire()}",
    "hopping_averages": f"{base(*NORMALIZED, 'windows AS (' + hopping(300, 60) + ')')}{wire()}",
    "window_averages_default": f"{base(*NORMALIZED, windows(300, 60))}{wire()}",
    "window_averages_demo": f"{base(*NORMALIZED, windows(30, 10))}{wire()}",
    "window_averages_daily": f"{base(*NORMALIZED, windows(86400, 21600))}{wire()}",
    "window_averages_uneven": f"{base(*NORMALIZED, windows(25200, 10800))}{wire()}",
    "window_averages_by_tenant": f"""{base(raw(extra=', event_type AS tenant_id'), '''
firsts AS (
  SELECT * FROM raw WHERE truck_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tenant_id, truck_id, "timestamp" ORDER BY seq) = 1
), norm AS (
  SELECT tenant_id, truck_id, CAST(round(temperature * 100) AS BIGINT) AS centi, event_time
  FROM firsts WHERE temperature > 0 AND event_time IS NOT NULL
)''', windows(86400, 21600, keys='tenant_id, truck_id'))}{wire(keys='tenant_id, truck_id')}""",
    "rolled_up_averages": f"{base(*NORMALIZED, TOTALS)} SELECT * FROM totals",
    "expected_averages": """
SELECT event_type,
       CAST(((200 * sum(CAST(round(value * 100) AS BIGINT)) + count(*)) // (2 * count(*))) AS BIGINT) / 10000.0
         AS expected_average
FROM events GROUP BY event_type""",
    "truck_totals": f"{base(*NORMALIZED, TOTALS)} SELECT * FROM totals",
    "state_lookup": f"""{base(*NORMALIZED, TOTALS)}
SELECT c_custkey AS truck_id, coalesce("sum", 0.0) AS "sum", coalesce("count", 0) AS "count",
       coalesce(average, 0.0) AS average
FROM customer LEFT JOIN totals ON truck_id = c_custkey""",
    "running_state": f"""{base(*NORMALIZED, RUNNING)}
SELECT truck_id, seq, s / 100.0 AS "sum", n AS "count", {avg4('s', 'n')} AS average FROM running""",
    "compacted_changelog": f"""{base(*NORMALIZED, RUNNING)}
SELECT 'truck:' || truck_id AS key, CASE WHEN n % 7 <> 0 THEN s / 100.0 END AS "sum",
       CASE WHEN n % 7 <> 0 THEN n END AS "count", seq
FROM running QUALIFY row_number() OVER (PARTITION BY truck_id ORDER BY seq DESC) = 1""",
    "materialized_changelog": f"{base(*NORMALIZED, RUNNING, LIVE)} SELECT * FROM live",
    "state_as_of": f"""{base(*NORMALIZED, RUNNING.replace('running AS', 'all_running AS'), '''
running AS (SELECT * FROM all_running WHERE seq <= (SELECT max(event_id) // 2 FROM events))''', LIVE)}
SELECT * FROM live""",
    "state_as_of_time": f"""{base(*NORMALIZED, RUNNING.replace('running AS', 'all_running AS'), """
running AS (
  SELECT a.* FROM all_running a JOIN raw ON raw.seq = a.seq
  WHERE epoch_us(arrival) <= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events)
)""", LIVE)} SELECT * FROM live""",
    "state_as_of_offsets": f"""{base(*NORMALIZED, RUNNING.replace('running AS', 'all_running AS'), """
ends AS (SELECT (user_id + 1) % 20 AS part, max(event_id) // 2 AS until FROM events GROUP BY ALL),
running AS (
  SELECT a.* FROM all_running a JOIN ends ON part = a.truck_id % 20 WHERE part % 5 <> 0 AND seq <= until
)""", LIVE)} SELECT * FROM live""",
    "merged_changelog": f"{base(*NORMALIZED, RUNNING, LIVE)} SELECT * FROM live",
    "state_from_snapshots": f"""{base(*NORMALIZED, RUNNING.replace('running AS', 'all_running AS'), HALF_WAY, """
running AS (SELECT a.* FROM all_running a JOIN ends ON part = a.truck_id % 20 WHERE seq <= until)""", LIVE)}
SELECT * FROM live""",
    "reconciled_states": f"""{base(*NORMALIZED, RUNNING, LIVE, TOTALS)}
SELECT t.truck_id, t."sum" AS expected_sum, t."count" AS expected_count,
       coalesce(l."sum", 0.0) AS recovered_sum, coalesce(l."count", 0) AS recovered_count,
       l.truck_id IS NOT NULL AS matches
FROM totals t LEFT JOIN live l ON t.truck_id = l.truck_id""",
    "fleet_latest": f"{base(raw(), FIRSTS, ACCEPTED, LATEST)} SELECT *, 'active' AS status FROM latest",
    "latest_averages": f"""{base(*NORMALIZED, windows(21600, 3600), f'''
averages AS (
  SELECT truck_id, window_type, {avg4('s', 'n')} AS average, n, w + size AS closed,
         (w + size) * 2000000 + CASE window_type WHEN 'tumbling' THEN 1 ELSE 0 END AS seq
  FROM windows
)''', by_truck_averages('averages', 'by_truck'))} SELECT * FROM by_truck""",
    "fleet_roster": f"{base(*ROSTER_PARTS)} SELECT * FROM roster",
    "roster_page": f"{base(*ROSTER_PARTS)} SELECT * FROM roster ORDER BY truck_id LIMIT 200",
    "fleet_positions": f"""{base(*ROSTER_PARTS)}
SELECT truck_id, CASE WHEN longitude IS NOT NULL THEN latitude END AS map_latitude,
       CASE WHEN latitude IS NOT NULL THEN longitude END AS map_longitude,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'kafka' ELSE 'simulated' END AS gps_source,
       coalesce(last_temperature > 42, false) AS is_anomalous
FROM roster""",
    "anomalies": f"{base(raw(), FIRSTS)} SELECT {ANOMALY_COLUMNS} FROM firsts WHERE temperature > 42",
    "recent_anomalies": f"""{base(raw(), FIRSTS)}
SELECT {ANOMALY_COLUMNS} FROM firsts WHERE temperature > 42 ORDER BY seq DESC LIMIT 15""",
    "recent_readings": f"""{base(raw(), FIRSTS, ACCEPTED)}
SELECT seq, truck_id, temperature, "timestamp", fuel_level FROM accepted ORDER BY seq DESC LIMIT 20""",
    "telemetry_totals": f"""{base(raw(), STAGED, FIRSTS, NORM, windows(86400, 21600))}
SELECT count(*) AS total_raw, count(*) FILTER (WHERE stage = 'no_key') AS no_key,
       count(*) FILTER (WHERE stage = 'duplicate') AS duplicates,
       count(*) FILTER (WHERE stage = 'filtered') AS filtered,
       count(*) FILTER (WHERE stage = 'accepted') AS accepted,
       (SELECT count(*) FROM windows) AS total_aggregates,
       count(DISTINCT truck_id) FILTER (WHERE stage = 'accepted') AS active_trucks,
       count(*) FILTER (WHERE stage = 'accepted' AND temperature > 42) AS anomalies_seen,
       least(count(*) FILTER (WHERE stage = 'accepted' AND temperature > 42), 50) AS anomalies
FROM staged""",
    "stage_rates": f"""{base(raw(), STAGED, FIRSTS, NORM, 'windows AS (' + tumbling(300) + ')',
                            stage_rate(5, 1, True))}
SELECT {iso_s('sampled_at')} AS sampled_at, ingestion_rate, filter_rate, duplicate_rate, aggregate_rate FROM rates""",
    "parsed_rates": f"""{base(raw(), STAGED, stage_rate(3600, 600, False))}
SELECT {iso_s('sampled_at')} AS sampled_at, ingestion_rate, filter_rate,
       greatest(0.0, round(ingestion_rate - filter_rate, 2)) AS parsed_rate FROM rates""",
    "throughput_history": f"""{base(raw(), STAGED, stage_rate(5, 1, False))}
SELECT {iso_s('newest - k')} AS sampled_at, coalesce(ingestion_rate, 0.0) AS ingestion,
       coalesce(filter_rate, 0.0) AS filtered
FROM (SELECT max(sampled_at) AS newest FROM rates) CROSS JOIN range(0, 60) AS back(k)
LEFT JOIN rates ON sampled_at = newest - k WHERE newest IS NOT NULL""",
    "consumer_lag": """
WITH offsets AS (
  SELECT event_type AS topic, user_id % 20 AS part, max(event_id) + 1 AS high,
         CASE WHEN user_id % 20 = 3 THEN -1001 WHEN user_id % 20 = 5 THEN max(event_id) + 3
              ELSE max(event_id) FILTER (WHERE value > 40) END AS committed
  FROM events GROUP BY event_type, user_id % 20
)
SELECT topic, sum(CASE WHEN committed >= 0 THEN greatest(0, high - committed) ELSE 0 END)::BIGINT AS lag,
       CASE WHEN topic IS NULL THEN 'ok' END AS status
FROM offsets GROUP BY ROLLUP (topic)""",
    "counter_rates": counter(60),
    "counter_rates_with_gaps": counter(
        60, "HAVING max(event_id % 1000) % 7 <> 6 AND max(event_id % 1000) % 11 <> 10"),
    "counter_rates_by_blocks": counter(
        60, "HAVING max(event_id % 1000) % 7 <> 6 AND max(event_id % 1000) % 11 <> 10"),
    "counter_rates_hourly": counter(3600),
    "alert_states": f"""{ALERTS}
SELECT alert, severity, metric, {iso('ts')} AS ts, value, {iso('since')} AS active_since, state FROM states""",
    "alert_states_by_blocks": f"""{ALERTS}
SELECT alert, severity, metric, {iso('ts')} AS ts, value, {iso('since')} AS active_since, state FROM states""",
    "alerts_now": f"""{ALERTS}
SELECT alert, metric, severity, {iso('ts')} AS ts, state, {iso('since')} AS active_since
FROM states QUALIFY row_number() OVER (PARTITION BY alert ORDER BY states.ts DESC) = 1""",
    "dataset_quality": f"""{DATASET}
SELECT count(*) AS rows, count(DISTINCT truck_id) AS unique_trucks,
       count(*) FILTER (WHERE truck_id IS NULL) AS null_truck_id,
       count(*) FILTER (WHERE temperature IS NULL) AS null_temperature,
       count(*) FILTER (WHERE temperature IS NULL OR temperature <= 0) AS not_positive,
       count(*) FILTER (WHERE temperature > 0) AS valid,
       count(*) FILTER (WHERE temperature > 0) - count(*) FILTER (WHERE temperature IS NULL) AS valid_reported,
       'FAIL' AS verdict, 'null required fields' AS reason
FROM dataset""",
    "exactly_once_audit": once("PASSED", 'count(DISTINCT (truck_id, "timestamp"))'),
    "exactly_once_audit_without_dedup": once("FAILED", "count(*)"),
    "recovery_audit": f"""{base(*NORMALIZED, RUNNING, TOTALS)}, lasting AS (
  SELECT truck_id, s / 100.0 AS "sum", n AS "count" FROM running
  QUALIFY row_number() OVER (PARTITION BY truck_id ORDER BY seq DESC) = 1
), compared AS (
  SELECT t.truck_id, l."sum" IS NOT DISTINCT FROM t."sum" AND l."count" IS NOT DISTINCT FROM t."count" AS same
  FROM totals t LEFT JOIN lasting l ON l.truck_id = t.truck_id
)
SELECT (SELECT count(*) FROM running) AS changelog_records, count(*) AS trucks,
       count(*) FILTER (WHERE NOT same) AS mismatches,
       CASE WHEN count(*) FILTER (WHERE NOT same) = 0 THEN 'PASSED' ELSE 'FAILED' END AS verdict FROM compared""",
    "throughput_audit": f"""{base(raw())}
SELECT count(*) AS events, (epoch_us(max(arrival)) - epoch_us(min(arrival))) / 1000000.0 AS elapsed_seconds,
       round(count(*) / ((epoch_us(max(arrival)) - epoch_us(min(arrival))) / 1000000.0), 4) AS events_per_second,
       CASE WHEN count(*) / ((epoch_us(max(arrival)) - epoch_us(min(arrival))) / 1000000.0) >= 100000 THEN 'PASS'
            ELSE 'BELOW TARGET' END AS verdict
FROM raw""",
    "average_audit": f"""{base(*NORMALIZED, windows(86400, 21600), """
recomputed AS (
  SELECT truck_id, 'tumbling' AS window_type, epoch(date_trunc('day', event_time))::BIGINT AS w, sum(centi) AS s, count(*) AS n
  FROM norm GROUP BY ALL
  UNION ALL
  SELECT truck_id, 'hopping', epoch(hop)::BIGINT, sum(centi), count(*)
  FROM (SELECT truck_id, centi, unnest(generate_series(time_bucket(INTERVAL '6 hours', event_time - INTERVAL '18 hours'),
                                                       event_time, INTERVAL '6 hours')) AS hop FROM norm) GROUP BY ALL
)""")}
SELECT coalesce(e.window_type, r.window_type) AS window_type, count(r.n) AS windows,
       count(*) FILTER (WHERE e.n IS NULL) AS missing, count(*) FILTER (WHERE r.n IS NULL) AS unexpected,
       count(*) FILTER (WHERE e.n <> r.n OR e.s <> r.s) AS different
FROM windows e FULL JOIN recomputed r ON e.truck_id = r.truck_id AND e.window_type = r.window_type AND e.w = r.w
GROUP BY ALL""",
    "zscore_anomalies": f"""{base(*NORMALIZED, '''
stats AS (
  SELECT truck_id, epoch_us(event_time) // 2592000000000 AS w, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(centi) AS DOUBLE) AS s, CAST(sum(centi * centi) AS DOUBLE) AS sq
  FROM norm GROUP BY ALL
), scored AS (
  SELECT norm.truck_id, seq, centi / 100.0 AS temperature_c,
         round((centi * n - s) / sqrt(nullif(n * sq - s * s, 0.0)), 6) AS zscore
  FROM norm JOIN stats ON norm.truck_id = stats.truck_id AND epoch_us(event_time) // 2592000000000 = w
  WHERE n > 1
)''')} SELECT * FROM scored WHERE abs(zscore) > 2.5""",
    "trailing_zscores": f"""{base(*NORMALIZED, """
stats AS (
  SELECT truck_id, seq, centi, CAST(count(*) OVER t AS DOUBLE) AS n, CAST(sum(centi::HUGEINT) OVER t AS DOUBLE) AS s,
         CAST(sum(centi::HUGEINT * centi) OVER t AS DOUBLE) AS sq
  FROM norm WINDOW t AS (PARTITION BY truck_id ORDER BY epoch_us(event_time)
                         RANGE BETWEEN 864000000000 PRECEDING AND CURRENT ROW)
), scored AS (
  SELECT truck_id, seq, centi / 100.0 AS temperature_c,
         round((centi * n - s) / sqrt(nullif(n * sq - s * s, 0.0)), 6) AS zscore
  FROM stats WHERE n > 1
)""")} SELECT * FROM scored WHERE abs(zscore) > 2.0""",
    "stream_window_averages": f"{base(*NORMALIZED, windows(21600, 3600))}{wire()}",
    "stream_state": f"{base(raw('0'), FIRSTS, NORM, TOTALS)} SELECT * FROM totals",
    "stream_state_resumed": f"{base(raw('0'), FIRSTS, NORM, TOTALS)} SELECT * FROM totals",
    "stream_latest": f"""{base(raw('0').replace('raw AS', 'delivered AS'),
                              'raw AS (SELECT * FROM delivered WHERE event_time IS NOT NULL)',
                              FIRSTS, ACCEPTED, LATEST)} SELECT *, 'active' AS status FROM latest""",
}
