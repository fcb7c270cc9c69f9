"""The same answers in plain SQL over the test tables, for checking the registry against."""

from __future__ import annotations

from tidemark.operators.quality import ERFC
from tidemark.schemas import (
    COMPONENTS, DEVICE_SEED, LOCATIONS, MODELS, PARTS, ROOT_CAUSES, SEVERITIES, STATUSES,
)

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_DEVICE = "'device_' || CAST(user_id % 12 + 1 AS VARCHAR)"
_MS = "date_trunc('milliseconds', ts)"
_CUT = "TIMESTAMP '2024-01-25 00:00:00'"
_WEEK = {n: f"TIMESTAMP '2024-01-{1 + 7 * n:02d} 00:00:00'" for n in (1, 2, 3)}


def _pick(number: str, values: list[str]) -> str:
    """The SQL of values[number % len(values)]."""
    cases = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


def _telemetry(at: str) -> str:
    return f"""telemetry AS (
  SELECT event_id AS reading_id, {_DEVICE} AS device_id, {at} AS event_time,
         value / CAST(100 AS DOUBLE) AS energy_usage, value AS temperature,
         {_K} / CAST(20 AS DOUBLE) AS vibration, CAST(70 + {_K} % 31 AS INTEGER) AS signal_strength
  FROM events)"""


def _events(at: str) -> str:
    return f"""iot_events AS (
  SELECT {_DEVICE} AS device_id, {at} AS event_time,
    CASE event_type WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'maintenance' ELSE 'inspection' END AS event_type,
    {_pick(_K, SEVERITIES)} AS severity,
    CASE WHEN event_type = 'error' THEN 'ERR' || CAST(1000 + {_K} AS VARCHAR) END AS error_code,
    CASE WHEN event_type = 'error' THEN {_pick(_K, COMPONENTS)} END AS component,
    CASE WHEN event_type = 'error' THEN {_pick(f'{_K} // 4', ROOT_CAUSES)} END AS root_cause,
    CASE WHEN event_type = 'purchase' THEN 'tech-' || CAST({_K} % 20 + 1 AS VARCHAR) END AS technician,
    CASE WHEN event_type = 'purchase' THEN 15 + {_K} END AS duration_min,
    CASE WHEN event_type = 'purchase' THEN {_pick(_K, PARTS)} END AS parts_replaced,
    CASE WHEN event_type NOT IN ('error', 'purchase') THEN {_pick(_K, STATUSES)} END AS status,
    CASE WHEN event_type NOT IN ('error', 'purchase') THEN 7 + {_K} % 24 END AS next_inspection_days
  FROM events)"""


_DIM = "dim(device_id, temp_threshold, location_id, model, status) AS (VALUES " + ", ".join(
    f"('{d}', CAST({t} AS DOUBLE), '{loc}', '{m}', '{s}')" for d, t, loc, m, s in DEVICE_SEED
) + ")"

_SILVER_COLUMNS = """t.reading_id, t.device_id, t.event_time,
         t.event_time + to_seconds(CAST(t.reading_id % 4 AS DOUBLE)) AS ingest_time,
         t.energy_usage, t.temperature, t.vibration, t.signal_strength, d.temp_threshold,
         t.temperature > d.temp_threshold AS anomaly_flag, t.vibration > 3.0 AS vibration_spike,
         d.location_id, d.model"""


def _silver(at: str) -> str:
    return f"""{_telemetry(at)}, {_DIM}, silver AS (
  SELECT {_SILVER_COLUMNS}
  FROM telemetry t LEFT JOIN dim d ON t.device_id = d.device_id)"""


def _gold(at: str, by: str = "ingest_time", unit: str = "minute") -> str:
    return f"""{_silver(at)}, gold AS (
  SELECT device_id, CAST(date_trunc('{unit}', {by}) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('{unit}', {by}) AS TIMESTAMP) + INTERVAL 1 {unit} AS window_end,
         count(*) AS cnt_points,
         CAST(sum(CASE WHEN temperature > temp_threshold THEN 1 ELSE 0 END) AS BIGINT) AS cnt_anomalies,
         CAST(sum(CASE WHEN vibration > 3.0 THEN 1 ELSE 0 END) AS BIGINT) AS cnt_vib_spikes,
         round(avg(temperature), 9) AS avg_temperature, min(temperature) AS min_temperature,
         max(temperature) AS max_temperature, round(avg(energy_usage), 9) AS avg_energy_usage,
         max(vibration) AS max_vibration, min(signal_strength) AS min_signal,
         max(temp_threshold) AS threshold_used,
         max(temperature) > max(temp_threshold) AS anomaly_flag,
         max(location_id) AS location_id, max(model) AS model
  FROM silver GROUP BY 1, 2, 3)"""


# Gold windows that had closed when the first drop's last reading had arrived.
_GOLD_COLD = (
    f"gold_cold AS (SELECT * FROM gold WHERE window_end <= "
    f"(SELECT max(ingest_time) FROM silver WHERE event_time < {_CUT}))"
)


def _round1(column: str) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(18, 4)), 1) AS DOUBLE)"


_FEED = """SELECT device_id, location_id, temperature, temp_threshold, event_time
FROM silver WHERE anomaly_flag OR vibration_spike"""

_HOT_DEVICES = f"""SELECT device_id, count(*) AS anomalies, {_round1('max(temperature)')} AS worst_temp
FROM silver WHERE anomaly_flag GROUP BY device_id ORDER BY anomalies DESC, device_id"""


def _pct(gold: str) -> str:
    return f"""SELECT device_id, max(threshold_used) AS threshold, count(*) AS windows,
       CAST(sum(cnt_anomalies) AS BIGINT) AS anomalous_readings,
       round(CAST(100 AS DOUBLE) * CAST(sum(cnt_anomalies) AS DOUBLE) / CAST(sum(cnt_points) AS DOUBLE), 1)
         AS pct_over_threshold
FROM {gold} GROUP BY device_id ORDER BY pct_over_threshold DESC, device_id"""


def _failures(gold: str, where: str = "TRUE") -> str:
    return f"""SELECT e.device_id, e.component, e.root_cause, h.window_start, h.cnt_anomalies,
       {_round1('h.max_temperature')} AS max_c, h.threshold_used
FROM iot_events e JOIN {gold} h
  ON e.device_id = h.device_id AND e.event_time >= h.window_start AND e.event_time < h.window_end
WHERE e.event_type = 'failure' AND {where}"""


_CHANGES = f"""changes AS (
  SELECT {_DEVICE} AS device_id, 'user_' || CAST(user_id AS VARCHAR) AS user_device,
    CAST(24 AS DOUBLE) + ({_K} % 11) * CAST(0.5 AS DOUBLE) AS temp_threshold,
    {_pick(_K, LOCATIONS)} AS location_id, {_pick(_K, MODELS)} AS model,
    ts AS valid_from
  FROM events WHERE event_type = 'signup')"""


def _last_change(key: str) -> str:
    return f"""last_change AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
    ORDER BY valid_from DESC, temp_threshold DESC, model DESC, location_id DESC) AS rn FROM changes) WHERE rn = 1)"""


_ERFC = "-x * x" + "".join(
    f" + {c} * pow(t, {k})" for k, c in enumerate(f"({x}::DOUBLE)" for x in ERFC)
)


def _counted(rules: dict[str, str], source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{rule}' AS rule, count(*) AS rows_checked, "
        f"count(*) FILTER (WHERE NOT coalesce({ok}, FALSE)) AS violations FROM {source}"
        for rule, ok in rules.items()
    )


_TELEMETRY_RULES = {
    "temperature_in_range": "temperature BETWEEN 18.0 AND 30.0",
    "reading_id_in_range": "reading_id BETWEEN 1 AND 100000000",
    "event_time_present": "event_time IS NOT NULL",
    "device_id_present": "device_id IS NOT NULL",
}

_EVENT_RULES = {
    "event_type_known": "event_type IN ('failure', 'maintenance', 'inspection')",
    "severity_known": "severity IN ('low', 'medium', 'high')",
    "failure_fields_present":
        "event_type <> 'failure' OR (error_code IS NOT NULL AND component IS NOT NULL AND root_cause IS NOT NULL)",
    "failure_fields_exclusive":
        "event_type = 'failure' OR (error_code IS NULL AND component IS NULL AND root_cause IS NULL)",
    "maintenance_fields_present":
        "event_type <> 'maintenance' OR "
        "(technician IS NOT NULL AND duration_min IS NOT NULL AND parts_replaced IS NOT NULL)",
    "maintenance_fields_exclusive":
        "event_type = 'maintenance' OR (technician IS NULL AND duration_min IS NULL AND parts_replaced IS NULL)",
    "inspection_fields_present":
        "event_type <> 'inspection' OR (status IS NOT NULL AND next_inspection_days IS NOT NULL)",
    "inspection_fields_exclusive":
        "event_type = 'inspection' OR (status IS NULL AND next_inspection_days IS NULL)",
}

_SNAPSHOT_ROWS = {
    "iot_telemetry": f"(SELECT count(*) FROM telemetry WHERE event_time < {_CUT})",
    "iot_events": f"(SELECT count(*) FROM telemetry WHERE event_time < {_CUT})",
    "datalake_device_telemetry": f"(SELECT count(*) FROM silver WHERE event_time < {_CUT})",
    "datalake_device_health_1min": "(SELECT count(*) FROM gold_cold)",
}


def _lag(table: str, source: str, when: str, cold: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) FILTER (WHERE NOT ({cold})) AS rows_behind,
       date_sub('second', max({when}) FILTER (WHERE {cold}), max({when})) AS seconds_behind FROM {source}"""


def _round(number: int, landed: str, cold: str) -> str:
    return f"""SELECT CAST({number} AS INTEGER) AS round, count(*) FILTER (WHERE {landed}) AS hot_plus_cold,
       count(*) FILTER (WHERE {cold}) AS cold_only,
       count(*) FILTER (WHERE {landed}) - count(*) FILTER (WHERE {cold}) AS rows_only_in_hot FROM events"""


def oracle_sql() -> dict[str, str]:
    telemetry, telemetry_ms = _telemetry("ts"), _telemetry(_MS)
    silver, silver_ms = _silver("ts"), _silver(_MS)
    gold, gold_ms = _gold("ts"), _gold(_MS)
    gold_hour = _gold("ts", unit="hour")
    way = "reading_id % 8"
    lost = f"{way} IN (4, 7)"

    def kept(column: str, spoiled_by: str = "FALSE") -> str:
        return f"CASE WHEN {lost} OR {spoiled_by} THEN NULL ELSE {column} END AS {column}"

    closed = f"window_end <= (SELECT max(ingest_time) FROM silver WHERE event_time < {_CUT})"
    sql = {
        "decode_telemetry": f"WITH {telemetry_ms} SELECT * FROM telemetry",
        "decode_events": f"WITH {_events(_MS)} SELECT * FROM iot_events",
        "decode_tolerant": f"""WITH {telemetry_ms}
SELECT reading_id AS message_id, {kept('reading_id')}, {kept('device_id')},
       {kept('event_time', f'{way} IN (1, 2)')}, {kept('energy_usage')},
       {kept('temperature', f'{way} IN (3, 6)')}, {kept('vibration', f'{way} = 6')},
       {kept('signal_strength', f'{way} = 5')},
       CASE {way} WHEN 4 THEN 'not_json' WHEN 7 THEN 'null_message' END AS quarantine_reason
FROM telemetry""",
        "decode_quarantine": f"""WITH {telemetry_ms}
SELECT CASE {way} WHEN 4 THEN 'not_json' ELSE 'null_message' END AS reason, count(*) AS messages
FROM telemetry WHERE {lost} GROUP BY 1""",
        "decode_timestamp": f"""SELECT event_id,
       CASE event_id % 7 WHEN 0 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) WHEN 5 THEN {_MS} END AS event_time
FROM events""",
        "bronze_telemetry": f"WITH {telemetry_ms} SELECT * FROM telemetry",
        "bronze_events": f"WITH {_events(_MS)} SELECT * FROM iot_events",
        "dim_seed": f"""WITH {telemetry}, {_DIM}, n AS (SELECT device_id, count(*) AS readings FROM telemetry GROUP BY 1)
SELECT coalesce(d.device_id, n.device_id) AS device_id, d.temp_threshold, d.location_id, d.model, d.status,
       coalesce(n.readings, 0) AS readings
FROM dim d FULL JOIN n ON d.device_id = n.device_id""",
        "dim_upsert": f"""WITH {_DIM}, {_CHANGES}, {_last_change('device_id')}
SELECT device_id, temp_threshold, location_id, model, 'active' AS status FROM last_change
UNION ALL SELECT * FROM dim WHERE device_id NOT IN (SELECT device_id FROM last_change)""",
        "lookup_join": f"""WITH {telemetry}, {_DIM}
SELECT t.*, d.temp_threshold, d.location_id, d.model FROM telemetry t LEFT JOIN dim d ON t.device_id = d.device_id""",
        "lookup_join_shuffled": f"""WITH {_CHANGES}, {_last_change('user_device')}
SELECT e.event_id AS reading_id, 'user_' || CAST(e.user_id AS VARCHAR) AS device_id, e.value AS temperature,
       c.temp_threshold, c.location_id, c.model
FROM events e LEFT JOIN last_change c ON 'user_' || CAST(e.user_id AS VARCHAR) = c.user_device""",
        "lookup_join_asof": f"""WITH {telemetry}, {_CHANGES}, versions AS (
  SELECT device_id, valid_from,
         max({{'temp_threshold': temp_threshold, 'location_id': location_id, 'model': model}}) AS v
  FROM changes GROUP BY 1, 2)
SELECT t.reading_id, t.device_id, t.event_time, t.temperature, c.valid_from,
       c.v.temp_threshold AS temp_threshold, c.v.location_id AS location_id, c.v.model AS model
FROM telemetry t ASOF LEFT JOIN versions c ON t.device_id = c.device_id AND t.event_time >= c.valid_from""",
        "stream_lookup_per_reading": f"""WITH {telemetry}, {_CHANGES}, versions AS (
  SELECT device_id, valid_from,
         max({{'temp_threshold': temp_threshold, 'location_id': location_id, 'model': model}}) AS v
  FROM changes GROUP BY 1, 2)
SELECT t.reading_id, t.device_id, t.event_time, t.temperature, c.valid_from,
       c.v.temp_threshold AS temp_threshold, c.v.location_id AS location_id, c.v.model AS model
FROM telemetry t ASOF LEFT JOIN versions c ON t.device_id = c.device_id AND t.event_time >= c.valid_from""",
        "late_side_output": f"""WITH {telemetry}, told AS (
  SELECT device_id, date_trunc('minute', event_time) AS window_start,
         (event_time >= {_CUT} OR reading_id % 2 <> 0)
           AND date_trunc('minute', event_time) + INTERVAL 1 MINUTE <= (
             SELECT max(event_time) - INTERVAL 5 SECOND FROM telemetry WHERE event_time < {_CUT} AND reading_id % 2 = 0) AS late
  FROM telemetry)
SELECT device_id, CAST(window_start AS TIMESTAMP) AS window_start, count(*) FILTER (WHERE NOT late) AS in_window,
       count(*) FILTER (WHERE late) AS late FROM told GROUP BY 1, 2""",
        "dim_changelog": f"""WITH {_DIM}, {_CHANGES}, ranked AS (
  SELECT *, valid_from >= {_CUT} AS second, row_number() OVER (PARTITION BY device_id, valid_from >= {_CUT}
    ORDER BY valid_from DESC, temp_threshold DESC, model DESC, location_id DESC) AS rn FROM changes),
upserts AS (SELECT CASE WHEN second THEN 3 ELSE 2 END AS version, device_id, temp_threshold, location_id, model, 'active' AS status
  FROM ranked WHERE rn = 1),
rows AS (SELECT 1 AS version, * FROM dim UNION ALL SELECT * FROM upserts),
steps AS (SELECT *, lag({{'t': temp_threshold, 'l': location_id, 'm': model, 's': status}}) OVER along AS old
  FROM rows WINDOW along AS (PARTITION BY device_id ORDER BY version)),
changed AS (SELECT * FROM steps
  WHERE old IS NULL OR old <> {{'t': temp_threshold, 'l': location_id, 'm': model, 's': status}})
SELECT CAST(version AS BIGINT) AS version, CASE WHEN old IS NULL THEN '+I' ELSE '+U' END AS row_kind, device_id, temp_threshold,
       location_id, model, status FROM changed
UNION ALL SELECT version, '-U', device_id, old.t, old.l, old.m, old.s FROM changed WHERE old IS NOT NULL""",
        "only_in_hot_exact": f"""WITH {silver}
SELECT reading_id % 50 AS reading_id, device_id, round(temperature) AS temperature, anomaly_flag, count(*) AS copies
FROM silver WHERE event_time >= {_CUT} GROUP BY ALL""",
        "live_failure_context": f"WITH {gold_hour}, {_events('ts')} {_failures('gold')}",
        "live_hot_devices": f"""WITH {silver}, landed AS (
  SELECT 2 AS after_drop, * FROM silver UNION ALL SELECT 1, * FROM silver WHERE event_time < {_CUT}),
ranked AS (SELECT after_drop, device_id, count(*) AS anomalies, {_round1('max(temperature)')} AS worst_temp,
  row_number() OVER (PARTITION BY after_drop ORDER BY count(*) DESC, device_id) AS place
  FROM landed WHERE anomaly_flag GROUP BY after_drop, device_id)
SELECT after_drop, device_id, anomalies, worst_temp FROM ranked WHERE place <= 5""",
        "live_lag_histogram": f"""WITH {silver}, instants AS (
  SELECT CAST(make_timestamp(CAST((ceil(epoch_us(event_time) / 20000000.0) + i) * 20000000 AS BIGINT)) AS TIMESTAMP) AS as_of,
         date_sub('second', event_time, ingest_time) AS lag_s FROM silver, range(3) r(i))
SELECT as_of, lag_s, count(*) AS readings FROM instants GROUP BY 1, 2""",
        "type_mix_fit": f"""WITH {_events('ts')}, n AS (
  SELECT count(*) AS n, CAST(0 AS BIGINT) AS unexpected, count(*) FILTER (WHERE event_type = 'failure') AS f,
         count(*) FILTER (WHERE event_type = 'maintenance') AS m, count(*) FILTER (WHERE event_type = 'inspection') AS i FROM iot_events),
c AS (SELECT n, unexpected, pow(f - n * 0.1::DOUBLE, 2) / (n * 0.1::DOUBLE) + pow(m - n * 0.3::DOUBLE, 2) / (n * 0.3::DOUBLE)
  + pow(i - n * 0.6::DOUBLE, 2) / (n * 0.6::DOUBLE) AS x FROM n)
SELECT n, unexpected, round(x, 6) AS chi_square, round(exp(-x / 2), 9) AS p_value FROM c""",
        "rate_fit": f"""WITH {silver}, r AS (
  SELECT temp_threshold, 'anomaly' AS rate, count(anomaly_flag) AS n, count(*) FILTER (WHERE anomaly_flag) AS hits,
         greatest(0::DOUBLE, least(1::DOUBLE, (30 - temp_threshold) / 12)) AS expected
  FROM silver WHERE temp_threshold IS NOT NULL GROUP BY 1
  UNION ALL SELECT temp_threshold, 'spike', count(vibration_spike), count(*) FILTER (WHERE vibration_spike), 0.05::DOUBLE
  FROM silver WHERE temp_threshold IS NOT NULL GROUP BY 1),
d AS (SELECT *, (hits - n * expected) / sqrt(n * expected * (1 - expected)) AS z FROM r),
t AS (SELECT *, abs(z) / sqrt(2::DOUBLE) AS x, 1 / (1 + abs(z) / sqrt(2::DOUBLE) / 2) AS t FROM d)
SELECT temp_threshold, rate, n, hits, round(expected, 9) AS expected, round(z, 6) AS deviations,
       round(t * exp({_ERFC}), 9) AS p_value FROM t""",
        "stream_health": f"""WITH {telemetry}, {_DIM}, b AS (
  SELECT CASE WHEN event_time < {_CUT} THEN 0 ELSE 1 END AS batch_id, device_id FROM telemetry)
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS readings, CAST(sum(batch_id) AS BIGINT) AS null_event_time,
       count(*) FILTER (WHERE device_id NOT IN (SELECT device_id FROM dim)) AS null_threshold,
       batch_id = 1 AS timestamps_lost, FALSE AS dimension_missing FROM b GROUP BY batch_id""",
        "silver_enriched": f"WITH {silver} SELECT * FROM silver",
        "gold_health": f"WITH {gold} SELECT * FROM gold",
        "gold_health_hourly": f"WITH {gold_hour} SELECT * FROM gold",
        "gold_health_daily": f"WITH {_gold('ts', unit='day')} SELECT * FROM gold",
        "gold_health_event_time": f"WITH {_gold('ts', 'event_time')} SELECT * FROM gold",
        "stream_silver": f"WITH {silver_ms} SELECT * FROM silver",
        "stream_gold": f"WITH {gold_ms} SELECT * FROM gold",
        "stream_gold_event_time": f"WITH {_gold(_MS, 'event_time')} SELECT * FROM gold",
        "late_readings": f"WITH {_gold('ts', 'event_time')} SELECT * FROM gold WHERE window_start >= {_CUT}",
        "stream_gold_arrival": f"""WITH {silver}
SELECT device_id, count(*) AS points, count(*) FILTER (WHERE anomaly_flag) AS anomalies,
       count(*) FILTER (WHERE vibration_spike) AS spikes, max(temperature) AS max_temperature,
       bool_or(anomaly_flag) AS anomaly_flag, CAST(0 AS BIGINT) AS doubled, CAST(0 AS BIGINT) AS not_a_second
FROM silver GROUP BY 1""",
        "landing_quarantine": f"""WITH {telemetry}
SELECT CASE {way} WHEN 4 THEN 'not_json' ELSE 'landed' END AS outcome, count(*) AS messages
FROM telemetry WHERE {way} <> 7 GROUP BY 1 UNION ALL SELECT 'events', count(*) FROM events""",
        "peek_hot": f"""WITH {telemetry}
SELECT least(count(*), 5) AS rows, count(*) AS hot_readings FROM telemetry WHERE temperature > 29""",
        "anomaly_feed": f"WITH {silver} {_FEED}",
        "hot_devices": f"WITH {silver} {_HOT_DEVICES}",
        "lag_histogram": f"""WITH {silver}
SELECT date_sub('second', event_time, ingest_time) AS lag_s, count(*) AS readings
FROM silver WHERE event_time > (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1 ORDER BY 1""",
        "filter_hot_readings": f"WITH {telemetry} SELECT * FROM telemetry WHERE temperature > 29",
        "pct_over_threshold": f"WITH {gold} {_pct('gold')}",
        "event_counts": f"""WITH {_events('ts')}
SELECT event_type, severity, count(*) AS n FROM iot_events GROUP BY 1, 2 ORDER BY 1, 2""",
        "failure_context": f"""WITH {gold}, {_events('ts')} {_failures('gold')}
ORDER BY window_start DESC, device_id, component, root_cause, cnt_anomalies, max_c LIMIT 20""",
        "failure_context_all": f"WITH {gold_hour}, {_events('ts')} {_failures('gold')}",
        "recent_windows": f"""WITH {gold_ms}
SELECT * FROM gold WHERE window_start >= (SELECT max(window_start) FROM gold) - INTERVAL 120 MINUTE""",
        "contract_telemetry": f"WITH {telemetry} {_counted(_TELEMETRY_RULES, 'telemetry')}",
        "contract_events": f"WITH {_events('ts')} {_counted(_EVENT_RULES, 'iot_events')}",
        "landing_health": f"""WITH {gold_ms}, s AS (
  SELECT count(*) AS readings, count(*) FILTER (WHERE event_time IS NULL) AS null_event_time,
         count(*) FILTER (WHERE temp_threshold IS NULL) AS null_threshold,
         (SELECT count(*) FROM gold) AS windows FROM silver)
SELECT *, readings > 0 AND null_event_time = readings AS timestamps_lost,
       readings > 0 AND null_threshold = readings AS dimension_missing,
       readings > 0 AND windows = 0 AS windows_missing FROM s""",
        "unmatched_devices": f"""WITH {telemetry}, {_DIM}
SELECT device_id, count(*) AS readings FROM telemetry
WHERE device_id NOT IN (SELECT device_id FROM dim) GROUP BY 1""",
        "type_mix": f"""WITH {_events('ts')}
SELECT event_type, count(*) AS n,
       round(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM iot_events), 2) AS pct
FROM iot_events GROUP BY 1""",
        "rate_profile": f"""WITH {silver}
SELECT temp_threshold, count(*) AS readings, count(*) FILTER (WHERE anomaly_flag) AS anomalies,
       count(*) FILTER (WHERE vibration_spike) AS spikes FROM silver GROUP BY 1""",
        "union_read": f"""WITH {silver_ms}
SELECT *, CASE WHEN event_time < {_CUT} THEN 'cold' ELSE 'hot' END AS tier FROM silver""",
        "cold_read": f"WITH {silver_ms} SELECT * FROM silver WHERE event_time < {_CUT}",
        "cold_count": f"WITH {silver_ms} SELECT count(*) AS cold_only FROM silver WHERE event_time < {_CUT}",
        "live_count": f"WITH {silver_ms} SELECT count(*) AS hot_plus_cold FROM silver",
        "live_feed": f"WITH {silver_ms} {_FEED}",
        "lake_snapshots": f"WITH {gold_ms}, {_GOLD_COLD} " + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, CAST(1 AS BIGINT) AS snapshot_id, 'append' AS operation, "
            f"{rows} AS row_count"
            for name, rows in _SNAPSHOT_ROWS.items()
        ),
        "freshness_gap": f"""WITH {silver_ms}
SELECT count(*) AS hot_plus_cold, count(*) FILTER (WHERE event_time < {_CUT}) AS cold_only,
       count(*) FILTER (WHERE event_time >= {_CUT}) AS rows_only_in_hot FROM silver""",
        "freshness_gap_gold": f"""WITH {gold_ms}, {_GOLD_COLD}
SELECT (SELECT count(*) FROM gold) AS windows_hot_plus_cold, (SELECT count(*) FROM gold_cold) AS windows_cold_only""",
        "only_in_hot": f"""WITH {silver_ms}, lake AS (SELECT * FROM silver WHERE event_time < {_CUT})
SELECT t.reading_id AS reading_only_in_hot, t.device_id, t.temperature, t.anomaly_flag
FROM silver t LEFT JOIN lake l ON t.reading_id = l.reading_id WHERE l.reading_id IS NULL""",
        "tiered_hot_devices": f"WITH {silver_ms} {_HOT_DEVICES}",
        "tiered_since": f"""WITH {silver_ms}
SELECT reading_id, device_id, event_time FROM silver WHERE event_time >= {_CUT} - INTERVAL 2 DAY""",
        "lake_pct_over_threshold": f"WITH {gold_ms}, {_GOLD_COLD} {_pct('gold_cold')}",
        "lake_event_counts": f"""WITH {_events(_MS)}
SELECT event_type, severity, count(*) AS n FROM iot_events WHERE event_time < {_CUT} GROUP BY 1, 2 ORDER BY 1, 2""",
        "lake_failure_context": f"""WITH {gold_ms}, {_GOLD_COLD}, {_events(_MS)}
{_failures('gold_cold', f'e.event_time < {_CUT}')}""",
        "lake_lag": f"""WITH {gold_ms}
{_lag('iot_telemetry', 'telemetry', 'event_time', f'event_time < {_CUT}')} UNION ALL
{_lag('iot_events', 'telemetry', 'event_time', f'event_time < {_CUT}')} UNION ALL
{_lag('datalake_device_telemetry', 'silver', 'event_time', f'event_time < {_CUT}')} UNION ALL
{_lag('datalake_device_health_1min', f'(SELECT *, {closed} AS closed FROM gold)', 'window_start', 'closed')}""",
        "tiering_flush": f"""SELECT CAST(CASE WHEN ts < {_WEEK[2]} THEN 1 WHEN ts < {_WEEK[3]} THEN 2 ELSE 3 END AS BIGINT)
         AS snapshot_id, event_id AS reading_id, {_DEVICE} AS device_id, value AS temperature FROM events""",
        "tiering_catchup": " UNION ALL ".join(
            [
                _round(1, f"ts < {_WEEK[1]}", "FALSE"),
                _round(2, f"ts < {_WEEK[1]}", f"ts < {_WEEK[1]}"),
                _round(3, f"ts < {_WEEK[2]}", f"ts < {_WEEK[1]}"),
                _round(4, f"ts < {_WEEK[3]}", f"ts < {_WEEK[1]}"),
                _round(5, "TRUE", f"ts < {_WEEK[1]}"),
                _round(6, "TRUE", "TRUE"),
            ]
        ),
        "log_ttl": f"""SELECT CASE WHEN ts < {_WEEK[2]} THEN 'cold' ELSE 'hot' END AS source, event_id AS reading_id
FROM events UNION ALL SELECT 'stream' AS source, event_id AS reading_id FROM events""",
        "stream_after_ttl": f"WITH {telemetry} SELECT reading_id, device_id, event_time, temperature FROM telemetry",
        "silver_after_ttl": f"WITH {silver} SELECT * FROM silver",
        "flush_lag": f"""WITH w AS (
  SELECT CASE WHEN ts < {_WEEK[2]} THEN 1 WHEN ts < {_WEEK[3]} THEN 2 ELSE 3 END AS k FROM events)
SELECT CAST(k AS BIGINT) AS snapshot_id, count(*) AS row_count, CAST(30 AS DOUBLE) AS target_s, k > 1 AS has_interval,
       CASE WHEN k > 1 THEN TRUE END AS missed_at_once, CASE WHEN k > 1 THEN FALSE END AS missed_in_a_day
FROM w GROUP BY k""",
        "compaction": f"""SELECT CASE WHEN ts < {_WEEK[3]} THEN 'cold' ELSE 'hot' END AS tier, event_id AS reading_id,
       {_DEVICE} AS device_id, ts AS event_time, value AS temperature, CAST(1 AS BIGINT) AS live_snapshots FROM events""",
    }
    return sql
