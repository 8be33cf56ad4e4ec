"""The catalog's queries in DuckDB SQL, written from the operators' definitions."""

from __future__ import annotations

# Base tables as common table expressions.
FAST_TIME = "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60)"
PLANT = "'machine_' || lpad((user_id % 5 + 1)::varchar, 2, '0')"
FLEET = "'machine_' || lpad(user_id::varchar, 6, '0')"
K = "cast(json_extract_string(props, '$.k') as int)"
KEYS = "time, machine_id, location"
RAW_COLUMNS = f"{KEYS}, power_kw, energy_kwh, voltage_v, current_a, power_factor"


def raw(time: str = FAST_TIME, machine: str = PLANT, extra: str = "") -> str:
    return f"""SELECT {time} AS time, {machine} AS machine_id,
        CASE user_id % 5 WHEN 0 THEN 'produksi_a' WHEN 1 THEN 'produksi_a' WHEN 2 THEN 'produksi_b'
            WHEN 3 THEN 'gudang' ELSE 'office' END AS location,
        value / 10 AS power_kw, value / 3600 AS energy_kwh, 210 + {K} / 5.0::double AS voltage_v,
        value * 100 / 220 AS current_a, 0.80::double + {K} / 500.0::double AS power_factor{extra}
        FROM events"""


def minutes(source: str = "raw") -> str:
    return f"""SELECT date_trunc('minute', time) AS time, machine_id, location,
        avg(power_kw) AS avg_power_kw, sum(energy_kwh) AS sum_energy_kwh, avg(voltage_v) AS avg_voltage_v,
        avg(current_a) AS avg_current_a, avg(power_factor) AS avg_power_factor,
        min(power_kw) AS min_power_kw, max(power_kw) AS max_power_kw, count(*) AS sample_count
        FROM {source} GROUP BY ALL"""


def hours(source: str = "minutes", count: str = "sum(sample_count)::bigint", mean: str = "avg({0})") -> str:
    return f"""SELECT date_trunc('hour', time) AS time, machine_id, location,
        {mean.format('avg_power_kw')} AS avg_power_kw, sum(sum_energy_kwh) AS sum_energy_kwh,
        {mean.format('avg_voltage_v')} AS avg_voltage_v, {mean.format('avg_current_a')} AS avg_current_a,
        {mean.format('avg_power_factor')} AS avg_power_factor,
        min(min_power_kw) AS min_power_kw, max(max_power_kw) AS max_power_kw, {count} AS sample_count
        FROM {source} GROUP BY ALL"""


def tiers(time: str = FAST_TIME, machine: str = PLANT, **hour_options: str) -> str:
    return f"WITH raw AS ({raw(time, machine)}), minutes AS ({minutes()}), hours AS ({hours(**hour_options)})"


FAST = tiers()
WIDE = tiers("ts")
WIDE_FLEET = tiers("ts", FLEET)

NOW = "TIMESTAMP '2024-01-01 11:30:00'"
TODAY = "TIMESTAMP '2024-01-01 00:00:00'"
WIDE_NOW = "TIMESTAMP '2024-01-30 12:00:00'"


def half_up(value: str, digits: int) -> str:
    scale = 10**digits
    return f"floor(({value}) * {scale}.0::double + 0.5::double) / {scale}.0::double"


def rounded(*columns: str) -> str:
    return ", ".join(f"{fixed(c)} AS {c}" for c in columns)


def fixed(value: str) -> str:
    """Six digits, after cutting off the noise that the order of addition leaves."""
    return f"CASE WHEN isfinite({value}) THEN {half_up(half_up(value, 9), 6)} ELSE {value} END"


RAW_MEASURES = ("power_kw", "energy_kwh", "voltage_v", "current_a", "power_factor")
RAW_ROUNDED = f"{KEYS}, {rounded(*RAW_MEASURES)}"
TIER_MEASURES = (
    "avg_power_kw", "sum_energy_kwh", "avg_voltage_v", "avg_current_a", "avg_power_factor",
    "min_power_kw", "max_power_kw",
)
TIER_UNCOUNTED = f"{KEYS}, {rounded(*TIER_MEASURES)}"
TIER_ROUNDED = f"{TIER_UNCOUNTED}, sample_count"


def meter_delta(base: str) -> str:
    return f"""{base}, seen AS (SELECT *, lag(energy_kwh) OVER (PARTITION BY machine_id, location ORDER BY time)
        AS previous FROM raw)
        SELECT {KEYS}, {fixed('CASE WHEN energy_kwh - previous < 0 THEN energy_kwh ELSE energy_kwh - previous END')}
        AS energy_kwh FROM seen"""


# Messages: the reading's number picks how its payload is spoiled.
MESSAGES = f"""WITH raw AS ({raw(extra=', event_id, event_id % 13 AS kind')}), messages AS (SELECT *,
    time AS received_at, time - INTERVAL 10 SECOND AS sent,
    CASE WHEN kind = 10 THEN 'factory/' || location || '/' || machine_id || '/energy'
        ELSE 'energy/' || machine_id || '/data' END AS topic,
    CASE kind WHEN 1 THEN 'missing:machine_id' WHEN 9 THEN 'missing:machine_id' WHEN 6 THEN 'missing:voltage_v'
        WHEN 4 THEN 'nan:power_kw' WHEN 7 THEN 'nan:power_factor' WHEN 5 THEN 'non_finite:power_kw'
        WHEN 8 THEN 'bad_json' END AS reject_reason FROM raw)"""
SENT_MS = "epoch_us(sent) - epoch_us(sent) % 1000"
VALID = f"""{MESSAGES}, valid AS (SELECT
    CASE WHEN kind IN (3, 10, 12) THEN received_at ELSE make_timestamp({SENT_MS}) END AS time, machine_id,
    CASE WHEN kind = 2 THEN '' ELSE location END AS location,
    power_kw, energy_kwh, voltage_v, current_a, power_factor, received_at
    FROM messages WHERE reject_reason IS NULL)"""


def gaps(base: str, source: str, bucket: str) -> str:
    """From each bucket with a reading to the machine's next one, where that is not the next bucket."""
    return f"""{base}, present AS (SELECT DISTINCT machine_id, location, date_trunc('{bucket}', time) AS b FROM {source}),
        ahead AS (SELECT *, b + INTERVAL 1 {bucket} AS gap_start,
            lead(b) OVER (PARTITION BY machine_id, location ORDER BY b) AS gap_end FROM present)
        SELECT machine_id, location, gap_start, gap_end,
            date_diff('{bucket}', gap_start, gap_end)::bigint AS missing FROM ahead WHERE gap_end > gap_start"""


RESENT = f"""WITH old AS ({raw(extra=', event_type')}), new AS (SELECT
    CASE WHEN event_type IN ('purchase', 'error') THEN time ELSE time + INTERVAL 1 DAY END AS time,
    machine_id, location, power_kw + 1 AS power_kw, energy_kwh, voltage_v, current_a, power_factor FROM old),
    merged AS (SELECT {RAW_COLUMNS} FROM new UNION ALL
        SELECT {RAW_COLUMNS} FROM old WHERE ({KEYS}) NOT IN (SELECT ({KEYS}) FROM new))
    SELECT {RAW_ROUNDED} FROM merged"""

LATEST = f"""latest AS (SELECT machine_id, location, arg_max(power_kw, time) AS power_kw,
    arg_max(voltage_v, time) AS voltage_v, arg_max(current_a, time) AS current_a,
    arg_max(power_factor, time) AS power_factor, max(time) AS last_seen
    FROM raw WHERE time >= {NOW} - INTERVAL 60 SECOND GROUP BY ALL)"""
HOURLY = f"""hourly AS (SELECT time AS hour_bucket, machine_id, sum(sum_energy_kwh) AS energy_kwh FROM hours
    WHERE time >= {TODAY} AND time < {TODAY} + INTERVAL 1 DAY GROUP BY ALL)"""
SHARE = f"""share AS (SELECT machine_id, sum(sum_energy_kwh) AS total_kwh FROM minutes
    WHERE time >= {TODAY} AND time < {NOW} GROUP BY ALL)"""
GRID = f"""labels AS (SELECT DISTINCT strftime(hour_bucket, '%H:00') AS hour_label FROM hourly),
    starts AS (SELECT machine_id, min(hour_bucket) AS first_hour FROM hourly GROUP BY ALL),
    grid AS (SELECT s.machine_id, s.first_hour, l.hour_label,
        coalesce({half_up('h.energy_kwh', 3)}, 0.0::double) AS energy_kwh
        FROM starts s CROSS JOIN labels l LEFT JOIN hourly h
        ON h.machine_id = s.machine_id AND strftime(h.hour_bucket, '%H:00') = l.hour_label)"""
TOTAL_POWER = half_up("coalesce(sum(power_kw), 0.0::double)", 2)

ORACLES: dict[str, str] = {
    "raw_to_minute": f"{FAST} SELECT {TIER_ROUNDED} FROM minutes",
    "raw_to_minute_nocount": f"{FAST} SELECT {TIER_UNCOUNTED} FROM minutes",
    "minute_to_hour": f"{FAST} SELECT {TIER_ROUNDED} FROM hours",
    "minute_to_hour_weighted": (
        tiers(mean="sum({0} * sample_count) / sum(sample_count)") + f" SELECT {TIER_ROUNDED} FROM hours"
    ),
    "minute_to_hour_rowcount": tiers(count="count(*)") + f" SELECT {TIER_ROUNDED} FROM hours",
    "fleet_hours": f"{WIDE_FLEET} SELECT {TIER_ROUNDED} FROM hours",
    "date_bin_offset": f"""{FAST} SELECT time_bucket(INTERVAL 15 MINUTE, time, TIMESTAMP '1970-01-01 00:05:00')
        AS bucket, machine_id, {fixed('sum(energy_kwh)')} AS sum_energy_kwh, count(*) AS sample_count
        FROM raw GROUP BY ALL""",
    "completeness_by_minute": f"""{FAST} SELECT {KEYS}, sample_count,
        {fixed('sample_count / 6.0::double')} AS completeness FROM minutes""",
    "completeness_alert": f"""{WIDE} SELECT {KEYS}, sample_count, {fixed('sample_count / 360.0::double')}
        AS completeness FROM hours WHERE sample_count / 360.0::double < 0.02::double""",
    "gap_report": gaps(f"WITH raw AS ({raw('ts')})", "raw", "minute"),
    "gap_report_hours": gaps(WIDE_FLEET, "hours", "hour"),
    "empty_values": f"""WITH raw AS ({raw(extra=', event_type, event_id')}), spoiled AS (SELECT * REPLACE (
        CASE WHEN event_type <> 'error' THEN power_kw END AS power_kw,
        CASE WHEN machine_id <> 'machine_03' THEN voltage_v END AS voltage_v,
        CASE WHEN location <> 'office' THEN location ELSE 'unknown' END AS location) FROM raw WHERE event_id % 10 <> 0),
        minutes AS ({minutes('spoiled')}), filled AS (SELECT * REPLACE
        ({', '.join(f'coalesce({c}, 0) AS {c}' for c in TIER_MEASURES)}) FROM minutes)
        SELECT {TIER_ROUNDED} FROM filled""",
    "late_readings": f"""WITH raw AS ({raw(extra=', event_id')}), arrived AS (SELECT *,
        time + to_seconds(event_id % 101) AS received_at FROM raw)
        SELECT {KEYS}, received_at, event_id FROM arrived
        WHERE received_at >= date_trunc('minute', time) + INTERVAL 2 MINUTE""",
    "latest_reading": f"""{FAST} SELECT machine_id, location,
        {fixed('arg_max(power_kw, time)')} AS latest_power_kw, {fixed('arg_max(energy_kwh, time)')} AS latest_energy_kwh,
        {fixed('arg_max(voltage_v, time)')} AS latest_voltage_v, {fixed('arg_max(current_a, time)')} AS latest_current_a,
        {fixed('arg_max(power_factor, time)')} AS latest_power_factor, max(time) AS last_seen
        FROM raw WHERE time >= {NOW} - INTERVAL 5 MINUTE GROUP BY ALL""",
    "latest_power_by_machine": f"""{FAST} SELECT machine_id, {fixed('arg_max(power_kw, time)')} AS latest_power_kw,
        max(time) AS last_seen FROM raw WHERE time >= {NOW} - INTERVAL 5 MINUTE GROUP BY ALL""",
    "fleet_latest_reading": f"""{WIDE_FLEET} SELECT machine_id, location,
        {fixed('arg_max(power_kw, time)')} AS latest_power_kw, {fixed('arg_max(energy_kwh, time)')} AS latest_energy_kwh,
        {fixed('arg_max(voltage_v, time)')} AS latest_voltage_v, {fixed('arg_max(current_a, time)')} AS latest_current_a,
        {fixed('arg_max(power_factor, time)')} AS latest_power_factor, max(time) AS last_seen
        FROM raw WHERE time >= {WIDE_NOW} - INTERVAL 30 DAY GROUP BY ALL""",
    "minute_trend": f"""{FAST} SELECT time AS bucket, machine_id, location, {rounded(
        'avg_power_kw', 'sum_energy_kwh', 'avg_voltage_v', 'avg_power_factor', 'min_power_kw', 'max_power_kw')}
        FROM minutes WHERE time >= {NOW} - INTERVAL 1 HOUR""",
    "hourly_report": f"""{FAST} SELECT time AS hour_bucket, machine_id, location, {rounded(
        'sum_energy_kwh', 'avg_power_kw', 'max_power_kw', 'avg_power_factor')}, sample_count
        FROM hours WHERE time >= {NOW} - INTERVAL 7 DAY""",
    "hourly_report_week": f"""{WIDE} SELECT time AS hour_bucket, machine_id, location, {rounded(
        'sum_energy_kwh', 'avg_power_kw', 'max_power_kw', 'avg_power_factor')}, sample_count
        FROM hours WHERE time >= {WIDE_NOW} - INTERVAL 7 DAY""",
    "machine_comparison": f"""{FAST} SELECT machine_id, location,
        {fixed('sum(sum_energy_kwh)')} AS energy_kwh_this_hour, {fixed('avg(avg_power_kw)')} AS avg_power_kw,
        {fixed('max(max_power_kw)')} AS peak_power_kw, {fixed('min(min_power_kw)')} AS min_power_kw,
        {fixed('avg(avg_power_factor)')} AS avg_pf
        FROM minutes WHERE time >= date_trunc('hour', {NOW}) GROUP BY ALL""",
    "power_factor_alert": f"""{FAST} SELECT machine_id, location, {fixed('avg(avg_power_factor)')} AS avg_pf_last_hour,
        count(*) AS sample_count FROM minutes WHERE time >= {NOW} - INTERVAL 1 HOUR
        GROUP BY machine_id, location HAVING avg(avg_power_factor) < 0.90""",
    "fleet_power_factor_alert": f"""{WIDE_FLEET} SELECT machine_id, location,
        {fixed('avg(avg_power_factor)')} AS avg_pf_last_hour, count(*) AS sample_count
        FROM minutes WHERE time >= {WIDE_NOW} - INTERVAL 30 DAY
        GROUP BY machine_id, location HAVING avg(avg_power_factor) < 0.8991234::double""",
    "hourly_energy": f"""{FAST}, {HOURLY} SELECT hour_bucket, machine_id, {rounded('energy_kwh')} FROM hourly""",
    "energy_share": f"{FAST}, {SHARE} SELECT machine_id, {rounded('total_kwh')} FROM share",
    "total_power": f"{FAST}, {LATEST} SELECT {fixed(TOTAL_POWER)} AS total_power_kw FROM latest",
    "peak_hour_flag": f"""{WIDE}, flagged AS (SELECT *, avg(max_power_kw) OVER (PARTITION BY machine_id, location
        ORDER BY time RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS rolling_avg FROM hours)
        SELECT {KEYS}, {rounded('max_power_kw', 'rolling_avg')},
        (max_power_kw > 0.8::double * rolling_avg)::int AS peak_hour_flag FROM flagged""",
    "meter_delta": meter_delta(WIDE),
    "fleet_meter_delta": meter_delta(WIDE_FLEET),
    "dense_hourly_grid": f"""{FAST}, {HOURLY}, {GRID} SELECT machine_id, hour_label, {rounded('energy_kwh')}
        FROM grid""",
    "dashboard_realtime": f"""{FAST}, {LATEST} SELECT machine_id, location,
        {rounded('power_kw', 'voltage_v', 'current_a', 'power_factor')},
        strftime(last_seen, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(last_seen) // 1000 % 1000)::varchar, 3, '0') || 'Z'
        AS last_seen FROM latest""",
    "dashboard_line_chart": f"""{FAST}, {HOURLY}, {GRID} SELECT machine_id, first_hour,
        string_agg(hour_label, ' ' ORDER BY hour_label) AS labels,
        string_agg(round(energy_kwh * 1000)::bigint::varchar, ' ' ORDER BY hour_label) AS thousandths
        FROM grid GROUP BY ALL""",
    "dashboard_pie_chart": f"""{FAST}, {SHARE} SELECT machine_id, {rounded('total_kwh')},
        {fixed(half_up('total_kwh', 3))} AS value FROM share""",
    "dashboard_document": f"""{FAST}, {LATEST}, {HOURLY}, {SHARE}, {GRID}, document AS (
        SELECT 0 AS part, '' AS machine_id, 0 AS position, {TOTAL_POWER} AS value FROM latest
        UNION ALL SELECT 1, machine_id, 0, power_kw FROM latest
        UNION ALL SELECT 1, machine_id, 1, voltage_v FROM latest
        UNION ALL SELECT 1, machine_id, 2, current_a FROM latest
        UNION ALL SELECT 1, machine_id, 3, power_factor FROM latest
        UNION ALL SELECT 2, '', row_number() OVER (ORDER BY hour_label) - 1, left(hour_label, 2)::double FROM labels
        UNION ALL SELECT 3, machine_id, row_number() OVER (PARTITION BY machine_id ORDER BY hour_label) - 1,
            energy_kwh FROM grid
        UNION ALL SELECT 5, machine_id, 0, 0.0::double FROM share
        UNION ALL SELECT 7, '', 0, {half_up('total_kwh', 3)} FROM share)
        SELECT part::int AS part, machine_id, position::int AS position, {rounded('value')} FROM document""",
    "topic_filter": f"{MESSAGES} SELECT event_id, topic FROM messages WHERE topic LIKE 'energy/%'",
    "topic_filter_two_levels": f"{MESSAGES} SELECT event_id, topic FROM messages WHERE topic LIKE 'factory/%'",
    "parse_validate": f"{VALID} SELECT {RAW_ROUNDED}, received_at FROM valid",
    "quarantine": f"""{MESSAGES} SELECT topic, received_at, reject_reason
        FROM messages WHERE reject_reason IS NOT NULL""",
    "reject_counts": f"""{MESSAGES} SELECT reject_reason, count(*) AS messages FROM messages
        WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    "ingest_counts": f"""{MESSAGES}, outcomes AS (SELECT 'messages' AS outcome FROM messages
        UNION ALL SELECT coalesce(reject_reason, 'valid') FROM messages)
        SELECT outcome, count(*) AS messages FROM outcomes GROUP BY ALL""",
    "explode_batch": f"""WITH raw AS ({raw()}), both_times AS (SELECT *, time AS received_at FROM raw UNION ALL
        SELECT time + INTERVAL 10 SECOND AS time, machine_id, location, power_kw, energy_kwh, voltage_v, current_a,
        power_factor, time AS received_at FROM raw), cut AS (SELECT * REPLACE
        (make_timestamp(epoch_us(time) - epoch_us(time) % 1000) AS time) FROM both_times)
        SELECT {RAW_ROUNDED}, received_at FROM cut""",
    "rule_project": f"""{MESSAGES}, fields AS (SELECT kind,
        CASE WHEN kind NOT IN (1, 8, 9) THEN machine_id END AS machine_id,
        CASE WHEN kind = 2 THEN '' WHEN kind NOT IN (8, 9) THEN location END AS location,
        CASE WHEN kind = 5 THEN 'Infinity'::double WHEN kind NOT IN (3, 4, 8, 9) THEN power_kw END AS power_kw,
        CASE WHEN kind NOT IN (8, 9) THEN energy_kwh END AS energy_kwh,
        CASE WHEN kind NOT IN (6, 8, 9) THEN voltage_v END AS voltage_v,
        CASE WHEN kind NOT IN (8, 9) THEN current_a END AS current_a,
        CASE WHEN kind NOT IN (7, 8, 9) THEN power_factor END AS power_factor,
        CASE WHEN kind = 10 THEN 0 WHEN kind NOT IN (0, 3, 8, 9, 11, 12) THEN ({SENT_MS}) // 1000 END AS ts_ms,
        epoch_us(received_at) // 1000 AS mqtt_ts FROM messages)
        SELECT machine_id, location, {rounded('power_kw', 'energy_kwh', 'voltage_v', 'current_a', 'power_factor')},
        coalesce(ts_ms, -1) AS ts_ms, mqtt_ts FROM fields""",
    "outgoing_topics": f"""{FAST} SELECT 'energy/' || machine_id || '/data' AS topic, count(*) AS messages
        FROM raw GROUP BY ALL""",
    "outgoing_payloads": f"""WITH raw AS ({raw()}), cut AS (SELECT * REPLACE
        (make_timestamp(epoch_us(time) - epoch_us(time) % 1000) AS time), time AS received_at FROM raw)
        SELECT 'energy/' || machine_id || '/data' AS topic, {RAW_ROUNDED}, received_at FROM cut""",
    "dedupe_last_write": f"""WITH raw AS ({raw(extra=', event_id')}) SELECT {KEYS}, {fixed('power_kw * 2')} AS power_kw,
        {rounded('energy_kwh', 'voltage_v', 'current_a', 'power_factor')}, event_id + 1 AS arrival FROM raw""",
    "upsert_merge": RESENT,
    "upsert_table": RESENT,
    "upsert_scattered": f"""{WIDE}, merged AS (SELECT * REPLACE
        (power_kw + CASE WHEN epoch_us(time) // 3600000000 % 2 = 0 THEN 1 ELSE 0 END AS power_kw) FROM raw)
        SELECT {RAW_ROUNDED} FROM merged""",
    "upsert_null_tags": f"""{FAST}, merged AS (SELECT * REPLACE
        (power_kw + 1 AS power_kw, nullif(location, 'office') AS location) FROM raw)
        SELECT {RAW_ROUNDED} FROM merged""",
    "upsert_versions": f"""WITH raw AS ({raw(extra=', event_type')}), merged AS (SELECT * REPLACE
        (power_kw * CASE event_type WHEN 'purchase' THEN 3 WHEN 'error' THEN 2 ELSE 1 END AS power_kw),
        time + CASE event_type WHEN 'purchase' THEN INTERVAL 30 MINUTE WHEN 'error' THEN INTERVAL 10 MINUTE
            ELSE INTERVAL 0 MINUTE END AS received_at FROM raw)
        SELECT {RAW_ROUNDED}, received_at FROM merged""",
    "upsert_settled_ties": f"""WITH raw AS ({raw(extra=', event_id')}), merged AS (SELECT * REPLACE
        (power_kw + (2 - event_id % 3) AS power_kw) FROM raw)
        SELECT {RAW_ROUNDED} FROM merged""",
    "machine_lookup": f"""{WIDE_FLEET} SELECT {RAW_ROUNDED} FROM raw
        WHERE machine_id IN ('machine_000003', 'machine_000017', 'machine_000040')
        AND time >= TIMESTAMP '2024-01-02' AND time < TIMESTAMP '2024-01-25'""",
    "catalog_scan": f"WITH raw AS ({raw()}) SELECT {RAW_ROUNDED} FROM raw",
    "quarantine_table": f"""{MESSAGES} SELECT topic, received_at, reject_reason,
        'batch ' || (event_id % 2)::varchar AS batch FROM messages WHERE reject_reason IS NOT NULL""",
    "minute_job_nocount": f"{FAST} SELECT {TIER_UNCOUNTED}, NULL::bigint AS sample_count FROM minutes",
    "tier_scan": f"""{FAST} SELECT {RAW_ROUNDED} FROM raw
        WHERE time >= TIMESTAMP '2024-01-01 02:30:00' AND time < {NOW}""",
    "retention_keep": f"{WIDE} SELECT {RAW_ROUNDED} FROM raw WHERE time >= TIMESTAMP '2024-01-16 12:00:00'",
    "retention_applied": f"{WIDE} SELECT {TIER_ROUNDED} FROM hours WHERE time >= {WIDE_NOW} - INTERVAL 14 DAY",
    "incremental_minute": f"{FAST} SELECT {TIER_ROUNDED} FROM minutes",
    "checkpointed_minute": f"{FAST} SELECT {TIER_ROUNDED} FROM minutes WHERE time < {NOW}",
    "backfill_tiers": f"""{FAST} SELECT {TIER_ROUNDED}, 'energy_minute' AS tier FROM minutes
        UNION ALL SELECT {TIER_ROUNDED}, 'energy_hour' AS tier FROM hours""",
    "line_protocol_roundtrip": f"{FAST} SELECT {TIER_ROUNDED} FROM minutes",
    "line_protocol_readings": f"WITH raw AS ({raw()}) SELECT {RAW_ROUNDED} FROM raw",
    "line_protocol_escaped": f"""{FAST}, tagged AS (SELECT * REPLACE (location || ' a,b=c' AS location) FROM minutes)
        SELECT {TIER_ROUNDED} FROM tagged""",
    "line_protocol_rejects": f"""{FAST} SELECT CASE machine_id WHEN 'machine_01' THEN 'no time'
        WHEN 'machine_02' THEN 'bad number' ELSE 'bad time' END AS reject_reason, count(*) AS lines FROM minutes
        WHERE machine_id IN ('machine_01', 'machine_02', 'machine_03') GROUP BY ALL""",
    "line_protocol_seconds": f"{FAST} SELECT {TIER_ROUNDED} FROM minutes WHERE machine_id <> 'machine_03'",
    "stream_minute": f"""{FAST} SELECT {TIER_ROUNDED} FROM minutes
        WHERE time + INTERVAL 1 MINUTE <= (SELECT max(time) FROM raw) - INTERVAL 1 MINUTE""",
    "stream_hour": f"""{FAST}, closed AS (SELECT * FROM minutes
        WHERE time + INTERVAL 1 MINUTE <= (SELECT max(time) FROM raw) - INTERVAL 1 MINUTE),
        closed_hours AS ({hours('closed')}) SELECT {TIER_ROUNDED} FROM closed_hours
        WHERE time + INTERVAL 1 HOUR <= (SELECT max(time) FROM raw) - INTERVAL 1 MINUTE""",
    "stream_ingest": f"""{VALID}, last AS (SELECT * FROM valid
        QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY received_at DESC) = 1)
        SELECT {RAW_ROUNDED} FROM last""",
}


def daily(base: str) -> str:
    return f"""{base} SELECT date_trunc('day', time)::timestamp AS day, machine_id, location,
        {fixed('sum(sum_energy_kwh)')} AS total_energy_kwh, {fixed('avg(avg_power_kw)')} AS avg_power_kw,
        {fixed('max(max_power_kw)')} AS peak_power_kw, {fixed('avg(avg_power_factor)')} AS avg_power_factor,
        sum(sample_count)::bigint AS total_samples
        FROM hours WHERE time >= {WIDE_NOW} - INTERVAL 30 DAY GROUP BY ALL"""


# Reports over stored tiers are those over derived ones.
for _name in ("latest_reading", "minute_trend", "machine_comparison", "power_factor_alert"):
    ORACLES[f"stored_{_name}"] = ORACLES[_name]
ORACLES["stored_hourly_report"] = ORACLES["hourly_report_week"]
ORACLES["stored_daily_summary"] = daily(WIDE)
ORACLES["daily_summary"] = daily(WIDE)
ORACLES["fleet_daily_summary"] = daily(WIDE_FLEET)
# Tiers that late readings reached in the end are those of one pass over all readings.
ORACLES["late_repair"] = ORACLES["late_repair_marked"] = ORACLES["backfill_tiers"]
ORACLES["reset_minute_job"] = ORACLES["incremental_minute"]
