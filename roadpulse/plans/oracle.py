"""DuckDB texts of the derived test tables, for side-by-side checks of the queries."""

import re

LEVELS = ("FREE_FLOW", "MODERATE", "CONGESTED", "SEVERE", "UNKNOWN")
FLAGS = ("MISSING_SPEED", "ZERO_SPEED", "MISSING_TIMESTAMP", "MISSING_BOROUGH", "MISSING_LINK_ID")
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def rd(expr: str, digits: int) -> str:
    """Half-up decimal rounding in the form both engines agree on."""
    return f"cast(round(cast({expr} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {rd(f'{part} * 100.0::DOUBLE / {whole}', digits)} ELSE 0.0::DOUBLE END"


def level(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'UNKNOWN' WHEN {x} >= 35 THEN 'FREE_FLOW' WHEN {x} >= 15 THEN 'MODERATE' "
        f"WHEN {x} >= 5 THEN 'CONGESTED' ELSE 'SEVERE' END"
    )


def borough_code(x: str) -> str:
    cases = " ".join(f"WHEN {x} = '{name}' THEN {i}" for i, name in enumerate(BOROUGHS))
    return f"cast(CASE {cases} ELSE -1 END AS INTEGER)"


def level_code(x: str) -> str:
    cases = " ".join(f"WHEN {x} = '{name}' THEN {i}" for i, name in enumerate(LEVELS[:4]))
    return f"cast(CASE {cases} ELSE -1 END AS INTEGER)"


def level_name(x: str) -> str:
    cases = " ".join(f"WHEN {x} = {i} THEN '{name}'" for i, name in enumerate(LEVELS[:4]))
    return f"CASE {cases} ELSE 'UNKNOWN' END"


_COORD = r"^([+-]?[0-9]*\.?[0-9]+),([+-]?[0-9]*\.?[0-9]+)$"

VIEWS = {
    "traffic_raw_fx": """
SELECT cast(event_id AS VARCHAR) AS id,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '0' ELSE cast(value AS VARCHAR) END AS speed,
  json_extract_string(props, '$.k') AS travel_time,
  cast(event_id % 3 AS VARCHAR) AS status,
  CASE WHEN event_id % 103 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') END AS data_as_of,
  CASE WHEN event_id % 107 <> 0 THEN cast(user_id AS VARCHAR) END AS link_id,
  CASE WHEN event_id % 109 = 0 THEN 'bad'
    ELSE '40.' || cast(50 + user_id % 45 AS VARCHAR) || ',-74.' || cast(10 + user_id % 30 AS VARCHAR) || ' 40.70,-74.00'
  END AS link_points,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 113 = 0 THEN 'New Jersey'
    ELSE CASE event_type WHEN 'click' THEN 'Manhattan' WHEN 'error' THEN 'Brooklyn' WHEN 'purchase' THEN 'Queens'
      WHEN 'signup' THEN 'Bronx' WHEN 'view' THEN 'Staten Island' END END AS borough,
  'LINK ' || cast(user_id AS VARCHAR) AS link_name,
  cast(event_id % 5 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
  ts + to_seconds(cast(event_id % 7 AS BIGINT)) AS processed_at,
  cast(floor(event_id / 1000) AS BIGINT) AS batch_id, value AS raw_value
FROM events""",
    "messages_fx": """
SELECT id AS key, kafka_partition AS "partition", kafka_offset AS "offset", processed_at AS "timestamp",
  CASE WHEN kafka_offset % 73 = 0 THEN '["' || id || '"]'
    WHEN kafka_offset % 71 = 0 THEN '{' || body ELSE '{' || body || '}' END AS value
FROM (SELECT *, concat_ws(',',
    CASE WHEN kafka_offset % 83 = 0 THEN '"speed":' || speed ELSE '"speed":"' || speed || '"' END,
    CASE WHEN kafka_offset % 79 = 0 THEN '"transcom_id":null' END,
    CASE WHEN kafka_offset % 67 = 0 THEN '"travel_time":"' || travel_time || '.5"'
      ELSE '"travel_time":"' || travel_time || '"' END,
    '"id":"' || id || '"', '"status":"' || status || '"', '"data_as_of":"' || data_as_of || '"',
    '"link_id":"' || link_id || '"', '"link_points":"' || link_points || '"', '"borough":"' || borough || '"',
    '"link_name":"' || link_name || '"') AS body
  FROM traffic_raw_fx)""",
    "checked_fx": """
SELECT *,
  CASE WHEN NOT json_valid(value) THEN true ELSE false END AS invalid_json,
  is_object IS FALSE AND json_valid(value) AS not_an_object,
  coalesce(is_object AND (t_speed IS NULL OR t_data_as_of IS NULL OR t_link_id IS NULL OR t_borough IS NULL
    OR t_link_name IS NULL), false) AS missing_required,
  coalesce(t_speed <> 'VARCHAR' OR t_transcom_id <> 'VARCHAR', false) AS wrong_type,
  coalesce(t_speed = 'VARCHAR' AND NOT regexp_matches(speed, '^[0-9]+(\\.[0-9]+)?$'), false) AS speed_format,
  coalesce(t_borough = 'VARCHAR' AND borough NOT IN ('Manhattan','Brooklyn','Queens','Bronx','Staten Island'), false)
    AS unknown_borough,
  coalesce(t_speed = 'VARCHAR' AND NOT (try_cast(speed AS DOUBLE) BETWEEN 0 AND 200), false) AS speed_range,
  coalesce(t_travel_time = 'VARCHAR' AND NOT regexp_matches(travel_time, '^[+-]?[0-9]+$'), false) AS travel_time_text
FROM (SELECT *, json_type(j) = 'OBJECT' AS is_object,
    json_type(j, '$.speed') AS t_speed, json_type(j, '$.data_as_of') AS t_data_as_of,
    json_type(j, '$.link_id') AS t_link_id, json_type(j, '$.borough') AS t_borough,
    json_type(j, '$.link_name') AS t_link_name, json_type(j, '$.transcom_id') AS t_transcom_id,
    json_type(j, '$.travel_time') AS t_travel_time,
    json_extract_string(j, '$.speed') AS speed, json_extract_string(j, '$.borough') AS borough,
    json_extract_string(j, '$.travel_time') AS travel_time, json_extract_string(j, '$.status') AS status,
    json_extract_string(j, '$.id') AS id, json_extract_string(j, '$.link_id') AS link_id,
    json_extract_string(j, '$.data_as_of') AS data_as_of, json_extract_string(j, '$.link_points') AS link_points,
    json_extract_string(j, '$.link_name') AS link_name
  FROM (SELECT *, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM messages_fx))""",
    "verdict_fx": """
SELECT *, NOT (invalid_json OR not_an_object OR missing_required OR wrong_type OR speed_format OR unknown_borough
  OR speed_range OR travel_time_text) AS is_valid
FROM checked_fx""",
    "traffic_fx": f"""
SELECT *, {level('speed')} AS congestion_level,
  CASE WHEN speed IS NOT NULL THEN {rd('1.0 - least(speed / 60.0::DOUBLE, 1.0)', 4)} END AS congestion_score,
  hour_of_day IS NOT NULL AND NOT is_weekend AND (hour_of_day IN (7, 8) OR hour_of_day IN (17, 18)) AS peak_flag,
  CASE WHEN hour_of_day IS NOT NULL THEN NOT is_weekend AND hour_of_day IN (7, 8, 17, 18) END AS is_peak_hour,
  CASE WHEN hour_of_day IS NULL THEN NULL WHEN hour_of_day < 6 THEN 'OVERNIGHT'
    WHEN NOT is_weekend AND hour_of_day IN (7, 8) THEN 'MORNING_PEAK'
    WHEN NOT is_weekend AND hour_of_day IN (17, 18) THEN 'EVENING_PEAK' ELSE 'OFF_PEAK' END AS time_bucket,
  coalesce(speed IS NULL, false) AS f_missing_speed, coalesce(speed = 0, false) AS f_zero_speed,
  data_as_of_parsed IS NULL AS f_missing_timestamp, coalesce(borough, '') = '' AS f_missing_borough,
  coalesce(link_id, '') = '' AS f_missing_link_id
FROM (SELECT id AS record_id, link_id, link_name, borough, link_points, data_as_of, processed_at, kafka_partition,
    kafka_offset, batch_id, raw_value,
    try_cast(speed AS DOUBLE) AS speed, cast(trunc(try_cast(travel_time AS DOUBLE)) AS INTEGER) AS travel_time,
    cast(trunc(try_cast(status AS DOUBLE)) AS INTEGER) AS status,
    try_cast(data_as_of AS TIMESTAMP) AS data_as_of_parsed,
    cast(hour(try_cast(data_as_of AS TIMESTAMP)) AS INTEGER) AS hour_of_day,
    cast(dayofweek(try_cast(data_as_of AS TIMESTAMP)) + 1 AS INTEGER) AS day_of_week,
    dayofweek(try_cast(data_as_of AS TIMESTAMP)) IN (0, 6) AS is_weekend,
    try_cast(nullif(regexp_extract(split_part(trim(link_points), ' ', 1), '{_COORD}', 1), '') AS DOUBLE) AS latitude,
    try_cast(nullif(regexp_extract(split_part(trim(link_points), ' ', 1), '{_COORD}', 2), '') AS DOUBLE) AS longitude
  FROM traffic_raw_fx)""",
    "traffic_pred_fx": f"""
SELECT *, raw_value * 0.9::DOUBLE + 2 AS predicted_speed, {level('(raw_value * 0.9::DOUBLE + 2)')} AS predicted_congestion,
  0.5::DOUBLE + (kafka_offset % 50) / 100.0::DOUBLE AS congestion_confidence, 0.1::DOUBLE - raw_value / 1000 AS anomaly_score,
  (0.1::DOUBLE - raw_value / 1000) < 0 AS is_anomaly
FROM traffic_fx""",
    "quality_fx": f"""
SELECT cast(batch_id AS VARCHAR) AS batch_id,
  CASE WHEN batch_id % 4 = 0 THEN 'batch_processor' ELSE 'spark_stream_processor' END AS source,
  max(processed_at) AS recorded_at, count(*) AS total_records,
  count(*) - count_if(speed IS NULL) - count_if(borough IS NULL) - count_if(data_as_of_parsed IS NULL) AS valid_records,
  count_if(speed IS NOT NULL AND borough IS NOT NULL AND data_as_of_parsed IS NOT NULL) AS strict_valid_records,
  {pct('(count(*) - count_if(speed IS NULL) - count_if(borough IS NULL) - count_if(data_as_of_parsed IS NULL))', 'count(*)', 2)}
    AS quality_score,
  count_if(speed IS NULL) AS null_speed, count_if(borough IS NULL) AS null_borough,
  count_if(data_as_of_parsed IS NULL) AS null_data_as_of,
  count_if(coalesce(speed = 0, false)) AS zero_speed, count_if(congestion_level = 'UNKNOWN') AS unknown_congestion,
  {", ".join(f"count_if(congestion_level = '{n}') AS n_{n.lower()}" for n in LEVELS)},
  {", ".join(f"count_if(f_{n.lower()}) AS flag_{n.lower()}" for n in FLAGS)},
  {", ".join(f"count_if(coalesce(borough = '{n}', false)) AS n_{n.lower().replace(' ', '_')}" for n in BOROUGHS)},
  count_if(coalesce(borough = 'New Jersey', false)) AS n_new_jersey
FROM traffic_fx GROUP BY batch_id""",
    "lineage_fx": """
SELECT cast(batch_id AS VARCHAR) AS batch_id, phase, status, started_at, duration_ms, record_count,
  CASE WHEN phase = 'batch_processing' THEN 'batch_processor' ELSE 'spark_stream_processor' END AS processor,
  phase || '_' || strftime(started_at, '%Y%m%dT%H%M%S') || '_'
    || substr(sha256(phase || '|' || cast(batch_id AS VARCHAR)), 1, 8) AS lineage_id
FROM (SELECT batch_id,
    CASE WHEN batch_id % 4 = 0 THEN 'batch_processing' ELSE 'stream_processing' END AS phase,
    CASE WHEN batch_id % 7 = 0 THEN 'failed' WHEN batch_id % 5 = 0 THEN 'partial' ELSE 'success' END AS status,
    min(processed_at) AS started_at, cast(500 + (batch_id * 37) % 400 AS BIGINT) AS duration_ms,
    count(*) AS record_count
  FROM traffic_fx GROUP BY batch_id)""",
    "hourly_fx": f"""
SELECT date_trunc('hour', data_as_of_parsed) AS window_start, borough, count(speed) AS record_count,
  avg(speed) AS avg_speed, min(speed) AS min_speed, max(speed) AS max_speed, median(speed) AS median_speed,
  avg(travel_time) AS avg_travel_time, avg(congestion_score) AS avg_congestion_score,
  {", ".join(f"count_if(congestion_level = '{n}') AS {n}" for n in LEVELS[:4])}
FROM traffic_fx WHERE borough IS NOT NULL AND data_as_of_parsed IS NOT NULL GROUP BY 1, 2""",
    "hourly_flat_fx": f"""
SELECT window_start, borough, record_count, {rd('avg_speed', 2)} AS avg_speed, {rd('min_speed', 2)} AS min_speed,
  {rd('max_speed', 2)} AS max_speed, {rd('median_speed', 2)} AS median_speed,
  {rd('avg_travel_time', 2)} AS avg_travel_time, {rd('avg_congestion_score', 4)} AS avg_congestion_score
FROM hourly_fx""",
}


def with_views(sql: str) -> str:
    """Prefixes the view definitions a query needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    prefix = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {prefix},\n{body[5:]}"
    return f"WITH {prefix}\n{body}"
