"""The registered queries as SQL over the same tables, for DuckDB.

Built from shared common table expressions; each query names the ones it needs.
"""

from __future__ import annotations

from fieldgauge import contract as C

_DAY = "DATE '2024-01-15'"
_AS_OF_DATE = "DATE '2024-01-31'"
_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
_LOCATION = "'field-a'"


def _steady(value: str) -> str:
    return f"round(round({value}, 9), 6)"


_CTES = {
    "readings": """
SELECT event_id, loc || '-' || lpad(CAST(user_id AS VARCHAR), 3, '0') AS deviceId,
  loc AS location, date_trunc('second', ts) AS sensor_timestamp,
  epoch_us(ts) // 1000 AS "timestamp",
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 211 = 0 THEN -6e1
       WHEN event_id % 50 = 0 THEN CAST(955 AS DOUBLE) / 1e1
       ELSE CAST((event_id * 37) % 500 AS DOUBLE) / 1e1 - 5e0 END AS temperature,
  CAST((event_id * 53) % 1020 AS DOUBLE) / 1e1 AS humidity,
  CASE WHEN event_id % 61 = 0 THEN 8.5e2
       ELSE 9.9e2 + CAST((event_id * 29) % 500 AS DOUBLE) / 1e1 END AS pressure,
  CASE WHEN event_id % 101 = 0 THEN NULL
       ELSE event_type IN ('click', 'purchase') END AS motion,
  value * 6e0 AS light,
  CASE WHEN event_id % 127 = 0 THEN CAST(145 AS DOUBLE) / 1e1
       ELSE 3e0 + CAST((event_id * 17) % 80 AS DOUBLE) / 1e1 END AS acidity,
  CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 40
       + (user_id % 4) * 20 + 1 AS INTEGER) AS battery_level,
  CAST(-50 - (event_id % 45) AS INTEGER) AS signal_strength,
  '1.2.' || CAST(event_id % 10 AS VARCHAR) AS firmware_version
FROM (SELECT *, CASE user_id % 5 WHEN 0 THEN 'warehouse-a' WHEN 1 THEN 'warehouse-b'
        WHEN 2 THEN 'field-a' WHEN 3 THEN 'field-b' ELSE 'lab-a' END AS loc FROM events) e
""",
    "messages": """
SELECT *, '{"deviceId":"' || deviceId || '"'
  || coalesce(',"temperature":' || CAST(temperature AS VARCHAR), '')
  || ',"humidity":' || CAST(humidity AS VARCHAR) || ',"pressure":' || CAST(pressure AS VARCHAR)
  || coalesce(',"motion":' || CAST(motion AS VARCHAR), '')
  || ',"light":' || CAST(light AS VARCHAR) || ',"acidity":' || CAST(acidity AS VARCHAR)
  || ',"location":"' || location || '","timestamp":' || CAST("timestamp" AS VARCHAR)
  || ',"metadata":{"battery_level":' || CAST(battery_level AS VARCHAR)
  || ',"signal_strength":' || CAST(signal_strength AS VARCHAR)
  || ',"firmware_version":"' || firmware_version || '"}}' AS message
FROM readings
""",
    # damage: 1 empty, 2 broken, 3 device_id, 4 sensorId, 5 bad time, 6 no location
    "damaged": """
SELECT *, CASE WHEN event_id % 71 = 0 THEN 1 WHEN event_id % 73 = 0 THEN 2
  WHEN event_id % 79 = 0 THEN 3 WHEN event_id % 83 = 0 THEN 4
  WHEN event_id % 89 = 0 THEN 5 WHEN event_id % 103 = 0 THEN 6 ELSE 0 END AS damage
FROM readings
""",
    "rejected": """
SELECT 'iot-sensor-data' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
  event_id AS "offset",
  CASE WHEN damage <= 2 THEN 'unparseable' WHEN damage <= 4 THEN 'missing_device_id'
       WHEN damage = 5 THEN 'missing_timestamp' ELSE 'missing_location' END AS reason,
  damage = 3 AS misnamed_device_id
FROM damaged WHERE damage > 0
""",
    "bronze": f"""
SELECT *, sha256(CAST(event_id AS VARCHAR)) AS record_id,
  CASE WHEN location LIKE 'warehouse%' THEN 'temperature-sensor'
       WHEN location LIKE 'field%' THEN 'environmental-sensor'
       ELSE 'iot-sensor' END AS deviceType,
  CAST(sensor_timestamp AS DATE) AS event_date,
  CAST(year(sensor_timestamp) AS INTEGER) AS "year",
  CAST(month(sensor_timestamp) AS INTEGER) AS "month",
  CAST(day(sensor_timestamp) AS INTEGER) AS "day",
  CAST(hour(sensor_timestamp) AS INTEGER) AS "hour",
  {_AS_OF_DATE} AS bronze_date, 'raw-s3-json' AS data_source,
  'bronze-batch-job-v2' AS ingestion_job, 'ingested' AS processing_status
FROM readings
""",
    "flags": """
SELECT *, coalesce(length(deviceId) > 0, false) AS deviceId_valid,
  coalesce(length(deviceType) > 0, false) AS deviceType_valid,
  sensor_timestamp IS NOT NULL AS timestamp_valid,
  coalesce(temperature BETWEEN -50 AND 100, false) AS temperature_valid,
  coalesce(humidity BETWEEN 0 AND 100, false) AS humidity_valid,
  coalesce(pressure BETWEEN 500 AND 1500, false) AS pressure_valid,
  coalesce(length(location) > 0, false) AS location_valid,
  motion IS NOT NULL AS motion_valid,
  coalesce(light BETWEEN 0 AND 100000, false) AS light_valid,
  coalesce(acidity BETWEEN 0 AND 14, false) AS acidity_valid
FROM bronze
""",
    "scored": """
SELECT *, (deviceId_valid AND deviceType_valid AND timestamp_valid AND temperature_valid
   AND humidity_valid AND pressure_valid AND location_valid AND motion_valid
   AND light_valid AND acidity_valid) AS is_valid_record,
  (deviceId_valid::INT + deviceType_valid::INT + timestamp_valid::INT + temperature_valid::INT
   + humidity_valid::INT + pressure_valid::INT + location_valid::INT + motion_valid::INT
   + light_valid::INT + acidity_valid::INT) / 1e1 AS data_quality_score
FROM flags
""",
    "categories": f"""
SELECT *, {_steady("temperature")} AS temperature_celsius,
  {_steady("temperature * 9 / 5 + 32")} AS temperature_fahrenheit,
  {_steady("temperature + 273.15")} AS temperature_kelvin,
  CASE WHEN temperature < 0 THEN 'freezing' WHEN temperature BETWEEN 0 AND 15 THEN 'cold'
       WHEN temperature BETWEEN 16 AND 25 THEN 'comfortable'
       WHEN temperature BETWEEN 26 AND 35 THEN 'warm' ELSE 'hot' END AS temperature_category,
  CASE WHEN humidity < 30 THEN 'dry' WHEN humidity BETWEEN 30 AND 60 THEN 'comfortable'
       WHEN humidity BETWEEN 61 AND 80 THEN 'humid' ELSE 'very_humid' END AS humidity_category,
  CASE WHEN pressure < 1000 THEN 'low' WHEN pressure BETWEEN 1000 AND 1025 THEN 'normal'
       ELSE 'high' END AS pressure_category,
  CASE WHEN light < 1 THEN 'dark' WHEN light BETWEEN 1 AND 50 THEN 'dim'
       WHEN light BETWEEN 51 AND 500 THEN 'indoor' WHEN light BETWEEN 501 AND 10000 THEN 'bright'
       ELSE 'very_bright' END AS light_category,
  CASE WHEN acidity < 3 THEN 'very_acidic' WHEN acidity BETWEEN 3 AND 6 THEN 'acidic'
       WHEN acidity BETWEEN 6 AND 8 THEN 'neutral' WHEN acidity BETWEEN 8 AND 11 THEN 'basic'
       ELSE 'very_basic' END AS acidity_category,
  CASE WHEN motion THEN 'active' ELSE 'inactive' END AS motion_status,
  CAST(hour(sensor_timestamp) AS INTEGER) AS hour_of_day,
  CAST(dayofweek(sensor_timestamp) + 1 AS INTEGER) AS day_of_week,
  dayofweek(sensor_timestamp) IN (0, 6) AS is_weekend,
  CASE WHEN month(sensor_timestamp) IN (12, 1, 2) THEN 'winter'
       WHEN month(sensor_timestamp) IN (3, 4, 5) THEN 'spring'
       WHEN month(sensor_timestamp) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
  battery_level < 20 AS low_battery, signal_strength < -80 AS poor_signal,
  {_AS_OF_DATE} AS silver_processing_date, 'bronze_to_silver_v2' AS data_lineage,
  'silver-batch-job' AS processing_job, '2.0' AS silver_tier_version
FROM scored WHERE is_valid_record
""",
    "silver": """
SELECT *, CASE WHEN low_battery AND poor_signal THEN 'critical'
    WHEN low_battery OR poor_signal THEN 'warning' ELSE 'good' END AS device_health_status,
  CASE WHEN temperature_category = 'comfortable' AND humidity_category = 'comfortable'
         AND light_category IN ('indoor', 'bright') THEN 'optimal'
       WHEN temperature_category IN ('comfortable', 'warm')
         AND humidity_category IN ('comfortable', 'humid') THEN 'good'
       ELSE 'poor' END AS comfort_index
FROM categories
""",
    "hourly": f"""
SELECT event_date, hour_of_day, location, deviceType, count(*) AS total_readings,
  count(DISTINCT deviceId) AS unique_devices,
  {_steady("avg(temperature)")} AS avg_temperature, min(temperature) AS min_temperature,
  max(temperature) AS max_temperature, {_steady("avg(humidity)")} AS avg_humidity,
  {_steady("avg(pressure)")} AS avg_pressure, {_steady("avg(light)")} AS avg_light,
  {_steady("avg(acidity)")} AS avg_acidity, count(*) FILTER (motion) AS motion_detections,
  {_steady("avg(data_quality_score)")} AS avg_quality_score,
  {_steady("count(*) FILTER (motion) * 1e2 / count(*)")} AS motion_percentage
FROM silver GROUP BY event_date, hour_of_day, location, deviceType
""",
    "daily_counts": """
SELECT event_date, location, deviceType, count(*) AS daily_readings,
  count(DISTINCT deviceId) AS active_devices, count(DISTINCT hour_of_day) AS active_hours,
  avg(temperature) AS t, min(temperature) AS daily_min_temp, max(temperature) AS daily_max_temp,
  avg(humidity) AS h, avg(pressure) AS p, avg(light) AS l, avg(acidity) AS a,
  count(*) FILTER (motion) AS daily_motion_detections, avg(data_quality_score) AS q,
  count(*) FILTER (comfort_index = 'optimal') AS optimal_readings,
  count(*) FILTER (comfort_index = 'good') AS good_readings,
  count(*) FILTER (comfort_index = 'poor') AS poor_readings,
  count(*) FILTER (light_category = 'bright') AS bright_light_readings,
  count(*) FILTER (acidity_category = 'neutral') AS neutral_acidity_readings
FROM silver GROUP BY event_date, location, deviceType
""",
    "daily": f"""
SELECT event_date, location, deviceType, daily_readings, active_devices, active_hours,
  {_steady("t")} AS daily_avg_temp, daily_min_temp, daily_max_temp,
  {_steady("h")} AS daily_avg_humidity, {_steady("p")} AS daily_avg_pressure,
  {_steady("l")} AS daily_avg_light, {_steady("a")} AS daily_avg_acidity,
  daily_motion_detections, {_steady("q")} AS daily_quality_score, optimal_readings,
  good_readings, poor_readings, bright_light_readings, neutral_acidity_readings,
  {_steady("(optimal_readings + good_readings) * 1e2 / daily_readings")} AS comfort_percentage,
  {_steady("daily_motion_detections * 1e2 / daily_readings")} AS motion_percentage,
  {_steady("bright_light_readings * 1e2 / daily_readings")} AS bright_light_percentage,
  {_steady("neutral_acidity_readings * 1e2 / daily_readings")} AS neutral_acidity_percentage
FROM daily_counts
""",
    "device_counts": """
SELECT event_date, deviceId, deviceType, location, count(*) AS total_readings,
  count(DISTINCT hour_of_day) AS active_hours, avg(temperature) AS t, avg(humidity) AS h,
  avg(pressure) AS p, avg(light) AS l, avg(acidity) AS a,
  count(*) FILTER (motion) AS motion_detections, avg(data_quality_score) AS q,
  avg(battery_level) AS b, avg(signal_strength) AS s,
  min(sensor_timestamp) AS first_reading, max(sensor_timestamp) AS last_reading
FROM silver GROUP BY event_date, deviceId, deviceType, location
""",
    "device": f"""
SELECT event_date, deviceId, deviceType, location, total_readings, active_hours,
  {_steady("t")} AS avg_temperature, {_steady("h")} AS avg_humidity,
  {_steady("p")} AS avg_pressure, {_steady("l")} AS avg_light, {_steady("a")} AS avg_acidity,
  motion_detections, {_steady("q")} AS device_quality_score,
  {_steady("b")} AS avg_battery_level, {_steady("s")} AS avg_signal_strength,
  first_reading, last_reading,
  {_steady("motion_detections * 1e2 / total_readings")} AS motion_percentage,
  CASE WHEN q >= 0.9 AND active_hours >= 20 AND b >= 80 THEN 'excellent'
       WHEN q >= 0.8 AND active_hours >= 16 AND b >= 60 THEN 'good'
       WHEN q >= 0.7 AND active_hours >= 12 AND b >= 40 THEN 'acceptable'
       ELSE 'needs_attention' END AS device_health
FROM device_counts
""",
    "mart": """
SELECT location, deviceType AS device_type, daily_readings AS total_readings, active_devices,
  active_hours, daily_avg_temp AS avg_temperature, daily_min_temp AS min_temperature,
  daily_max_temp AS max_temperature, daily_avg_humidity AS avg_humidity,
  daily_avg_pressure AS avg_pressure, daily_quality_score AS quality_score, comfort_percentage,
  optimal_readings, good_readings, poor_readings, event_date AS report_date
FROM daily
""",
    "latest": f"""
SELECT * FROM mart WHERE report_date =
  (SELECT max(report_date) FROM mart WHERE report_date <= {_AS_OF_DATE})
""",
    "windows": f"""
SELECT time_bucket(INTERVAL 5 MINUTE, sensor_timestamp) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, sensor_timestamp) + INTERVAL 5 MINUTE AS window_end, deviceId,
  {_steady("avg(temperature)")} AS avg_temperature, min(temperature) AS min_temperature,
  max(temperature) AS max_temperature, {_steady("avg(humidity)")} AS avg_humidity,
  {_steady("avg(pressure)")} AS avg_pressure, count(*) AS record_count,
  min(location) AS location
FROM readings GROUP BY 1, 2, 3
""",
}


def _one_decimal(name: str) -> str:
    """One decimal place, the shortest text of the number rounded half up, as Java does."""
    exact = f"CAST(CAST({name} AS VARCHAR) AS DECIMAL(30, 15))"
    return f"CAST(CAST(round({exact}, 1) AS DECIMAL(20, 1)) AS VARCHAR)"


def _anomaly_ctes(t, h, p, light, a, battery) -> dict[str, str]:
    """Rules with the given limits; each limit pair is (low, high)."""
    rules = [
        ("Temperature", "temperature", t, "°C", "°C"),
        ("Humidity", "humidity", h, "%", "%"),
        ("Pressure", "pressure", p, "", " hPa"),
        ("Light", "light", light, "", " lux"),
        ("Acidity", "acidity", a, "", " pH"),
    ]
    parts = [
        f"SELECT *, {n} AS rule, '{kind}' AS anomaly_type, {name} AS reading, "
        f"'{pair[0]}{low_unit} to {pair[1]}{unit}' AS threshold, "
        f"{_one_decimal(name)} || '{low_unit if low_unit else unit}' AS value "
        f"FROM readings WHERE {name} < {pair[0]} OR {name} > {pair[1]}"
        for n, (kind, name, pair, low_unit, unit) in enumerate(rules)
        if pair is not None
    ]
    if battery is not None:
        parts.append(
            "SELECT *, 5 AS rule, 'Low Battery' AS anomaly_type, CAST(battery_level AS DOUBLE) "
            f"AS reading, '> {battery}%' AS threshold, CAST(battery_level AS VARCHAR) || '%' "
            f"AS value FROM readings WHERE battery_level < {battery}"
        )
    return {"anomalies": " UNION ALL ".join(parts)}


_STANDARD = _anomaly_ctes((-10.0, 80.0), (0.0, 100.0), (900.0, 1100.0), (0.0, 1000.0), (4.0, 10.0), 20)
_NO_BATTERY = _anomaly_ctes((-10.0, 80.0), (0.0, 100.0), (900.0, 1100.0), (0.0, 1000.0), (4.0, 10.0), None)
_NARROW = _anomaly_ctes((20.0, 25.0), (40.0, 60.0), (1000.0, 1020.0), (100.0, 500.0), (6.0, 8.0), 50)

_TYPES = """string_agg(anomaly_type, ', ' ORDER BY rule)"""
_SUBJECT = "'[IoT Alert] Anomaly detected in ' || deviceId || ' at ' || location"
_BODY = """'Device: ' || deviceId || chr(10) || 'Location: ' || location || chr(10)
  || 'Timestamp: ' || strftime(sensor_timestamp, '%Y-%m-%d %H:%M:%S') || chr(10) || chr(10)
  || 'Anomalies detected:' || chr(10)
  || string_agg('- ' || anomaly_type || ': ' || value || ' (threshold: ' || threshold || ')',
                chr(10) ORDER BY rule) || chr(10) || chr(10)
  || 'Please investigate this issue immediately.' || chr(10) || chr(10) || '---' || chr(10)
  || 'IoT Monitoring System'"""
_ALERT_KEY = "event_id, deviceId, location, sensor_timestamp"

_READING = """deviceId, sensor_timestamp, temperature, humidity, pressure, motion, light, acidity,
  location, "timestamp", battery_level, signal_strength, firmware_version"""
_FLAT = """deviceId, temperature, humidity, pressure, motion, light, acidity, location,
  "timestamp", battery_level, signal_strength, firmware_version"""
_RAW_PARTS = """"year" AS raw_year, "month" AS raw_month, "day" AS raw_day, "hour" AS raw_hour"""
_CATEGORY_NAMES = ", ".join(f"{b.metric}_category" for b in C.CATEGORY_BANDS)
_FLAG_NAMES = ", ".join(f"{name}_valid" for name in C.RULES)


def _distribution(column: str, source: str) -> str:
    return f'SELECT {column}, count(*) AS "count" FROM {source} GROUP BY {column}'


_BODIES = {
    "ingest_envelope": """SELECT deviceId AS kafka_key, 'iot-sensor-data' AS topic,
        CAST(event_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
        make_timestamp("timestamp" * 1000) AS kafka_timestamp,
        CAST(length(message) AS INTEGER) AS message_length FROM messages""",
    "ingest_parse": f'SELECT event_id AS "offset", {_READING} FROM readings',
    "ingest_valid": f"""SELECT event_id AS "offset", deviceId, sensor_timestamp, temperature,
        humidity, pressure, motion, light, acidity,
        CASE WHEN damage = 6 THEN NULL ELSE location END AS location, "timestamp",
        battery_level, signal_strength, firmware_version,
        CAST(year(sensor_timestamp) AS INTEGER) AS "year",
        CAST(month(sensor_timestamp) AS INTEGER) AS "month",
        CAST(day(sensor_timestamp) AS INTEGER) AS "day",
        CAST(hour(sensor_timestamp) AS INTEGER) AS "hour"
        FROM damaged WHERE damage IN (0, 6)""",
    "epoch_to_timestamp": """SELECT event_id, sensor_timestamp AS from_millis,
        sensor_timestamp AS from_seconds,
        make_timestamp(CAST(trunc(("timestamp" - 1705000000000) / 1e3) AS BIGINT) * 1000000)
          AS around_epoch FROM readings""",
    "calendar_parts": 'SELECT event_id, "year", "month", "day", "hour" FROM bronze',
    "dead_letter": "SELECT * FROM rejected",
    "dead_letter_sample": """SELECT "partition", "offset", reason FROM rejected
        ORDER BY topic, "partition", "offset" LIMIT 10""",
    "required_fields": """SELECT event_id AS "offset", missing_fields = '' AS is_complete,
        missing_fields FROM (SELECT event_id, concat_ws(',',
          CASE WHEN damage BETWEEN 1 AND 4 THEN 'deviceId' END,
          CASE WHEN damage IN (1, 2, 6) THEN 'location' END,
          CASE WHEN damage IN (1, 2) THEN 'timestamp' END,
          CASE WHEN damage IN (1, 2) OR temperature IS NULL THEN 'temperature' END,
          CASE WHEN damage IN (1, 2) OR motion IS NULL THEN 'motion' END) AS missing_fields
        FROM damaged) m""",
    "raw_scan": f"SELECT {_FLAT}, {_RAW_PARTS} FROM bronze",
    "bronze": f"""SELECT {_FLAT}, {_RAW_PARTS}, {_AS_OF} AS bronze_ingestion_time, bronze_date,
        "year", "month", "day", data_source, ingestion_job, processing_status, deviceType,
        event_date FROM bronze""",
    "bronze_record_ids": 'SELECT deviceId, "timestamp", sha256(message) AS record_id FROM messages',
    "bronze_device_type": "SELECT event_id, location, deviceType FROM bronze",
    "bronze_historical": f"""SELECT event_id, {_FLAT}, bronze_date, "year", "month", "day",
        'batch-parquet' AS data_source, 'bronze-batch-job-v1' AS ingestion_job FROM bronze""",
    "bronze_partition_counts": "SELECT event_date, count(*) AS n FROM bronze GROUP BY event_date",
    "bronze_slice": f"""SELECT event_id, event_date, deviceId, deviceType, temperature, humidity,
        pressure, light, acidity, motion, location, "timestamp" FROM bronze
        WHERE event_date = {_DAY}""",
    "bronze_quality": f"""SELECT count(*) AS total_records,
        count(DISTINCT deviceId) AS unique_devices, count(DISTINCT deviceType) AS device_types,
        count(DISTINCT location) AS locations, {_AS_OF} AS earliest_ingestion,
        {_AS_OF} AS latest_ingestion FROM bronze""",
    "bronze_dist_type": _distribution("deviceType", "bronze"),
    "bronze_dist_location": _distribution("location", "bronze"),
    "silver_standardized": """SELECT bronze_date, "year", "month", "day", event_date, data_source,
        ingestion_job, record_id, deviceId, deviceType, location, temperature, humidity, pressure,
        motion, light, acidity, sensor_timestamp, battery_level, signal_strength,
        firmware_version FROM bronze""",
    "silver_rule_flags": f"SELECT record_id, {_FLAG_NAMES}, is_valid_record FROM scored",
    "quality_score": "SELECT record_id, data_quality_score FROM scored",
    "quality_flag": """SELECT event_id, CASE
        WHEN temperature IS NULL OR temperature < -50 OR temperature > 100 THEN 'INVALID_TEMP'
        WHEN humidity IS NULL OR humidity < 0 OR humidity > 100 THEN 'INVALID_HUMIDITY'
        WHEN pressure IS NULL OR pressure < 0 THEN 'INVALID_PRESSURE'
        ELSE 'VALID' END AS data_quality_flag FROM readings""",
    "quality_report": f"""SELECT total_records, valid_records,
        total_records - valid_records AS invalid_records,
        {_steady("valid_records / CAST(total_records AS DOUBLE)")} AS quality_score,
        round(valid_records * 1e2 / total_records, 2) AS valid_percentage,
        round((total_records - valid_records) * 1e2 / total_records, 2) AS invalid_percentage,
        CASE WHEN valid_records * 1e2 / total_records >= 95 THEN 'EXCELLENT'
             WHEN valid_records * 1e2 / total_records >= 90 THEN 'GOOD'
             WHEN valid_records * 1e2 / total_records >= 80 THEN 'ACCEPTABLE'
             ELSE 'POOR' END AS grade
        FROM (SELECT count(*) AS total_records,
              count(*) FILTER (is_valid_record) AS valid_records FROM scored) c""",
    "quality_by_device": f"""SELECT event_date, deviceId, deviceType, location,
        count(*) AS total_records, count(*) FILTER (is_valid_record) AS valid_records,
        {_steady("avg(data_quality_score)")} AS avg_quality_score,
        {_steady("min(data_quality_score)")} AS min_quality_score
        FROM scored GROUP BY event_date, deviceId, deviceType, location""",
    "silver": f"""SELECT bronze_date, "year", "month", "day", event_date, data_source,
        ingestion_job, record_id, deviceId, deviceType, location, temperature, humidity, pressure,
        motion, light, acidity, sensor_timestamp, {_FLAG_NAMES}, is_valid_record,
        data_quality_score, temperature_celsius, temperature_fahrenheit, temperature_kelvin,
        {_CATEGORY_NAMES}, motion_status, hour_of_day, day_of_week, is_weekend, season,
        battery_level, signal_strength, firmware_version, low_battery, poor_signal,
        device_health_status, comfort_index, silver_processing_date, data_lineage,
        processing_job, silver_tier_version FROM silver""",
    "silver_units": """SELECT record_id, temperature_celsius, temperature_fahrenheit,
        temperature_kelvin FROM silver""",
    "silver_categories": f"SELECT record_id, {_CATEGORY_NAMES}, motion_status FROM silver",
    "silver_categories_contiguous": """SELECT record_id,
        CASE WHEN temperature < 0 THEN 'freezing' WHEN temperature < 16 THEN 'cold'
             WHEN temperature < 26 THEN 'comfortable' WHEN temperature <= 35 THEN 'warm'
             ELSE 'hot' END AS temperature_category,
        CASE WHEN humidity < 30 THEN 'dry' WHEN humidity < 61 THEN 'comfortable'
             WHEN humidity <= 80 THEN 'humid' ELSE 'very_humid' END AS humidity_category,
        pressure_category,
        CASE WHEN light < 1 THEN 'dark' WHEN light < 51 THEN 'dim' WHEN light < 501 THEN 'indoor'
             WHEN light <= 10000 THEN 'bright' ELSE 'very_bright' END AS light_category,
        acidity_category FROM silver""",
    "silver_comfort": "SELECT record_id, comfort_index FROM silver",
    "silver_calendar": "SELECT record_id, hour_of_day, day_of_week, is_weekend, season FROM silver",
    "silver_health": "SELECT record_id, low_battery, poor_signal, device_health_status FROM silver",
    "silver_partition_counts": """SELECT event_date, deviceType, count(*) AS n FROM silver
        GROUP BY event_date, deviceType""",
    "silver_slice": f"""SELECT record_id, event_date, deviceType, deviceId, comfort_index
        FROM silver WHERE event_date = {_DAY}""",
    "silver_summary": """SELECT count(*) AS total_records,
        count(DISTINCT deviceId) AS unique_devices FROM silver""",
    "silver_dist_health": _distribution("device_health_status", "silver"),
    "silver_dist_temp": _distribution("temperature_category", "silver"),
    "silver_dist_comfort": _distribution("comfort_index", "silver"),
    "gold_hourly": "SELECT * FROM hourly",
    "gold_daily": "SELECT * FROM daily",
    "gold_device": "SELECT * FROM device",
    "gold_hourly_approx": "SELECT * EXCLUDE (unique_devices), true AS devices_within_bound FROM hourly",
    "gold_devices_sketch": """SELECT location, deviceType, count(DISTINCT deviceId) AS devices,
        true AS within_bound FROM silver GROUP BY location, deviceType""",
    "job_gold_daily": "SELECT * FROM daily",
    "job_after_correction": "SELECT * FROM daily",
    "job_with_history": "SELECT * FROM daily",
    "bronze_history_quarantine": """SELECT deviceId, deviceType, location, temperature, humidity,
        pressure, light, acidity, battery_level, signal_strength, firmware_version,
        CAST(NULL AS DATE) AS event_date, 'missing_timestamp' AS reason
        FROM bronze WHERE event_id % 89 = 0""",
    "window_agg_batch": "SELECT * FROM windows",
    "alert_anomalies": f"SELECT {_ALERT_KEY}, anomaly_type, value, threshold, reading FROM anomalies",
    "alert_readings": f"""SELECT {_ALERT_KEY}, CAST(count(*) AS INTEGER) AS n_anomalies
        FROM anomalies GROUP BY {_ALERT_KEY}""",
    "alert_types": f"""SELECT {_ALERT_KEY}, {_TYPES} AS anomaly_types,
        {_AS_OF} AS alert_timestamp FROM anomalies GROUP BY {_ALERT_KEY}""",
    "alert_types_without_battery": f"""SELECT {_ALERT_KEY}, {_TYPES} AS anomaly_types
        FROM anomalies GROUP BY {_ALERT_KEY}""",
    "alert_messages": f"""SELECT event_id, 'admin@company.com' AS recipient,
        {_SUBJECT} AS subject, {_BODY} AS body FROM anomalies GROUP BY {_ALERT_KEY}""",
    "alert_custom_thresholds": """SELECT event_id, anomaly_type, value, threshold, reading
        FROM anomalies""",
    "alert_simple_range": """SELECT event_id, deviceId, temperature, humidity, pressure
        FROM readings WHERE temperature < 10 OR temperature > 35 OR humidity < 20
        OR humidity > 80 OR pressure < 1000 OR pressure > 1040""",
    "alert_batch_stats": """SELECT batch_id, records, coalesce(anomalies, 0) AS anomalies,
        coalesce(alerts, 0) AS alerts
        FROM (SELECT event_id // 1000 AS batch_id, count(*) AS records FROM readings GROUP BY 1) r
        LEFT JOIN (SELECT event_id // 1000 AS batch_id, count(*) AS anomalies,
              count(DISTINCT event_id) AS alerts FROM anomalies GROUP BY 1) a USING (batch_id)""",
    "export_timeseries": """SELECT CAST(event_date AS TIMESTAMP) + to_hours(hour_of_day) AS "time",
        avg_temperature AS temperature, avg_humidity AS humidity, avg_pressure AS pressure,
        avg_quality_score AS data_quality, total_readings AS sensor_readings,
        deviceType AS device_type, location, unique_devices FROM hourly""",
    "export_daily": "SELECT * FROM mart",
    "export_device_status": """SELECT deviceId AS device_id, deviceType AS device_type, location,
        total_readings, active_hours, device_quality_score AS quality_score,
        device_health AS health_status, avg_temperature, avg_humidity, avg_pressure,
        first_reading, last_reading, event_date AS report_date FROM device""",
    "export_summary": f"""SELECT {_AS_OF_DATE} AS export_date, CAST(3 AS BIGINT) AS tables_exported,
        (SELECT count(*) FROM hourly) + (SELECT count(*) FROM daily)
        + (SELECT count(*) FROM device) AS records_exported""",
    "dash_locations_in": f"SELECT location FROM latest WHERE location IN ({_LOCATION}, 'lab-a')",
    "dash_temperature": f"""SELECT avg_temperature AS "Average Temperature",
        min_temperature AS "Min Temperature", max_temperature AS "Max Temperature",
        {_steady("max_temperature - min_temperature")} AS "Temperature Range"
        FROM latest WHERE location = {_LOCATION}""",
    "dash_irrigation": f"""SELECT location,
        CAST(avg(avg_humidity) AS DECIMAL(10, 1)) AS soil_moisture,
        CASE WHEN avg(avg_humidity) BETWEEN 40 AND 70 THEN 100
             WHEN avg(avg_humidity) BETWEEN 30 AND 80 THEN 75
             WHEN avg(avg_humidity) BETWEEN 20 AND 90 THEN 50 ELSE 25 END AS irrigation_efficiency
        FROM mart WHERE location = {_LOCATION}
        AND report_date BETWEEN {_AS_OF_DATE} - 7 AND {_AS_OF_DATE} GROUP BY location""",
    "dash_growing_degree_days": f"""SELECT report_date AS "date", location,
        CAST(avg_temperature AS DECIMAL(10, 1)) AS daily_avg_temp,
        CASE WHEN avg_temperature > 10 THEN CAST(avg_temperature - 10 AS DECIMAL(10, 1))
             ELSE CAST(0 AS DECIMAL(10, 1)) END AS growing_degree_days
        FROM mart WHERE location = {_LOCATION}
        AND report_date BETWEEN {_AS_OF_DATE} - 30 AND {_AS_OF_DATE}""",
    "dash_conditions": f"""SELECT avg_humidity AS "Humidity %", avg_pressure AS "Pressure",
        quality_score AS "Data Quality", comfort_percentage AS "Comfort Level %"
        FROM latest WHERE location = {_LOCATION}""",
    "dash_field_health": f"""SELECT location,
        CAST(avg(avg_temperature) AS DECIMAL(10, 1)) AS field_temp,
        CAST(avg(avg_humidity) AS DECIMAL(10, 1)) AS soil_moisture,
        CAST(avg(avg_pressure) AS DECIMAL(10, 1)) AS atmospheric_pressure,
        CAST(avg(comfort_percentage) AS DECIMAL(10, 1)) AS growing_conditions_score
        FROM mart WHERE location = {_LOCATION}
        AND report_date BETWEEN {_AS_OF_DATE} - 7 AND {_AS_OF_DATE} GROUP BY location""",
    "dash_location_list": "SELECT DISTINCT location FROM mart",
    "dash_status_bands": """SELECT report_date, location, device_type,
        CASE WHEN avg_temperature >= 20 THEN 'red' WHEN avg_temperature >= 15 THEN 'dark-green'
             ELSE 'dark-blue' END AS temperature_status,
        CASE WHEN avg_humidity >= 85 THEN 'red' WHEN avg_humidity >= 70 THEN 'orange'
             ELSE 'green' END AS humidity_status FROM mart""",
    "stream_raw_roundtrip": f"SELECT {_FLAT}, {_RAW_PARTS} FROM bronze",
    # a window closes once the watermark, ten minutes behind the newest reading, passes its end
    "stream_window_agg": """SELECT * FROM windows WHERE window_end <=
        (SELECT max(sensor_timestamp) - INTERVAL 10 MINUTE FROM readings)""",
    "stream_window_latest": "SELECT * FROM windows",
    # the watermark is what the first batch left: five days behind its newest reading
    "stream_late_rows": """SELECT * FROM (
        SELECT deviceId, time_bucket(INTERVAL 5 MINUTE, sensor_timestamp) AS window_start,
          time_bucket(INTERVAL 5 MINUTE, sensor_timestamp) + INTERVAL 5 MINUTE AS window_end,
          count(*) AS accepted, count(*) - count(*) FILTER (late) AS held, count(*) FILTER (late) AS late
        FROM (SELECT *, event_id % 11 = 0 AND time_bucket(INTERVAL 5 MINUTE, sensor_timestamp)
                + INTERVAL 5 MINUTE <= (SELECT max(sensor_timestamp) - INTERVAL 5 DAY FROM readings
                WHERE event_id % 11 != 0) AS late FROM readings) r
        GROUP BY 1, 2, 3) w WHERE late > 0""",
    "stream_window_state": """SELECT deviceId, window_start, window_end FROM windows WHERE window_end >
        (SELECT max(sensor_timestamp) - INTERVAL 10 MINUTE FROM readings)""",
    "stream_flow_metrics": """SELECT count(*) AS received,
        count(*) FILTER (damage IN (0, 6)) AS accepted FROM damaged""",
    "silver_calendar_year": """SELECT record_id, hour_of_day, day_of_week, is_weekend, season
        FROM silver""",
    "gold_device_health": "SELECT deviceId, active_hours, total_readings, device_health FROM device",
    "silver_rule_flags_broken": f"""SELECT record_id, {_FLAG_NAMES}, is_valid_record,
        data_quality_score FROM scored""",
    "quality_flag_broken": """SELECT event_id, CASE
        WHEN temperature IS NULL OR temperature < -50 OR temperature > 100 THEN 'INVALID_TEMP'
        WHEN humidity IS NULL OR humidity < 0 OR humidity > 100 THEN 'INVALID_HUMIDITY'
        WHEN pressure IS NULL OR pressure < 0 THEN 'INVALID_PRESSURE'
        ELSE 'VALID' END AS data_quality_flag FROM readings""",
    "dash_irrigation_status": f"""SELECT *, CASE WHEN irrigation_efficiency >= 85 THEN 'dark-green'
        WHEN irrigation_efficiency >= 30 THEN 'semi-dark-green' ELSE 'red' END AS status FROM (
        SELECT location, CAST(avg(avg_humidity) AS DECIMAL(10, 1)) AS soil_moisture,
        CASE WHEN avg(avg_humidity) BETWEEN 40 AND 70 THEN 100
             WHEN avg(avg_humidity) BETWEEN 30 AND 80 THEN 75
             WHEN avg(avg_humidity) BETWEEN 20 AND 90 THEN 50 ELSE 25 END AS irrigation_efficiency
        FROM mart WHERE location = {_LOCATION}
        AND report_date BETWEEN {_AS_OF_DATE} - 7 AND {_AS_OF_DATE} GROUP BY location) s""",
    "raw_compacted": f"SELECT {_FLAT}, {_RAW_PARTS} FROM bronze",
    "stream_dead_letter": "SELECT * FROM rejected",
    "stream_message_counts": """SELECT count(*) + count(*) FILTER (event_id % 7 = 0) AS received,
        count(*) FILTER (damage IN (0, 6)) AS accepted,
        count(*) FILTER (damage NOT IN (0, 6)) AS rejected,
        count(*) FILTER (event_id % 7 = 0) AS repeated, CAST(0 AS BIGINT) AS too_late FROM damaged""",
    "alert_outbox_due": f"""SELECT sha256(CAST(event_id AS VARCHAR)) AS record_id, deviceId,
        sensor_timestamp, {_SUBJECT} AS subject, 'failed' AS status, CAST(2 AS INTEGER) AS attempts,
        'ConnectionError: no route' AS last_error
        FROM anomalies WHERE location = {_LOCATION} GROUP BY {_ALERT_KEY}""",
    "stream_alerts": f"""SELECT deviceId, location, sensor_timestamp, {_TYPES} AS anomaly_types,
        'admin@company.com' AS recipient, {_SUBJECT} AS subject, {_BODY} AS body,
        'pending' AS status, CAST(0 AS INTEGER) AS attempts
        FROM anomalies GROUP BY {_ALERT_KEY}""",
}

def _replaced(**columns: str) -> dict[str, str]:
    """The feed with some columns given anew."""
    given = ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())
    return {"readings": f"SELECT * REPLACE ({given}) FROM ({_CTES['readings']}) r"}


_HOUR = "event_id % (6 + 6 * (user_id % 4))"
_HEALTH_FEED = {
    "readings": _replaced(
        sensor_timestamp=f"TIMESTAMP '2024-01-15 00:00:00' + to_hours(CAST({_HOUR} AS INTEGER))",
        timestamp=f"1705276800000 + 3600000 * ({_HOUR})",
        battery_level="CAST(CASE user_id % 5 WHEN 4 THEN NULL ELSE 25 + 20 * (user_id % 5) END AS INTEGER)",
    )["readings"].replace("SELECT event_id, loc", "SELECT event_id, user_id, loc", 1)
}
_YEAR_FEED = _replaced(
    sensor_timestamp="sensor_timestamp + to_days(CAST(event_id % 366 AS INTEGER))",
    timestamp='"timestamp" + (event_id % 366) * 86400000',
)
_BROKEN_FEED = _replaced(
    deviceId="CASE WHEN event_id % 11 = 0 THEN '' ELSE deviceId END",
    location="CASE WHEN event_id % 13 = 0 THEN '' ELSE location END",
    timestamp='CASE WHEN event_id % 17 <> 0 THEN "timestamp" END',
    sensor_timestamp="CASE WHEN event_id % 17 <> 0 THEN sensor_timestamp END",
    humidity="CASE WHEN event_id % 19 = 0 THEN 1005 / 1e1 ELSE humidity END",
    pressure="CASE WHEN event_id % 46 = 0 THEN -1e0 WHEN event_id % 23 = 0 THEN 499e0 ELSE pressure END",
    light="CASE WHEN event_id % 29 = 0 THEN -5 / 1e1 ELSE light END",
)

_RULES_USED = {
    "gold_device_health": {**_STANDARD, **_HEALTH_FEED},
    "silver_calendar_year": {**_STANDARD, **_YEAR_FEED},
    "silver_rule_flags_broken": {**_STANDARD, **_BROKEN_FEED},
    "quality_flag_broken": {**_STANDARD, **_BROKEN_FEED},
    "alert_types_without_battery": _NO_BATTERY,
    "alert_custom_thresholds": _NARROW,
}


def _needed(text: str, ctes: dict[str, str]) -> list[str]:
    """Names of the expressions a text refers to, inputs first."""
    names: list[str] = []
    words = set(text.replace("(", " ").replace(")", " ").split())
    for name, body in ctes.items():
        if name in words:
            names += [n for n in _needed(body, {k: v for k, v in ctes.items() if k != name})]
            names.append(name)
    return list(dict.fromkeys(names))


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, body in _BODIES.items():
        ctes = {**_CTES, **_RULES_USED.get(name, _STANDARD)}
        used = _needed(body, ctes)
        parts = ", ".join(f"{cte} AS ({ctes[cte].strip()})" for cte in used)
        found[name] = f"WITH {parts} {body}" if parts else body
    return found
