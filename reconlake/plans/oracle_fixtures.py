"""DuckDB SQL that rebuilds the fixture rows of ``sources/fixtures.py`` and the
pipeline stages on top of them, as CTE text the oracles prepend to their SELECT.

Written independently of the Spark code (DuckDB dialect: ``strftime``,
``regexp_replace(..., 'g')``, 0-based ``dayofweek``)."""

from __future__ import annotations

_RATE = """CAST(CASE service_type
      WHEN 'voice' THEN CASE WHEN is_roaming THEN 0.45 ELSE 0.05 END
      WHEN 'data'  THEN CASE WHEN is_roaming THEN 1.50 ELSE 0.10 END
      WHEN 'sms'   THEN CASE WHEN is_roaming THEN 0.15 ELSE 0.02 END END AS DECIMAL(4,2))"""


def _expected(vol: str) -> str:
    return (f"CASE WHEN {vol} IS NULL OR {vol} = 0 THEN CAST(NULL AS DOUBLE) "
            f"ELSE CAST(round(CAST({vol} AS DECIMAL(18,4)) * {_RATE}, 4) AS DOUBLE) END")


ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

RAW = f"""
ev AS (
  SELECT event_id AS id, (event_id * 37) % 100 AS h, CAST(ts AS TIMESTAMP) AS ts, value,
    CASE WHEN event_id % 241 = 0 THEN CAST(NULL AS VARCHAR)
         WHEN event_id % 233 = 0 THEN '12345'
         WHEN event_id % 5 = 0 THEN '+358 ' || lpad(CAST(user_id AS VARCHAR), 4, '0') || '-0000'
         ELSE '+358' || lpad(CAST(user_id AS VARCHAR), 4, '0') || '0000' END AS msisdn,
    CASE WHEN event_type IN ('view', 'click') THEN 'data' WHEN event_type = 'signup' THEN 'sms'
         ELSE 'voice' END AS service_type,
    event_id % 5 = 1 AS is_roaming,
    'CALL-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS call_id
  FROM events
),
cdr_one AS (
  SELECT *, {_expected('volume')} AS expected_charge,
    CASE WHEN id % 7 = 0 THEN CAST(NULL AS DATE)
         ELSE CAST(CAST(ts AS DATE) + CASE WHEN hour(ts) = 23 THEN 1 ELSE 0 END AS DATE) END AS pdate
  FROM (SELECT *, CASE WHEN h >= 96 OR id % 257 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS volume FROM ev)
),
cdr_rows AS (
  SELECT 'CDR' AS record_type, 'Network Elements' AS source_system, call_id, msisdn,
    '358' || lpad(CAST((id * 7919) % 100000000000 AS VARCHAR), 11, '0') AS imsi,
    strftime(ts, {ISO}) AS "timestamp", service_type, volume,
    CASE WHEN volume IS NULL THEN NULL WHEN service_type = 'voice' THEN 'minutes'
         WHEN service_type = 'data' THEN 'MB' ELSE 'count' END AS unit,
    CASE WHEN service_type = 'voice' AND volume IS NOT NULL THEN CAST(round(volume * 60) AS INTEGER) END
      AS duration_seconds,
    is_roaming, CASE WHEN is_roaming THEN 'US' END AS roaming_country,
    CASE id % 5 WHEN 0 THEN 'MSC-01' WHEN 1 THEN 'MSC-02' WHEN 2 THEN 'SGSN-01' WHEN 3 THEN 'SGSN-02'
         ELSE 'GGSN-01' END AS network_element,
    'CELL-' || CAST(1000 + (id * 13) % 9000 AS VARCHAR) AS cell_id,
    CASE WHEN volume IS NULL THEN 'PARTIAL' ELSE 'COMPLETED' END AS status,
    expected_charge,
    CASE WHEN h IN (90, 91) OR h >= 96 THEN 'BAD' ELSE 'GOOD' END AS data_quality,
    CAST(100000 + (id * 7) % 900000 AS INTEGER) AS sequence_number,
    volume IS NULL AS incomplete,
    strftime(ts + INTERVAL 2 SECOND, {ISO}) AS EventProcessedUtcTime,
    CAST(id % 4 AS INTEGER) AS PartitionId,
    strftime(ts + INTERVAL 1 SECOND, {ISO}) AS EventEnqueuedUtcTime,
    CASE WHEN pdate IS NULL THEN '/bronze/cdr-events/part.parquet'
         ELSE '/bronze/cdr-events/' || strftime(pdate, '%Y-%m-%d') || '/part.parquet' END AS source_path,
    id
  FROM cdr_one
),
cdr_raw AS (
  SELECT * EXCLUDE (id) FROM cdr_rows
  UNION ALL SELECT * EXCLUDE (id) FROM cdr_rows WHERE id % 229 = 0
),
edr_one AS (
  SELECT *, {_expected('volume')} AS expected_charge,
    ts + to_seconds(CASE WHEN id % 223 = 0 THEN 1200 ELSE 30 + (id * 7) % 271 END) AS ets
  FROM (SELECT *, CASE WHEN id % 257 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS volume
        FROM ev WHERE h < 96)
),
edr_rows AS (
  SELECT 'EDR' AS record_type, 'Online Charging System' AS source_system,
    CASE WHEN id % 239 = 0 THEN CAST(NULL AS VARCHAR)
         ELSE 'SESSION-' || lpad(CAST(id AS VARCHAR), 12, '0') END AS session_id,
    msisdn,
    CASE WHEN id % 211 = 0 THEN 'CALL-ORPHAN' || CAST(id AS VARCHAR) ELSE call_id END AS cdr_call_id,
    strftime(ets, {ISO}) AS "timestamp",
    CASE WHEN id % 227 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN h IN (85, 86, 87) THEN CAST(round(CAST(expected_charge AS DECIMAL(18,4))
              * CAST(110 + id % 41 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)), 4) AS DOUBLE)
         WHEN h IN (88, 89, 94, 95) THEN 0.0
         ELSE coalesce(expected_charge, 0.0) END AS charge_amount,
    'EUR' AS currency,
    5.0 + CAST((id * 17) % 19500 AS DOUBLE) / 100 AS account_balance_before,
    CAST((id * 29) % 19500 AS DOUBLE) / 100 AS account_balance_after,
    CASE WHEN id % 2 = 0 THEN 'PREPAID_DEDUCT' ELSE 'POSTPAID_INVOICE' END AS payment_method,
    CASE WHEN id % 3 = 0 THEN 'RE-BACKUP' ELSE 'RE-PRIMARY' END AS rating_engine,
    'RG-' || CAST(100 + (id * 11) % 900 AS VARCHAR) AS rating_group,
    CASE WHEN h IN (94, 95) THEN 'FAILED' ELSE 'SUCCESS' END AS billing_status,
    'TX-' || lpad(CAST(id AS VARCHAR), 12, '0') AS transaction_id,
    CASE WHEN h IN (85, 86, 87, 88, 89, 92, 93, 94, 95) THEN 'BAD' ELSE 'GOOD' END AS data_quality,
    CAST(100 + (id * 31) % 4900 AS DOUBLE) AS processing_latency_ms,
    strftime(ets + INTERVAL 2 SECOND, {ISO}) AS EventProcessedUtcTime,
    CAST(id % 4 AS INTEGER) AS PartitionId,
    strftime(ets + INTERVAL 1 SECOND, {ISO}) AS EventEnqueuedUtcTime,
    '/bronze/edr-events/part.parquet' AS source_path,
    id
  FROM edr_one
),
edr_raw AS (
  SELECT * EXCLUDE (id) FROM edr_rows
  UNION ALL SELECT * EXCLUDE (id) FROM edr_rows WHERE id % 251 = 0
)"""

# Bronze: drop capture columns, path date, lineage (ingestion time left out).
BRONZE = r"""
cdr_bronze AS (
  SELECT * EXCLUDE (EventProcessedUtcTime, PartitionId, EventEnqueuedUtcTime, duration_seconds,
                    roaming_country, record_type, source_system, source_path),
    try_strptime(nullif(regexp_extract(source_path, '/(\d{4}-\d{2}-\d{2})/', 1), ''), '%Y-%m-%d')::DATE
      AS partition_date,
    source_path AS bronze_source_file,
    CAST(NULL AS VARCHAR) AS _rescued_data
  FROM cdr_raw
),
edr_bronze AS (
  SELECT * EXCLUDE (EventProcessedUtcTime, PartitionId, EventEnqueuedUtcTime, record_type,
                    source_system, source_path),
    source_path AS bronze_source_file
  FROM edr_raw
)"""

# Silver: parse, derive, flag (processing time left out).
SILVER = r"""
cdr_parsed AS (
  SELECT *, try_cast("timestamp" AS TIMESTAMP) AS timestamp_parsed FROM cdr_bronze
),
cdr_enriched AS (
  SELECT *,
    coalesce(partition_date, CAST(timestamp_parsed AS DATE)) AS business_date,
    CAST(volume AS DECIMAL(15,2)) AS volume_decimal,
    CAST(expected_charge AS DECIMAL(10,4)) AS expected_charge_decimal,
    regexp_replace(msisdn, '[^0-9+]', '', 'g') AS msisdn_normalized,
    CAST(hour(timestamp_parsed) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(timestamp_parsed) + 1 AS INTEGER) AS day_of_week,
    (data_quality <> 'GOOD') OR (volume IS NULL) OR (expected_charge IS NULL) AS has_quality_issue
  FROM cdr_parsed
),
cdr_dedup AS (
  SELECT * FROM cdr_enriched
  QUALIFY row_number() OVER (PARTITION BY call_id, msisdn, service_type
                             ORDER BY timestamp_parsed NULLS LAST, bronze_source_file) = 1
),
cdr_clean AS (
  SELECT * FROM cdr_dedup
  WHERE coalesce(call_id IS NOT NULL AND length(call_id) > 10, false)
    AND coalesce(msisdn IS NOT NULL AND length(msisdn) >= 10, false)
    AND coalesce("timestamp" IS NOT NULL, false)
),
edr_enriched AS (
  SELECT *,
    CAST(timestamp_parsed AS DATE) AS business_date,
    CAST(charge_amount AS DECIMAL(10,4)) AS charge_amount_decimal,
    regexp_replace(msisdn, '[^0-9+]', '', 'g') AS msisdn_normalized,
    (data_quality <> 'GOOD') OR (billing_status <> 'SUCCESS') OR (charge_amount < 0) AS has_quality_issue
  FROM (SELECT *, try_cast("timestamp" AS TIMESTAMP) AS timestamp_parsed FROM edr_bronze)
),
edr_dedup AS (
  SELECT * FROM edr_enriched
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY timestamp_parsed NULLS LAST, transaction_id) = 1
),
edr_clean AS (
  SELECT * FROM edr_dedup
  WHERE coalesce(session_id IS NOT NULL, false) AND coalesce(cdr_call_id IS NOT NULL, false)
    AND coalesce(msisdn IS NOT NULL, false)
)"""

# Gold: full outer interval join and the 23-column projection.
MATCH = """
rec AS (
  SELECT coalesce(c.business_date, e.business_date) AS business_date,
    coalesce(c.msisdn_normalized, e.msisdn_normalized) AS msisdn_normalized,
    c.has_quality_issue AS cdr_has_quality_issue, e.has_quality_issue AS edr_has_quality_issue,
    c.timestamp_parsed AS usage_timestamp, e.timestamp_parsed AS billing_timestamp,
    c.msisdn AS cdr_msisdn, e.msisdn AS edr_msisdn,
    c.data_quality AS cdr_data_quality, e.data_quality AS edr_data_quality,
    c.call_id, c.service_type, c.status, c._rescued_data AS cdr_rescued_data,
    c.partition_date AS cdr_partition_date,
    CAST(c.volume_decimal AS DOUBLE) AS usage_volume,
    CAST(c.expected_charge_decimal AS DOUBLE) AS expected_charge,
    e.session_id, e.cdr_call_id AS edr_reference_to_cdr, e.payment_method, e.billing_status,
    e.transaction_id, CAST(e.charge_amount_decimal AS DOUBLE) AS actual_charge
  FROM cdr_clean c FULL OUTER JOIN edr_clean e
    ON e.cdr_call_id = c.call_id AND e.msisdn_normalized = c.msisdn_normalized
   AND e.timestamp_parsed BETWEEN c.timestamp_parsed AND c.timestamp_parsed + INTERVAL 15 MINUTE
)"""

DERIVE_COLS = """
    CASE WHEN cdr_has_quality_issue THEN 'cdr' WHEN edr_has_quality_issue THEN 'edr' ELSE NULL END AS reconciled,
    CASE WHEN cdr_has_quality_issue THEN NULL WHEN edr_has_quality_issue THEN NULL
         ELSE abs(usage_volume - actual_charge) END AS volume_variance,
    actual_charge - expected_charge AS variance,
    CASE WHEN expected_charge > 0 THEN ((actual_charge - expected_charge) / expected_charge) * 100
         ELSE 0 END AS variance_percent"""

CLASSIFY = """
classified AS (
  SELECT *,
    CASE WHEN usage_timestamp IS NULL THEN 'PHANTOM_EDR'
         WHEN billing_timestamp IS NULL THEN 'MISSING_EDR'
         WHEN abs(variance_percent) <= 5.0 THEN 'MATCHED'
         WHEN variance < 0 THEN 'UNDER_BILLED'
         WHEN variance > 0 THEN 'OVER_BILLED'
         ELSE 'UNKNOWN' END AS mismatch_type
  FROM (SELECT *, {derive} FROM {src})
),
scored AS (
  SELECT *,
    CASE WHEN mismatch_type = 'MATCHED' THEN 'NONE'
         WHEN mismatch_type IN ('PHANTOM_EDR', 'MISSING_EDR') THEN 'CRITICAL'
         WHEN abs(variance) > 5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
    CASE WHEN mismatch_type = 'MISSING_EDR' THEN expected_charge
         WHEN mismatch_type = 'UNDER_BILLED' THEN abs(variance)
         WHEN mismatch_type = 'OVER_BILLED' THEN abs(variance)
         WHEN mismatch_type = 'PHANTOM_EDR' THEN actual_charge
         ELSE 0 END AS revenue_impact
  FROM classified
)"""


def calendar_sql(start: str, end: str, name: str = "cal") -> str:
    """Calendar CTE over an inclusive date range given as SQL date expressions."""
    return f"""
{name}_spine AS (
  SELECT CAST(d AS DATE) AS date FROM generate_series(CAST({start} AS TIMESTAMP), CAST({end} AS TIMESTAMP),
                                                      INTERVAL 1 DAY) AS t(d)
),
{name} AS (
  SELECT date,
    CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(year(date) AS INTEGER) AS year,
    CAST(month(date) AS INTEGER) AS month,
    CAST(day(date) AS INTEGER) AS day_of_month,
    strftime(date, '%A') AS day_of_week,
    strftime(date, '%a') AS day_of_week_abbr,
    strftime(date, '%B') AS month_name,
    strftime(date, '%B') || ' ' || CAST(year(date) AS VARCHAR) AS month_year,
    CAST(quarter(date) AS INTEGER) AS quarter,
    'Q' || CAST(quarter(date) AS VARCHAR) || ' ' || CAST(year(date) AS VARCHAR) AS quarter_year,
    CAST(weekofyear(date) AS INTEGER) AS week_of_year,
    CAST(dayofyear(date) AS INTEGER) AS day_of_year,
    NOT (dayofweek(date) IN (0, 6)) AS is_weekday,
    dayofweek(date) IN (0, 6) AS is_weekend,
    CASE WHEN month(date) = 1 AND day(date) = 26 THEN 'Republic Day'
         WHEN month(date) = 8 AND day(date) = 15 THEN 'Independence Day'
         WHEN month(date) = 10 AND day(date) = 2 THEN 'Gandhi Jayanti' END IS NOT NULL AS is_holiday,
    CASE WHEN month(date) = 1 AND day(date) = 26 THEN 'Republic Day'
         WHEN month(date) = 8 AND day(date) = 15 THEN 'Independence Day'
         WHEN month(date) = 10 AND day(date) = 2 THEN 'Gandhi Jayanti' END AS holiday_name
  FROM {name}_spine
)"""


CAL_COLS = """cal.date_key AS cal_date_key, cal.year AS cal_year, cal.month AS cal_month,
    cal.day_of_month AS cal_day_of_month, cal.day_of_week AS cal_day_of_week, cal.month_name AS cal_month_name,
    cal.quarter AS cal_quarter, cal.quarter_year AS cal_quarter_year, cal.week_of_year AS cal_week_of_year,
    cal.day_of_year AS cal_day_of_year, cal.is_weekday AS cal_is_weekday, cal.is_weekend AS cal_is_weekend"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)
