"""DuckDB oracle SQL per query key (same output column names and types as
``plans/queries.py``). Built from the CTE blocks in ``oracle_fixtures``."""

from __future__ import annotations

from reconlake.plans.oracle_fixtures import (BRONZE, CAL_COLS, CLASSIFY, DERIVE_COLS, MATCH, RAW, SILVER,
                                             calendar_sql, with_ctes)

def _q(select: str, *ctes: str) -> str:
    return with_ctes(*ctes) + "\n" + select


_DEC = """CAST(volume_decimal AS DOUBLE) AS volume_decimal,
  CAST(expected_charge_decimal AS DOUBLE) AS expected_charge_decimal"""

CDR_BRONZE_COLS = """call_id, msisdn, imsi, "timestamp", service_type, volume, unit, is_roaming, network_element,
  cell_id, status, expected_charge, data_quality, sequence_number, incomplete, partition_date,
  bronze_source_file, _rescued_data"""
CDR_SILVER_COLS = CDR_BRONZE_COLS + """, timestamp_parsed, business_date, """ + _DEC + """,
  msisdn_normalized, hour_of_day, day_of_week, has_quality_issue"""
EDR_BRONZE_COLS = """session_id, msisdn, cdr_call_id, "timestamp", charge_amount, currency, account_balance_before,
  account_balance_after, payment_method, rating_engine, rating_group, billing_status, transaction_id,
  data_quality, processing_latency_ms, bronze_source_file"""
EDR_SILVER_COLS = EDR_BRONZE_COLS + """, timestamp_parsed, business_date,
  CAST(charge_amount_decimal AS DOUBLE) AS charge_amount_decimal, msisdn_normalized, has_quality_issue"""

# reconcile_calendar alone takes a calendar shorter than the data
SHORT_CAL = calendar_sql("DATE '2024-01-01'", "DATE '2024-01-25'")

STRINGLY = """
stringly AS (
  SELECT * REPLACE (CASE WHEN sequence_number % 97 = 0 THEN NULL ELSE volume END AS volume) ,
    sequence_number % 97 = 0 AS junk
  FROM cdr_raw
)"""

# two deliveries for the upsert keys (see queries._versions)
CDR_V = """
cdr_v AS (
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS seq FROM cdr_clean
  UNION ALL
  SELECT * REPLACE (expected_charge + 1.0 AS expected_charge,
                    CAST(expected_charge_decimal + 1 AS DECIMAL(10,4)) AS expected_charge_decimal,
                    'CORRECTED' AS status),
         TIMESTAMP '2024-02-02 00:00:00' AS seq
  FROM cdr_clean WHERE sequence_number % 10 = 0
),
cdr_latest AS (
  SELECT * FROM cdr_v QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY seq DESC) = 1
)"""
EDR_V = """
edr_v AS (
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS seq FROM edr_clean
  UNION ALL
  SELECT * REPLACE (charge_amount + 0.5 AS charge_amount,
                    CAST(charge_amount_decimal + 0.5 AS DECIMAL(10,4)) AS charge_amount_decimal,
                    'ADJUSTED' AS billing_status),
         TIMESTAMP '2024-02-02 00:00:00' AS seq
  FROM edr_clean WHERE CAST(substring(session_id, 9, 12) AS BIGINT) % 10 = 0
),
edr_latest AS (
  SELECT * FROM edr_v QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY seq DESC) = 1
)"""

EVENT_YEARS = """(SELECT date_trunc('year', min(CAST(ts AS DATE))) FROM events)""", \
    """(SELECT CAST(date_trunc('year', max(CAST(ts AS DATE))) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)
        FROM events)"""
DATA_CAL = calendar_sql(EVENT_YEARS[0], EVENT_YEARS[1], name="dcal")
GOLD_CAL = calendar_sql(*EVENT_YEARS)

DETAIL_SELECT = f"""SELECT rec.*, {CAL_COLS} FROM rec JOIN cal ON rec.business_date = cal.date"""

SUMMARY_SELECT = """SELECT business_date, mismatch_type, severity, record_count, total_revenue_impact,
  total_revenue_impact / priced AS avg_revenue_impact, unique_customers_affected
FROM (SELECT business_date, mismatch_type, severity,
        count(*) AS record_count,
        round(sum(revenue_impact), 4) AS total_revenue_impact,
        count(revenue_impact) AS priced,
        count(DISTINCT msisdn_normalized) AS unique_customers_affected
      FROM scored GROUP BY business_date, mismatch_type, severity)"""

_ALL = (RAW, BRONZE, SILVER)
_GOLD = (RAW, BRONZE, SILVER, MATCH)

ORACLES: dict[str, str] = {
    "bronze_cdr": _q(f"SELECT {CDR_BRONZE_COLS} FROM cdr_bronze", RAW, BRONZE),
    "bronze_edr": _q(f"SELECT {EDR_BRONZE_COLS} FROM edr_bronze", RAW, BRONZE),
    "bronze_partition_date": _q(r"""SELECT call_id, source_path,
  try_strptime(nullif(regexp_extract(source_path, '/(\d{4}-\d{2}-\d{2})/', 1), ''), '%Y-%m-%d')::DATE
    AS partition_date FROM cdr_raw""", RAW),
    "bronze_schema_hints": _q("""SELECT call_id, msisdn, "timestamp", service_type, volume, expected_charge,
  data_quality, network_element FROM stringly""", RAW, STRINGLY),
    "bronze_rescued_data": _q("SELECT call_id, volume, junk AS has_rescued FROM stringly", RAW, STRINGLY),
    "bronze_schema_evolution": _q("""SELECT call_id, network_element,
  CASE WHEN PartitionId < 2 THEN NULL ELSE cell_id END AS cell_id FROM cdr_raw""", RAW),
    "event_envelope_roundtrip": _q("SELECT msisdn AS key, call_id, volume FROM cdr_raw", RAW),
    "usage_units": _q("""SELECT call_id, service_type, duration_seconds,
  CASE WHEN service_type = 'voice' THEN round(duration_seconds / 60.0, 2) ELSE volume END AS volume,
  CASE WHEN (CASE WHEN service_type = 'voice' THEN duration_seconds ELSE volume END) IS NULL THEN NULL
       WHEN service_type = 'voice' THEN 'minutes' WHEN service_type = 'data' THEN 'MB' ELSE 'count' END AS unit
FROM cdr_raw""", RAW),
    "usage_completeness": _q("""SELECT call_id, volume,
  CASE WHEN volume IS NULL THEN 'PARTIAL' ELSE 'COMPLETED' END AS status, volume IS NULL AS incomplete
FROM cdr_raw""", RAW),
    "rated_usage": _q("""SELECT call_id, service_type, is_roaming, volume,
  CAST(CASE service_type WHEN 'voice' THEN CASE WHEN is_roaming THEN 0.45 ELSE 0.05 END
       WHEN 'data' THEN CASE WHEN is_roaming THEN 1.50 ELSE 0.10 END
       WHEN 'sms' THEN CASE WHEN is_roaming THEN 0.15 ELSE 0.02 END END AS DOUBLE) AS rate,
  expected_charge FROM cdr_raw""", RAW),
    "silver_cdr": _q(f"SELECT {CDR_SILVER_COLS} FROM cdr_clean", *_ALL),
    "silver_edr": _q(f"SELECT {EDR_SILVER_COLS} FROM edr_clean", *_ALL),
    "silver_cdr_business_date": _q("SELECT call_id, partition_date, timestamp_parsed, business_date "
                                   "FROM cdr_enriched", *_ALL),
    "silver_decimal_casts": _q("""SELECT call_id, volume, CAST(volume_decimal AS DOUBLE) AS volume_decimal,
  expected_charge, CAST(expected_charge_decimal AS DOUBLE) AS expected_charge_decimal FROM cdr_enriched""", *_ALL),
    "silver_msisdn_normalized": _q("SELECT call_id, msisdn, msisdn_normalized FROM cdr_enriched", *_ALL),
    "silver_time_attributes": _q("SELECT call_id, timestamp_parsed, hour_of_day, day_of_week FROM cdr_enriched",
                                 *_ALL),
    "silver_cdr_quality_flag": _q("SELECT call_id, data_quality, volume, expected_charge, has_quality_issue "
                                  "FROM cdr_enriched", *_ALL),
    "silver_edr_quality_flag": _q("SELECT session_id, data_quality, billing_status, charge_amount, "
                                  "has_quality_issue FROM edr_enriched", *_ALL),
    "expect_drop_cdr": _q("SELECT call_id, msisdn, service_type FROM cdr_clean", *_ALL),
    "expect_drop_edr": _q("SELECT session_id, cdr_call_id, msisdn FROM edr_clean", *_ALL),
    "expect_fail_guard": _q("SELECT call_id, msisdn, service_type FROM cdr_dedup "
                            "WHERE NOT coalesce(timestamp_parsed > current_timestamp, false)", *_ALL),
    "expectation_metrics": _q("""
SELECT rule, action, CAST(passed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed FROM (
  SELECT 'valid_call_id' AS rule, 'drop' AS action,
         count_if(coalesce(call_id IS NOT NULL AND length(call_id) > 10, false)) AS passed,
         count_if(NOT coalesce(call_id IS NOT NULL AND length(call_id) > 10, false)) AS failed FROM cdr_dedup
  UNION ALL SELECT 'valid_msisdn', 'drop',
         count_if(coalesce(msisdn IS NOT NULL AND length(msisdn) >= 10, false)),
         count_if(NOT coalesce(msisdn IS NOT NULL AND length(msisdn) >= 10, false)) FROM cdr_dedup
  UNION ALL SELECT 'valid_timestamp', 'drop', count_if("timestamp" IS NOT NULL),
         count_if("timestamp" IS NULL) FROM cdr_dedup
  UNION ALL SELECT 'no_future_dates', 'fail', count_if(coalesce(timestamp_parsed <= current_timestamp, false)),
         count_if(NOT coalesce(timestamp_parsed <= current_timestamp, false)) FROM cdr_dedup
  UNION ALL SELECT 'good_data_quality', 'warn', count_if(coalesce(data_quality = 'GOOD', false)),
         count_if(NOT coalesce(data_quality = 'GOOD', false)) FROM cdr_dedup
  UNION ALL SELECT 'valid_session_id', 'drop', count_if(session_id IS NOT NULL),
         count_if(session_id IS NULL) FROM edr_dedup
  UNION ALL SELECT 'valid_cdr_call_id', 'drop', count_if(cdr_call_id IS NOT NULL),
         count_if(cdr_call_id IS NULL) FROM edr_dedup
  UNION ALL SELECT 'valid_edr_msisdn', 'drop', count_if(msisdn IS NOT NULL), count_if(msisdn IS NULL) FROM edr_dedup
  UNION ALL SELECT 'successful_billing', 'warn', count_if(coalesce(billing_status = 'SUCCESS', false)),
         count_if(NOT coalesce(billing_status = 'SUCCESS', false)) FROM edr_dedup
)""", *_ALL),
    "dedup_cdr": _q("SELECT call_id, msisdn, service_type, timestamp_parsed FROM cdr_clean", *_ALL),
    "dedup_cdr_changed_copies": _q("""
SELECT call_id, msisdn, service_type, timestamp_parsed, cell_id FROM (
  SELECT *, 0 AS n FROM cdr_enriched
  UNION ALL SELECT * REPLACE (timestamp_parsed + INTERVAL 90 SECOND AS timestamp_parsed, cell_id || '-moved' AS cell_id), 1
  FROM cdr_enriched WHERE sequence_number % 7 = 0
  UNION ALL SELECT * REPLACE (cell_id || '-moved' AS cell_id), 2 FROM cdr_enriched WHERE sequence_number % 7 = 0
) QUALIFY row_number() OVER (PARTITION BY call_id, msisdn, service_type ORDER BY timestamp_parsed NULLS LAST, n) = 1
""", *_ALL),
    "dedup_edr": _q("SELECT session_id, timestamp_parsed FROM edr_dedup", *_ALL),
    "scd1_cdr": _q("""SELECT call_id, expected_charge, CAST(expected_charge_decimal AS DOUBLE) AS expected_charge_decimal,
  status, timestamp_parsed FROM cdr_latest""", *_ALL, CDR_V),
    "scd1_edr": _q("""SELECT session_id, charge_amount, CAST(charge_amount_decimal AS DOUBLE) AS charge_amount_decimal,
  billing_status FROM edr_latest""", *_ALL, EDR_V),
    "scd1_except_columns": _q("""SELECT call_id, msisdn, imsi, "timestamp", service_type, volume, unit, is_roaming,
  network_element, cell_id, status, expected_charge, data_quality, sequence_number, incomplete, partition_date,
  timestamp_parsed, business_date, """ + _DEC + """, msisdn_normalized, hour_of_day, day_of_week,
  has_quality_issue FROM cdr_latest""", *_ALL, CDR_V),
    "scd1_change_rows": _q("""SELECT call_id, 'update_preimage' AS change_type, expected_charge, status
FROM cdr_clean WHERE sequence_number % 10 = 0
UNION ALL
SELECT call_id, 'update_postimage', expected_charge + 1.0, 'CORRECTED' FROM cdr_clean WHERE sequence_number % 10 = 0
""", *_ALL),
    "calendar_spine": _q("SELECT date FROM dcal_spine", DATA_CAL),
    "calendar_dim": _q("SELECT * FROM dcal", DATA_CAL),
    "calendar_holidays": _q("SELECT date, holiday_name, is_holiday, day_of_week FROM dcal WHERE is_holiday",
                            DATA_CAL),
    "reconcile_full_outer": _q("SELECT * FROM rec", *_GOLD),
    "reconcile_calendar": _q(f"SELECT rec.business_date, rec.call_id, rec.session_id, {CAL_COLS} "
                             "FROM rec JOIN cal ON rec.business_date = cal.date", *_GOLD, SHORT_CAL),
    "reconcile_quality_side": _q("SELECT call_id, session_id, cdr_has_quality_issue, edr_has_quality_issue, "
                                 "reconciled FROM scored", *_GOLD, CLASSIFY.format(derive=DERIVE_COLS, src="rec")),
    "reconcile_variance": _q("SELECT call_id, session_id, volume_variance, variance, variance_percent FROM scored",
                             *_GOLD, CLASSIFY.format(derive=DERIVE_COLS, src="rec")),
    "reconcile_mismatch_type": _q("SELECT call_id, session_id, mismatch_type FROM scored",
                                  *_GOLD, CLASSIFY.format(derive=DERIVE_COLS, src="rec")),
    "reconcile_severity": _q("SELECT call_id, session_id, mismatch_type, severity FROM scored",
                             *_GOLD, CLASSIFY.format(derive=DERIVE_COLS, src="rec")),
    "reconcile_revenue_impact": _q("SELECT call_id, session_id, mismatch_type, revenue_impact FROM scored",
                                   *_GOLD, CLASSIFY.format(derive=DERIVE_COLS, src="rec")),
    "reconciliation_detail": _q("SELECT * FROM scored", *_GOLD, GOLD_CAL,
                                f"detailed AS ({DETAIL_SELECT})",
                                CLASSIFY.format(derive=DERIVE_COLS, src="detailed")),
    "reconciliation_summary": _q(SUMMARY_SELECT, *_GOLD, GOLD_CAL, f"detailed AS ({DETAIL_SELECT})",
                                 CLASSIFY.format(derive=DERIVE_COLS, src="detailed")),
}
ORACLES["reconciliation_summary_sql"] = ORACLES["reconciliation_summary"]
# incremental refresh must equal the full recompute of the new version
ORACLES["summary_incremental"] = ORACLES["reconciliation_summary"]

# --- streaming and layout keys (batch read of what the stream / writer produced) ---


def _without(cols: str, name: str) -> str:
    """Column list text without one plain column."""
    return ", ".join(c.strip() for c in cols.replace("\n", " ").split(",") if c.strip() != name)


_DETAIL = (*_GOLD, GOLD_CAL, f"detailed AS ({DETAIL_SELECT})", CLASSIFY.format(derive=DERIVE_COLS, src="detailed"))

ORACLES.update({
    "bronze_cdr_stream": _q(f"SELECT {_without(CDR_BRONZE_COLS, 'bronze_source_file')} FROM cdr_bronze", RAW, BRONZE),
    "bronze_edr_stream": _q(f"SELECT {_without(EDR_BRONZE_COLS, 'bronze_source_file')} FROM edr_bronze", RAW, BRONZE),
    "bronze_mixed_files": _q("""
SELECT call_id, msisdn,
  CASE WHEN sequence_number % 3 = 1 AND sequence_number % 97 = 0 THEN NULL ELSE volume END AS volume,
  CASE WHEN sequence_number % 3 = 1 AND sequence_number % 89 = 0 THEN NULL ELSE sequence_number END AS sequence_number,
  CASE WHEN sequence_number % 3 = 1 AND (sequence_number % 97 = 0 OR sequence_number % 89 = 0) THEN
         '{' || concat_ws(',', CASE WHEN sequence_number % 97 = 0 THEN '"volume":"n/a"' END,
                          CASE WHEN sequence_number % 89 = 0 THEN '"sequence_number":"no. ' || sequence_number || '"' END) || '}'
       WHEN sequence_number % 3 = 2 THEN '{"vendor_flag":"v' || PartitionId || '"}' END AS _rescued_data
FROM cdr_raw""", RAW),
    "bronze_lineage": _q("SELECT call_id, partition_date, partition_date IS NOT NULL AS path_has_date, "
                         "true AS is_parquet FROM cdr_bronze", RAW, BRONZE),
    "dedup_cdr_stream": _q(f"SELECT {_without(CDR_SILVER_COLS, 'bronze_source_file')} FROM cdr_clean", *_ALL),
    "dedup_edr_stream": _q(f"SELECT {_without(EDR_SILVER_COLS, 'bronze_source_file')} FROM edr_clean", *_ALL),
    "dedup_edr_bounded": _q(f"SELECT {_without(EDR_SILVER_COLS, 'bronze_source_file')} FROM edr_clean", *_ALL),
    "dedup_cdr_index": _q("SELECT call_id, msisdn, service_type FROM cdr_clean", *_ALL),
    "dedup_edr_index": _q(f"SELECT {_without(EDR_SILVER_COLS, 'bronze_source_file')} FROM edr_clean", *_ALL),
    "reconcile_stream": ORACLES["reconciliation_detail"],
    "reconcile_stream_late": ORACLES["reconciliation_detail"],
    "scd1_stream": ORACLES["scd1_cdr"],
    "medallion_summary": ORACLES["reconciliation_summary"],
    "layout_clustered": _q("SELECT call_id, msisdn, service_type FROM cdr_clean", *_ALL),
    "layout_compacted": _q("SELECT business_date, call_id, session_id, mismatch_type FROM scored", *_DETAIL),
    "partition_pruned_read": _q("SELECT business_date, count(*) AS record_count FROM scored WHERE business_date - "
                                "(SELECT min(business_date) FROM scored) IN (2, 9, 16) GROUP BY business_date",
                                *_DETAIL),
})

# --- upsert tables in cells and incremental gold (see plans/delta_queries.py) -----------

CDR_FINAL = """
cdr_final AS (
  SELECT * REPLACE (
    CASE WHEN sequence_number % 10 = 0 THEN expected_charge + 1.0 ELSE expected_charge END AS expected_charge,
    CASE WHEN sequence_number % 10 = 0 THEN CAST(expected_charge_decimal + 1 AS DECIMAL(10,4))
         ELSE expected_charge_decimal END AS expected_charge_decimal,
    CASE WHEN sequence_number % 20 = 0 THEN CAST(business_date + INTERVAL 1 DAY AS DATE) ELSE business_date END AS business_date,
    CASE WHEN sequence_number % 10 = 0 THEN 'CORRECTED' ELSE status END AS status)
  FROM cdr_clean WHERE sequence_number % 10 <> 2
)"""
EDR_FINAL = """
edr_final AS (
  SELECT * EXCLUDE (n) REPLACE (
    CASE WHEN n % 10 = 0 THEN charge_amount + 0.5 ELSE charge_amount END AS charge_amount,
    CASE WHEN n % 10 = 0 THEN CAST(charge_amount_decimal + 0.5 AS DECIMAL(10,4)) ELSE charge_amount_decimal END
      AS charge_amount_decimal,
    CASE WHEN n % 10 = 0 THEN 'ADJUSTED' ELSE billing_status END AS billing_status)
  FROM (SELECT *, CAST(substring(session_id, 9, 12) AS BIGINT) AS n FROM edr_clean) WHERE n % 10 <> 2
)"""
_FINAL = (*_ALL, CDR_FINAL, EDR_FINAL, MATCH.replace("cdr_clean c", "cdr_final c").replace("edr_clean e", "edr_final e"),
          GOLD_CAL, f"detailed AS ({DETAIL_SELECT})", CLASSIFY.format(derive=DERIVE_COLS, src="detailed"))

ORACLES.update({
    "scd1_in_cells": _q("""SELECT call_id, business_date, expected_charge,
  CAST(expected_charge_decimal AS DOUBLE) AS expected_charge_decimal, status FROM cdr_final""", *_ALL, CDR_FINAL),
    "scd1_change_log": _q("""SELECT call_id, 'update_preimage' AS change_type, business_date, expected_charge, status
FROM cdr_clean WHERE sequence_number % 10 = 0
UNION ALL
SELECT call_id, 'update_postimage', business_date, expected_charge, status FROM cdr_final WHERE sequence_number % 10 = 0
UNION ALL
SELECT call_id, 'insert', business_date, expected_charge, status FROM cdr_final WHERE sequence_number % 10 = 1
UNION ALL
SELECT call_id, 'delete', business_date, expected_charge, status FROM cdr_clean WHERE sequence_number % 10 = 2""",
                          *_ALL, CDR_FINAL),
    "silver_date_pruned": _q("""SELECT business_date, call_id, status FROM cdr_final
WHERE business_date - (SELECT min(business_date) FROM cdr_final) IN (2, 9, 16)""", *_ALL, CDR_FINAL),
    "detail_incremental": _q("SELECT * FROM scored", *_FINAL),
    "summary_by_delta": _q(SUMMARY_SELECT, *_FINAL),
})
ORACLES["summary_by_counts"] = ORACLES["summary_by_delta"]
