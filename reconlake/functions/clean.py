"""Silver cleaning: event-time parse, business date, decimals, subscriber number
normalisation, time attributes and quality flags. All built-in expressions
(narrow, inside whole-stage codegen); no UDF.

``clean_cdr`` / ``clean_edr`` give the enriched rows *without* dedup; the
dedup and the expectations are frame operators (``operators/``) applied by
``silver_cdr`` / ``silver_edr`` in ``plans/pipeline.py`` in the reference's
order: enrich, dedup, then expectations on the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output decimal types and the normalisation pattern.
VOLUME_DECIMAL = "decimal(15,2)"
CHARGE_DECIMAL = "decimal(10,4)"
MSISDN_STRIP = "[^0-9+]"


def parse_ts(c: Column) -> Column:
    """ISO-8601 text to timestamp in the session zone; malformed text -> NULL."""
    return F.try_to_timestamp(c)


def normalize_msisdn(c: Column) -> Column:
    return F.regexp_replace(c, MSISDN_STRIP, "")


def to_decimal(c: Column, dtype: str) -> Column:
    """Numeric to decimal, NULL on overflow instead of an ANSI error."""
    return c.try_cast(dtype)


def cdr_quality_issue() -> Column:
    # three-valued: NULL data_quality with both values present stays NULL
    return ((F.col("data_quality") != "GOOD") | F.col("volume").isNull()
            | F.col("expected_charge").isNull())


def edr_quality_issue() -> Column:
    return ((F.col("data_quality") != "GOOD") | (F.col("billing_status") != "SUCCESS")
            | (F.col("charge_amount") < 0))


def enrich_cdr(df: DataFrame) -> DataFrame:
    """Columns computed before dedup in the usage flow."""
    ts = parse_ts(F.col("timestamp"))
    return df.withColumns({
        "timestamp_parsed": ts,
        "business_date": F.coalesce(F.col("partition_date"), F.to_date(ts)),
    })


def finish_cdr(df: DataFrame) -> DataFrame:
    """Columns computed after dedup in the usage flow."""
    return df.withColumns({
        "volume_decimal": to_decimal(F.col("volume"), VOLUME_DECIMAL),
        "expected_charge_decimal": to_decimal(F.col("expected_charge"), CHARGE_DECIMAL),
        "msisdn_normalized": normalize_msisdn(F.col("msisdn")),
        "hour_of_day": F.hour("timestamp_parsed"),
        "day_of_week": F.dayofweek("timestamp_parsed"),
        "has_quality_issue": cdr_quality_issue(),
        "silver_processing_time": F.current_timestamp(),
    })


def clean_cdr(df: DataFrame) -> DataFrame:
    """All usage silver columns without dedup (for column-level checks)."""
    return finish_cdr(enrich_cdr(df))


def clean_edr(df: DataFrame) -> DataFrame:
    """All charge silver columns (the charge flow dedups after these)."""
    ts = parse_ts(F.col("timestamp"))
    return df.withColumn("timestamp_parsed", ts).withColumns({
        "business_date": F.to_date("timestamp_parsed"),
        "charge_amount_decimal": to_decimal(F.col("charge_amount"), CHARGE_DECIMAL),
        "msisdn_normalized": normalize_msisdn(F.col("msisdn")),
        "has_quality_issue": edr_quality_issue(),
        "silver_processing_time": F.current_timestamp(),
    })
