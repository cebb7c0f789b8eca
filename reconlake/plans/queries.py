"""Query registry: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the testdata tables (through the fixtures) over whole
tables. Output columns are named exactly as in the matching oracle
(``plans/oracles.py``). Two output conventions keep the engine comparison
exact: decimals are returned as double, and processing/ingestion timestamps
(``current_timestamp()``) are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import calendar_dim, clean, rating
from reconlake.operators import dedup, expectations, incremental, reconcile, scd, summary
from reconlake.plans import pipeline as pl
from reconlake.session import ensure_session
from reconlake.sources import envelope, fixtures, ingest
from reconlake.streaming.cells import rows_of

NOW_COLS = ("bronze_ingestion_time", "silver_processing_time", "reconciliation_timestamp",
            "silver_processed_timestamp")
DEC_COLS = ("volume_decimal", "expected_charge_decimal", "charge_amount_decimal")


def _out(df: DataFrame) -> DataFrame:
    """Drop time-of-run columns, decimals as double."""
    df = df.drop(*[c for c in NOW_COLS if c in df.columns])
    return df.withColumns({c: F.col(c).cast("double") for c in DEC_COLS if c in df.columns})


def _pipe(spark: SparkSession, sf: str) -> pl.Pipeline:
    return pl.Pipeline(ensure_session(spark), sf)


# --- bronze ---------------------------------------------------------------------------

def bronze_cdr(spark, sf):
    return _out(_pipe(spark, sf).bronze_cdr())


def bronze_edr(spark, sf):
    return _out(_pipe(spark, sf).bronze_edr())


def bronze_partition_date(spark, sf):
    raw = fixtures.cdr_raw(ensure_session(spark), sf)
    return raw.select("call_id", "source_path", ingest.partition_date(F.col("source_path")).alias("partition_date"))


def _stringly_cdr(spark, sf):
    """Capture where the numeric columns arrived as text (a JSON capture), with
    an unparseable marker in some rows: input for hints and rescue."""
    raw = fixtures.cdr_raw(ensure_session(spark), sf)
    junk = F.col("sequence_number") % 97 == 0
    return raw.withColumns({
        "volume": F.when(junk, F.lit("n/a")).otherwise(F.col("volume").cast("string")),
        "expected_charge": F.col("expected_charge").cast("string"),
    })


HINTED = ["call_id", "msisdn", "timestamp", "service_type", "volume", "expected_charge",
          "data_quality", "network_element"]


def bronze_schema_hints(spark, sf):
    return ingest.apply_hints(_stringly_cdr(spark, sf)).select(*HINTED)


def bronze_rescued_data(spark, sf):
    r = ingest.rescue(_stringly_cdr(spark, sf))
    return r.select("call_id", "volume", F.col("_rescued_data").isNotNull().alias("has_rescued"))


def bronze_schema_evolution(spark, sf):
    """Old files lack ``cell_id``; new files add it. The stored schema evolves by
    appending it; old rows read it as NULL."""
    raw = fixtures.cdr_raw(ensure_session(spark), sf)
    old = raw.where(F.col("PartitionId") < 2).drop("cell_id")
    new = raw.where(F.col("PartitionId") >= 2)
    evolved = ingest.evolve_schema(old.schema, new.schema)
    stored = ingest.schema_from_json(ingest.schema_to_json(evolved))
    both = ingest.conform(old, stored).unionByName(ingest.conform(new, stored))
    return both.select("call_id", "network_element", "cell_id")


def event_envelope_roundtrip(spark, sf):
    raw = fixtures.cdr_raw(ensure_session(spark), sf)
    cols = ["call_id", "msisdn", "timestamp", "volume", "is_roaming"]
    rec = raw.select(*cols)
    back = envelope.decode(envelope.encode(rec), rec.schema)
    return back.select("key", "call_id", "volume")


# --- rating ---------------------------------------------------------------------------

def usage_units(spark, sf):
    raw = fixtures.cdr_raw(ensure_session(spark), sf)
    return rating.units(raw).select("call_id", "service_type", "duration_seconds", "volume", "unit")


def usage_completeness(spark, sf):
    raw = fixtures.cdr_raw(ensure_session(spark), sf)
    return rating.completeness(raw.drop("status", "incomplete")).select("call_id", "volume", "status", "incomplete")


def rated_usage(spark, sf):
    spark = ensure_session(spark)
    raw = fixtures.cdr_raw(spark, sf).drop("expected_charge")
    return rating.rate(raw, fixtures.tariffs(spark)).select(
        "call_id", "service_type", "is_roaming", "volume", "rate", "expected_charge")


# --- silver ---------------------------------------------------------------------------

def silver_cdr(spark, sf):
    return _out(_pipe(spark, sf).cdr())


def silver_edr(spark, sf):
    return _out(_pipe(spark, sf).edr())


def _enriched_cdr(spark, sf):
    return clean.clean_cdr(_pipe(spark, sf).bronze_cdr())


def _enriched_edr(spark, sf):
    return clean.clean_edr(_pipe(spark, sf).bronze_edr())


def silver_cdr_business_date(spark, sf):
    return _enriched_cdr(spark, sf).select("call_id", "partition_date", "timestamp_parsed", "business_date")


def silver_decimal_casts(spark, sf):
    return _out(_enriched_cdr(spark, sf).select("call_id", "volume", "volume_decimal",
                                                 "expected_charge", "expected_charge_decimal"))


def silver_msisdn_normalized(spark, sf):
    return _enriched_cdr(spark, sf).select("call_id", "msisdn", "msisdn_normalized")


def silver_time_attributes(spark, sf):
    return _enriched_cdr(spark, sf).select("call_id", "timestamp_parsed", "hour_of_day", "day_of_week")


def silver_cdr_quality_flag(spark, sf):
    return _enriched_cdr(spark, sf).select("call_id", "data_quality", "volume", "expected_charge",
                                           "has_quality_issue")


def silver_edr_quality_flag(spark, sf):
    return _enriched_edr(spark, sf).select("session_id", "data_quality", "billing_status", "charge_amount",
                                           "has_quality_issue")


# --- expectations ---------------------------------------------------------------------

def _cdr_before_rules(spark, sf):
    rows = clean.enrich_cdr(_pipe(spark, sf).bronze_cdr())
    rows = dedup.first(rows, pl.CDR_DEDUP_KEYS, ["timestamp_parsed", "bronze_source_file"])
    return clean.finish_cdr(rows)


def _edr_before_rules(spark, sf):
    rows = clean.clean_edr(_pipe(spark, sf).bronze_edr())
    return dedup.first(rows, pl.EDR_DEDUP_KEYS, ["timestamp_parsed", "transaction_id"])


def expect_drop_cdr(spark, sf):
    drops = [r for r in expectations.CDR_RULES if r.action == expectations.DROP]
    return expectations.apply(_cdr_before_rules(spark, sf), drops).select("call_id", "msisdn", "service_type")


def expect_drop_edr(spark, sf):
    return _pipe(spark, sf).edr_staging().select("session_id", "cdr_call_id", "msisdn")


def expect_fail_guard(spark, sf):
    fails = [r for r in expectations.CDR_RULES if r.action == expectations.FAIL]
    return expectations.apply(_cdr_before_rules(spark, sf), fails).select("call_id", "msisdn", "service_type")


def expectation_metrics(spark, sf):
    c = expectations.metrics(_cdr_before_rules(spark, sf), expectations.CDR_RULES)
    e = expectations.metrics(_edr_before_rules(spark, sf), expectations.EDR_RULES)
    return c.unionByName(e)


# --- dedup / SCD1 ---------------------------------------------------------------------

def dedup_cdr(spark, sf):
    return _pipe(spark, sf).cdr_staging().select("call_id", "msisdn", "service_type", "timestamp_parsed")


def dedup_edr(spark, sf):
    return _edr_before_rules(spark, sf).select("session_id", "timestamp_parsed")


def dedup_cdr_changed_copies(spark, sf):
    """Every 7th call arrives three times: as it is, later with another cell, and
    at the same time with another cell. The first by time wins, whatever the
    order of arrival; among equal times one row is kept (its key and time)."""
    rows = _enriched_cdr(spark, sf)
    later = F.expr("INTERVAL 90 SECONDS")
    copies = F.when(F.col("sequence_number") % 7 == 0, F.array(F.lit(2), F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0)))
    rows = rows.select("*", F.explode(copies).alias("copy")).withColumns({
        "timestamp_parsed": F.when(F.col("copy") == 1, F.col("timestamp_parsed") + later).otherwise(F.col("timestamp_parsed")),
        "cell_id": F.when(F.col("copy") > 0, F.concat(F.col("cell_id"), F.lit("-moved"))).otherwise(F.col("cell_id"))})
    kept = dedup.first(rows, pl.CDR_DEDUP_KEYS, ["timestamp_parsed", "copy"])
    return kept.select(*pl.CDR_DEDUP_KEYS, "timestamp_parsed", "cell_id")


def _versions(staging: DataFrame, key_mod_col: str, change: dict) -> tuple[DataFrame, DataFrame]:
    """Two deliveries: version 1 = all rows, sequence 2024-02-01; version 2 =
    rows whose ``key_mod_col`` is a multiple of 10, with changed values and
    sequence 2024-02-02."""
    v1 = staging.withColumn("silver_processing_time", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    v2 = (staging.where(F.col(key_mod_col) % 10 == 0)
                 .withColumns(change)
                 .withColumn("silver_processing_time", F.lit("2024-02-02 00:00:00").cast("timestamp")))
    return v1, v2


def _cdr_versions(spark, sf):
    st = _pipe(spark, sf).cdr_staging()
    return _versions(st, "sequence_number", {
        "expected_charge": F.col("expected_charge") + F.lit(1.0),
        "expected_charge_decimal": (F.col("expected_charge_decimal") + F.lit(1)).cast("decimal(10,4)"),
        "status": F.lit("CORRECTED"),
    })


def _edr_versions(spark, sf):
    st = _pipe(spark, sf).edr_staging()
    return _versions(st.withColumn("__n", F.substring("session_id", 9, 12).cast("bigint")), "__n", {
        "charge_amount": F.col("charge_amount") + F.lit(0.5),
        "charge_amount_decimal": (F.col("charge_amount_decimal") + F.lit(0.5)).cast("decimal(10,4)"),
        "billing_status": F.lit("ADJUSTED"),
    })


def scd1_cdr(spark, sf):
    v1, v2 = _cdr_versions(spark, sf)
    out = scd.upsert(scd.apply_scd1(v1, pl.CDR_KEYS, pl.SEQUENCE), v2, pl.CDR_KEYS, pl.SEQUENCE)
    return _out(out.select("call_id", "expected_charge", "expected_charge_decimal", "status", "timestamp_parsed"))


def scd1_edr(spark, sf):
    v1, v2 = _edr_versions(spark, sf)
    out = scd.upsert(scd.apply_scd1(v1, pl.EDR_KEYS, pl.SEQUENCE), v2, pl.EDR_KEYS, pl.SEQUENCE)
    return _out(out.select("session_id", "charge_amount", "charge_amount_decimal", "billing_status"))


def scd1_except_columns(spark, sf):
    v1, v2 = _cdr_versions(spark, sf)
    except_cols = ("bronze_source_file", "bronze_ingestion_time", "_rescued_data")
    out = scd.upsert(scd.apply_scd1(v1, pl.CDR_KEYS, pl.SEQUENCE, except_cols), v2, pl.CDR_KEYS,
                     pl.SEQUENCE, except_cols)
    return _out(out.drop("silver_processing_time"))


def scd1_change_rows(spark, sf):
    v1, v2 = _cdr_versions(spark, sf)
    before = scd.apply_scd1(v1, pl.CDR_KEYS, pl.SEQUENCE).select("call_id", "expected_charge", "status")
    after = scd.upsert(scd.apply_scd1(v1, pl.CDR_KEYS, pl.SEQUENCE), v2, pl.CDR_KEYS, pl.SEQUENCE) \
               .select("call_id", "expected_charge", "status")
    return scd.changes(before, after, ["call_id"])


# --- calendar -------------------------------------------------------------------------

def calendar_spine(spark, sf):
    return calendar_dim.spine_from_bounds(pl.event_years(spark, sf))


def calendar_dim_q(spark, sf):
    return _out(calendar_dim.build_from_bounds(pl.event_years(spark, sf)))


def calendar_holidays(spark, sf):
    cal = calendar_dim.build_from_bounds(pl.event_years(spark, sf))
    return cal.where("is_holiday").select("date", "holiday_name", "is_holiday", "day_of_week")


# --- gold -----------------------------------------------------------------------------

def reconcile_full_outer(spark, sf):
    return _pipe(spark, sf).matched()


# The inner join with a calendar drops dates outside it; only this key takes a
# calendar shorter than the data, to show that.
SHORT_CALENDAR = ("2024-01-01", "2024-01-25")


def reconcile_calendar(spark, sf):
    p = pl.Pipeline(ensure_session(spark), sf, SHORT_CALENDAR)
    rec = reconcile.calendar_join(p.matched(), p.calendar(), p.calendar_days())
    keep = ["business_date", "call_id", "session_id"] + [f"cal_{c}" for c in reconcile.CALENDAR_OUT]
    return rec.select(*keep)


def _classified(spark, sf):
    return _pipe(spark, sf).classified()


def reconcile_quality_side(spark, sf):
    return _classified(spark, sf).select("call_id", "session_id", "cdr_has_quality_issue",
                                         "edr_has_quality_issue", "reconciled")


def reconcile_variance(spark, sf):
    return _classified(spark, sf).select("call_id", "session_id", "volume_variance", "variance", "variance_percent")


def reconcile_mismatch_type(spark, sf):
    return _classified(spark, sf).select("call_id", "session_id", "mismatch_type")


def reconcile_severity(spark, sf):
    return _classified(spark, sf).select("call_id", "session_id", "mismatch_type", "severity")


def reconcile_revenue_impact(spark, sf):
    return _classified(spark, sf).select("call_id", "session_id", "mismatch_type", "revenue_impact")


def reconciliation_detail(spark, sf):
    return _out(_pipe(spark, sf).detail())


MONEY = 4  # decimals of the amounts; summaries are rounded at this scale on both sides


def reconciliation_summary(spark, sf):
    return summary.summarize(_pipe(spark, sf).detail(), MONEY)


def reconciliation_summary_sql(spark, sf):
    spark = ensure_session(spark)
    return summary.summarize_sql(spark, _pipe(spark, sf).detail(), "reconciliation_detail", money=True)


def summary_incremental(spark, sf):
    """Version 1 is the detail as if the charges of the last third of the data's time span had
    not arrived yet. They arrive: their match keys are re-matched (delta join), and the summary
    recomputes the dates which detail rows of these keys leave or enter."""
    p = pl.Pipeline(ensure_session(spark), sf, materialize=True)
    ts = F.col("timestamp_parsed")
    span = p.edr().agg(F.min(F.unix_micros(ts)).alias("a"), F.max(F.unix_micros(ts)).alias("b")).first()
    known = ts.isNull()
    if span["a"] is not None:
        known = known | (F.unix_micros(ts) < F.lit(span["a"] + (span["b"] - span["a"]) * 2 // 3))

    def detail(cdr: DataFrame, edr: DataFrame) -> DataFrame:
        return pl.detail(cdr, edr, p.calendar(), p.calendar_days(), with_timestamp=False).select(
            "business_date", "call_id", "edr_reference_to_cdr", "msisdn_normalized", "mismatch_type", "severity",
            "revenue_impact").checkpoint(eager=True)

    v1 = detail(p.cdr(), p.edr().where(known))
    keys = incremental.touched_keys(None, p.edr().where(~known))
    fresh = detail(rows_of(p.cdr(), keys, incremental.MATCH_KEY), rows_of(p.edr(), keys, incremental.CHARGE_KEY))
    stale = incremental.rows_with_keys(v1, keys)
    dates = stale.select("business_date").unionByName(fresh.select("business_date")).distinct()
    v2 = incremental.rows_with_keys(v1, keys, "left_anti").unionByName(fresh)
    return summary.refresh(summary.summarize(v1, MONEY), v2, dates, MONEY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_cdr": bronze_cdr,
    "bronze_edr": bronze_edr,
    "bronze_partition_date": bronze_partition_date,
    "bronze_schema_hints": bronze_schema_hints,
    "bronze_rescued_data": bronze_rescued_data,
    "bronze_schema_evolution": bronze_schema_evolution,
    "event_envelope_roundtrip": event_envelope_roundtrip,
    "usage_units": usage_units,
    "usage_completeness": usage_completeness,
    "rated_usage": rated_usage,
    "silver_cdr": silver_cdr,
    "silver_edr": silver_edr,
    "silver_cdr_business_date": silver_cdr_business_date,
    "silver_decimal_casts": silver_decimal_casts,
    "silver_msisdn_normalized": silver_msisdn_normalized,
    "silver_time_attributes": silver_time_attributes,
    "silver_cdr_quality_flag": silver_cdr_quality_flag,
    "silver_edr_quality_flag": silver_edr_quality_flag,
    "expect_drop_cdr": expect_drop_cdr,
    "expect_drop_edr": expect_drop_edr,
    "expect_fail_guard": expect_fail_guard,
    "expectation_metrics": expectation_metrics,
    "dedup_cdr": dedup_cdr,
    "dedup_edr": dedup_edr,
    "dedup_cdr_changed_copies": dedup_cdr_changed_copies,
    "scd1_cdr": scd1_cdr,
    "scd1_edr": scd1_edr,
    "scd1_except_columns": scd1_except_columns,
    "scd1_change_rows": scd1_change_rows,
    "calendar_spine": calendar_spine,
    "calendar_dim": calendar_dim_q,
    "calendar_holidays": calendar_holidays,
    "reconcile_full_outer": reconcile_full_outer,
    "reconcile_calendar": reconcile_calendar,
    "reconcile_quality_side": reconcile_quality_side,
    "reconcile_variance": reconcile_variance,
    "reconcile_mismatch_type": reconcile_mismatch_type,
    "reconcile_severity": reconcile_severity,
    "reconcile_revenue_impact": reconcile_revenue_impact,
    "reconciliation_detail": reconciliation_detail,
    "reconciliation_summary": reconciliation_summary,
    "reconciliation_summary_sql": reconciliation_summary_sql,
    "summary_incremental": summary_incremental,
}
