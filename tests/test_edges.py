"""Literal edge rows (FIXTURES.md §3) for matching, classification, dedup,
upsert, expectations and the calendar join. Every matching case runs both
join strategies, which must agree."""

import pytest

from conftest import cdr_row, edr_row, frames
from reconlake.functions import calendar_dim, classify
from reconlake.operators import expectations, reconcile, scd
from reconlake.plans import pipeline as pl

STRATEGIES = ["split", "fullouter"]


def classified(spark, cdrs, edrs, strategy):
    cdr, edr = frames(spark, cdrs, edrs)
    out = classify.derive(reconcile.match(cdr, edr, strategy=strategy), with_timestamp=False)
    return sorted((r.asDict() for r in out.collect()),
                  key=lambda d: (d["call_id"] or "", d["session_id"] or ""))


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("edr_ts", ["2024-01-05T10:00:00.000000", "2024-01-05T10:15:00.000000"])
def test_window_ends_match(spark, strategy, edr_ts):
    rows = classified(spark, [cdr_row()], [edr_row(ts=edr_ts)], strategy)
    assert len(rows) == 1
    assert rows[0]["mismatch_type"] == "MATCHED"


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("edr_ts", ["2024-01-05T09:59:59.999999", "2024-01-05T10:15:00.000001"])
def test_just_outside_window(spark, strategy, edr_ts):
    rows = classified(spark, [cdr_row()], [edr_row(ts=edr_ts)], strategy)
    assert sorted(r["mismatch_type"] for r in rows) == ["MISSING_EDR", "PHANTOM_EDR"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_msisdn_punctuation(spark, strategy):
    rows = classified(spark, [cdr_row(msisdn="+358 0001-0000")], [edr_row(msisdn="+35800010000")], strategy)
    assert [r["mismatch_type"] for r in rows] == ["MATCHED"]
    assert rows[0]["msisdn_normalized"] == "+35800010000"


@pytest.mark.parametrize("expected,actual,mt,sev,impact", [
    (100.0, 105.0, "MATCHED", "NONE", 0.0),      # exactly 5 %
    (10.0, 15.0, "OVER_BILLED", "MEDIUM", 5.0),  # exactly 5 absolute
    (10.0, 5.0, "UNDER_BILLED", "MEDIUM", 5.0),
    (10.0, 16.0, "OVER_BILLED", "HIGH", 6.0),
    (0.0, 50.0, "MATCHED", "NONE", 0.0),         # expected 0 -> percent 0
    (1.0, None, "UNKNOWN", "MEDIUM", 0.0),
])
def test_classification_cells(spark, expected, actual, mt, sev, impact):
    rows = classified(spark, [cdr_row(expected_charge=expected)], [edr_row(charge_amount=actual)], "split")
    assert len(rows) == 1
    r = rows[0]
    assert (r["mismatch_type"], r["severity"]) == (mt, sev)
    assert r["revenue_impact"] == pytest.approx(impact)


def test_expected_null_is_matched_whatever_billed(spark):
    rows = classified(spark, [cdr_row(expected_charge=None)], [edr_row(charge_amount=50.0)], "split")
    assert rows[0]["mismatch_type"] == "MATCHED"
    assert rows[0]["cdr_has_quality_issue"] is True


def test_missing_and_phantom_impact(spark):
    rows = classified(spark, [cdr_row(expected_charge=2.5)],
                      [edr_row(cdr_call_id="CALL-OTHER", charge_amount=7.0)], "split")
    by = {r["mismatch_type"]: r for r in rows}
    assert by["MISSING_EDR"]["revenue_impact"] == pytest.approx(2.5)
    assert by["MISSING_EDR"]["variance_percent"] is None
    assert by["PHANTOM_EDR"]["revenue_impact"] == pytest.approx(7.0)
    assert by["PHANTOM_EDR"]["severity"] == "CRITICAL"


def test_null_quality_flag_falls_through(spark):
    rows = classified(spark, [cdr_row(data_quality=None)], [edr_row()], "split")
    r = rows[0]
    assert r["cdr_has_quality_issue"] is None
    assert r["reconciled"] is None
    rows = classified(spark, [cdr_row(data_quality=None)], [edr_row(billing_status="FAILED")], "split")
    assert rows[0]["reconciled"] == "edr"


def test_shadowing_order(spark):
    """Invalid first arrival, valid second, same dedup key: both gone by default,
    the second kept with validate_first."""
    from reconlake.operators import expectations as ex
    ddl = ("call_id string, msisdn string, timestamp string, service_type string, volume double, "
           "expected_charge double, data_quality string, status string, partition_date date, "
           "_rescued_data string, bronze_source_file string")
    first = cdr_row(ts="2024-01-05T10:00:00.000000", path="/bronze/cdr-events/2024-01-05/a.parquet")
    second = cdr_row(ts="2024-01-05T10:05:00.000000", path="/bronze/cdr-events/2024-01-05/b.parquet")
    bronze = spark.createDataFrame([first, second], ddl)
    rules = [ex.Rule("late_enough", "timestamp_parsed >= timestamp'2024-01-05 10:01:00'", ex.DROP)]
    from reconlake.functions import clean
    from reconlake.operators import dedup
    rows = clean.enrich_cdr(bronze)
    default = ex.apply(dedup.first(rows, pl.CDR_DEDUP_KEYS, ["timestamp_parsed"]), rules)
    assert default.count() == 0
    pre = dedup.first(ex.apply(rows, rules), pl.CDR_DEDUP_KEYS, ["timestamp_parsed"])
    assert [r.timestamp for r in pre.collect()] == ["2024-01-05T10:05:00.000000"]


def test_two_upserts_one_batch_later_event_wins(spark):
    ddl = "call_id string, seq timestamp, timestamp_parsed timestamp, v int"
    import datetime as dt
    same = dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([("A", same, dt.datetime(2024, 1, 1, 10), 1),
                                ("A", same, dt.datetime(2024, 1, 1, 11), 2),
                                ("B", same, None, 3),
                                ("B", same, dt.datetime(2024, 1, 1, 9), 4)], ddl)
    out = {r.call_id: r.v for r in scd.apply_scd1(df, ["call_id"], "seq").collect()}
    assert out == {"A": 2, "B": 4}


def test_future_event_time_aborts(spark):
    fails = [r for r in expectations.CDR_RULES if r.action == expectations.FAIL]
    cdr, _ = frames(spark, [cdr_row(ts="2999-01-01T00:00:00.000000")], [edr_row()])
    with pytest.raises(Exception, match="no_future_dates"):
        expectations.apply(cdr, fails).collect()


def test_null_rule_passes_fail_guard_but_fails_drop(spark):
    cdr, _ = frames(spark, [cdr_row(ts="not a time")], [edr_row()])
    fails = [r for r in expectations.CDR_RULES if r.action == expectations.FAIL]
    assert expectations.apply(cdr, fails).count() == 1
    m = {r.rule: (r.passed, r.failed) for r in expectations.metrics(cdr, expectations.CDR_RULES).collect()}
    assert m["no_future_dates"] == (0, 1)


def test_path_without_date_uses_event_time(spark):
    from reconlake.sources import ingest
    raw = spark.createDataFrame([("CALL-000000000001", "/bronze/cdr-events/part.parquet",
                                  "2024-01-07T23:30:00.000000")], "call_id string, p string, timestamp string")
    b = ingest.bronze_cdr(raw, path_col="p")
    from reconlake.functions import clean
    r = clean.enrich_cdr(b).collect()[0]
    assert r.partition_date is None
    assert str(r.business_date) == "2024-01-07"


def test_date_outside_calendar_dropped(spark):
    cdr, edr = frames(spark, [cdr_row(ts="2024-03-01T10:00:00.000000")], [edr_row(ts="2024-03-01T10:01:00.000000")])
    rec = reconcile.match(cdr, edr)
    cal = calendar_dim.build(spark, "2024-01-01", "2024-01-31")
    assert reconcile.calendar_join(rec, cal, 31).count() == 0


def test_stream_quarantines_null_event_time(spark):
    from reconlake.streaming import runner
    cdr, _ = frames(spark, [cdr_row(ts="garbage"), cdr_row(call_id="CALL-000000000002")], [edr_row()])
    ok, bad = runner.quarantine(cdr)
    assert ok.count() == 1 and bad.count() == 1


def test_calendar_attributes(spark):
    cal = {str(r.date): r for r in calendar_dim.build(spark, "2026-01-01", "2027-01-01").collect()}
    assert len(cal) == 366
    assert cal["2027-01-01"].week_of_year == 53
    assert cal["2026-01-26"].holiday_name == "Republic Day" and cal["2026-01-26"].is_holiday
    assert cal["2026-01-03"].is_weekend and not cal["2026-01-03"].is_weekday
    assert cal["2026-01-01"].month_year == "January 2026" and cal["2026-01-01"].quarter_year == "Q1 2026"
    assert cal["2026-01-01"].date_key == 20260101
    spine = calendar_dim.spine(spark, "2026-01-01", "2026-02-20")
    assert spine.count() == 51


def test_fail_rule_sees_rows_a_drop_rule_removes(spark):
    cdr, _ = frames(spark, [cdr_row(msisdn="123", ts="2999-01-01T00:00:00.000000")], [edr_row()])
    with pytest.raises(Exception, match="no_future_dates"):
        expectations.apply(cdr, expectations.CDR_RULES).collect()


def test_validate_first_options(spark):
    """The drop rules before the dedup: an invalid first arrival no longer
    shadows a valid later one (usage: missing timestamp; charge: missing call reference)."""
    from conftest import CDR_DDL, EDR_DDL
    first = cdr_row(ts=None, path="/bronze/cdr-events/2024-01-05/a.parquet")
    second = cdr_row(ts="2024-01-05T10:05:00.000000", path="/bronze/cdr-events/2024-01-05/b.parquet")
    cdr = spark.createDataFrame([first, second], CDR_DDL)
    # a row without time sorts last in the dedup, so the valid row is kept in both orders
    assert pl.silver_cdr_staging(cdr).count() == 1
    assert pl.silver_cdr_staging(cdr, validate_first=True).count() == 1
    e_bad = edr_row(session_id="S1", cdr_call_id=None, ts="2024-01-05T10:01:00.000000")
    e_good = edr_row(session_id="S1", ts="2024-01-05T10:02:00.000000")
    edr = spark.createDataFrame([e_bad, e_good], EDR_DDL)
    assert pl.silver_edr_staging(edr).count() == 0
    kept = pl.silver_edr_staging(edr, validate_first=True).collect()
    assert [r.cdr_call_id for r in kept] == ["CALL-000000000001"]
