"""Properties of the match and the upsert, and the split match
against a brute-force full outer interval join on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reconlake.operators import reconcile
from reconlake.plans import pipeline as pl

T0 = dt.datetime(2024, 1, 5, 10, 0, 0)
W = dt.timedelta(minutes=15)


def test_match_covers_both_sides(spark):
    p = pl.Pipeline(spark, SF_SMALL)
    cdr, edr, rec = p.cdr(), p.edr(), p.matched()
    n = rec.count()
    assert n >= max(cdr.count(), edr.count())
    missing_c = cdr.select("call_id").subtract(rec.where(F.col("call_id").isNotNull()).select("call_id"))
    missing_e = edr.select("session_id").subtract(rec.where(F.col("session_id").isNotNull()).select("session_id"))
    assert missing_c.count() == 0 and missing_e.count() == 0


def test_scd1_unique_by_key(spark):
    p = pl.Pipeline(spark, SF_SMALL)
    for df, key in ((p.cdr(), "call_id"), (p.edr(), "session_id")):
        assert df.groupBy(key).count().where("count > 1").count() == 0


def brute_force(cdrs, edrs):
    """Full outer interval join in plain Python: (cdr index | None, edr index | None)."""
    out, matched_c, matched_e = [], set(), set()
    for i, (ck, cm, ct) in enumerate(cdrs):
        for j, (ek, em, et) in enumerate(edrs):
            if None in (ck, cm, ct, ek, em, et):
                continue
            if ck == ek and cm == em and ct <= et <= ct + W:
                out.append((i, j))
                matched_c.add(i)
                matched_e.add(j)
    out += [(i, None) for i in range(len(cdrs)) if i not in matched_c]
    out += [(None, j) for j in range(len(edrs)) if j not in matched_e]
    return sorted(out, key=_order)


def _order(t):
    return (t[0] is None, t[0] or 0, t[1] is None, t[1] or 0)


key = st.sampled_from(["K1", "K2", None])
num = st.sampled_from(["+1", "+2"])
offset = st.sampled_from([-60, 0, 1, 450, 899, 900, 901, 1800, 3600]).map(lambda s: T0 + dt.timedelta(seconds=s))
row = st.tuples(key, num, st.one_of(offset, st.just(None)))


def frames(spark, cdrs, edrs):
    """Minimal silver-shaped frames; an index column identifies each row."""
    c = spark.createDataFrame(
        [(f"C{i}", k, m, t, t.date() if t else None) for i, (k, m, t) in enumerate(cdrs)],
        "idx string, call_id string, msisdn_normalized string, timestamp_parsed timestamp, business_date date")
    e = spark.createDataFrame(
        [(f"E{j}", k, m, t, t.date() if t else None) for j, (k, m, t) in enumerate(edrs)],
        "idx string, cdr_call_id string, msisdn_normalized string, timestamp_parsed timestamp, business_date date")
    fill_c = {"has_quality_issue": F.lit(False), "msisdn": F.col("msisdn_normalized"), "data_quality": F.lit("GOOD"),
              "service_type": F.lit("voice"), "status": F.col("idx"), "_rescued_data": F.lit(None).cast("string"),
              "partition_date": F.col("business_date"), "volume_decimal": F.lit(1).cast("decimal(15,2)"),
              "expected_charge_decimal": F.lit(1).cast("decimal(10,4)")}
    fill_e = {"has_quality_issue": F.lit(False), "msisdn": F.col("msisdn_normalized"), "data_quality": F.lit("GOOD"),
              "session_id": F.col("idx"), "payment_method": F.lit("P"), "billing_status": F.lit("SUCCESS"),
              "transaction_id": F.col("idx"), "charge_amount_decimal": F.lit(1).cast("decimal(10,4)")}
    return c.withColumns(fill_c), e.withColumns(fill_e)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cdrs=st.lists(row, max_size=6), edrs=st.lists(row, max_size=8))
def test_split_match_equals_brute_force(spark, cdrs, edrs):
    c, e = frames(spark, cdrs, edrs)
    got = reconcile.match(c, e, strategy="split").select("status", "session_id").collect()
    pairs = [((int(r.status[1:]) if r.status else None), (int(r.session_id[1:]) if r.session_id else None))
             for r in got]
    assert sorted(pairs, key=_order) == brute_force(cdrs, edrs)
