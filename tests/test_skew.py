"""A hot key: one call reference carries a third of all charge rows.

The split full outer match must equal the one-join full outer match (brute
force over the same frames), the presence table must stay bounded by time
windows, and AQE must split the skewed join partition."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from reconlake.operators import reconcile
from reconlake.plans import pipeline as pl


def hot_frames(spark):
    """Real silver rows, plus copies of real charge rows re-pointed at one call
    reference (about half as many as the real charges, so a third of all),
    spread over one day, and a few usage rows with that reference."""
    p = pl.Pipeline(spark, SF_SMALL)
    cdr, edr = p.cdr(), p.edr()
    day = F.lit(dt.datetime(2024, 1, 3)).cast("timestamp")
    secs = (F.abs(F.xxhash64("session_id")) % 86400).cast("decimal(18,6)")
    hot_edr = edr.limit(edr.count() // 2).withColumns({
        "session_id": F.concat(F.lit("SESSION-HOT-"), F.col("session_id")),
        "cdr_call_id": F.lit("CALL-HOT"),
        "msisdn_normalized": F.lit("+35899990000"),
        "timestamp_parsed": day + F.make_dt_interval(secs=secs),
    })
    hours = (F.abs(F.xxhash64("call_id")) % 24).cast("int")
    hot_cdr = cdr.limit(5).withColumns({
        "call_id": F.lit("CALL-HOT"),
        "msisdn_normalized": F.lit("+35899990000"),
        "timestamp_parsed": day + F.make_dt_interval(hours=hours),
    })
    return cdr.unionByName(hot_cdr), edr.unionByName(hot_edr)


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_split_equals_full_outer_under_skew(spark):
    cdr, edr = hot_frames(spark)
    split = reconcile.match(cdr, edr, strategy="split")
    full = reconcile.match(cdr, edr, strategy="fullouter")
    a, b = rows(split), rows(full)
    assert len(a) == len(b)
    assert a == b
    hot_pairs = split.where((F.col("call_id") == "CALL-HOT") & F.col("session_id").isNotNull()).count()
    assert hot_pairs > 0


def test_presence_is_bounded_by_windows(spark):
    _, edr = hot_frames(spark)
    pres = reconcile.presence(edr).where(F.col("p_call_id") == "CALL-HOT")
    # one day of hot charges -> at most 96 fifteen-minute buckets
    assert pres.count() <= 96


def test_aqe_splits_the_hot_partition(spark):
    cdr, edr = hot_frames(spark)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = reconcile.match(cdr, edr, strategy="split")
        df.collect()  # runs this frame's own query execution to its final adaptive plan
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_replay_storm_collapses_before_the_shuffle(spark):
    """One usage record replayed thousands of times (most of the input): the
    dedup keeps one row, and the plan aggregates partially before its exchange,
    so no task receives the replayed rows whole."""
    from reconlake.operators import dedup
    p = pl.Pipeline(spark, SF_SMALL)
    rows = p.bronze_cdr()
    storm = rows.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("__n")).drop("__n")
    both = rows.unionByName(storm)
    out = dedup.first(both, pl.CDR_DEDUP_KEYS, ["timestamp"])
    assert out.count() == rows.dropDuplicates(pl.CDR_DEDUP_KEYS).count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    below = text.split("Exchange hashpartitioning(call_id", 1)[1]
    assert "SortAggregate" in below          # partial aggregate under the exchange
