"""Physical-plan properties of the headline queries."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from reconlake.plans import pipeline as pl
from reconlake.plans import stream_queries

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def static_plan(spark, df) -> str:
    """Static plan as at scale: no side small enough to broadcast by estimate,
    AQE off so exchange reuse is visible before execution."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_detail_and_summary_have_no_slow_operators(spark):
    p = pl.Pipeline(spark, SF_SMALL)
    for df in (p.matched(), p.detail(), p.summary()):
        text = static_plan(spark, df)
        for bad in FORBIDDEN:
            assert bad not in text, bad


def test_match_reuses_join_exchanges(spark):
    text = static_plan(spark, pl.Pipeline(spark, SF_SMALL).matched())
    assert "SortMergeJoin" in text
    assert text.count("ReusedExchange") >= 3


def test_calendar_is_broadcast_with_known_size(spark):
    text = static_plan(spark, pl.Pipeline(spark, SF_SMALL).detail())
    assert "BroadcastHashJoin" in text and "BroadcastExchange" in text


def test_scan_reads_only_needed_columns(spark):
    text = plan_text(pl.Pipeline(spark, SF_SMALL).summary())
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text
    assert "props" not in text


def test_partition_filter_reaches_scan(spark):
    df = stream_queries.partition_pruned_read(spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "business_date" in filters and "2024-01-10" in filters


def test_summary_preaggregates_before_shuffle(spark):
    text = static_plan(spark, pl.Pipeline(spark, SF_SMALL).summary())
    # partial aggregates sit below the exchanges of the group-by
    assert text.count("HashAggregate") >= 4


def test_events_filter_is_pushed(spark):
    from reconlake.sources import fixtures
    df = fixtures.read_table(spark, SF_SMALL, "events").where(F.col("event_id") > 10).select("event_id")
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,10)]" in plan_text(df)


def test_usage_shuffled_once_for_the_match(spark):
    """Downstream filters (the calendar join) must not make the two joins'
    usage subtrees differ: one exchange on the join keys, reused."""
    import re
    for df in (pl.Pipeline(spark, SF_SMALL).summary(), pl.Pipeline(spark, SF_SMALL).detail()):
        text = static_plan(spark, df)
        # a ReusedExchange line repeats the original's text: count distinct ones
        usage = set(re.findall(r"Exchange hashpartitioning\(call_id#\d+, msisdn_normalized#\d+, \d+\)", text))
        charge = set(re.findall(r"Exchange hashpartitioning\(cdr_call_id#\d+, msisdn_normalized#\d+, \d+\)", text))
        assert len(usage) == 1, usage
        assert len(charge) == 1, charge
        assert "ReusedExchange" in text
        # one scan and one dedup shuffle per record type, whatever the branch
        dedup = set(re.findall(r"Exchange hashpartitioning\(call_id#\d+, msisdn#\d+, service_type#\d+", text))
        assert len(dedup) == 1, dedup
        assert text.count("FileScan") == 2
