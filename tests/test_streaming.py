"""Streaming behaviour: restart from checkpoint, watermark drops, observed
expectation metrics, idempotent upsert replay, compaction invariance."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, cdr_row, edr_row, frames
from reconlake.functions import calendar_dim
from reconlake.plans import pipeline as pl
from reconlake.plans import stream_queries as sq
from reconlake.session import scratch_path
from reconlake.streaming import runner, upsert


def test_restart_processes_only_new_files(spark):
    land = sq.Landing(spark, SF_SMALL)
    out = scratch_path(spark, "t_restart")
    ckpt = f"{out}.__checkpoint"
    runner.sink(land.bronze_cdr(), out, ckpt)
    n1 = spark.read.parquet(out).count()
    runner.sink(land.bronze_cdr(), out, ckpt)          # nothing new: no rows added
    assert spark.read.parquet(out).count() == n1
    extra = spark.read.parquet(f"{land.cdr_dir}/2024-01-05").limit(3)
    extra.write.mode("append").parquet(f"{land.cdr_dir}/2024-01-05")
    runner.sink(land.bronze_cdr(), out, ckpt)
    assert spark.read.parquet(out).count() == n1 + 3


def test_observed_expectation_metrics(spark):
    land = sq.Landing(spark, SF_SMALL)
    out = scratch_path(spark, "t_observe")
    q = runner.sink(runner.silver_cdr_stream(land.bronze_cdr()), out, f"{out}.__checkpoint")
    seen = [p["observedMetrics"]["cdr_expectations"] for p in q.recentProgress
            if "cdr_expectations" in (p.get("observedMetrics") or {})]
    assert seen
    failed = sum(m["good_data_quality_failed"] for m in seen)
    assert failed > 0


def test_late_rows_dropped_by_watermark(spark):
    """Files arriving out of event-time order: the second micro-batch is behind
    the watermark, and the join drops its rows (a test of its own)."""
    cdr_new, edr_new = frames(spark, [cdr_row(call_id="CALL-NEW0000000", ts="2024-01-10T10:00:00.000000")],
                              [edr_row(cdr_call_id="CALL-NEW0000000", ts="2024-01-10T10:01:00.000000")])
    cdr_old, edr_old = frames(spark, [cdr_row(call_id="CALL-OLD0000000", ts="2024-01-01T10:00:00.000000")],
                              [edr_row(session_id="SESSION-OLD", cdr_call_id="CALL-OLD0000000",
                                       ts="2024-01-01T10:01:00.000000")])
    base = scratch_path(spark, "t_late")
    c_dir, e_dir = f"{base}/cdr", f"{base}/edr"
    cdr_new.write.parquet(c_dir)
    edr_new.write.parquet(e_dir)
    schema_c, schema_e = spark.read.parquet(c_dir).schema, spark.read.parquet(e_dir).schema
    out, ckpt = f"{base}/out", f"{base}/ckpt"

    def run():
        c = spark.readStream.schema(schema_c).parquet(c_dir)
        e = spark.readStream.schema(schema_e).parquet(e_dir)
        cal = calendar_dim.build(spark, "2024-01-01", "2024-01-31")
        return runner.sink(runner.reconcile_stream(c, e, cal, 31), out, ckpt)

    run()
    cdr_old.write.mode("append").parquet(c_dir)
    edr_old.write.mode("append").parquet(e_dir)
    q = run()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped > 0
    ids = {r.call_id for r in spark.read.parquet(out).collect()}
    assert "CALL-NEW0000000" in ids and "CALL-OLD0000000" not in ids


def _snap_rows(df):
    return sorted((r.call_id, r.v) for r in df.select("call_id", "v").collect())


def test_upsert_replay_and_compaction(spark):
    target = scratch_path(spark, "t_upsert")
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    ddl = "call_id string, silver_processing_time timestamp, timestamp_parsed timestamp, v int"
    b0 = spark.createDataFrame([("A", t1, t1, 1), ("B", t1, t1, 1)], ddl)
    b1 = spark.createDataFrame([("A", t2, t1, 2), ("C", t2, t1, 1)], ddl)
    upsert.write_batch(b0, 0, target)
    upsert.write_batch(b1, 1, target)
    keys, seq = ["call_id"], "silver_processing_time"
    before = _snap_rows(upsert.read_snapshot(spark, target, keys, seq))
    assert before == [("A", 2), ("B", 1), ("C", 1)]
    upsert.write_batch(b1, 1, target)          # replayed batch: same result
    assert _snap_rows(upsert.read_snapshot(spark, target, keys, seq)) == before
    v = upsert.compact(spark, target, keys, seq)
    assert v == 0
    assert _snap_rows(upsert.read_snapshot(spark, target, keys, seq)) == before
    b2 = spark.createDataFrame([("B", dt.datetime(2024, 2, 3), t1, 5)], ddl)
    upsert.write_batch(b2, 2, target)
    after = _snap_rows(upsert.read_snapshot(spark, target, keys, seq))
    assert after == [("A", 2), ("B", 5), ("C", 1)]
    # folded deltas are filtered by partition, not re-read
    _, m = upsert.manifest(spark, target)
    assert m["folded"] == 1


def test_stream_equals_batch_detail(spark):
    """The calendar covers every date; the flushed stream equals the batch detail."""
    from tools.check_oracles import digest
    stream = sq.reconcile_stream(spark, SF_SMALL)
    batch = pl.Pipeline(spark, SF_SMALL).detail(with_timestamp=False)
    batch = batch.withColumns({c: F.col(c) for c in batch.columns})
    cols = sorted(stream.columns)
    assert sorted(batch.columns) == cols
    assert digest(cols, [tuple(r) for r in stream.select(*cols).collect()]) == \
        digest(cols, [tuple(r) for r in batch.select(*cols).collect()])


def test_dataset_properties_are_kept(spark):
    from reconlake.functions import calendar_dim
    from reconlake.plans import datasets
    spec = datasets.Dataset("silver.calendar", datasets.VIEW,
                            lambda cat: calendar_dim.build(cat.spark, "2024-01-01", "2024-01-31"),
                            "Calendar dimension", {"layer": "silver"})
    cat = datasets.refresh(spark, [spec], scratch_path(spark, "t_datasets"))
    meta = cat.describe("silver.calendar")
    assert meta["comment"] == "Calendar dimension" and meta["properties"] == {"layer": "silver"}
    assert cat.read("silver.calendar").count() == 31


def test_bounded_cdr_dedup_matches_on_fixture(spark):
    """Duplicates in the fixture arrive together, so the bounded dedup keeps the
    same rows as the unbounded one."""
    land = sq.Landing(spark, SF_SMALL)
    a, b = scratch_path(spark, "t_dedup_a"), scratch_path(spark, "t_dedup_b")
    runner.sink(runner.silver_cdr_stream(land.bronze_cdr()), a, f"{a}.__checkpoint")
    runner.sink(runner.silver_cdr_stream(land.bronze_cdr(), bounded=True), b, f"{b}.__checkpoint")
    ka = sorted(r.call_id for r in spark.read.parquet(a).select("call_id").collect())
    kb = sorted(r.call_id for r in spark.read.parquet(b).select("call_id").collect())
    assert ka == kb and len(ka) > 0


def test_expectation_listener_totals(spark):
    import time
    from reconlake.streaming.metrics import ExpectationListener
    listener = ExpectationListener()
    spark.streams.addListener(listener)
    try:
        land = sq.Landing(spark, SF_SMALL)
        out = scratch_path(spark, "t_listener")
        runner.sink(runner.silver_cdr_stream(land.bronze_cdr()), out, f"{out}.__checkpoint")
        for _ in range(50):                      # listener events arrive asynchronously
            if listener.snapshot().get("cdr_expectations"):
                break
            time.sleep(0.1)
        totals = listener.snapshot()["cdr_expectations"]
        assert totals["valid_call_id_passed"] > 0
        assert totals["good_data_quality_failed"] > 0
    finally:
        spark.streams.removeListener(listener)


def test_declared_target_reads_empty(spark):
    target = scratch_path(spark, "t_declare")
    ddl = "call_id string, silver_processing_time timestamp, timestamp_parsed timestamp, v int"
    schema = spark.createDataFrame([], ddl).schema
    upsert.declare(spark, target, schema)
    snap = upsert.read_snapshot(spark, target, ["call_id"], "silver_processing_time")
    assert snap.count() == 0 and set(snap.columns) == {"call_id", "silver_processing_time", "timestamp_parsed", "v"}
    upsert.declare(spark, target, schema)        # idempotent
    assert upsert.manifest(spark, target)[0] == 0


def test_compaction_policy(spark):
    target = scratch_path(spark, "t_policy")
    ddl = "call_id string, silver_processing_time timestamp, timestamp_parsed timestamp, v int"
    t = dt.datetime(2024, 2, 1)
    for i in range(3):
        upsert.write_batch(spark.createDataFrame([("A", t + dt.timedelta(days=i), t, i)], ddl), i, target)
    keys, seq = ["call_id"], "silver_processing_time"
    assert upsert.maybe_compact(spark, target, keys, seq, max_deltas=3) is None
    assert upsert.maybe_compact(spark, target, keys, seq, max_deltas=2) == 0
    assert upsert.manifest(spark, target)[1]["folded"] == 2
    assert _snap_rows(upsert.read_snapshot(spark, target, keys, seq)) == [("A", 2)]


def test_failed_stream_stops_its_siblings(spark):
    """A fail rule aborts its stream; streams started with it are stopped too."""
    import pytest
    from conftest import CDR_DDL, cdr_row
    from reconlake.functions import clean
    from reconlake.operators import expectations
    src = scratch_path(spark, "t_fail_src")
    spark.createDataFrame([cdr_row(ts="2999-01-01T00:00:00.000000")], CDR_DDL).write.parquet(src)
    stream = clean.clean_cdr(spark.readStream.schema(CDR_DDL).parquet(src))
    bad = expectations.apply(stream, expectations.CDR_RULES)
    land = sq.Landing(spark, SF_SMALL)
    ok_out, bad_out = scratch_path(spark, "t_ok"), scratch_path(spark, "t_bad")
    q_bad = runner.start(bad, bad_out, f"{bad_out}.__checkpoint")
    q_ok = runner.start(land.bronze_cdr(), ok_out, f"{ok_out}.__checkpoint")
    with pytest.raises(Exception, match="no_future_dates"):
        runner.wait(q_bad, q_ok)
    assert not q_bad.isActive and not q_ok.isActive


def test_flows_without_state_take_all_new_files_in_one_batch(spark):
    """A merge copies the cells that it touches: by hundreds of files it would copy them again and again."""
    from pyspark.sql.types import StructType

    from reconlake.plans import datasets
    frame, asked = spark.createDataFrame([], "timestamp_parsed timestamp"), []

    class Streams:
        def read_stream(self, name, max_files=datasets.MAX_FILES):
            asked.append(max_files)
            return frame

    specs = datasets.medallion("c", StructType([]), "e", StructType([]), ("2024-01-01", "2024-01-31"))
    flows = [d for d in specs if d.kind == datasets.SCD1 or d.name.startswith("gold.quarantine")]
    for d in flows:
        d.build(Streams())
    assert len(flows) == 4 and asked == [None] * 4


def test_state_is_written_without_a_lookup_to_count_it(spark):
    from reconlake.session import ensure_session
    conf = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    assert ensure_session(spark).conf.get(conf) == "false"


def _progress(spark, rows, name):
    out = scratch_path(spark, name)
    return runner.sink(rows, out, f"{out}.__checkpoint").recentProgress[-1]["stateOperators"][0]


def test_state_lies_in_a_few_partitions_for_each_core(spark):
    """Each micro-batch opens the store of every partition: their number follows the cores, not the shuffles."""
    from reconlake.session import PARTITIONS
    src, before = scratch_path(spark, "t_state_src"), spark.conf.get(PARTITIONS)
    spark.range(20).write.parquet(src)
    cores = spark.sparkContext.defaultParallelism
    try:
        for asked, got in ((2 * cores + 3, 2 * cores), (1, 1)):
            spark.conf.set(PARTITIONS, str(asked))
            rows = spark.readStream.schema("id long").parquet(src).dropDuplicates(["id"])
            assert _progress(spark, rows, "t_state")["numShufflePartitions"] == got
            assert spark.conf.get(PARTITIONS) == str(asked)
    finally:
        spark.conf.set(PARTITIONS, before)


def test_a_join_keeps_one_store_per_partition(spark):
    base = scratch_path(spark, "t_stores")
    sides = []
    for name, frame in zip("ce", frames(spark, [cdr_row()], [edr_row()]), strict=True):
        frame.write.parquet(f"{base}/{name}")
        sides.append(spark.readStream.schema(frame.schema).parquet(f"{base}/{name}"))
    state = _progress(spark, runner.reconcile_stream(*sides, calendar_dim.build(spark, "2024-01-01", "2024-01-31"), 31), "t_stores")
    assert state["numStateStoreInstances"] == state["numShufflePartitions"]


def test_settings_of_streams_are_taken_back_when_a_start_fails(spark):
    import pytest
    from reconlake.plans.gold_stream import JOIN_STATE
    from reconlake.session import PARTITIONS, stream_state
    before = {k: spark.conf.get(k) for k in (PARTITIONS, *JOIN_STATE)}
    with pytest.raises(RuntimeError), stream_state(spark, JOIN_STATE):
        assert {k: spark.conf.get(k) for k in JOIN_STATE} == JOIN_STATE
        raise RuntimeError
    assert {k: spark.conf.get(k) for k in before} == before


def test_the_join_is_admitted_the_columns_that_it_reads(spark, monkeypatch):
    """The rest of the silver columns are not written again for the join; the match needs no other."""
    from types import SimpleNamespace

    from pyspark.sql.types import StructType

    from reconlake.operators import reconcile
    from reconlake.plans import datasets, gold_stream
    cdr, edr = frames(spark, [cdr_row(), cdr_row(call_id=None)], [edr_row(), edr_row(session_id="S", msisdn=None)])
    silver, got = {"silver.cdr_staging": cdr, "silver.edr_staging": edr}, {}

    class Flow:
        def __init__(self, table, source, *rest):
            got["schemas"] = source.sides

        def refresh(self, usage, charges):
            got["rows"] = usage, charges
            return 0

    monkeypatch.setattr(gold_stream, "GoldStream", Flow)
    specs = datasets.medallion("c", StructType([]), "e", StructType([]), ("2024-01-01", "2024-01-31"))
    cat = SimpleNamespace(spark=spark, root="r", keyed=lambda name: None, schema=lambda name: silver[name].schema,
                          read_stream=lambda name, max_files: silver[name])
    next(d for d in specs if d.name == "gold.reconciliation_detail").fold(cat, SimpleNamespace(version=lambda: 0))
    assert [d.columns for d in got["rows"]] == [reconcile.CDR_IN, reconcile.EDR_IN]
    assert [s.names for s in got["schemas"].values()] == [reconcile.CDR_IN, reconcile.EDR_IN]
    assert len(reconcile.CDR_IN) < len(cdr.columns) and len(reconcile.EDR_IN) < len(edr.columns)
    same = [sorted(map(str, reconcile.match(*pair).collect())) for pair in ((cdr, edr), got["rows"])]
    assert same[0] == same[1]
