"""Query keys that run streams or write files, then return the batch read of
what was written. Each run writes under a fresh directory below the shared
checkpoint root (``session.scratch_path``).

The fixture rows are first laid out as the capture tools would (date-foldered
usage files, an append-only charge table); the streams then read those files,
so the work grows with the testdata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import calendar_dim
from reconlake.operators import layout, reconcile
from reconlake.plans import pipeline as pl
from reconlake.plans.queries import _cdr_versions, _out
from reconlake.session import ensure_session, scratch_path
from reconlake.sources import fixtures, ingest, landing
from reconlake.streaming import runner, upsert


class Landing:
    """Capture files for one testdata directory, written once per instance."""

    def __init__(self, spark: SparkSession, sf: str, later: tuple[str, str] | None = None, files: int | None = None):
        """``later``: conditions on usage and charge rows that come with ``deliver_later`` only;
        ``files``: files per date and delivery."""
        self.spark = ensure_session(spark)
        self.sf = sf
        self.root = scratch_path(self.spark, "landing")
        self.cdr_dir = f"{self.root}/cdr-events"
        self.edr_dir = f"{self.root}/edr-events"
        raw = fixtures.cdr_raw(self.spark, sf)
        cap = raw.withColumn("partition_date", ingest.partition_date(F.col("source_path"))).drop("source_path")
        edr = fixtures.edr_raw(self.spark, sf).drop("source_path")
        self._later = [(d, F.coalesce(F.expr(c), F.lit(False))) for d, c in zip((cap, edr), later, strict=True)] if later else []
        self._files = files
        first = [d.where(~c) for d, c in self._later] or [cap, edr]
        landing.write_capture(first[0], self.cdr_dir, files=files)
        landing.write_table(first[1].repartition(files) if files else first[1], self.edr_dir, mode="overwrite")
        self.cdr_schema = cap.drop("partition_date").schema
        self.edr_schema = self.spark.read.parquet(self.edr_dir).schema

    def deliver_later(self) -> None:
        (cap, cdr_later), (edr, edr_later) = self._later
        landing.write_capture(cap.where(cdr_later), self.cdr_dir, mode="append", files=self._files)
        landing.write_table(edr.where(edr_later), self.edr_dir)

    def bronze_cdr(self) -> DataFrame:
        return runner.bronze_cdr_stream(self.spark, self.cdr_dir, self.cdr_schema)

    def bronze_edr(self) -> DataFrame:
        return runner.bronze_edr_stream(self.spark, self.edr_dir, self.edr_schema)


def _run(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    out = scratch_path(spark, name)
    runner.sink(df, out, f"{out}.__checkpoint", partition_by)
    return out


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def bronze_cdr_stream(spark, sf):
    land = Landing(spark, sf)
    out = _run(land.spark, land.bronze_cdr(), "bronze_cdr")
    return _out(_read(land.spark, out)).drop("bronze_source_file")


def mixed_landing(spark, sf) -> tuple[Landing, str]:
    """The usage capture with a third of its files as they are, a third with the
    volume and the (unhinted) sequence number as text, some of it no number, and a
    third with a column more."""
    land = Landing(spark, sf)
    rows = land.spark.read.schema(land.cdr_schema).parquet(f"{land.cdr_dir}/*/*")
    text = F.when(F.col("sequence_number") % 97 == 0, F.lit("n/a")).otherwise(F.col("volume").cast("string"))
    number = F.when(F.col("sequence_number") % 89 == 0, F.concat(F.lit("no. "), F.col("sequence_number"))).otherwise(
        F.col("sequence_number").cast("string"))
    root = f"{land.root}/mixed"
    for part, frame in enumerate((rows, rows.withColumn("__n", F.col("sequence_number")).withColumns(
                                      {"volume": text, "sequence_number": number}),
                                  rows.withColumn("vendor_flag", F.concat(F.lit("v"), F.col("PartitionId"))))):
        own = F.col("__n") if "__n" in frame.columns else F.col("sequence_number")
        frame.where(own % 3 == part).drop("__n").write.parquet(f"{root}/2024-01-0{part + 1}")
    return land, root


def bronze_mixed_files(spark, sf):
    """One bronze table from files of three physical schemas, with what was rescued."""
    land, root = mixed_landing(spark, sf)
    out = scratch_path(land.spark, "bronze_mixed")
    runner.bronze_cdr_mixed(land.spark, root, land.cdr_schema, ingest.CDR_HINTS, out, f"{out}.__checkpoint",
                            max_files=2, rescue_extra=True)
    rows = land.spark.read.option("recursiveFileLookup", "true").parquet(out)
    return rows.select("call_id", "msisdn", "volume", "sequence_number", "_rescued_data")


def bronze_lineage(spark, sf):
    land = Landing(spark, sf)
    b = _read(land.spark, _run(land.spark, land.bronze_cdr(), "bronze_lineage"))
    folder = F.concat(F.lit("/"), F.date_format("partition_date", "yyyy-MM-dd"), F.lit("/"))
    has = F.coalesce(F.instr("bronze_source_file", folder) > 0, F.lit(False))
    return b.select("call_id", "partition_date", has.alias("path_has_date"),
                    F.col("bronze_source_file").endswith(".parquet").alias("is_parquet"))


def bronze_edr_stream(spark, sf):
    land = Landing(spark, sf)
    out = _run(land.spark, land.bronze_edr(), "bronze_edr")
    return _out(_read(land.spark, out)).drop("bronze_source_file")


def dedup_cdr_stream(spark, sf):
    land = Landing(spark, sf)
    out = _run(land.spark, runner.silver_cdr_stream(land.bronze_cdr()), "dedup_cdr")
    return _out(_read(land.spark, out)).drop("bronze_source_file")


def dedup_edr_stream(spark, sf):
    land = Landing(spark, sf)
    out = _run(land.spark, runner.silver_edr_stream(land.bronze_edr()), "dedup_edr")
    return _out(_read(land.spark, out)).drop("bronze_source_file")


def dedup_edr_bounded(spark, sf):
    land = Landing(spark, sf)
    out = _run(land.spark, runner.silver_edr_stream(land.bronze_edr(), bounded=True), "dedup_edr_bounded")
    return _out(_read(land.spark, out)).drop("bronze_source_file")


def _by_index(spark, sf, side: str) -> DataFrame:
    """Staging rows of two deliveries through the key index, the second with files that repeat the first's."""
    from reconlake.plans import datasets
    land = Landing(spark, sf, later=LATER)
    spark = land.spark
    specs = datasets.medallion(land.cdr_dir, land.cdr_schema, land.edr_dir, land.edr_schema, ("2024-01-01", "2024-01-31"),
                               dedup="index")
    bronze, staging = (f"bronze.{side}_events", f"silver.{side}_staging")
    own = [d for d in specs if d.name in (bronze, staging)]
    root = scratch_path(spark, f"dedup-{side}")
    datasets.refresh(spark, own, root)
    land.deliver_later()
    again = _read(spark, f"{land.cdr_dir}/*/*" if side == "cdr" else land.edr_dir).limit(50)
    again.write.mode("append").parquet(f"{land.cdr_dir}/undated" if side == "cdr" else land.edr_dir)
    cat = datasets.refresh(spark, own, root)
    return _out(cat.read(staging))


def dedup_cdr_index(spark, sf):
    return _by_index(spark, sf, "cdr").select("call_id", "msisdn", "service_type")


def dedup_edr_index(spark, sf):
    return _by_index(spark, sf, "edr").drop("bronze_source_file")


SENTINEL_CALL = "CALL-SENTINEL-000"
SENTINEL_MSISDN = "+35899999999"


def land_flush_pair(land: Landing) -> str:
    """Land one usage record and its charge two days after the latest event
    time found in the capture files: a control pair that moves both join
    watermarks past every real row, so the next run flushes the rows still
    waiting for a partner. It enters where data enters (the capture files, not
    the sink-managed tables downstream), passes every rule (valid ids, a time
    in the past) and falls on a date that no real row has (charges follow usage
    within minutes). Returns that date."""
    spark = land.spark
    ts = F.to_timestamp(F.col("timestamp"))
    latest = (spark.read.schema(land.cdr_schema).parquet(f"{land.cdr_dir}/*/*")
                   .agg(F.max(ts).alias("t")).first()["t"])
    at = F.lit(latest).cast("timestamp") + F.expr("INTERVAL 2 DAYS")
    iso = F.date_format(at, fixtures.ISO_FMT)
    day = F.date_format(at, "yyyy-MM-dd")
    cdr = (spark.read.schema(land.cdr_schema).parquet(f"{land.cdr_dir}/*/*").limit(1)
                .withColumns({"call_id": F.lit(SENTINEL_CALL), "msisdn": F.lit(SENTINEL_MSISDN),
                              "timestamp": iso}))
    folder = cdr.select(day.alias("d")).first()["d"]
    cdr.write.mode("append").parquet(f"{land.cdr_dir}/{folder}")
    edr = (spark.read.schema(land.edr_schema).parquet(land.edr_dir).limit(1)
                .withColumns({"session_id": F.lit("SESSION-SENTINEL-000"), "cdr_call_id": F.lit(SENTINEL_CALL),
                              "msisdn": F.lit(SENTINEL_MSISDN),
                              "timestamp": F.date_format(at + F.expr("INTERVAL 1 MINUTE"), fixtures.ISO_FMT)}))
    edr.write.mode("append").parquet(land.edr_dir)
    return folder


def reconcile_stream(spark, sf):
    """capture files (plus a flush pair) -> silver staging streams -> gold
    stream, each with ``availableNow``. The pair is processed with the data;
    the closing no-data batch then sees the watermark past every real row and
    flushes the outer rows. The pair itself is left out of the result.
    (Restart from checkpoint is tested in tests/test_streaming.py.)"""
    land = Landing(spark, sf)
    spark = land.spark
    land_flush_pair(land)
    c_dir, e_dir = scratch_path(spark, "cdr_staging"), scratch_path(spark, "edr_staging")
    runner.wait(runner.start(runner.silver_cdr_stream(land.bronze_cdr()), c_dir, f"{c_dir}.__checkpoint"),
                runner.start(runner.silver_edr_stream(land.bronze_edr()), e_dir, f"{e_dir}.__checkpoint"))
    years = pl.years_of(spark, sf)
    out = scratch_path(spark, "gold_detail")
    cdr = spark.readStream.schema(_read(spark, c_dir).schema).parquet(c_dir)
    edr = spark.readStream.schema(_read(spark, e_dir).schema).parquet(e_dir)
    cdr, cdr_bad = runner.quarantine(cdr)
    edr, edr_bad = runner.quarantine(edr)
    gold = runner.reconcile_stream(cdr, edr, calendar_dim.build(spark, *years),
                                   reconcile.calendar_days(*years))
    runner.wait(runner.start(cdr_bad, f"{out}.__quarantine_cdr", f"{out}.__quarantine_cdr.__checkpoint"),
                runner.start(edr_bad, f"{out}.__quarantine_edr", f"{out}.__quarantine_edr.__checkpoint"),
                runner.start(gold, out, f"{out}.__checkpoint"))
    detail = _read(spark, out).where(F.coalesce(F.col("call_id"), F.lit("")) != SENTINEL_CALL)
    return _out(detail)


def scd1_stream(spark, sf):
    """Two deliveries through the streaming upsert (foreachBatch deltas of a
    merge-on-read table), with a compaction between them; the snapshot (base +
    delta) must equal the batch SCD1 of both."""
    spark = ensure_session(spark)
    v1, v2 = _cdr_versions(spark, sf)
    src = scratch_path(spark, "scd_source")
    target = scratch_path(spark, "scd_target")
    ckpt = f"{target}.__checkpoint"
    v1.write.mode("overwrite").parquet(src)
    schema = _read(spark, src).schema

    def run():
        upsert.upsert_stream(spark.readStream.schema(schema).parquet(src), target, ckpt)

    run()
    upsert.compact(spark, target, pl.CDR_KEYS, pl.SEQUENCE)
    v2.write.mode("append").parquet(src)
    run()
    snap = upsert.read_snapshot(spark, target, pl.CDR_KEYS, pl.SEQUENCE)
    return _out(snap.select("call_id", "expected_charge", "expected_charge_decimal", "status", "timestamp_parsed"))


def medallion_summary(spark, sf):
    """The dataset list refreshed end to end over the capture files, twice.
    Run 1: bronze and silver streams, upsert targets, calendar, the streaming
    gold detail (matched pairs and outer rows the watermark has passed) and
    the summary built whole. Run 2, after a flush pair lands in the capture
    files: the watermark passes every real row, the remaining outer rows are
    flushed, and the summary recomputes only the dates that received rows.
    The result must equal the batch summary."""
    from reconlake.plans import datasets
    land = Landing(spark, sf)
    spark = land.spark
    specs = datasets.medallion(land.cdr_dir, land.cdr_schema, land.edr_dir, land.edr_schema,
                               pl.years_of(spark, sf), money_scale=4, buckets=2)
    root = scratch_path(spark, "medallion")
    datasets.refresh(spark, specs, root)
    control = land_flush_pair(land)
    cat = datasets.refresh(spark, specs, root)
    # without the control pair's own date
    return cat.read("gold.reconciliation_summary").where(F.col("business_date") != F.lit(control).cast("date"))


LATER = ("sequence_number % 7 = 3", "CAST(substring(session_id, 9, 12) AS BIGINT) % 5 = 2")


def reconcile_stream_late(spark, sf):
    """The pipeline's gold detail when a part of the usage and charges lands late, in more
    files than a micro-batch takes: run 1 without them, run 2 with them and the flush pair.
    Its join gets the rows in order of time, in groups of about 80 files; what is behind
    the watermark is matched in batch. The result must equal the batch detail."""
    from reconlake.plans import datasets
    land = Landing(spark, sf, later=LATER, files=5)
    spark = land.spark
    specs = datasets.medallion(land.cdr_dir, land.cdr_schema, land.edr_dir, land.edr_schema, pl.years_of(spark, sf),
                               money_scale=4, max_files=80, buckets=1, dedup="index")[:-1]
    root = scratch_path(spark, "medallion-late")
    datasets.refresh(spark, specs, root)
    land.deliver_later()
    land_flush_pair(land)
    cat = datasets.refresh(spark, specs, root)
    detail = cat.read("gold.reconciliation_detail")
    return _out(detail.where(F.coalesce(F.col("call_id"), F.lit("")) != SENTINEL_CALL))


# --- layout ---------------------------------------------------------------------------

def layout_clustered(spark, sf):
    p = pl.Pipeline(ensure_session(spark), sf)
    path = scratch_path(p.spark, "clustered")
    layout.cluster_write(p.cdr(), path, ["call_id", "msisdn"])
    return _read(p.spark, path).select("call_id", "msisdn", "service_type")


def _written_detail(p: pl.Pipeline, name: str) -> str:
    path = scratch_path(p.spark, name)
    layout.write_partitioned(_out(p.detail()), path, "business_date")
    return path


def fragmented_detail(spark, sf) -> tuple[str, str]:
    """A detail table that was appended to in parts, and its date with most rows."""
    p = pl.Pipeline(ensure_session(spark), sf)
    path = _written_detail(p, "detail_table")
    rows = _read(p.spark, path)
    parts = scratch_path(p.spark, "detail_parts")
    for part in range(3):
        mine = rows.where(F.pmod(F.xxhash64("call_id", "session_id"), F.lit(3)) == part)
        mine.hint("rebalance", "business_date").write.mode("append").partitionBy("business_date").parquet(parts)
    day = rows.groupBy("business_date").count().orderBy(F.desc("count"), "business_date").first()["business_date"]
    return parts, str(day)


def layout_compacted(spark, sf):
    """The table after its largest date was compacted and swapped in."""
    path, day = fragmented_detail(spark, sf)
    layout.compact(spark, path, "business_date", day)
    return _read(spark, path).select("business_date", "call_id", "session_id", "mismatch_type")


PRUNED_DAYS = (2, 9, 16)               # after the first date of the detail


def partition_pruned_read(spark, sf):
    p = pl.Pipeline(ensure_session(spark), sf)
    path = _written_detail(p, "detail_pruned")
    rows = _read(p.spark, path)
    first = rows.agg(F.min("business_date").alias("d")).first()["d"]
    days = [F.date_add(F.lit(first).cast("date"), n) for n in PRUNED_DAYS]
    return rows.where(F.col("business_date").isin(*days)).groupBy("business_date").agg(
        F.count(F.lit(1)).alias("record_count"))


STREAM_QUERIES = {
    "bronze_cdr_stream": bronze_cdr_stream,
    "bronze_edr_stream": bronze_edr_stream,
    "bronze_lineage": bronze_lineage,
    "bronze_mixed_files": bronze_mixed_files,
    "dedup_cdr_stream": dedup_cdr_stream,
    "dedup_edr_stream": dedup_edr_stream,
    "dedup_edr_bounded": dedup_edr_bounded,
    "dedup_cdr_index": dedup_cdr_index,
    "dedup_edr_index": dedup_edr_index,
    "reconcile_stream": reconcile_stream,
    "reconcile_stream_late": reconcile_stream_late,
    "scd1_stream": scd1_stream,
    "medallion_summary": medallion_summary,
    "layout_clustered": layout_clustered,
    "layout_compacted": layout_compacted,
    "partition_pruned_read": partition_pruned_read,
}
