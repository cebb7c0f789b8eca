"""Structured Streaming flows over the same frame functions as the batch path.

Each flow is ``readStream`` -> functions from ``sources``/``functions``/
``operators`` -> ``writeStream`` to Parquet with a checkpoint, started with
``trigger(availableNow=True)`` (process what has landed, in bounded
micro-batches, then stop), so a scheduled job gets incremental, exactly-once
processing and restarts from its checkpoint after a failure.

Flows:
* ``bronze_cdr`` / ``bronze_edr``: file stream and table stream -> bronze table.
* ``silver_cdr`` / ``silver_edr``: streaming dedup (first arrival wins; state
  per key) + expectations -> staging log (append-only).
* ``reconcile``: stream-stream full outer interval join with a 1 h watermark on
  both inputs, stream-static calendar join, classification -> gold detail.
  Rows with a NULL event time would never leave the join state, so they are
  diverted to a quarantine sink before the join.
* upsert: ``streaming/upsert.py`` (``foreachBatch`` into a merge-on-read
  keyed table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reconlake.functions import classify, clean
from reconlake.operators import expectations, reconcile
from reconlake.session import stream_state
from reconlake.sources import ingest

# Watermark delays of the join inputs and of the charge dedup.
WATERMARK = "1 hour"
EDR_DEDUP_WATERMARK = "1 day"


def start(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
          query_name: str | None = None) -> StreamingQuery:
    """Start an append to a Parquet table with ``availableNow``."""
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    with stream_state(df.sparkSession):
        return w.start(path)


def wait(*queries: StreamingQuery) -> None:
    """Wait for ``availableNow`` queries started together. If one fails, the
    others are stopped (none is left running) and the first failure raised."""
    failure = None
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as err:  # noqa: BLE001 - re-raised below
            failure = failure or err
            for other in queries:
                if other.isActive:
                    other.stop()
    if failure is not None:
        raise failure
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def sink(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
         query_name: str | None = None) -> StreamingQuery:
    """Append to a Parquet table with ``availableNow`` and wait for the end."""
    q = start(df, path, checkpoint, partition_by, query_name)
    wait(q)
    return q


# --- bronze -------------------------------------------------------------------------

def bronze_cdr_stream(spark: SparkSession, landing: str, schema: StructType, max_files: int = 100,
                      hints: str | None = None) -> DataFrame:
    """Usage file stream over ``landing/*/*`` (date folders) -> bronze columns.
    ``_metadata.file_path`` gives the lineage and the path date. ``schema`` is
    what the files hold; with ``hints`` the hinted columns are then cast
    (``ingest.rescue``: values that do not cast go to ``_rescued_data``)."""
    src = ingest.stream_files(spark, f"{landing.rstrip('/')}/*/*", schema, max_files=max_files)
    src = src.select("*", F.col(ingest.FILE_PATH).alias("__path"))
    if hints:
        src = ingest.rescue(src, hints)
    return ingest.bronze_cdr(src, path_col="__path")


def bronze_cdr_shape(spark: SparkSession, schema: StructType, hints: str) -> DataFrame:
    """Usage bronze without rows, for files that hold ``schema``."""
    empty = spark.createDataFrame([], schema.add("__path", "string") if "__path" not in schema.names else schema)
    return ingest.bronze_cdr(ingest.rescue(empty, hints), path_col="__path")


def bronze_cdr_mixed(spark: SparkSession, landing: str, schema: StructType, hints: str, target: str,
                     checkpoint: str, max_files: int = 100, rescue_extra: bool = False) -> StreamingQuery:
    """Usage bronze for a landing whose files differ in physical types. The stream
    is one of file names (at most ``max_files`` per batch); each batch's files are
    read by ``ingest.read_mixed`` and written to a folder of the batch's own, so a
    replay replaces it. Columns outside ``schema`` go to ``_rescued_data`` with
    ``rescue_extra``, else they are left out."""
    shape = bronze_cdr_shape(spark, StructType(list(schema.fields)), hints).schema
    names = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", max_files).load(f"{landing.rstrip('/')}/*/*").select("path"))

    def each(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.collect())         # at most max_files
        if files:
            rows = ingest.read_mixed(batch.sparkSession, files, hints, schema if rescue_extra else None, types=schema)
            ingest.conform(ingest.bronze_cdr(rows, path_col="__path"), shape).write.mode("overwrite").parquet(
                f"{target}/batch={batch_id}")

    q = (names.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    wait(q)
    return q


def bronze_edr_stream(spark: SparkSession, table: str, schema: StructType, max_files: int = 100) -> DataFrame:
    src = ingest.stream_table(spark, table, schema, max_files=max_files)
    return ingest.bronze_edr(src.select("*", F.col(ingest.FILE_PATH).alias("__path")), path_col="__path")


# --- silver -------------------------------------------------------------------------

CDR_DEDUP_WATERMARK = "1 day"


def valid(rows: DataFrame, rules: list, validate_first: bool) -> DataFrame:
    """With ``validate_first`` the drop rules come before the dedup too: an invalid
    first arrival can't shadow a valid one, and rows without a key don't pile up in
    one state partition."""
    return expectations.apply(rows, [r for r in rules if r.action == expectations.DROP]) if validate_first else rows


def silver_cdr_stream(bronze: DataFrame, bounded: bool = False, validate_first: bool = False) -> DataFrame:
    """Enrich, stream dedup on (call_id, msisdn, service_type), finish,
    expectations. Default: no watermark, state kept for every key (the
    reference). ``bounded=True``: duplicates are only removed within a 1 day
    event-time watermark and their state is then dropped, so state stays
    proportional to one day of traffic."""
    rows = valid(clean.enrich_cdr(bronze), expectations.CDR_RULES, validate_first)
    keys = ["call_id", "msisdn", "service_type"]
    if bounded:
        rows = rows.withWatermark("timestamp_parsed", CDR_DEDUP_WATERMARK).dropDuplicatesWithinWatermark(keys)
    else:
        rows = rows.dropDuplicates(keys)
    rows = clean.finish_cdr(rows)
    return expectations.apply(expectations.observe(rows, expectations.CDR_RULES, "cdr_expectations"),
                              expectations.CDR_RULES)


def silver_edr_stream(bronze: DataFrame, bounded: bool = False, validate_first: bool = False) -> DataFrame:
    """Enrich, dedup on session_id after a 1 day watermark, expectations.

    With ``bounded=False`` (the reference) the watermark does not bound the
    dedup state because the event time is not a key; ``bounded=True`` uses
    ``dropDuplicatesWithinWatermark``: state expires, late duplicates drop."""
    rows = valid(clean.clean_edr(bronze), expectations.EDR_RULES, validate_first).withWatermark("timestamp_parsed", EDR_DEDUP_WATERMARK)
    rows = rows.dropDuplicatesWithinWatermark(["session_id"]) if bounded else rows.dropDuplicates(["session_id"])
    return expectations.apply(expectations.observe(rows, expectations.EDR_RULES, "edr_expectations"),
                              expectations.EDR_RULES)


# --- gold ---------------------------------------------------------------------------

def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an event time, rows without one)."""
    has = F.col("timestamp_parsed").isNotNull()
    return df.where(has), df.where(~has)


def reconcile_stream(cdr: DataFrame, edr: DataFrame, cal: DataFrame, cal_days: int | None = None,
                     watermark: str = WATERMARK) -> DataFrame:
    """Stream-stream full outer interval join (state bounded by the watermarks
    and the 15 min range), then the static calendar join and classification."""
    c = cdr.withWatermark("timestamp_parsed", watermark)
    e = edr.withWatermark("timestamp_parsed", watermark)
    rec = reconcile.match(c, e, strategy="fullouter")
    rec = reconcile.calendar_join(rec, cal, cal_days)
    return classify.derive(rec)


# --- upsert: see streaming/upsert.py (merge-on-read keyed table) ------------------
