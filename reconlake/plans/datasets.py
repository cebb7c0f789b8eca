"""The medallion pipeline as named datasets, run in the order listed.

A ``Dataset`` names a table under a root folder, says how it is produced and
carries the table's comment, properties and partition columns (kept in a
``_table.json`` beside the data). Kinds:

* ``streaming_table``: an append flow, run with ``trigger(availableNow=True)``
  and its own checkpoint, so each refresh processes only new input;
* ``scd1``: a keyed target declared apart from its flow (created empty with
  its schema), fed by the staging stream; with a partition column (the business
  date) a table in cells with a change log (``streaming/keyed.py``), else the
  merge-on-read upsert;
* ``delta_view``: a table in cells (``streaming/cells.py``) that ``fold`` brings up
  to date from what its sources log; its state says what is folded in, so a run
  that stopped anywhere is caught up by the next one. No clock is involved.
* ``materialized_view``: recomputed in batch and overwritten;

There is no dependency resolution: the list is ordered by hand, as a
declarative pipeline's graph would order it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reconlake.functions import calendar_dim, classify, clean
from reconlake.operators import expectations, incremental, layout, reconcile, summary
from reconlake.plans import gold_stream
from reconlake.plans import pipeline as pl
from reconlake.sources import ingest
from reconlake.streaming import keyindex, metrics, runner, upsert
from reconlake.streaming.cells import CellTable
from reconlake.streaming.keyed import KeyedTable
from reconlake.streaming.ordered import OrderedInput

STREAMING, SCD1, VIEW, DELTA = "streaming_table", "scd1", "materialized_view", "delta_view"


@dataclass
class Dataset:
    name: str
    kind: str
    build: Callable[["Catalog"], DataFrame]
    comment: str = ""
    properties: dict = field(default_factory=dict)
    partition_cols: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)          # scd1 only
    sequence_by: str = pl.SEQUENCE                          # scd1 only
    max_deltas: int = 32                                    # scd1 only: compact beyond this many deltas
    except_cols: tuple[str, ...] = ()                       # scd1 only: columns of the flow that the table leaves out
    buckets: int = 4                                        # scd1 with a partition column only: key buckets
    fold: Callable[["Catalog", CellTable], int] | None = None            # delta only
    hidden: tuple[str, ...] = ()                                         # delta only: columns that readers don't see
    flow: Callable[["Catalog", str], StreamingQuery] | None = None       # streaming only: writes batch folders itself


# files that a stream of the pipeline with state, or from the landing, takes in at once
MAX_FILES = 100


class Catalog:
    """Dataset name -> folder under ``root``; reads and stream-reads by name."""

    def __init__(self, spark: SparkSession, root: str, specs: dict[str, Dataset] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.specs = specs or {}
        self.run_started = datetime.now(timezone.utc)      # zone-aware: the driver's zone doesn't matter

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def schema(self, name: str) -> StructType | None:
        """The schema stored by the last refresh (``_table.json``), if any."""
        path = f"{self.path(name)}._table.json"
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return None
        return StructType.fromJson(self.describe(name)["schema"])

    def read(self, name: str) -> DataFrame:
        spec = self.specs.get(name)
        if spec is not None and spec.kind == SCD1 and spec.partition_cols:
            return self.keyed(name).snapshot()
        if spec is not None and spec.kind == DELTA:
            return self.cells(name).read().drop(*spec.hidden)
        if spec is not None and spec.kind == SCD1:
            return upsert.read_snapshot(self.spark, self.path(name), spec.keys, spec.sequence_by,
                                        schema=self.schema(name))
        # Read with the stored schema: files written before a column was added
        # read it as NULL, and no footer has to be opened. Without one (a table
        # not written by ``refresh``), merge the footers' schemas.
        stored = self.schema(name)
        if stored is not None:
            return self.spark.read.options(**self._layout(name)).schema(stored).parquet(self.path(name))
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(name))

    def read_stream(self, name: str, max_files: int | None = MAX_FILES) -> DataFrame:
        """A stream of the table, at most ``max_files`` new files in a micro-batch; all of them with None. What
        keeps no state takes all: a merge copies the cells it touches, so it should touch them once a run."""
        reader = self.spark.readStream.options(**self._layout(name)).schema(self.schema(name) or self.read(name).schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path(name))

    def keyed(self, name: str, schema: StructType | None = None) -> KeyedTable:
        """The partitioned upsert target ``name``."""
        spec = self.specs[name]
        return KeyedTable(self.spark, self.path(name), schema or self.schema(name), spec.keys, spec.sequence_by,
                          spec.partition_cols[0], spec.buckets)

    def cells(self, name: str, schema: StructType | None = None) -> CellTable:
        """The table in cells of the delta view ``name``."""
        return CellTable(self.spark, self.path(name), schema or self.schema(name), self.specs[name].partition_cols)

    def counts_path(self, name: str) -> str:
        return f"{self.root}/_metrics/batches/{name}"

    def rule_counts(self, name: str) -> DataFrame:
        """(rule, action, passed, failed) of a staging table with a key index, each batch counted once."""
        return keyindex.rule_counts(self.spark, self.counts_path(name))

    def _layout(self, name: str) -> dict[str, str]:
        """A flow's batch folders are no partition column of its table."""
        spec = self.specs.get(name)
        return {"recursiveFileLookup": "true"} if spec is not None and spec.flow else {}

    def describe(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.path(name)}._table.json", wholetext=True).first()[0])


def _write_meta(cat: Catalog, ds: Dataset, df: DataFrame) -> None:
    meta = {"name": ds.name, "kind": ds.kind, "comment": ds.comment, "properties": ds.properties,
            "partition_cols": ds.partition_cols, "schema": json.loads(df.schema.json())}
    cat.spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1) \
       .write.mode("overwrite").text(f"{cat.path(ds.name)}._table.json")


METRICS_TABLE = "_metrics/expectations"


def _record_metrics(cat: Catalog, dataset: str, totals: dict[str, dict[str, int]]) -> None:
    """Append this run's expectation counts (rule, passed, failed) of one
    dataset to a small table, like a pipeline event log's quality records."""
    rows = []
    for observation, values in totals.items():
        rules = sorted({k.rsplit("_", 1)[0] for k in values})
        for rule in rules:
            rows.append((cat.run_started, dataset, observation, rule,
                         values.get(f"{rule}_passed", 0), values.get(f"{rule}_failed", 0)))
    if rows:
        (cat.spark.createDataFrame(rows, "run_started timestamp, dataset string, observation string, "
                                         "rule string, passed long, failed long")
            .coalesce(1).write.mode("append").parquet(f"{cat.root}/{METRICS_TABLE}"))


def refresh(spark: SparkSession, datasets: list[Dataset], root: str) -> Catalog:
    """Run every dataset once, in list order: streams to the end of their
    available input, upsert flows (then compaction if due), views. A failing
    stream (a fail rule) aborts the refresh, as a failed update would."""
    cat = Catalog(spark, root, {d.name: d for d in datasets})
    listener = metrics.ExpectationListener()
    spark.streams.addListener(listener)
    try:
        _refresh_all(cat, datasets, listener)
    finally:
        spark.streams.removeListener(listener)
    return cat


def _refresh_all(cat: Catalog, datasets: list[Dataset], listener: metrics.ExpectationListener) -> None:
    spark = cat.spark
    for ds in datasets:
        path = cat.path(ds.name)
        df = ds.build(cat)
        if ds.kind == STREAMING:
            if ds.flow:
                q = ds.flow(cat, path)
            else:
                q = runner.sink(df, path, f"{path}._checkpoint", ds.partition_cols or None)
            _record_metrics(cat, ds.name, listener.totals_of(q))
        elif ds.kind == SCD1:
            df = df.drop(*ds.except_cols)
            if ds.partition_cols:
                _write_meta(cat, ds, df)                     # declared before its flow
                cat.keyed(ds.name, df.schema).upsert_stream(df, f"{path}._checkpoint")
                continue
            upsert.declare(spark, path, df.schema)
            upsert.upsert_stream(df, path, f"{path}._checkpoint", ds.except_cols)
            upsert.maybe_compact(spark, path, ds.keys, ds.sequence_by, ds.max_deltas, cat.schema(ds.name))
        elif ds.kind == VIEW:
            if ds.partition_cols:
                # full recompute: replace every partition (a vanished date must go too)
                layout.write_partitioned(df, path, ds.partition_cols[0], dynamic=False)
            else:
                df.write.mode("overwrite").parquet(path)
        elif ds.kind == DELTA:
            ds.fold(cat, cat.cells(ds.name, df.schema))
        else:
            raise ValueError(f"unknown dataset kind {ds.kind!r}")
        _write_meta(cat, ds, df)


def fold_detail(table: CellTable, usage: KeyedTable, charges: KeyedTable,
                finish: Callable[[DataFrame], DataFrame], calendar: list[str],
                log: Callable[[DataFrame, DataFrame], object] | None = None) -> int:
    """Bring the detail up to the upsert targets' versions; what is folded in is kept with its version.
    ``log`` gets the detail rows that went and came (not of a first build)."""
    now, done = {"usage": usage.version(), "charges": charges.version(), "calendar": calendar}, table.state()
    if table.version() < 0 or done["calendar"] != calendar:
        return table.commit(incremental.rematched(usage.snapshot(now["usage"]), charges.snapshot(now["charges"]), finish),
                            None, now)
    if all(done[k] == now[k] for k in now):
        return table.version()
    keys = incremental.touched_keys(usage.changes(done["usage"], now["usage"]), charges.changes(done["charges"], now["charges"]))

    def build(keys: DataFrame) -> DataFrame:
        own = {c: c for c in incremental.MATCH_KEY}
        return incremental.rematched(usage.matching(keys, own, now["usage"]),
                                     charges.matching(keys, incremental.CHARGE_KEY, now["charges"]), finish)

    number = incremental.replace_keys(table, keys, build, now, log)
    usage.forget_changes(done["usage"])
    charges.forget_changes(done["charges"])
    return number


def medallion(landing_cdr: str, cdr_schema, landing_edr: str, edr_schema,
              calendar_range: tuple[str, str], money_scale: int | None = None,
              gold: str = "stream", cdr_hints: str | None = None, bounded: bool = False,
              validate_first: bool = False, mixed: bool = False, rescue_extra: bool = False,
              max_files: int = MAX_FILES, buckets: int = 4, dedup: str = "state") -> list[Dataset]:
    """The reference's datasets: bronze, silver staging, silver upsert targets,
    calendar, gold detail and gold summary.

    ``gold="stream"`` (default, as in the reference): the detail is a
    streaming table fed by the stream-stream full outer join over the staging
    logs (rows without event time go to quarantine tables), so each refresh
    matches only new rows; rows are final once both watermarks pass them. The
    summary recomputes only business dates whose detail cells changed since its last
    refresh.

    The join takes the staging rows in order of event time, in groups of slices of about
    ``max_files`` files, so that no group's watermark passes the rows of the next
    (``streaming/ordered.py``). Rows that land behind the watermark are kept as late rows,
    counted in the metrics table ("late_rows"), and their keys are matched in batch
    (``plans/gold_stream.py``).

    ``dedup="state"`` (as in the reference) removes repeated arrivals by operator state: for
    charges rows that are a day late are dropped there. ``dedup="index"`` looks keys up in files
    instead (``streaming/keyindex.py``): no state, nothing is dropped for being late, and rule
    counts are kept once per batch (``Catalog.rule_counts``).

    ``bounded`` and ``validate_first`` are passed to the silver streams. With
    ``mixed`` the usage files may differ in physical types (``runner.bronze_cdr_mixed``,
    which takes ``rescue_extra``).

    ``gold="batch"``: the detail follows the upsert targets, so updates to already
    reconciled rows are reflected. A refresh re-matches the keys of their change rows
    and replaces the dates concerned (``operators/incremental.py``); the summary
    recomputes those dates. A new calendar range rebuilds the detail."""
    days = reconcile.calendar_days(*calendar_range)
    money = money_scale is not None

    def finish(cat: Catalog) -> Callable[[DataFrame], DataFrame]:
        return lambda rec: classify.derive(reconcile.calendar_join(rec, cat.read("silver.calendar"), days))

    def detail_batch(cat: Catalog) -> DataFrame:
        return incremental.rematched(cat.read("silver.cdr_events_silver"), cat.read("silver.edr_events_silver"), finish(cat))

    def detail_fold(cat: Catalog, table: CellTable) -> int:
        return fold_detail(table, cat.keyed("silver.cdr_events_silver"), cat.keyed("silver.edr_events_silver"),
                           finish(cat), [str(d) for d in calendar_range])

    def summary_fold(cat: Catalog, table: CellTable) -> int:
        return incremental.refresh_summary(
            table, cat.cells("gold.reconciliation_detail"),
            lambda rows: summary.summarize_sql(cat.spark, rows, "reconciliation_detail", money=money))

    def detail_shape(cat: Catalog) -> DataFrame:
        return detail_batch(cat).withColumn(gold_stream.PART, F.lit(0).cast("long"))

    def detail_stream_fold(cat: Catalog, table: CellTable) -> int:
        sides = {gold_stream.USAGE: "silver.cdr_staging", gold_stream.CHARGES: "silver.edr_staging"}
        # the join's input is written and shuffled once more: only the columns that the match reads
        reads = {gold_stream.USAGE: reconcile.CDR_IN, gold_stream.CHARGES: reconcile.EDR_IN}
        staging = {k: cat.read_stream(v, None).select(*reads[k]) for k, v in sides.items()}
        source = OrderedInput(cat.spark, f"{cat.root}/gold/join_input", {k: d.schema for k, d in staging.items()})
        flow = gold_stream.GoldStream(
            table, source, cat.keyed("silver.cdr_events_silver"), cat.keyed("silver.edr_events_silver"),
            lambda cdr, edr: runner.reconcile_stream(cdr, edr, cat.read("silver.calendar"), days), finish(cat), max_files)
        late = flow.refresh(staging[gold_stream.USAGE], staging[gold_stream.CHARGES])
        if late:
            _record_metrics(cat, "gold.reconciliation_detail", {metrics.LATE: {f"{metrics.IN_TIME}_failed": late}})
        return table.version()

    def summary_full(cat: Catalog) -> DataFrame:
        return summary.summarize_sql(cat.spark, cat.read("gold.reconciliation_detail"), "reconciliation_detail",
                                     money=money)

    def staging_by_index(name: str, bronze: str, clean_rows: Callable, finish_rows: Callable, keys: list[str], order: list[str],
                rules: list, comment: str) -> Dataset:
        def arrivals(rows: DataFrame) -> DataFrame:
            return runner.valid(clean_rows(rows), rules, validate_first)

        return Dataset(name, STREAMING, lambda cat: finish_rows(arrivals(cat.spark.createDataFrame([], cat.schema(bronze)))),
                       comment, flow=lambda cat, path: keyindex.dedup_stream(
                           arrivals(cat.read_stream(bronze)), keys, order, finish_rows, rules, path, f"{path}._checkpoint",
                           f"{path}._keys", cat.counts_path(name)))

    if dedup not in ("state", "index"):
        raise ValueError(f"unknown dedup {dedup!r}")
    hints = cdr_hints or ingest.CDR_HINTS
    specs = [
        Dataset("bronze.cdr_events", STREAMING,
                lambda cat: runner.bronze_cdr_shape(cat.spark, StructType(list(cdr_schema.fields)), hints),
                "What the usage capture delivered, less its own columns, with file and path date",
                {"quality": "bronze", "clustering": "call_id,msisdn"},
                flow=lambda cat, path: runner.bronze_cdr_mixed(cat.spark, landing_cdr, cdr_schema, hints, path,
                                                               f"{path}._checkpoint", rescue_extra=rescue_extra))
        if mixed else
        Dataset("bronze.cdr_events", STREAMING,
                lambda cat: runner.bronze_cdr_stream(cat.spark, landing_cdr, cdr_schema, hints=cdr_hints),
                "What the usage capture delivered, less its own columns, with file and path date",
                {"quality": "bronze", "clustering": "call_id,msisdn"}),
        Dataset("bronze.edr_events", STREAMING,
                lambda cat: runner.bronze_edr_stream(cat.spark, landing_edr, edr_schema),
                "What the charge table delivered, less capture columns, with its file",
                {"quality": "bronze", "clustering": "session_id,cdr_call_id,msisdn"}),
        staging_by_index("silver.cdr_staging", "bronze.cdr_events", clean.enrich_cdr, clean.finish_cdr, pl.CDR_DEDUP_KEYS,
                ["timestamp_parsed", "bronze_source_file"], expectations.CDR_RULES,
                "Usage rows that passed the rules, first arrivals only") if dedup == "index" else
        Dataset("silver.cdr_staging", STREAMING,
                lambda cat: runner.silver_cdr_stream(cat.read_stream("bronze.cdr_events"), bounded, validate_first),
                "Usage rows that passed the rules, first arrivals only"),
        staging_by_index("silver.edr_staging", "bronze.edr_events", clean.clean_edr, lambda rows: rows, pl.EDR_DEDUP_KEYS,
                ["timestamp_parsed", "transaction_id"], expectations.EDR_RULES,
                "Charge rows that passed the rules, first arrivals only") if dedup == "index" else
        Dataset("silver.edr_staging", STREAMING,
                lambda cat: runner.silver_edr_stream(cat.read_stream("bronze.edr_events"), bounded, validate_first),
                "Charge rows that passed the rules, first arrivals only"),
        Dataset("silver.cdr_events_silver", SCD1, lambda cat: cat.read_stream("silver.cdr_staging", None),
                "Latest usage row of each call", {"quality": "silver", "layer": "silver"}, ["business_date"], keys=pl.CDR_KEYS, buckets=buckets),
        Dataset("silver.edr_events_silver", SCD1, lambda cat: cat.read_stream("silver.edr_staging", None),
                "Latest charge row of each session", {"quality": "silver", "layer": "silver"}, ["business_date"], keys=pl.EDR_KEYS, buckets=buckets),
        Dataset("silver.calendar", VIEW, lambda cat: calendar_dim.build(cat.spark, *calendar_range),
                "One row per day of the range, with its attributes", {"layer": "silver"}),
    ]
    if gold == "stream":
        specs += [
            Dataset("gold.quarantine_cdr", STREAMING,
                    lambda cat: runner.quarantine(cat.read_stream("silver.cdr_staging", None))[1],
                    "Usage records without event time (kept out of the join state)"),
            Dataset("gold.quarantine_edr", STREAMING,
                    lambda cat: runner.quarantine(cat.read_stream("silver.edr_staging", None))[1],
                    "Charge records without event time (kept out of the join state)"),
            Dataset("gold.reconciliation_detail", DELTA, detail_shape, "Usage and charges side by side, with the outcome of each match",
                    {"quality": "gold", "layer": "gold"}, ["business_date", gold_stream.PART], fold=detail_stream_fold,
                    hidden=(gold_stream.PART,)),
            Dataset("gold.reconciliation_summary", DELTA, summary_full, "Counts and amounts per day, outcome and severity",
                    {"quality": "gold", "layer": "gold"}, ["business_date"], fold=summary_fold),
        ]
    elif gold == "batch":
        specs += [
            Dataset("gold.reconciliation_detail", DELTA, detail_batch, "Usage and charges side by side, with the outcome of each match",
                    {"quality": "gold", "layer": "gold"}, ["business_date"], fold=detail_fold),
            Dataset("gold.reconciliation_summary", DELTA, summary_full, "Counts and amounts per day, outcome and severity",
                    {"quality": "gold", "layer": "gold"}, ["business_date"], fold=summary_fold),
        ]
    else:
        raise ValueError(f"unknown gold mode {gold!r}")
    return specs
