"""Run the medallion pipeline over landing folders.

    python -m reconlake.plans.run --cdr-landing PATH --edr-table PATH --root PATH \\
        [--start 2024-01-01 --end 2024-12-31]

The usage schema is resolved the way the capture loader does it: the schema
observed in the Parquet footers (each file's is read once, in tasks, and kept in the
ledger ``<root>/_schemas/files``), merged with
the schema stored under ``<root>/_schemas/cdr.json`` by adding new columns. Where files
differ in the type of a column, they are read group by group and cast to the stored
type; what doesn't cast is rescued (``mixed``, the default of a new table).
The files are read with that schema; the hints (``ingest.CDR_HINTS``) are
applied at bronze by ``ingest.rescue``, which casts the hinted columns and keeps
values that do not cast in ``_rescued_data``. The merged schema is saved back
before the streams start, since a running stream's schema is fixed: a column
that appears later is picked up on the next run. Each run refreshes
all datasets with ``availableNow``, so it processes only what landed since the
previous run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from reconlake.plans import datasets
from reconlake.session import ensure_session, get_session
from reconlake.sources import ingest, schema_ledger
from reconlake.streaming.upsert import listing

SCHEMA_FILE = "_schemas/cdr.json"


def _read_text(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


LEDGER = "_schemas/files"


def cdr_schema(spark: SparkSession, cdr_landing: str, root: str) -> tuple[StructType, bool]:
    """(observed and stored usage schema, whether some files differ from it in a type);
    the schema is stored under ``root``, with the ledger of the files' own schemas."""
    stored = _read_text(spark, f"{root}/{SCHEMA_FILE}")
    schema = None if stored is None else ingest.schema_from_json(stored)
    # one row per distinct schema, in the order in which the landing's paths show them
    seen = schema_ledger.update(spark, f"{cdr_landing.rstrip('/')}/*/*", f"{root}/{LEDGER}").orderBy("first").collect()
    physical = [ingest.schema_from_json(r["schema"]) for r in seen]
    if not physical:
        raise FileNotFoundError(f"no Parquet files under {cdr_landing}")
    for one in physical:
        schema = one if schema is None else ingest.evolve_schema(schema, one, widen=stored is None)
    _write_text(spark, f"{root}/{SCHEMA_FILE}", ingest.schema_to_json(schema))
    return schema, any(ingest.conflicts(schema, one) for one in physical)


def plan(spark: SparkSession, cdr_landing: str, edr_table: str, root: str,
         calendar_range: tuple[str, str] | None = None, gold: str = "stream", **options) -> list[datasets.Dataset]:
    """The datasets for what has landed; ``options`` go to ``datasets.medallion`` (bounded, validate_first, mixed,
    rescue_extra, dedup, ...)."""
    ensure_session(spark)
    root = root.rstrip("/")
    start = calendar_range[0] if calendar_range else spark.conf.get("start_date")
    end = calendar_range[1] if calendar_range else spark.conf.get("end_date")
    c_schema, conflict = cdr_schema(spark, cdr_landing, root)
    # file by file from the start, unless the table was begun as a plain stream (whose sink log rules)
    plain = "_spark_metadata" in listing(spark, f"{root}/bronze/cdr_events")
    if plain and conflict:
        raise ValueError("usage files differ in a column's type, and bronze.cdr_events was begun as a plain stream")
    options["mixed"] = not plain and options.get("mixed", True)
    e_schema = spark.read.option("mergeSchema", "true").parquet(edr_table).schema
    return datasets.medallion(cdr_landing, c_schema, edr_table, e_schema, (start, end), gold=gold,
                              cdr_hints=ingest.CDR_HINTS, **options)


def run(spark: SparkSession, cdr_landing: str, edr_table: str, root: str,
        calendar_range: tuple[str, str] | None = None, gold: str = "stream", **options) -> datasets.Catalog:
    """Refresh the datasets of ``plan``."""
    return datasets.refresh(spark, plan(spark, cdr_landing, edr_table, root, calendar_range, gold, **options), root)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--cdr-landing", required=True)
    ap.add_argument("--edr-table", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--master")
    ap.add_argument("--gold", choices=["stream", "batch"], default="stream",
                    help="stream: incremental detail by the stream-stream join (rows final once the "
                         "watermark passes); batch: detail recomputed from the upsert snapshots")
    ap.add_argument("--plain", action="store_true", help="usage files never differ in physical types: one plain file stream")
    ap.add_argument("--bounded", action="store_true", help="streaming dedup state of one day")
    ap.add_argument("--validate-first", action="store_true", help="drop rules before the streaming dedup too")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    rng = (a.start, a.end) if a.start and a.end else None
    cat = run(spark, a.cdr_landing, a.edr_table, a.root, rng, a.gold, mixed=not a.plain, bounded=a.bounded,
              validate_first=a.validate_first)
    cat.read("gold.reconciliation_summary").orderBy("business_date", "mismatch_type", "severity").show(50, False)


if __name__ == "__main__":
    main()
