"""Bronze ingest: schema hints, rescue, evolution, capture-column drop, path date,
lineage, and the streaming file/table sources.

Batch and stream share the projection functions (``bronze_cdr``, ``bronze_edr``);
only the source differs. For files, the path comes from the hidden
``_metadata.file_path`` column; fixtures carry it as ``source_path``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, DoubleType, FractionalType, IntegralType, NumericType,
                               StringType, StructField, StructType, TimestampType)

from reconlake.sources import schema_ledger

# Capture columns dropped at bronze, per record type.
CDR_EXCLUDE = [
    "EventProcessedUtcTime",
    "PartitionId",
    "EventEnqueuedUtcTime",
    "duration_seconds",
    "roaming_country",
    "record_type",
    "source_system",
]
EDR_EXCLUDE = [
    "EventProcessedUtcTime",
    "PartitionId",
    "EventEnqueuedUtcTime",
    "record_type",
    "source_system",
]

# Schema hints for the critical usage columns.
CDR_HINTS = """call_id STRING, msisdn STRING, timestamp STRING, service_type STRING,
volume DOUBLE, expected_charge DOUBLE, data_quality STRING, network_element STRING"""

# Fixed value: the date folder pattern of the usage landing zone (base/YYYY-MM-DD/file).
DATE_FOLDER = r"/(\d{4}-\d{2}-\d{2})/"

FILE_PATH = "_metadata.file_path"
RESCUED = "_rescued_data"


def partition_date(path: Column) -> Column:
    """Date folder of a file path; NULL when the path has no such folder.
    ``try_to_date`` because an empty match must not raise under ANSI mode."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, DATE_FOLDER, 1), F.lit("")), "yyyy-MM-dd")


def _path_col(df: DataFrame, path_col: str | None) -> Column:
    if path_col is None:
        return F.col(FILE_PATH)
    return F.col(path_col)


def bronze_cdr(df: DataFrame, path_col: str | None = FILE_PATH, rescued: bool = True) -> DataFrame:
    """Usage bronze: drop capture columns, add path date, ingestion time, source file.
    ``_rescued_data`` is added as NULL when the source did not create one."""
    path = _path_col(df, path_col)
    out = df.drop(*CDR_EXCLUDE)
    out = out.withColumn("partition_date", partition_date(path)) \
             .withColumn("bronze_ingestion_time", F.current_timestamp()) \
             .withColumn("bronze_source_file", path)
    if path_col and path_col != FILE_PATH and path_col in out.columns:
        out = out.drop(path_col)
    if rescued and "_rescued_data" not in out.columns:
        out = out.withColumn("_rescued_data", F.lit(None).cast("string"))
    return out


def bronze_edr(df: DataFrame, path_col: str | None = FILE_PATH) -> DataFrame:
    """Charge bronze: drop capture columns, add ingestion time and source file."""
    path = _path_col(df, path_col)
    out = df.drop(*EDR_EXCLUDE)
    out = out.withColumn("bronze_ingestion_time", F.current_timestamp()) \
             .withColumn("bronze_source_file", path)
    if path_col and path_col != FILE_PATH and path_col in out.columns:
        out = out.drop(path_col)
    return out


# --- schema: hints, rescue, evolution -------------------------------------------------

def hint_schema(hints_ddl: str = CDR_HINTS) -> StructType:
    return StructType.fromDDL(" ".join(hints_ddl.split()))


def resolve_schema(observed: StructType, hints_ddl: str = CDR_HINTS) -> StructType:
    """Observed (inferred) schema with hinted columns forced to the hinted type.
    Hinted columns absent from the data are appended as nullable."""
    hints = {f.name: f.dataType for f in hint_schema(hints_ddl).fields}
    fields = [StructField(f.name, hints.get(f.name, f.dataType), True) for f in observed.fields]
    seen = {f.name for f in observed.fields}
    fields += [StructField(n, t, True) for n, t in hints.items() if n not in seen]
    return StructType(fields)


def _hinted_cols(df: DataFrame, hints_ddl: str) -> list[Column]:
    target = resolve_schema(df.schema, hints_ddl)
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            cols.append(c if df.schema[f.name].dataType == f.dataType else c.try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return cols


def apply_hints(df: DataFrame, hints_ddl: str = CDR_HINTS) -> DataFrame:
    """Cast hinted columns to their hinted type (``try_cast``: bad values become
    NULL and are kept by ``rescue``); a hinted column missing from the frame
    becomes a typed NULL. Unhinted columns pass through."""
    return df.select(*_hinted_cols(df, hints_ddl))


def rescue(df: DataFrame, hints_ddl: str = CDR_HINTS, expected: StructType | None = None,
           types: StructType | None = None) -> DataFrame:
    """Cast hinted columns and keep the raw text of values that did not cast in
    ``_rescued_data`` (JSON object, NULL when nothing was rescued). ``types`` does the same
    for unhinted columns: those that it names get its type. With
    ``expected``, columns outside that schema are unexpected: their non-NULL
    values move into ``_rescued_data`` too and the columns are dropped."""
    hints = hint_schema(hints_ddl)
    if types is not None:
        hints = StructType([*hints.fields, *[f for f in types.fields
                                             if f.name not in hints.names and f.name in df.columns]])
        hints_ddl = hints.toDDL()
    failed = []
    if expected is not None:
        known = set(expected.fieldNames()) | set(hints.fieldNames())
        extra = [c for c in df.columns if c not in known]
        failed += [F.col(c).cast("string").alias(c) for c in extra]
        df_cast = df.drop(*extra)
    else:
        df_cast = df
    for f in hints.fields:
        if f.name not in df.columns or df.schema[f.name].dataType == f.dataType:
            continue
        raw = F.col(f.name)
        bad = raw.isNotNull() & raw.try_cast(f.dataType).isNull()
        failed.append(F.when(bad, raw.cast("string")).alias(f.name))
    if not failed:
        return apply_hints(df_cast, hints_ddl).withColumn("_rescued_data", F.lit(None).cast("string"))
    # an all-NULL struct encodes as '{}': nothing rescued -> NULL
    blob = F.nullif(F.to_json(F.struct(*failed)), F.lit("{}"))
    return df.select(*_hinted_cols(df_cast, hints_ddl), blob.alias("_rescued_data"))


def read_mixed(spark: SparkSession, files: list[str], hints_ddl: str = CDR_HINTS,
               expected: StructType | None = None, path_col: str = "__path",
               types: StructType | None = None) -> DataFrame:
    """Files whose columns may differ in type or number, as one frame with the hints
    applied. Only these files' footers are read, in tasks; files of one physical schema are
    read together with that schema, cast by ``rescue`` to the hints and to ``types`` (values
    that don't cast, and with ``expected`` also unexpected columns, go to ``_rescued_data``),
    and united by name. ``path_col`` gets each row's file."""
    groups: dict[str, list[str]] = {}
    for f, schema in sorted(schema_ledger.of_files(spark, files).items()):
        groups.setdefault(schema, []).append(f)
    known = StructType([*expected.fields, StructField(path_col, StringType())]) if expected is not None else None
    parts = []
    for schema, own in sorted(groups.items()):
        rows = spark.read.schema(schema_from_json(schema)).parquet(*own).select(
            "*", F.col(FILE_PATH).alias(path_col))
        parts.append(rescue(rows, hints_ddl, known, types))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def wider(a: DataType, b: DataType) -> DataType:
    """The least type that holds both: the larger of two whole or two fractional number
    types, double for mixed ones, timestamp for date and timestamp, else text."""
    if a == b:
        return a
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        if isinstance(a, DecimalType) and isinstance(b, DecimalType):
            whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
            return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
        for kind in (IntegralType, FractionalType):
            if isinstance(a, kind) and isinstance(b, kind) and DecimalType not in (type(a), type(b)):
                return max(a, b, key=lambda t: _SIZES[t.typeName()])
        return DoubleType()
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    return StringType()


_SIZES = {"byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8}


def evolve_schema(old: StructType, new: StructType, widen: bool = False) -> StructType:
    """Add-new-columns evolution: keep the stored order, append unseen columns as
    nullable. A type change of an existing column keeps the stored type, as a table with
    that type may exist; with ``widen`` (nothing is stored yet) it becomes ``wider``."""
    names = {f.name: f.dataType for f in new.fields}
    kept = [StructField(f.name, wider(f.dataType, names[f.name]), True) if widen and f.name in names else f
            for f in old.fields]
    seen = {f.name for f in old.fields}
    return StructType(kept + [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in seen])


def conflicts(schema: StructType, physical: StructType) -> bool:
    """Some column of the files has another type than in ``schema``."""
    types = {f.name: f.dataType for f in schema.fields}
    return any(types.get(f.name, f.dataType) != f.dataType for f in physical.fields)


def schema_to_json(schema: StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project a batch onto an evolved schema (missing columns become NULL). Values that
    don't cast become NULL; if the schema has ``_rescued_data``, their text goes there, next
    to what was rescued before."""
    cols, failed = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[f.name].dataType == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
            bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            failed.append(F.when(bad, F.col(f.name).cast("string")).alias(f.name))
    if failed and RESCUED in schema.names:
        more = F.nullif(F.to_json(F.struct(*failed)), F.lit("{}"))
        old = F.col(RESCUED) if RESCUED in df.columns else F.lit(None).cast("string")
        both = F.concat(F.rtrim(old, F.lit("}")), F.lit(","), F.ltrim(more, F.lit("{")))
        cols[schema.names.index(RESCUED)] = F.coalesce(both, old, more).alias(RESCUED)
    return df.select(*cols)


# --- sources --------------------------------------------------------------------------

def read_files(spark: SparkSession, path: str, schema: StructType | None = None,
               glob: str = "*.parquet") -> DataFrame:
    """Batch read of a date-foldered landing zone (base/YYYY-MM-DD/*.parquet)."""
    r = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def stream_files(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet",
                 max_files: int = 100) -> DataFrame:
    """Incremental Parquet file stream with admission control (files per trigger).
    ``path`` may hold a folder glob such as ``base/*/``; the file source lists on
    the driver and records processed files in the checkpoint."""
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files)
            .parquet(path))


def stream_table(spark: SparkSession, path: str, schema: StructType, max_files: int = 100) -> DataFrame:
    """Append-only stream over a Parquet table directory written by this library."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
