"""Landing zones as the capture tools lay them out, written from fixture frames.

* usage capture: ``base/YYYY-MM-DD/part-*.parquet`` (plain date folders, not
  ``key=value``), rows without a date under ``base/undated/``;
* charge table: one append-only Parquet directory.

Spark writes ``partitionBy`` folders as ``col=value``; the folders are renamed to
the bare date afterwards through the Hadoop FileSystem API (one metadata
operation per date folder, no data passes through the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNDATED = "undated"
_COL = "__landing"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_capture(df: DataFrame, base: str, date_col: str = "partition_date", mode: str = "overwrite",
                  files: int | None = None) -> None:
    """Write ``df`` (without ``date_col``) into date folders under ``base``.
    A REBALANCE hint keeps few files per date and splits a heavy date; with ``files`` a
    date's rows are dealt over so many. ``append`` adds files to folders that are there."""
    spark = df.sparkSession
    folder = F.coalesce(F.date_format(F.col(date_col), "yyyy-MM-dd"), F.lit(UNDATED))
    out = df.withColumn(_COL, folder).drop(date_col)
    out = out.repartition(files, F.rand(1)) if files else out.hint("rebalance", _COL)
    out.write.mode(mode).partitionBy(_COL).parquet(base)
    fs, root, jvm = _fs(spark, base)
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(_COL + "="):
            target = jvm.org.apache.hadoop.fs.Path(root, name.split("=", 1)[1])
            if not fs.exists(target):
                fs.rename(st.getPath(), target)
                continue
            for f in fs.listStatus(st.getPath()):
                fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(target, f.getPath().getName()))
            fs.delete(st.getPath(), True)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)
