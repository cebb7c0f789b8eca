"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reconlake.session import scratch_path


def written(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, and a lost
    executor costs no recomputation."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches are cut by bytes too, so that very long texts don't pile up in one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
