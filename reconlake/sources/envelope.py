"""JSON event envelope keyed by subscriber, as on a message bus: ``key`` is the
subscriber number (so one subscriber's events stay in one bus partition),
``value`` the record as JSON text. ``decode`` parses it back with a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def encode(df: DataFrame, key: str = "msisdn") -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def decode(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select("key", F.from_json("value", schema).alias("r")).select("key", "r.*")
