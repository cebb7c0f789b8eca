"""Usage rating: units, completeness, tariff lookup and expected charge.

The tariff is a small dimension (service x roaming); it is joined with an
explicit broadcast only when its row count is under ``MAX_TARIFF_ROWS``, a
bound checked on the driver from the frame itself (a count of a tiny table,
not of the usage data). Larger tariff tables fall back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TARIFF_ROWS = 100_000


def units(df: DataFrame) -> DataFrame:
    """Voice seconds -> minutes (2 decimals); unit by service type."""
    svc = F.col("service_type")
    volume = F.when(svc == "voice", F.round(F.col("duration_seconds") / 60, 2)).otherwise(F.col("volume"))
    unit = (F.when(volume.isNull(), F.lit(None).cast("string"))
             .when(svc == "voice", "minutes").when(svc == "data", "MB").otherwise("count"))
    return df.withColumn("volume", volume).withColumn("unit", unit)


def completeness(df: DataFrame) -> DataFrame:
    """Missing volume marks the record PARTIAL and incomplete."""
    missing = F.col("volume").isNull()
    return df.withColumns({
        "status": F.when(missing, "PARTIAL").otherwise("COMPLETED"),
        "incomplete": missing,
    })


def rate(df: DataFrame, tariffs: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Join the rate by (service_type, is_roaming); expected_charge =
    round(volume * rate, 4) computed in decimal, NULL when volume is NULL or 0."""
    if broadcast is None:
        broadcast = tariffs.count() <= MAX_TARIFF_ROWS
    t = tariffs.select("service_type", "is_roaming", F.col("rate").cast("double").alias("rate"))
    if broadcast:
        t = F.broadcast(t)
    out = df.join(t, ["service_type", "is_roaming"], "left")
    v = F.col("volume")
    exact = F.round(v.cast("decimal(18,4)") * F.col("rate").cast("decimal(8,4)"), 4).cast("double")
    return out.withColumn("expected_charge", F.when(v.isNull() | (v == 0), F.lit(None).cast("double"))
                          .otherwise(exact))
