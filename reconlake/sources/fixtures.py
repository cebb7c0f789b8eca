"""Usage (CDR) and charge (EDR) records derived from the testdata ``events`` table.

Every column is arithmetic on (event_id, ts, user_id, event_type, value), so the
same rows can be rebuilt in SQL by the oracles (``plans/oracles.py``). No random
numbers. The rules are the ones in FIXTURES.md §2; money is computed in
decimal so both engines round identically.

Work grows with ``events``: one scan and one narrow projection per record
(duplicated rows come from a generator, not a second scan). No shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tariff per service (local, roaming), network elements.
TARIFFS = [
    ("voice", 0.05, 0.45),
    ("data", 0.10, 1.50),
    ("sms", 0.02, 0.15),
]
NETWORK_ELEMENTS = ["MSC-01", "MSC-02", "SGSN-01", "SGSN-02", "GGSN-01"]

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common derived columns; ``ts`` becomes a session-zone (UTC) timestamp."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    id_ = F.col("event_id")
    h = (id_ * 37) % 100
    user4 = F.lpad(F.col("user_id").cast("string"), 4, "0")
    msisdn = (F.when(id_ % 241 == 0, F.lit(None).cast("string"))
               .when(id_ % 233 == 0, F.lit("12345"))
               .when(id_ % 5 == 0, F.concat(F.lit("+358 "), user4, F.lit("-0000")))
               .otherwise(F.concat(F.lit("+358"), user4, F.lit("0000"))))
    service = (F.when(F.col("event_type").isin("view", "click"), "data")
                .when(F.col("event_type") == "signup", "sms")
                .otherwise("voice"))
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        id_.alias("id"), h.alias("h"), ts.alias("ts"), F.col("value"),
        msisdn.alias("msisdn"), service.alias("service_type"),
        (id_ % 5 == 1).alias("is_roaming"),
        F.concat(F.lit("CALL-"), F.lpad(id_.cast("string"), 12, "0")).alias("call_id"),
    )


def _rate(service: Column, roaming: Column) -> Column:
    """Tariff as decimal(4,2) for the fixture's own rating of expected_charge."""
    expr = None
    for svc, local, roam in TARIFFS:
        branch = F.when(roaming, F.lit(roam)).otherwise(F.lit(local))
        expr = (F.when(service == svc, branch) if expr is None else expr.when(service == svc, branch))
    return expr.cast("decimal(4,2)")


def _expected_charge(volume: Column, service: Column, roaming: Column) -> Column:
    exact = F.round(volume.cast("decimal(18,4)") * _rate(service, roaming), 4)
    return F.when(volume.isNull() | (volume == 0), F.lit(None).cast("double")).otherwise(exact.cast("double"))


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return ts + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def cdr_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage records as captured from the bus (19 record columns, 3 capture
    columns, and ``source_path`` standing in for the file path)."""
    b = _base(spark, sf_dir)
    id_, h = F.col("id"), F.col("h")
    volume = F.when((h >= 96) | (id_ % 257 == 0), F.lit(None).cast("double")).otherwise(F.col("value"))
    b = b.withColumn("volume", volume)
    unit = (F.when(F.col("volume").isNull(), F.lit(None).cast("string"))
             .when(F.col("service_type") == "voice", "minutes")
             .when(F.col("service_type") == "data", "MB")
             .otherwise("count"))
    ne = None
    for i, name in enumerate(NETWORK_ELEMENTS):
        ne = F.when(id_ % 5 == i, name) if ne is None else ne.when(id_ % 5 == i, name)
    pdate = (F.when(id_ % 7 == 0, F.lit(None).cast("date"))
              .otherwise(F.date_add(F.to_date("ts"), F.when(F.hour("ts") == 23, 1).otherwise(0))))
    src = F.when(pdate.isNull(), F.lit("/bronze/cdr-events/part.parquet")).otherwise(
        F.concat(F.lit("/bronze/cdr-events/"), F.date_format(pdate, "yyyy-MM-dd"), F.lit("/part.parquet")))
    rows = b.select(
        F.lit("CDR").alias("record_type"),
        F.lit("Network Elements").alias("source_system"),
        "call_id", "msisdn",
        F.concat(F.lit("358"), F.lpad(((id_ * 7919) % 100000000000).cast("string"), 11, "0")).alias("imsi"),
        F.date_format("ts", ISO_FMT).alias("timestamp"),
        "service_type", "volume",
        unit.alias("unit"),
        F.when((F.col("service_type") == "voice") & F.col("volume").isNotNull(),
               F.round(F.col("volume") * 60).cast("int")).alias("duration_seconds"),
        "is_roaming",
        F.when(F.col("is_roaming"), F.lit("US")).alias("roaming_country"),
        ne.alias("network_element"),
        F.concat(F.lit("CELL-"), (1000 + (id_ * 13) % 9000).cast("string")).alias("cell_id"),
        F.when(F.col("volume").isNull(), "PARTIAL").otherwise("COMPLETED").alias("status"),
        _expected_charge(F.col("volume"), F.col("service_type"), F.col("is_roaming")).alias("expected_charge"),
        F.when(h.isin(90, 91) | (h >= 96), "BAD").otherwise("GOOD").alias("data_quality"),
        (100000 + (id_ * 7) % 900000).cast("int").alias("sequence_number"),
        F.col("volume").isNull().alias("incomplete"),
        F.date_format(_plus_seconds(F.col("ts"), F.lit(2)), ISO_FMT).alias("EventProcessedUtcTime"),
        (id_ % 4).cast("int").alias("PartitionId"),
        F.date_format(_plus_seconds(F.col("ts"), F.lit(1)), ISO_FMT).alias("EventEnqueuedUtcTime"),
        src.alias("source_path"),
        id_.alias("event_id"),
    )
    return _duplicate(rows, 229)


def edr_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge records for every usage record with ``h < 96``."""
    b = _base(spark, sf_dir).filter(F.col("h") < 96)
    id_, h = F.col("id"), F.col("h")
    volume = F.when(id_ % 257 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    expected = _expected_charge(volume, F.col("service_type"), F.col("is_roaming"))
    over = F.round(expected.cast("decimal(18,4)") * (110 + id_ % 41).cast("decimal(5,0)")
                   * F.lit(0.01).cast("decimal(3,2)"), 4).cast("double")
    charge = (F.when(id_ % 227 == 0, F.lit(None).cast("double"))
               .when(h.isin(85, 86, 87), over)
               .when(h.isin(88, 89, 94, 95), F.lit(0.0))
               .otherwise(F.coalesce(expected, F.lit(0.0))))
    delay = F.when(id_ % 223 == 0, F.lit(1200)).otherwise(30 + (id_ * 7) % 271)
    ets = _plus_seconds(F.col("ts"), delay)
    rows = b.select(
        F.lit("EDR").alias("record_type"),
        F.lit("Online Charging System").alias("source_system"),
        F.when(id_ % 239 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("SESSION-"), F.lpad(id_.cast("string"), 12, "0"))).alias("session_id"),
        "msisdn",
        F.when(id_ % 211 == 0, F.concat(F.lit("CALL-ORPHAN"), id_.cast("string")))
         .otherwise(F.col("call_id")).alias("cdr_call_id"),
        F.date_format(ets, ISO_FMT).alias("timestamp"),
        charge.alias("charge_amount"),
        F.lit("EUR").alias("currency"),
        (F.lit(5.0) + ((id_ * 17) % 19500).cast("double") / 100).alias("account_balance_before"),
        (((id_ * 29) % 19500).cast("double") / 100).alias("account_balance_after"),
        F.when(id_ % 2 == 0, "PREPAID_DEDUCT").otherwise("POSTPAID_INVOICE").alias("payment_method"),
        F.when(id_ % 3 == 0, "RE-BACKUP").otherwise("RE-PRIMARY").alias("rating_engine"),
        F.concat(F.lit("RG-"), (100 + (id_ * 11) % 900).cast("string")).alias("rating_group"),
        F.when(h.isin(94, 95), "FAILED").otherwise("SUCCESS").alias("billing_status"),
        F.concat(F.lit("TX-"), F.lpad(id_.cast("string"), 12, "0")).alias("transaction_id"),
        F.when(h.isin(85, 86, 87, 88, 89, 92, 93, 94, 95), "BAD").otherwise("GOOD").alias("data_quality"),
        (100 + (id_ * 31) % 4900).cast("double").alias("processing_latency_ms"),
        F.date_format(_plus_seconds(ets, F.lit(2)), ISO_FMT).alias("EventProcessedUtcTime"),
        (id_ % 4).cast("int").alias("PartitionId"),
        F.date_format(_plus_seconds(ets, F.lit(1)), ISO_FMT).alias("EventEnqueuedUtcTime"),
        F.lit("/bronze/edr-events/part.parquet").alias("source_path"),
        id_.alias("event_id"),
    )
    return _duplicate(rows, 251)


def _duplicate(rows: DataFrame, every: int) -> DataFrame:
    """Rows whose event id is a multiple of ``every`` appear twice (one scan,
    a generator instead of a self-union)."""
    copies = F.when(F.col("event_id") % every == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("*", F.explode(copies).alias("__copy")).drop("__copy", "event_id")


def tariffs(spark: SparkSession) -> DataFrame:
    """Six-row tariff table (service_type, is_roaming, rate)."""
    rows = [(svc, False, local) for svc, local, _ in TARIFFS] + [(svc, True, roam) for svc, _, roam in TARIFFS]
    return spark.createDataFrame(rows, "service_type string, is_roaming boolean, rate double")
