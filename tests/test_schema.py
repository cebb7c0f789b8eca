"""Landing files of different schemas: the ledger opens each file once, types follow a
lattice, values of another type are rescued."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType,
                               TimestampType)

from reconlake.plans import run as runner_mod
from reconlake.session import scratch_path
from reconlake.sources import ingest, schema_ledger


def test_wider_types(spark):
    assert ingest.wider(IntegerType(), LongType()) == LongType()
    assert ingest.wider(FloatType(), DoubleType()) == DoubleType()
    assert ingest.wider(LongType(), FloatType()) == DoubleType()
    assert ingest.wider(DecimalType(10, 2), DecimalType(8, 4)) == DecimalType(12, 4)
    assert ingest.wider(DecimalType(38, 0), DecimalType(38, 30)) == DoubleType()
    assert ingest.wider(DecimalType(10, 2), IntegerType()) == DoubleType()
    assert ingest.wider(DateType(), TimestampType()) == TimestampType()
    assert ingest.wider(IntegerType(), StringType()) == StringType()
    a, b = StructType.fromDDL("x int, y string"), StructType.fromDDL("z int, x bigint")
    assert ingest.evolve_schema(a, b).simpleString() == "struct<x:int,y:string,z:int>"
    assert ingest.evolve_schema(a, b, widen=True).simpleString() == "struct<x:bigint,y:string,z:int>"
    assert ingest.conflicts(a, b) and not ingest.conflicts(a, StructType.fromDDL("y string, w date"))


def test_conform_rescues_what_does_not_cast(spark):
    df = spark.createDataFrame([("1", "a", None), ("x}", "b", '{"volume":"n/a"}'), (None, "c", '{"k":"v"}'), ("y", "d", None)],
                               "n string, k string, _rescued_data string")
    got = ingest.conform(df, StructType.fromDDL("k string, n int, _rescued_data string, more date")).collect()
    assert [(r.k, r.n, r.more) for r in got] == [("a", 1, None), ("b", None, None), ("c", None, None), ("d", None, None)]
    assert [r._rescued_data and json.loads(r._rescued_data) for r in got] == [
        None, {"volume": "n/a", "n": "x}"}, {"k": "v"}, {"n": "y"}]


def test_no_known_file_is_opened_again(spark):
    base = scratch_path(spark, "t_ledger")
    spark.range(3).write.parquet(f"{base}/land/2024-01-01")
    spark.range(3).withColumn("id", F.col("id").cast("string")).write.parquet(f"{base}/land/2024-01-02")
    first = schema_ledger.update(spark, f"{base}/land/*/*", f"{base}/ledger").collect()
    assert sorted(json.loads(r.schema)["fields"][0]["type"] for r in first) == ["long", "string"]
    assert sum(r.files for r in first) == schema_ledger.known(spark, f"{base}/ledger").count()
    for folder, _, names in os.walk(f"{base}/land"):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "wb") as f:          # a footer read would fail from now on
                    f.write(b"no parquet")
                if os.path.exists(crc := os.path.join(folder, f".{n}.crc")):
                    os.remove(crc)
    spark.range(2).withColumn("more", F.lit(1)).write.parquet(f"{base}/land/2024-01-03")
    second = schema_ledger.update(spark, f"{base}/land/*/*", f"{base}/ledger").collect()
    assert len(second) == 3 and schema_ledger.unseen(spark, f"{base}/land/*/*", f"{base}/ledger").count() == 0
    # whole files, read by Spark, say the same
    paths = [r.path for r in schema_ledger.known(spark, f"{base}/ledger").where("path like '%2024-01-03%'").collect()]
    assert {r.schema for r in schema_ledger.by_content(spark, paths).collect()} == set(schema_ledger.of_files(spark, paths).values())


def test_schema_of_conflicting_files(spark):
    """At first sight the wider type; a stored type stays, whatever comes later."""
    base = scratch_path(spark, "t_conflict")
    spark.range(3).select(F.col("id").cast("int").alias("n"), F.lit("a").alias("call_id")).write.parquet(f"{base}/land/2024-01-01")
    spark.range(3).select("id", F.col("id").alias("n")).write.parquet(f"{base}/land/2024-01-02")
    schema, conflict = runner_mod.cdr_schema(spark, f"{base}/land", f"{base}/root")
    assert schema.simpleString() == "struct<n:bigint,call_id:string,id:bigint>" and conflict
    spark.range(3).select(F.lit("x").alias("n")).write.parquet(f"{base}/land/2024-01-03")
    schema, conflict = runner_mod.cdr_schema(spark, f"{base}/land", f"{base}/root")
    assert schema.simpleString() == "struct<n:bigint,call_id:string,id:bigint>" and conflict
