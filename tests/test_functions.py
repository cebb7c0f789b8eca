"""Column and frame functions on literal rows: ingest (hints, rescue,
evolution, path date), envelope, rating, layout, change rows, summary refresh."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reconlake.functions import rating
from reconlake.operators import layout, scd, summary
from reconlake.session import scratch_path
from reconlake.sources import envelope, fixtures, ingest


def test_partition_date_from_path(spark):
    df = spark.createDataFrame([("/x/cdr-events/2024-01-05/part-0.parquet",), ("/x/cdr-events/part.parquet",),
                                ("/x/2024-13-45/p.parquet",), (None,)], "p string")
    got = [r.d for r in df.select(ingest.partition_date(F.col("p")).alias("d")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None]


def test_hints_cast_and_add_missing(spark):
    df = spark.createDataFrame([("CALL-1", "12.5", "x")], "call_id string, volume string, extra string")
    out = ingest.apply_hints(df)
    types = dict((f.name, f.dataType.simpleString()) for f in out.schema.fields)
    assert types["volume"] == "double" and types["extra"] == "string"
    assert types["expected_charge"] == "double" and types["network_element"] == "string"
    r = out.collect()[0]
    assert r.volume == 12.5 and r.expected_charge is None


def test_rescue_keeps_raw_text(spark):
    df = spark.createDataFrame([("A", "1.5", "2"), ("B", "n/a", "x")], "call_id string, volume string, "
                               "expected_charge string")
    rows = {r.call_id: r for r in ingest.rescue(df).collect()}
    assert rows["A"]._rescued_data is None and rows["A"].volume == 1.5
    assert rows["B"].volume is None
    assert json.loads(rows["B"]._rescued_data) == {"volume": "n/a", "expected_charge": "x"}


def test_schema_evolution_appends(spark):
    from pyspark.sql.types import StructType
    old = StructType.fromDDL("a string, b int")
    new = StructType.fromDDL("a string, c double, b long")
    ev = ingest.evolve_schema(old, new)
    assert [f.name for f in ev.fields] == ["a", "b", "c"]
    assert ev["b"].dataType.simpleString() == "int"
    assert ingest.schema_from_json(ingest.schema_to_json(ev)) == ev


def test_envelope_roundtrip(spark):
    df = spark.createDataFrame([("+358", "CALL-1", 1.25, True)], "msisdn string, call_id string, volume double, "
                               "is_roaming boolean")
    enc = envelope.encode(df)
    assert enc.columns == ["key", "value"]
    back = envelope.decode(enc, df.schema).collect()[0]
    assert (back.key, back.call_id, back.volume, back.is_roaming) == ("+358", "CALL-1", 1.25, True)


def test_rating(spark):
    df = spark.createDataFrame([("voice", True, 10.0), ("data", False, 0.0), ("sms", False, None),
                                ("fax", False, 3.0)], "service_type string, is_roaming boolean, volume double")
    out = {r.service_type: r for r in rating.rate(df, fixtures.tariffs(spark)).collect()}
    assert out["voice"].rate == 0.45 and out["voice"].expected_charge == 4.5
    assert out["data"].expected_charge is None            # zero volume is unrated
    assert out["sms"].expected_charge is None
    assert out["fax"].rate is None and out["fax"].expected_charge is None


def test_units_and_completeness(spark):
    df = spark.createDataFrame([("voice", 90, None), ("data", None, 12.5), ("sms", None, None)],
                               "service_type string, duration_seconds int, volume double")
    out = rating.completeness(rating.units(df)).collect()
    assert (out[0].volume, out[0].unit) == (1.5, "minutes")
    assert (out[1].unit, out[1].status) == ("MB", "COMPLETED")
    assert (out[2].unit, out[2].status, out[2].incomplete) == (None, "PARTIAL", True)


def test_cluster_write_sorts_within_files(spark):
    path = scratch_path(spark, "t_cluster")
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), F.col("id"))
    layout.cluster_write(df, path, ["k"], 4)
    files = spark.read.parquet(path).select("k", F.input_file_name().alias("f"))
    ranges = files.groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert len(ranges) >= 2
    for a, b in zip(ranges, ranges[1:]):
        assert a.hi <= b.lo                    # files cover disjoint key ranges


def test_change_rows(spark):
    before = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "k string, v int")
    after = spark.createDataFrame([("A", 1), ("B", 5), ("D", 4)], "k string, v int")
    got = sorted((r.k, r.change_type, r.v) for r in scd.changes(before, after, ["k"]).collect())
    assert got == [("B", "update_postimage", 5), ("B", "update_preimage", 2), ("C", "delete", 3),
                   ("D", "insert", 4)]


@pytest.mark.parametrize("money", [None, 4])
def test_refresh_equals_recompute(spark, money):
    ddl = "business_date date, mismatch_type string, severity string, revenue_impact double, msisdn_normalized string"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    v1 = spark.createDataFrame([(d1, "MATCHED", "NONE", 0.0, "a"), (d2, "MISSING_EDR", "CRITICAL", 1.5, "b")], ddl)
    v2 = spark.createDataFrame([(d1, "MATCHED", "NONE", 0.0, "a"), (d2, "MISSING_EDR", "CRITICAL", 1.5, "b"),
                                (d2, "MISSING_EDR", "CRITICAL", 2.25, "b")], ddl)
    dates = spark.createDataFrame([(d2,)], "business_date date")
    inc = summary.refresh(summary.summarize(v1, money), v2, dates, money)
    full = summary.summarize(v2, money)
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))


def test_rescue_unexpected_columns(spark):
    from pyspark.sql.types import StructType
    expected = StructType.fromDDL("call_id string, volume double")
    df = spark.createDataFrame([("A", "1.5", "x1"), ("B", "2", None)], "call_id string, volume string, surprise string")
    rows = {r.call_id: r for r in ingest.rescue(df, expected=expected).collect()}
    assert "surprise" not in rows["A"].asDict()
    assert json.loads(rows["A"]._rescued_data) == {"surprise": "x1"}
    assert rows["B"]._rescued_data is None and rows["B"].volume == 2.0


def test_changed_dates_only_flags_changed_days(spark):
    ddl = "business_date date, call_id string, revenue_impact double"
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    v1 = spark.createDataFrame([(d1, "a", 1.0), (d2, "b", 2.0), (d2, "c", 3.0)], ddl)
    v2 = spark.createDataFrame([(d1, "a", 1.0), (d2, "c", 3.0), (d2, "b", 2.5), (d3, "d", 4.0)], ddl)
    got = sorted(r.business_date for r in summary.changed_dates(v1, v2).collect())
    assert got == [d2, d3]
    assert summary.changed_dates(v1, v1).count() == 0


def test_compact_replaces_the_files_of_one_partition(spark):
    from reconlake.plans import stream_queries as sq
    path, day = sq.fragmented_detail(spark, SF_SMALL)
    files = lambda: {r[0]: r[1] for r in spark.read.parquet(path).groupBy("business_date").agg(
        F.count_distinct(F.col("_metadata.file_path"))).collect()}
    rows = lambda: sorted(map(str, spark.read.parquet(path).collect()))
    before, content = files(), rows()
    assert layout.compact(spark, path, "business_date", day) == 1
    after = files()
    assert rows() == content
    for d, n in before.items():
        assert after[d] == (1 if str(d) == day else n)
    assert before[[d for d in before if str(d) == day][0]] > 1


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from reconlake import session
    assert session.is_local("local") and session.is_local("local[8]") and not session.is_local("local-cluster[2,1,1024]")
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(fake, "x")
