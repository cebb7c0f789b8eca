"""The pipeline runner over landing folders: two runs, the second after new
files with an extra column landed (schema evolution), processing only them."""

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from reconlake.plans import datasets
from reconlake.plans import run as runner_mod
from reconlake.plans import stream_queries as sq
from reconlake.session import scratch_path


def test_two_runs_with_new_column(spark):
    land = sq.Landing(spark, SF_SMALL)
    root = scratch_path(spark, "t_run")
    rng = ("2024-01-01", "2024-01-31")
    # batch gold: the new files carry old event times, which a stream's watermark would drop as late
    cat = runner_mod.run(spark, land.cdr_dir, land.edr_dir, root, rng, gold="batch", buckets=1)
    m = spark.read.parquet(f"{root}/{datasets.METRICS_TABLE}")
    got = {(r.dataset, r.rule): (r.passed, r.failed) for r in m.collect()}
    p, f = got[("silver.cdr_staging", "good_data_quality")]
    assert f > 0 and p > 0 and ("silver.edr_staging", "successful_billing") in got
    assert m.select("run_started").distinct().count() == 1 and cat.run_started is not None
    n1 = cat.read("bronze.cdr_events").count()
    s1 = cat.read("gold.reconciliation_summary").agg(F.sum("record_count")).first()[0]
    assert n1 > 0 and s1 > 0

    extra = (spark.read.parquet(f"{land.cdr_dir}/2024-01-05").limit(4)
             .withColumn("call_id", F.concat(F.lit("CALL-NEW-"), F.col("call_id")))
             .withColumn("rating_plan", F.lit("PLAN-A")))
    extra.write.mode("overwrite").parquet(f"{land.cdr_dir}/2024-01-31")
    cat = runner_mod.run(spark, land.cdr_dir, land.edr_dir, root, rng, gold="batch", buckets=1)

    bronze = cat.read("bronze.cdr_events")
    assert bronze.count() == n1 + 4
    assert "rating_plan" in bronze.columns
    assert bronze.where(F.col("rating_plan") == "PLAN-A").count() == 4
    stored = json.loads(runner_mod._read_text(spark, f"{root}/{runner_mod.SCHEMA_FILE}"))
    assert "rating_plan" in [f["name"] for f in stored["fields"]]
    # the four new calls have no charge: four more MISSING_EDR rows on 2024-01-31
    s2 = cat.read("gold.reconciliation_summary")
    new = s2.where((F.col("business_date") == F.lit("2024-01-31").cast("date"))
                   & (F.col("mismatch_type") == "MISSING_EDR")).agg(F.sum("record_count")).first()[0]
    assert new >= 4
    assert s2.agg(F.sum("record_count")).first()[0] == s1 + 4


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.drop("reconciliation_timestamp").collect())


def test_stream_gold_with_late_rows_and_a_stopped_run(spark):
    """Run 2 gets rows behind the watermark and stops before the summary; run 3 catches up.
    Detail and summary equal what the silver tables give in batch."""
    from reconlake.functions import calendar_dim, classify
    from reconlake.operators import reconcile, summary
    land = sq.Landing(spark, SF_SMALL, later=sq.LATER)
    rng = ("2024-01-01", "2024-12-31")
    specs = datasets.medallion(land.cdr_dir, land.cdr_schema, land.edr_dir, land.edr_schema, rng, money_scale=4,
                               buckets=1, dedup="index")
    root = scratch_path(spark, "t_late_run")
    cat = datasets.refresh(spark, specs, root)
    before = cat.cells("gold.reconciliation_detail").version()
    land.deliver_later()
    sq.land_flush_pair(land)
    datasets.refresh(spark, specs[:-1], root)               # stops before the summary
    cat = datasets.Catalog(spark, root, {d.name: d for d in specs})
    detail, view = cat.cells("gold.reconciliation_detail"), cat.cells("gold.reconciliation_summary")
    assert view.state()["detail"] == before < detail.version()
    metrics = spark.read.parquet(f"{root}/{datasets.METRICS_TABLE}")
    assert metrics.where("observation = 'late_rows' and failed > 100").count() == 1
    rec = reconcile.match(cat.read("silver.cdr_events_silver"), cat.read("silver.edr_events_silver"))
    whole = classify.derive(reconcile.calendar_join(rec, calendar_dim.build(spark, *rng), reconcile.calendar_days(*rng)))
    assert _rows(cat.read("gold.reconciliation_detail")) == _rows(whole)
    cat = datasets.refresh(spark, specs, root)
    assert _rows(cat.read("gold.reconciliation_summary")) == _rows(
        summary.summarize(cat.read("gold.reconciliation_detail"), 4).select(cat.read("gold.reconciliation_summary").columns))


def test_hints_applied_to_text_capture(spark):
    """A capture whose volume arrives as text: the stream reads the files as
    they are and the hint casts it at bronze, rescuing what does not cast."""
    land = sq.Landing(spark, SF_SMALL)
    base = scratch_path(spark, "t_text_capture")
    text = (spark.read.parquet(f"{land.cdr_dir}/2024-01-0*")
            .withColumn("volume", F.when(F.col("call_id").endswith("3"), F.lit("n/a"))
                        .otherwise(F.col("volume").cast("string"))))
    text.write.parquet(f"{base}/cdr/2024-01-05")
    specs = runner_mod.plan(spark, f"{base}/cdr", land.edr_dir, f"{base}/root", ("2024-01-01", "2024-01-31"), mixed=False)
    cat = datasets.refresh(spark, specs[:1], f"{base}/root")
    bronze = cat.read("bronze.cdr_events")
    assert dict(bronze.dtypes)["volume"] == "double"
    bad = bronze.where(F.col("_rescued_data").isNotNull())
    assert bad.count() == text.where(F.col("volume") == "n/a").count() > 0
    assert bad.where(F.col("volume").isNotNull()).count() == 0
    assert json.loads(bad.first()["_rescued_data"]) == {"volume": "n/a"}


def test_mixed_landing_through_the_pipeline(spark):
    """Files of three physical schemas: read file by file, and a second run takes new files only."""
    land, root = sq.mixed_landing(spark, SF_SMALL)
    base = scratch_path(spark, "t_mixed")
    args = (spark, root, land.edr_dir, base, ("2024-01-01", "2024-12-31"))
    cat = datasets.refresh(spark, runner_mod.plan(*args)[:1], base)
    bronze = cat.read("bronze.cdr_events")
    n = spark.read.parquet(f"{land.cdr_dir}/*/*").count()
    assert bronze.count() == n and dict(bronze.dtypes)["volume"] == "double" and "vendor_flag" in bronze.columns
    assert bronze.where("_rescued_data is not null").count() == spark.read.parquet(f"{root}/2024-01-02").where(
        "volume = 'n/a'").count() > 0
    spark.read.parquet(f"{root}/2024-01-01").limit(3).write.parquet(f"{root}/2024-01-09")
    cat = datasets.refresh(spark, runner_mod.plan(*args)[:1], base)
    assert cat.read("bronze.cdr_events").count() == n + 3
