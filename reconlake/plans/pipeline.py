"""The batch medallion pipeline over the testdata-derived fixtures.

bronze (drop, path date, lineage) -> silver (enrich, dedup, finish,
expectations, SCD1 snapshot) -> gold (match, calendar, classify) -> summary.

Each function returns a lazy DataFrame; nothing is collected or cached. With
``materialize``, the silver snapshots are written to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import calendar_dim, classify, clean
from reconlake.operators import dedup, expectations, reconcile, scd, summary
from reconlake.session import _checkpoint_root, ensure_session, scratch_path
from reconlake.sources import fixtures, ingest

# Dedup and upsert keys of both flows.
CDR_DEDUP_KEYS = ["call_id", "msisdn", "service_type"]
EDR_DEDUP_KEYS = ["session_id"]
CDR_KEYS = ["call_id"]
EDR_KEYS = ["session_id"]
SEQUENCE = "silver_processing_time"


def bronze_cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.bronze_cdr(fixtures.cdr_raw(spark, sf_dir), path_col="source_path")


def bronze_edr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.bronze_edr(fixtures.edr_raw(spark, sf_dir), path_col="source_path")


def silver_cdr_staging(bronze: DataFrame, validate_first: bool = False) -> DataFrame:
    """Enrich, dedup (first arrival by event time), finish, then expectations on
    the result. ``validate_first`` applies the drop rules before the dedup
    instead, so an invalid first arrival cannot shadow a valid later one."""
    rows = clean.enrich_cdr(bronze)
    if validate_first:
        pre = [r for r in expectations.CDR_RULES if r.action == expectations.DROP]
        rows = expectations.apply(rows, pre)
    rows = dedup.first(rows, CDR_DEDUP_KEYS, ["timestamp_parsed", "bronze_source_file"])
    return expectations.apply(clean.finish_cdr(rows), expectations.CDR_RULES)


def silver_edr_staging(bronze: DataFrame, validate_first: bool = False) -> DataFrame:
    """Enrich, dedup on session_id (first by event time), expectations on the
    result; ``validate_first`` as for the usage flow."""
    rows = clean.clean_edr(bronze)
    if validate_first:
        pre = [r for r in expectations.EDR_RULES if r.action == expectations.DROP]
        rows = expectations.apply(rows, pre)
    rows = dedup.first(rows, EDR_DEDUP_KEYS, ["timestamp_parsed", "transaction_id"])
    return expectations.apply(rows, expectations.EDR_RULES)


def silver_cdr(staging: DataFrame) -> DataFrame:
    """SCD1 snapshot keyed by call_id."""
    return scd.apply_scd1(staging, CDR_KEYS, SEQUENCE)


def silver_edr(staging: DataFrame) -> DataFrame:
    return scd.apply_scd1(staging, EDR_KEYS, SEQUENCE)


def event_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(start, end): the whole years that cover all events, so no row falls out of the calendar."""
    day = F.to_date(F.col("ts").cast("timestamp"))
    return fixtures.read_table(ensure_session(spark), sf_dir, "events").agg(
        F.trunc(F.min(day), "year").alias("start"),
        F.date_sub(F.add_months(F.trunc(F.max(day), "year"), 12), 1).alias("end"))


def years_of(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day of the whole years that cover the data: one row of a small job."""
    row = event_years(spark, sf_dir).first()
    return str(row["start"]), str(row["end"])


def detail(cdr: DataFrame, edr: DataFrame, cal: DataFrame | None, cal_days: int | None = None,
           strategy: str = "split", with_timestamp: bool = True) -> DataFrame:
    rec = reconcile.match(cdr, edr, strategy=strategy)
    if cal is not None:
        rec = reconcile.calendar_join(rec, cal, cal_days)
    return classify.derive(rec, with_timestamp=with_timestamp)


@dataclass
class Pipeline:
    """Lazy handles on every stage for one testdata directory. Without a
    ``calendar_range`` the calendar covers all years of the data."""

    spark: SparkSession
    sf_dir: str
    calendar_range: tuple[str, str] | None = None
    strategy: str = "split"
    materialize: bool = False
    _memo: dict = field(default_factory=dict)

    def __post_init__(self):
        ensure_session(self.spark)
        if self.materialize:
            _checkpoint_root(self.spark)

    def _get(self, name, fn):
        if name not in self._memo:
            self._memo[name] = fn()
        return self._memo[name]

    def bronze_cdr(self):
        return self._get("bronze_cdr", lambda: bronze_cdr(self.spark, self.sf_dir))

    def bronze_edr(self):
        return self._get("bronze_edr", lambda: bronze_edr(self.spark, self.sf_dir))

    def cdr_staging(self):
        return self._get("cdr_staging", lambda: silver_cdr_staging(self.bronze_cdr()))

    def edr_staging(self):
        return self._get("edr_staging", lambda: silver_edr_staging(self.bronze_edr()))

    def _silver(self, df: DataFrame) -> DataFrame:
        """With ``materialize``, Parquet files under the shared checkpoint folder, so
        several gold frames reuse one silver computation (each reads the columns it
        needs) and a lost executor does not replay the bronze-to-silver chain."""
        if not self.materialize:
            return df
        path = scratch_path(self.spark, "silver")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def cdr(self):
        return self._get("cdr", lambda: self._silver(silver_cdr(self.cdr_staging())))

    def edr(self):
        return self._get("edr", lambda: self._silver(silver_edr(self.edr_staging())))

    def calendar(self):
        return self._get("calendar", lambda: calendar_dim.build(self.spark, *self._range()))

    def _range(self) -> tuple[str, str]:
        return self.calendar_range or self._get("years", lambda: years_of(self.spark, self.sf_dir))

    def calendar_days(self) -> int:
        """Rows of the calendar: known before the join is planned, so it is broadcast by its size."""
        return reconcile.calendar_days(*self._range())

    def matched(self):
        return self._get("matched", lambda: reconcile.match(self.cdr(), self.edr(), strategy=self.strategy))

    def classified(self, with_timestamp: bool = False):
        """Match + classify, before the calendar join."""
        return classify.derive(self.matched(), with_timestamp=with_timestamp)

    def detail(self, with_timestamp: bool = True):
        rec = reconcile.calendar_join(self.matched(), self.calendar(), self.calendar_days())
        return classify.derive(rec, with_timestamp=with_timestamp)

    def summary(self):
        return summary.summarize(self.detail())
