"""Query keys of the upsert tables in cells and of the incremental gold.

The silver rows are delivered in three batches: most rows; then updates (some move to
another date), new keys and deletions; then older versions that come late. The tables
must hold what the deliveries together say, the change log what the second one
changed, and the gold detail and summary, refreshed after the first and the last
delivery, must equal a rebuild.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.functions import classify
from reconlake.operators import incremental, reconcile, summary
from reconlake.operators.counts import CountTable
from reconlake.plans import pipeline as pl
from reconlake.plans.datasets import fold_detail
from reconlake.plans.queries import MONEY, _out
from reconlake.session import ensure_session, scratch_path
from reconlake.streaming.cells import CellTable
from reconlake.streaming.keyed import KeyedTable

GONE = "CANCELLED"


def _at(day: int) -> Column:
    return F.lit(f"2024-02-0{day} 00:00:00").cast("timestamp")


def _deliveries(rows: DataFrame, number: str, change: dict[str, Column], state: str) -> list[DataFrame]:
    """By ``number`` modulo 10: 0 is updated, 1 comes with the second delivery, 2 is
    deleted then; the third delivery has older versions of 0 and 2."""
    n = F.col(number) % 10
    old = rows.withColumn(state, F.lit("OLD"))
    second = rows.where(n == 0).withColumns(change).unionByName(rows.where(n == 1)).unionByName(
        rows.where(n == 2).withColumn(state, F.lit(GONE)))
    return [d.withColumn(pl.SEQUENCE, _at(day)).drop("__n")
            for d, day in ((rows.where(F.coalesce(n != 1, F.lit(True))), 2), (second, 3), (old.where(n.isin(0, 2)), 1))]


class Deliveries:
    """Both upsert tables, filled delivery by delivery."""

    def __init__(self, spark: SparkSession, sf: str):
        self.p = pl.Pipeline(ensure_session(spark), sf, materialize=True)
        self.spark = self.p.spark
        self.root = scratch_path(self.spark, "deliveries")

    # each side is built when it is first asked for

    @cached_property
    def usage_batches(self) -> list[DataFrame]:
        usage = self.p.cdr().withColumn("__n", F.col("sequence_number"))
        return _deliveries(usage, "__n", {
            "expected_charge": F.col("expected_charge") + F.lit(1.0),
            "expected_charge_decimal": (F.col("expected_charge_decimal") + F.lit(1)).cast("decimal(10,4)"),
            "business_date": F.when(F.col("__n") % 20 == 0, F.date_add("business_date", 1)).otherwise(F.col("business_date")),
            "status": F.lit("CORRECTED")}, "status")

    @cached_property
    def charge_batches(self) -> list[DataFrame]:
        charges = self.p.edr().withColumn("__n", F.substring("session_id", 9, 12).cast("bigint"))
        return _deliveries(charges, "__n", {
            "charge_amount": F.col("charge_amount") + F.lit(0.5),
            "charge_amount_decimal": (F.col("charge_amount_decimal") + F.lit(0.5)).cast("decimal(10,4)"),
            "billing_status": F.lit("ADJUSTED")}, "billing_status")

    @cached_property
    def usage(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/usage", self.usage_batches[0].schema, pl.CDR_KEYS, pl.SEQUENCE, buckets=2,
                          deletes=f"status = '{GONE}'")

    @cached_property
    def charges(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/charges", self.charge_batches[0].schema, pl.EDR_KEYS, pl.SEQUENCE, buckets=2,
                          deletes=f"billing_status = '{GONE}'")

    def deliver(self, *numbers: int, usage: bool = True, charges: bool = True) -> None:
        for n in numbers:
            if usage:
                self.usage.apply(self.usage_batches[n], n)
            if charges:
                self.charges.apply(self.charge_batches[n], n)

    def finish(self, rec: DataFrame) -> DataFrame:
        return classify.derive(reconcile.calendar_join(rec, self.p.calendar(), self.p.calendar_days()))

    def detail(self, counts: CountTable | None = None) -> CellTable:
        """The detail after the first delivery, then brought up to date by the delta join; ``counts``
        follows it."""
        calendar = [str(d) for d in self.p._range()]
        shape = self.finish(reconcile.match(self.usage_batches[0], self.charge_batches[0]))
        table = CellTable(self.spark, f"{self.root}/detail", shape.schema, ["business_date"])
        self.deliver(0)
        fold_detail(table, self.usage, self.charges, self.finish, calendar)
        if counts:
            counts.rebuild(table.read())
        self.deliver(1, 2)
        fold_detail(table, self.usage, self.charges, self.finish, calendar, counts.apply if counts else None)
        return table


def scd1_in_cells(spark, sf):
    """The upsert table after all deliveries: rows that moved to another date included."""
    d = Deliveries(spark, sf)
    d.deliver(0, 1, 2, charges=False)
    return _out(d.usage.snapshot().select("call_id", "business_date", "expected_charge", "expected_charge_decimal", "status"))


def scd1_change_log(spark, sf):
    """What the second and third delivery changed, as the table logged it."""
    d = Deliveries(spark, sf)
    d.deliver(0, 1, 2, charges=False)
    return d.usage.changes(since=0).select("call_id", "change_type", "business_date", "expected_charge", "status")


PRUNED_DAYS = (2, 9, 16)               # after the first date of the usage


def silver_date_pruned(spark, sf):
    """Three dates of the upsert table: only their folders are read."""
    d = Deliveries(spark, sf)
    d.deliver(0, 1, charges=False)
    first = d.usage.snapshot().agg(F.min("business_date")).first()[0]
    days = [F.date_add(F.lit(first).cast("date"), n) for n in PRUNED_DAYS]
    return d.usage.snapshot().where(F.col("business_date").isin(*days)).select("business_date", "call_id", "status")


def detail_incremental(spark, sf):
    return _out(Deliveries(spark, sf).detail().read())


def summary_by_delta(spark, sf):
    d = Deliveries(spark, sf)
    detail = d.detail()
    shape = summary.summarize(detail.read(), MONEY).schema
    table = CellTable(d.spark, f"{d.root}/summary", shape, ["business_date"])
    for version in (0, detail.version()):
        _fold_summary(table, detail, version)
    return table.read()


def _fold_summary(table: CellTable, detail: CellTable, version: int) -> None:
    """The summary of an earlier version of the detail first, so that the last step is a refresh."""
    if table.version() < 0:
        table.commit(summary.summarize(detail.read(version), MONEY), None, {"detail": version})
    else:
        incremental.refresh_summary(table, detail, lambda rows: summary.summarize(rows, MONEY))


def summary_by_counts(spark, sf):
    """The summary from the count table, which took the detail's changes as rows that went and came."""
    d = Deliveries(spark, sf)
    counts = CountTable(d.spark, f"{d.root}/counts", buckets=2)
    d.detail(counts)
    return counts.summary()


DELTA_QUERIES = {
    "scd1_in_cells": scd1_in_cells,
    "scd1_change_log": scd1_change_log,
    "silver_date_pruned": silver_date_pruned,
    "detail_incremental": detail_incremental,
    "summary_by_delta": summary_by_delta,
    "summary_by_counts": summary_by_counts,
}
