"""The daily summary as a count table that takes retractions.

One row per (business date, outcome, severity, customer): its detail rows, how many of
them are priced, and their amount (as a decimal, so that what is added and later taken
away cancels exactly). A change of the detail is applied as the rows that came and the
rows that went; the work follows their number and the touched cells of the table, not
the detail of the dates. Distinct customers of a group are its rows in this table, so
they stay exact under retraction, which a stored distinct count could not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reconlake.operators import summary
from reconlake.session import scratch_path
from reconlake.streaming.cells import CellTable

CUSTOMER, BUCKET = "msisdn_normalized", "customer_bucket"
KEY = [*summary.GROUP, CUSTOMER]
SUMS = {"n": "bigint", "priced": "bigint", "amount": "decimal(38,4)"}
SCHEMA = ("business_date date, mismatch_type string, severity string, msisdn_normalized string, n bigint, priced bigint, "
          "amount decimal(38,4), customer_bucket int")


def contributions(detail: DataFrame, sign: int = 1) -> DataFrame:
    """What detail rows add to the counts (``sign`` -1: what they take away)."""
    impact = F.round("revenue_impact", 4).cast("decimal(38,4)")
    sums = detail.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count("revenue_impact").alias("priced"),
                                    F.coalesce(F.sum(impact), F.lit(0)).alias("amount"))
    return sums.select(*KEY, *[(F.col(c) * sign).cast(t).alias(c) for c, t in SUMS.items()])


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(*[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])


class CountTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 4):
        self.spark, self.buckets = spark, buckets
        self.table = CellTable(spark, path, StructType.fromDDL(SCHEMA), ["business_date", BUCKET])

    def _placed(self, rows: DataFrame) -> DataFrame:
        """With the cell of each customer, so that a date's rows lie in several."""
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(CUSTOMER), F.lit(self.buckets)).cast("int"))

    def rebuild(self, detail: DataFrame, state: dict | None = None) -> int:
        return self.table.commit(self._placed(contributions(detail)), None, state)

    def apply(self, removed: DataFrame, added: DataFrame, state: dict | None = None) -> int:
        """Take ``removed`` detail rows away and add ``added`` ones; the new version."""
        change = _added_up(contributions(added).unionByName(contributions(removed, -1))).where(
            "n <> 0 or priced <> 0 or amount <> 0")
        path = scratch_path(self.spark, "count-changes")
        self._placed(change).write.parquet(path)
        change = self.spark.read.schema(self.table.schema).parquet(path)
        cells = change.select(*self.table.by).distinct()
        merged = _added_up(self.table.read(cells=cells).select(*KEY, *SUMS).unionByName(change.select(*KEY, *SUMS)))
        return self.table.commit(self._placed(merged.where("n <> 0")), cells, state)

    def summary(self, dates: DataFrame | None = None) -> DataFrame:
        """The daily summary, of all dates or of some, with amounts as ``summarize(money_scale=4)`` gives them."""
        rows = self.table.read(cells=dates)
        sums = rows.groupBy(*summary.GROUP).agg(F.sum("n").alias("record_count"), F.sum("amount").cast("double").alias("t"),
                                                F.sum("priced").alias("p"), F.count(CUSTOMER).alias("unique_customers_affected"))
        total = F.when(F.col("p") > 0, F.col("t"))
        return sums.select(*summary.GROUP, "record_count", total.alias("total_revenue_impact"),
                           (total / F.col("p")).alias("avg_revenue_impact"), "unique_customers_affected")
