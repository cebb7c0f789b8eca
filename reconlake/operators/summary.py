"""Daily reconciliation summary, as DataFrame code and as SQL text, and its
incremental refresh by changed business dates.

The aggregate shuffles only partial rows: count/sum/avg combine on the map
side; the distinct count is planned by Spark as a two-level aggregate keyed by
(group, msisdn) first, so a subscriber holding many rows is collapsed per map
task before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ["business_date", "mismatch_type", "severity"]

# Fixed value: the materialized-view query, over a view named ``reconciliation_detail``.
SQL = """
SELECT business_date,
       mismatch_type,
       severity,
       count(*) AS record_count,
       sum(revenue_impact) AS total_revenue_impact,
       avg(revenue_impact) AS avg_revenue_impact,
       count(DISTINCT msisdn_normalized) AS unique_customers_affected
FROM reconciliation_detail
GROUP BY business_date, mismatch_type, severity
"""


# Same query with monetary rounding (see ``summarize(money_scale=4)``).
SQL_MONEY = """
SELECT business_date, mismatch_type, severity, record_count, total_revenue_impact,
       total_revenue_impact / priced AS avg_revenue_impact, unique_customers_affected
FROM (
  SELECT business_date,
         mismatch_type,
         severity,
         count(*) AS record_count,
         round(sum(revenue_impact), 4) AS total_revenue_impact,
         count(revenue_impact) AS priced,
         count(DISTINCT msisdn_normalized) AS unique_customers_affected
  FROM reconciliation_detail
  GROUP BY business_date, mismatch_type, severity
)
"""


def summarize(detail: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Daily summary. With ``money_scale`` the total is rounded to that many
    decimals and the average is that total over the non-NULL count: amounts
    carry at most that many decimals, so the rounded total is exact and the
    result no longer depends on summation order (partitioning, engine)."""
    if money_scale is None:
        return detail.groupBy(*GROUP).agg(
            F.count(F.lit(1)).alias("record_count"),
            F.sum("revenue_impact").alias("total_revenue_impact"),
            F.avg("revenue_impact").alias("avg_revenue_impact"),
            F.countDistinct("msisdn_normalized").alias("unique_customers_affected"),
        )
    agg = detail.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.round(F.sum("revenue_impact"), money_scale).alias("total_revenue_impact"),
        F.count("revenue_impact").alias("__priced"),
        F.countDistinct("msisdn_normalized").alias("unique_customers_affected"),
    )
    return agg.select(*GROUP, "record_count", "total_revenue_impact",
                      (F.col("total_revenue_impact") / F.col("__priced")).alias("avg_revenue_impact"),
                      "unique_customers_affected")


def summarize_sql(spark: SparkSession, detail: DataFrame, view: str = "reconciliation_detail",
                  money: bool = False) -> DataFrame:
    detail.createOrReplaceTempView(view)
    return spark.sql((SQL_MONEY if money else SQL).replace("reconciliation_detail", view))


def fingerprint(detail: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per business date: row count and the sum of 64-bit row hashes (as
    decimal, so it cannot overflow). Order-free, and a partial aggregate: one
    row per date leaves each map task."""
    cols = cols or [c for c in detail.columns if c != "business_date"]
    h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return detail.groupBy("business_date").agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h"))


def changed_dates(before: DataFrame, after: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Business dates whose rows differ between two detail versions.

    Compares per-date fingerprints instead of joining the row sets: two scans
    and two small aggregates, no shuffle of the detail rows. A date is
    reported when its count or hash sum differs, or it exists on one side only.
    A change that keeps both count and 64-bit hash sum equal would be missed;
    the chance is about 2^-64 per date."""
    cols = cols or [c for c in after.columns if c != "business_date"]
    a = fingerprint(before.select("business_date", *cols), cols).alias("a")
    b = fingerprint(after.select("business_date", *cols), cols).alias("b")
    j = a.join(b, "business_date", "full_outer")
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h"))
    return j.where(~same & F.col("business_date").isNotNull()).select("business_date")


def refresh(summary: DataFrame, detail: DataFrame, dates: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Summary after recomputing only ``dates`` from ``detail``.

    Exact (distinct counts included) because the group key contains the date:
    rows of unchanged dates are kept as they are, changed dates are recomputed
    from the detail restricted to them (a left-semi join against the small
    date set, planned as a broadcast by size). Written with
    ``partitionOverwriteMode=dynamic`` this rewrites only those partitions."""
    keep = summary.join(dates, "business_date", "left_anti")
    fresh = summarize(detail.join(dates, "business_date", "left_semi"), money_scale)
    return keep.unionByName(fresh)
