"""Connected components of an edge table, by contraction to minimum neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm.store import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the least node
    of its component.

    Each round points every root at its least neighbour (never upwards, so there
    are no cycles), follows the pointers twice, and contracts the edges. A hub
    costs no more than its edges: the minimum is combined before the shuffle, and
    the joins are ordinary shuffle joins that can be split at hot keys."""
    spark = edges.sparkSession
    labels = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("label"))
        step = written(spark, f"{name}-step", step)
        for _ in range(2):
            step = _follow(step, step)
        step = written(spark, f"{name}-step", step)
        labels = step if labels is None else written(spark, f"{name}-labels", _follow(labels, step))
        to_a = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        to_b = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = written(spark, f"{name}-edges", edges.join(to_a, "a").join(to_b, "b").where("la <> lb")
                        .select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
        if edges.isEmpty():
            return labels


def _follow(labels: DataFrame, step: DataFrame) -> DataFrame:
    """labels, each replaced by what ``step`` says of it (if it says anything)."""
    to = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return labels.join(to, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
