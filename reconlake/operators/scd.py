"""Keyed upsert (SCD type 1) without MERGE, and change rows between snapshots.

Batch: the new snapshot is the latest row per key over (old snapshot ∪ changes)
by the sequence column, tie-broken by event time then a row hash (the
sequence in the reference is one value per micro-batch, so ties are normal).
The ranking is an aggregate (``max_by``), which pre-aggregates per map task.

Stream: ``streaming/upsert.py`` runs the same function in ``foreachBatch`` over
the touched key buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.operators import dedup


def apply_scd1(df: DataFrame, keys: list[str], sequence_by: str,
               except_cols: tuple[str, ...] = (), tie_break: tuple[str, ...] = ("timestamp_parsed",)) -> DataFrame:
    """Latest row per key. ``except_cols`` are left out of the stored row."""
    order = [sequence_by] + [c for c in tie_break if c in df.columns and c != sequence_by]
    out = dedup.latest(df, keys, order)
    return out.drop(*[c for c in except_cols if c in out.columns])


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], sequence_by: str,
           except_cols: tuple[str, ...] = ()) -> DataFrame:
    """Target snapshot after applying ``changes`` (same columns as the target,
    minus ``except_cols``)."""
    changes = changes.drop(*[c for c in except_cols if c in changes.columns])
    return apply_scd1(target.unionByName(changes, allowMissingColumns=True), keys, sequence_by)


def changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Change rows between two snapshots unique by ``keys``, in change-feed form:
    ``insert``, ``delete``, ``update_preimage`` + ``update_postimage``.

    One full outer join on the key (unique on both sides, so no hot key);
    updates are detected by null-safe equality of the non-key columns."""
    vals = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*vals).alias("__v"), F.lit(True).alias("__e"))
    a = after.select(*keys, F.struct(*vals).alias("__v"), F.lit(True).alias("__e"))
    j = b.alias("b").join(a.alias("a"), on=keys, how="full_outer")
    kind = (F.when(F.col("b.__e").isNull(), F.array(F.lit("insert")))
             .when(F.col("a.__e").isNull(), F.array(F.lit("delete")))
             .when(~F.col("b.__v").eqNullSafe(F.col("a.__v")),
                   F.array(F.lit("update_preimage"), F.lit("update_postimage"))))
    rows = j.select(*keys, F.col("b.__v").alias("__b"), F.col("a.__v").alias("__a"),
                    F.explode(kind).alias("change_type"))
    image = F.when(F.col("change_type").isin("delete", "update_preimage"), F.col("__b")).otherwise(F.col("__a"))
    return rows.select(*keys, "change_type", image.alias("__img")).select(
        *keys, "change_type", *[F.col(f"__img.{c}").alias(c) for c in vals])
