"""Batch dedup with a deterministic winner.

``first`` keeps, per key, the row that sorts first by the ordering columns
(NULLs last), tie-broken by a hash of the whole row. It is an aggregate
(``min_by`` over a struct of the row), not a window: Spark runs a partial
aggregate before the shuffle, so a key holding a large share of the rows is
collapsed on the map side instead of landing whole in one task.

Streaming dedup (first arrival wins, state kept) lives in ``streaming/``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = "__row"
_ORD = "__ord"


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def ordering(df: DataFrame, order_cols: list[str], descending: bool = False) -> Column:
    """Struct that compares like ORDER BY order_cols NULLS LAST, row hash.
    For descending use, NULLs must still lose, so the null flag is inverted."""
    parts = []
    for c in order_cols:
        flag = F.col(c).isNotNull() if descending else F.col(c).isNull()
        parts += [flag.alias(f"{c}__null"), F.col(c).alias(c)]
    parts.append(row_hash(df).alias("__hash"))
    return F.struct(*parts)


def _unpack(best: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Key columns come from the grouping itself, the rest from the kept row:
    the output stays hash-partitioned on the key attributes, so a following
    aggregate or join on the same key needs no second shuffle."""
    return best.select(*[F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c) for c in cols])


def first(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the earliest by ``order_cols`` (NULLs last)."""
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    best = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordering(df, order_cols)).alias(_ROW)))
    return _unpack(best, cols, keys)


def latest(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the latest by ``order_cols`` (NULLs lose)."""
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    best = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]),
                            ordering(df, order_cols, descending=True)).alias(_ROW)))
    return _unpack(best, cols, keys)
