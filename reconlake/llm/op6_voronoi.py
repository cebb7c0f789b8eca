"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors become integers, floor(scale * x) per component. Pivots are the vectors
with the least hashes; every query and every candidate goes to its nearest pivot's
cell. From cell summaries alone (pivot, radius, largest norm, the k + 1 members
nearest to the pivot) each query cell gets a bound: at least k candidates score as
much with every query in it. A candidate cell is sent to a group of query cells only
if some member could score that much. Each (query group, block) pair is solved
locally by one integer matrix product, and the k best per query are kept of what
all blocks gave.

For a query q in the cell of pivot P (radius R) and a candidate x in the cell of
pivot p (radius r, largest norm M):
    q.x >= P.x - R |x|       and       q.x <= P.x + R |x| <= P.p + |P| r + R M.
The first, over the members in the summaries, gives the query cell's bound; the
second says which candidate cells can reach it.

Blocks hold at most ``block_rows`` candidates, so a cell with very many members (or
copies of one vector) is many blocks, none of which is large.

Nulls, ties, odd rows: vectors that are null, or hold a null or non-finite
component, take no part; of vectors of different lengths, the shorter counts as
filled up with zeros. Ties go to the smaller vec_id. Rows without vec_id take no
part. Rows that repeat a vec_id are candidates of their own, though a query never meets
rows of its own vec_id; as a query, a repeated id counts once, with its least vector. Fewer candidates than k: all are returned.
Scores that don't fit 64 bits are not defined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reconlake.llm.store import written

EXACT = 2.0 ** 52


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    v = F.col("embedding")
    fine = (F.col("vec_id").isNotNull() & v.isNotNull()
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return vectors.where(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _padded(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _assigner(pivots: np.ndarray):
    """Adds each vector's cell and its distance to the pivot."""
    norms = (pivots ** 2).sum(1)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 4096):
                part = b.iloc[lo:lo + 4096]
                x = _padded(part["v"].tolist(), pivots.shape[1])
                cell = (norms[None] - 2 * (x @ pivots.T)).argmin(1)
                away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
                yield pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "cell": cell.astype(np.int32),
                                    "away": away, "norm": np.sqrt((x ** 2).sum(1))})
    return assign


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; floating point as long as it is exact."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.shape[1], 1)
    if bound < EXACT:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row; equal scores by place."""
    n = scores.shape[1]
    if n <= k:
        return np.tile(np.arange(n), (len(scores), 1))
    if max(int(scores.max()), -int(scores.min())) < (1 << 62) // n:
        return np.argpartition(np.arange(n) - scores * n, k - 1, axis=1)[:, :k]
    return np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]


NONE = -(2 ** 63 - 1)              # score of no candidate
OPEN_GROUPS = 16                   # query blocks whose best a task keeps at once


class _Kept:
    """The k best candidates so far of the queries of one block."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.score = np.zeros((len(queries), 0), np.int64)
        self.vec = np.zeros((len(queries), 0), np.int64)

    def add(self, lo: int, score: np.ndarray, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best of what is kept and of new candidates, for the queries from lo on."""
        rows = slice(lo, lo + len(score))
        score = np.where(vec == self.queries[rows, None], NONE, score)
        score = np.concatenate([self.score[rows], score], axis=1)
        vec = np.concatenate([self.vec[rows], vec], axis=1)
        order = np.lexsort((vec, -score))[:, :self.k]
        return np.take_along_axis(score, order, 1), np.take_along_axis(vec, order, 1)

    def rows(self) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": np.repeat(self.queries, self.score.shape[1]),
                            "vec_id": self.vec.reshape(-1), "score": self.score.reshape(-1)})
        return out[out["score"] != NONE]


def _solver(k: int, width: int):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: dict[bytes, _Kept] = {}
        for b in batches:
            for r in b.itertuples(index=False):
                queries, data = _unpacked(r.q, r.q_kind, width), _unpacked(r.x, r.x_kind, width)
                ids, asked = np.asarray(r.x_ids, np.int64), np.asarray(r.q_ids, np.int64)
                name = asked.tobytes()
                if name not in open_ and len(open_) >= OPEN_GROUPS:
                    yield open_.pop(next(iter(open_))).rows()
                kept = open_.setdefault(name, _Kept(asked, k))
                parts = []
                for lo in range(0, len(queries), 512):
                    score = _products(queries[lo:lo + 512], data)
                    # as many more as a query's own rows, which don't count
                    top = _best(score, k + int((ids[:, None] == asked[None, lo:lo + 512]).sum(0).max()))
                    parts.append(kept.add(lo, np.take_along_axis(score, top, 1), ids[top]))
                wide = max(p[0].shape[1] for p in parts)
                kept.score, kept.vec = (np.concatenate([np.pad(p[i], ((0, 0), (0, wide - p[i].shape[1])), constant_values=fill)
                                                        for p in parts]) for i, fill in ((0, NONE), (1, 0)))
        for kept in open_.values():
            yield kept.rows()
    return solve


def _packed(rows: list, width: int) -> tuple[str, bytes]:
    """The integers in the smallest type that holds them all."""
    values = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        values[i, :len(r)] = r
    top = np.abs(values).max(initial=0)
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
    return kind, values.astype(kind).tobytes()


def _unpacked(blob: bytes, kind: str, width: int) -> np.ndarray:
    values = np.frombuffer(blob, kind).reshape(-1, width)
    return values.astype(np.int64) if kind == "<i8" else values.astype(np.float64)


def _packer(width: int, block_rows: int):
    """Rows of one partition, sorted by cell and vec_id, as blocks of one cell each."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, ids, rows, radius, norm = None, [], [], 0.0, 0.0

        def block():
            kind, blob = _packed(rows, width)
            return pd.DataFrame([{"cell": cell, "ids": np.array(ids, np.int64), "radius": radius, "norm": norm,
                                  "kind": kind, "blob": blob}])
        for b in batches:
            for r in b.itertuples(index=False):
                if ids and (r.cell != cell or len(ids) >= block_rows):
                    yield block()
                    ids, rows, radius, norm = [], [], 0.0, 0.0
                cell = r.cell
                ids.append(r.vec_id)
                rows.append(r.v)
                radius, norm = max(radius, r.away), max(norm, r.norm)
        if ids:
            yield block()
    return pack


BLOCKS = "cell int, ids array<bigint>, radius double, norm double, kind string, blob binary"


def needed_cells(pivots: np.ndarray, queries: list, data: list, members: np.ndarray, k: int, slack: float = 1e-6
                 ) -> list[tuple[int, int]]:
    """(query cell, data cell) pairs that can hold one of the k best of some query.

    ``queries``: (cell, radius); ``data``: (cell, radius, largest norm); ``members``:
    vectors of different ids from all cells. k + 1 of them, one of which may be the
    query itself, bound each query cell's k-th best score from below."""
    out = []
    for qc, r in queries:
        p = pivots[qc]
        low = np.sort(members @ p - r * np.sqrt((members ** 2).sum(1)))[::-1]
        bound = low[k] if len(low) > k else -np.inf
        for xc, radius, norm in data:
            high = pivots[xc] @ p + np.sqrt((p ** 2).sum()) * radius + r * norm
            if high + slack * (1 + abs(high)) >= bound:
                out.append((int(qc), int(xc)))
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, n_pivots: int = 64,
          block_rows: int = 1024, group_queries: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k best partners of every row of ``vectors``
    (vec_id, embedding) whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    data = integer_vectors(vectors, scale)
    # at most n_pivots vectors come to the driver
    pick = data.select(F.xxhash64("v").alias("h"), "v").dropDuplicates(["h"]).orderBy("h").limit(n_pivots).collect()
    if not pick:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(1, data.agg(F.max(F.size("v"))).first()[0])
    pivots = _padded([r["v"] for r in pick], width)
    placed = written(spark, "voronoi-cells", data.mapInPandas(
        _assigner(pivots), "vec_id long, v array<long>, cell int, away double, norm double"))
    # of an id that is repeated, one row is the query
    queries = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min(F.struct("v", "cell", "away", "norm")).alias("q")).select("vec_id", "q.*")

    # summaries: a row per cell, and k + 1 members of each cell with different ids
    cells = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.max("norm").alias("norm"),
                                       F.count(F.lit(1)).alias("n")).collect()
    asked = queries.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    nearest = placed.groupBy("cell", "vec_id").agg(F.min("away").alias("away"), F.min("v").alias("v")).withColumn(
        "i", F.row_number().over(Window.partitionBy("cell").orderBy("away", "vec_id"))).where(F.col("i") <= k + 1)
    one_each = nearest.groupBy("vec_id").agg(F.min("v").alias("v")).collect()
    pairs = needed_cells(pivots, [(r["cell"], r["radius"]) for r in asked],
                         [(r["cell"], r["radius"], r["norm"]) for r in cells], _padded([r["v"] for r in one_each], width), k)
    if not pairs:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    # query cells near each other travel together, so that data is sent once per group
    groups = max(1, -(-sum(r["n"] for r in asked) // group_queries))
    lead = pivots[:min(groups, len(pivots))]
    of_cell = {r["cell"]: int(((lead - pivots[r["cell"]]) ** 2).sum(1).argmin()) for r in asked}
    send = spark.createDataFrame(sorted({(of_cell[qc], xc) for qc, xc in pairs}), "grp int, xcell int")
    to_group = spark.createDataFrame(sorted(of_cell.items()), "cell int, grp int")

    # a row per cell: in how many parts it is dealt out, so that no cell has to fit one task
    parts = spark.createDataFrame([(r["cell"], r["n"] // (16 * block_rows) + 1) for r in cells], "cell int, parts long")

    def blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
        salted = rows.join(F.broadcast(parts), "cell", "left").withColumn(
            "salt", F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1))))
        dealt = salted.repartition("cell", "salt").sortWithinPartitions("cell", "vec_id").select(rows.columns)
        return written(spark, name, dealt.mapInPandas(_packer(width, size), BLOCKS))

    grouped = queries.join(F.broadcast(to_group), "cell").withColumn("cell", F.col("grp"))
    q = blocks(grouped.select("vec_id", "v", "cell", "away", "norm"), "voronoi-queries", group_queries)
    x = blocks(placed, "voronoi-data", block_rows)
    right = x.select(F.col("cell").alias("xcell"), F.col("ids").alias("x_ids"), F.col("kind").alias("x_kind"),
                     F.col("blob").alias("x"))
    left = q.select(F.col("cell").alias("grp"), F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"),
                    F.col("blob").alias("q"))
    # at most n_pivots squared rows
    local = right.join(F.broadcast(send), "xcell").join(left, "grp").select("q_ids", "q_kind", "q", "x_ids", "x_kind", "x")
    near = local.mapInPandas(_solver(k, width), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
