import math
import random

import numpy as np
import pytest

from reconlake.llm import op6_voronoi
from reconlake.llm.queries import op6_voronoi_top_k
from tests.llm.helpers import by_id

SMALL = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>"


def brute(rows, k, every, scale=256):
    fine = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in fine:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in fine if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def test_fixture(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert by_id(op6_voronoi_top_k(spark, SMALL).collect()) == by_id(brute(rows, 5, 50))


@pytest.mark.parametrize("pivots,block,group", [(1, 1000, 1000), (7, 3, 2), (64, 10, 5)])
def test_any_partition_gives_the_same_rows(spark, pivots, block, group):
    rng = random.Random(pivots)
    centres = [[rng.uniform(-3, 3) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]                     # copies of one vector: ties
    got = op6_voronoi.top_k(spark.createDataFrame(rows, VEC), 5, 10, 256, pivots, block, group)
    assert by_id(got.collect()) == by_id(brute(rows, 5, 10))



def test_bounds_leave_out_far_cells():
    """Cells that can't matter are not sent, and no needed one is left out."""
    rng = np.random.default_rng(0)
    pivots = np.array([[100.0, 0], [-100.0, 0], [0, 100.0]])
    data = [p + rng.normal(size=(20, 2)) for p in pivots]
    members = np.concatenate([d[:4] for d in data])
    cells = [(c, float(np.sqrt(((d - pivots[c]) ** 2).sum(1)).max()), float(np.sqrt((d ** 2).sum(1)).max()))
             for c, d in enumerate(data)]
    assert op6_voronoi.needed_cells(pivots, [(0, 2.0)], cells, members, 3) == [(0, 0)]


@pytest.mark.parametrize("rows", [
    [],
    [(0, [1.0, 2.0])],
    [(0, None), (50, [float("nan")]), (100, [None, 1.0]), (150, [float("inf")]), (None, [1.0])],
    [(0, [1.0, -2.0]), (0, [1.0, -3.0]), (0, [0.5, 1.0]), (1, [1.0]), (1, [1.0]), (2, [-1.0, 4.0, 5.0]), (50, []), (51, [0.0])],
    [(0, [3e12, 1.0]), (1, [1.0, 2.0]), (2, [0.001, 2.0]), (3, [-0.001, -2.0])],
])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], VEC + ", cell int")
    assert by_id(op6_voronoi.top_k(df).collect()) == by_id(brute(rows, 5, 50))
