import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from reconlake.llm import op12_search
from tests.llm.helpers import DOC, LOWER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string"


def ranked(docs, items, k=50):
    """(item_id, rank, doc_id, score) by scoring every document."""
    bags = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            s = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(b):
                m = 100 - 50 + (50 * sum(b.values()) * n) // total
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 20 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def search(spark, docs, items, k=50, **options):
    index = op12_search.build_index(spark.createDataFrame(docs, DOC))
    got = op12_search.search(index, spark.createDataFrame(items, ITEM), k, **options)
    return sorted([tuple(r) for r in got.collect()], key=str)


def texts(rng, n, words=40):
    vocabulary = [f"w{i}" for i in range(words)]
    weight = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocabulary, weight, k=rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("segment,piece,window", [(200, 64, 3), (4000, 1 << 20, 16), (1 << 24, 100, 2048)])
def test_equals_scoring_every_document(spark, monkeypatch, segment, piece, window):
    monkeypatch.setattr(op12_search, "SEGMENT", segment)
    monkeypatch.setattr(op12_search, "PIECE", piece)
    monkeypatch.setattr(op12_search, "WINDOW", window)
    rng = random.Random(segment)
    docs = list(enumerate(texts(rng, 300)))
    items = list(enumerate(texts(rng, 25)))
    assert search(spark, docs, items, 10) == ranked(docs, items, 10)


def test_the_best_sums_of_lists():
    """Accumulators, probed lists and windows against plain sums."""
    rng = np.random.default_rng(3)
    for n_docs, k in ((50, 3), (5000, 10), (9000, 50)):
        for _ in range(20):
            lists = []
            for size in rng.integers(0, n_docs, rng.integers(1, 12)) // rng.integers(1, 60, 1):
                docs = np.sort(rng.choice(n_docs, size, replace=False))
                lists.append((docs, rng.integers(1, 2 + int(rng.integers(1, 400)), size)))
            whole = np.zeros(n_docs, np.int64)
            for docs, share in lists:
                whole[docs] += share
            order = np.lexsort((np.arange(n_docs), -whole))[:k]
            order = order[whole[order] > 0]
            found, score = op12_search.best(lists, n_docs, k)
            assert found.tolist() == order.tolist() and score.tolist() == whole[order].tolist()


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,-\x00\x7f"), (None, "apple pie"), (5, "Apple APPLE éclair"), (5, "apple pie"), (5, "apple pie"),
            (4, "apple pie"), (6, "漢字 apple漢"), (7, "pie " * 60_000 + "x" * 50_000), (8, "ÉCLAIR éclair ß 3.14")]
    items = [(1, "Apple pie"), (1, "Apple pie"), (2, None), (3, ""), (None, "éclair ÉCLAIR 14"), (4, "apple漢 apple漢"), (5, "absent"),
             (6, "pie " + "x" * 50_000)]
    assert search(spark, docs, items) == ranked(docs, items)
    assert search(spark, docs, items, 2, block_terms=10_000) == ranked(docs, items, 2)


def test_empty_tables(spark):
    assert search(spark, [], [(1, "a b")]) == []
    assert search(spark, [(1, "a b")], []) == []
    assert search(spark, [(1, None)], [(1, "a b")]) == []


def test_extra_columns_and_one_index_for_many_searches(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", [1]), (2, "b c d", "t", [2])], DOC + ", term string, docs array<int>")
    index = op12_search.build_index(docs)
    assert op12_search.build_index(docs).count() == index.count() > 0
    items = spark.createDataFrame([(9, "a", 1.0)], ITEM + ", score double")
    assert [r.doc_id for r in op12_search.search(index, items).collect()] == [1]
    assert sorted(r.term for r in index.where("term is not null").collect()) == sorted(["a", "b", "c", "b", "c", "d"]) \
        or index.where("term is not null").count() == 4
