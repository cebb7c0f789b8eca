import random

import numpy as np
import pyarrow as pa
import pytest

from reconlake.llm import graph, op5_minhash, words
from reconlake.llm.queries import op5_minhash_near_dedup
from tests.llm.helpers import DOC, by_id, near_components, words_of

SMALL = "/root/testdata/sf0.001"


def test_word_hashes_follow_the_words(monkeypatch):
    texts = ["", None, "One  two\tTHREE\n", "é É\xa0x\x1fy", "a" * 300 + " b", " lead", "tail "]
    for piece in (1 << 20, 7):
        monkeypatch.setattr(words, "PIECE", piece)
        raw, ends = words.text_buffer(pa.array(texts))
        h, _, _, at = words.word_hashes(raw, ends)
        known = {}
        for i, t in enumerate(texts):
            own = words_of(t)
            assert at[i + 1] - at[i] == len(own)
            for w, x in zip(own, h[at[i]:at[i + 1]], strict=True):
                assert known.setdefault(w, x) == x
        assert len(set(known.values())) == len(known)


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 6, 60, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: max(1, int(n * 0.9))], rng.integers(0, 1 << 63, n // 10).astype(np.uint64)]))
        s = op5_minhash.signature([a, b], 240, op5_minhash._probes(240))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.25
        assert np.isin(s[0], a).all() and np.isin(s[1], b).all()


def test_fixture(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert by_id(op5_minhash_near_dedup(spark, SMALL).collect()) == by_id(near_components(rows))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "w" + str(rng.randrange(10 ** 6))
    return " ".join(w)


def test_groups_of_many_near_copies(spark):
    """Copies of one text with few and many edits: most stars are mixed, and no link is lost."""
    rng = random.Random(6)
    base = " ".join("b" + str(rng.randrange(400)) for _ in range(160))
    rows = [(i, edited(rng, base, rng.randint(0, 5))) for i in range(300)]
    rows += [(1000 + i, edited(rng, rows[rng.randrange(300)][1], 1)) for i in range(80)]
    got = op5_minhash.near_duplicates(spark.createDataFrame(rows, DOC))
    assert by_id(got.collect()) == by_id(near_components(rows))


@pytest.mark.parametrize("rows", [
    [],
    [(1, None), (2, ""), (3, " \n"), (4, None)],
    [(5, "A b"), (3, "a  B"), (None, "a b"), (3, "a b"), (9, "a b c d e"), (8, "A B C D E"), (7, "a b c d f")],
    [(None, "x y z"), (None, "X y z"), (None, None)],
    [(2, "long " * 50_000 + "end"), (1, "Long " * 50_000 + "end"), (3, "short")],
])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], DOC + ", node string, n_shingles int")
    assert by_id(op5_minhash.near_duplicates(df).collect()) == by_id(near_components(rows))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5001), (5000, 5001)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {got[i] for i in range(201)} == {0}
    assert {got[i] for i in range(1000, 1301)} == {1000}
    assert got[5001] == 5000 and len(got) == 201 + 301 + 2
