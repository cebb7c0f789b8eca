import random

import pyarrow as pa

from reconlake.llm import op7_tiling, words
from reconlake.llm.queries import op7_string_tiling
from tests.llm.helpers import DOC

SMALL = "/root/testdata/sf0.001"
ITEM = "item_id long, text string"


def token_list(text):
    """Token hashes of one text, by the operator's own tokens (tested below)."""
    raw, ends = words.text_buffer(pa.array([text]))
    return op7_tiling.tokens(raw, ends)[0]


def greedy(item, doc, least):
    """Greedy string tiling by trying everything: repeatedly mark the longest match."""
    free_i, free_d, covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and free_i[i + n] and free_d[d + n]
                       and item[i + n] == doc[d + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return covered
        for x in range(n):
            free_i[i + x] = free_d[d + x] = False
        covered += n


def test_tokens():
    a, b = token_list("The ÉCOLE, a--b!"), token_list("the école a b")
    assert a.tolist() == b.tolist() and len(a) == 4


def test_tiles_equal_exhaustive_tiling():
    rng = random.Random(2)
    for _ in range(120):
        item = [rng.randint(0, 60) for _ in range(rng.randint(5, 40))]
        cuts = sorted(rng.sample(range(len(item) + 1), 2))
        parts = [item[:cuts[0]], item[cuts[0]:cuts[1]], item[cuts[1]:], [rng.randint(0, 60) for _ in range(10)]]
        rng.shuffle(parts)
        doc = [x for p in parts for x in p]
        as_array = lambda xs: words.mix(op7_tiling.np.array(xs, op7_tiling.U))
        assert op7_tiling.tile(as_array(item), as_array(doc), 4) == greedy(item, doc, 4)


def test_fixture(spark):
    """On whole texts: the seeds lose no tile."""
    items = [(r.item_id, token_list(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    grams = {}
    for i, t in items:
        for x in words.shingle_hashes(t, 5).tolist():
            grams.setdefault(x, set()).add(i)
    of = dict(items)
    some = 0
    for r in op7_string_tiling(spark, SMALL).collect():
        token = token_list(docs[r.doc_id])
        near = set().union(*[grams.get(x, ()) for x in words.shingle_hashes(token, 5).tolist()], set())
        full = {i: op7_tiling.tile(of[i], token, 5) / len(of[i]) for i in near}
        assert r.items == sorted(i for i, c in full.items() if c >= 0.5)
        assert r.contaminated == bool(r.items) and r.n_items == len(r.items)
        some += r.contaminated
    assert some


def test_odd_rows_and_blocks(spark):
    w = [f"t{i}" for i in range(60)]
    item = " ".join(w[:30])
    bench = spark.createDataFrame([(1, item), (1, " ".join(w[30:60])), (2, None), (3, "too short"), (None, "a b c d e f g h")],
                                  ITEM)
    moved = " ".join(w[20:30] + ["x"] * 3 + w[:10] + ["y"] * 40 + w[10:20])
    rows = [(1, None), (2, ""), (3, item.upper()), (4, moved), (5, " ".join(w[:14])), (6, " ".join(w[:15])),
            (6, "A, b. c d! e f g h"), (None, item), (7, "z " * 100_000 + item), (8, (item + " ") * 200),
            (9, " ".join(x + " gap" for x in w))]
    df = spark.createDataFrame([(*r, "t") for r in rows], DOC + ", tiles string")
    want = {(1, 0), (2, 0), (3, 1), (4, 1), (5, 0), (6, 1), (None, 1), (7, 1), (8, 1), (9, 0)}
    got = op7_tiling.coverage(df, bench).collect()
    assert len(got) == len(rows) and {(r.doc_id, int(r.contaminated)) for r in got} == want
    kept = op7_tiling.decontaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 9]
    base = df.select("doc_id", "text")
    for size in (8, 40):                                   # many blocks: the same tiles
        many = op7_tiling.with_tiles(base, bench, block_tokens=size)
        one = op7_tiling.with_tiles(base, bench)
        key = lambda d: sorted((str(r.doc_id), len(r.text or ""), sorted(map(str, r.tiles or []))) for r in d.collect())
        assert key(many) == key(one)
    assert op7_tiling.coverage(df.limit(0), bench).count() == 0
    assert not op7_tiling.coverage(df, bench.limit(0)).where("contaminated").count()


def test_tiles_of_overlapping_quotes():
    as_array = lambda xs: words.mix(op7_tiling.np.array(xs, op7_tiling.U))
    item = list(range(28))
    doc = item[0:6] + [90] + item[5:11] + [91]
    assert op7_tiling.tile(as_array(item), as_array(doc), 5) == greedy(item, doc, 5) == 11
    rng = random.Random(6)
    for n in range(300):
        item = [rng.randint(0, 2 + n % 4) for _ in range(rng.randint(5, 30))]
        doc = [rng.randint(0, 2 + n % 4) for _ in range(rng.randint(5, 40))]
        doc[5:5] = item[n % 3:n % 3 + 9]
        assert op7_tiling.tile(as_array(item), as_array(doc), 3) == greedy(item, doc, 3)


def test_unspaced_scripts_and_unicode_gaps(spark):
    import numpy as np
    assert len(token_list("東京は日本の首都です。")) == 10 and len(token_list("ภาษาไทย")) == 7
    assert token_list("“the\u00a0end”—of it…").tolist() == token_list("the end of it").tolist()
    texts = ["東京a", "b京", "", "日", "é—x"]
    ends = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    _, at = op7_tiling.tokens(np.frombuffer("".join(texts).encode(), np.uint8), ends)
    assert np.diff(at).tolist() == [3, 2, 0, 1, 2]
    bench = spark.createDataFrame([(1, "世界で一番高い山は何ですか")], ITEM)
    docs = spark.createDataFrame([(1, "問題：世界で一番高い山は何ですか？答え"), (2, "世界は広い")], DOC)
    assert {(r.doc_id, r.contaminated) for r in op7_tiling.coverage(docs, bench).collect()} == {(1, True), (2, False)}


def test_short_items_are_searched_whole(spark):
    items = spark.createDataFrame([(1, "Quick brown fox"), (2, "fox quick"), (3, "漢字"), (4, ""), (5, None), (6, "one two three four five")], ITEM)
    docs = spark.createDataFrame([(1, "the quick, brown FOX jumps"), (2, "quick fox brown"), (3, "x漢字y"), (4, "one two three four"),
                                  (5, None), (6, "quick brown"), (7, "brown fox")], DOC)
    got = {r.doc_id: (r.items, r.best_coverage) for r in op7_tiling.coverage(docs, items).collect()}
    assert got == {1: ([1], 1.0), 2: ([], 0.0), 3: ([3], 1.0), 4: ([], 0.0), 5: ([], 0.0), 6: ([], 0.0), 7: ([], 0.0)}
