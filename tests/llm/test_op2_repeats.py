import random

import pytest

from reconlake.llm import op2_gsaca, op2_repeats
from tests.llm.helpers import DOC, by_id, repeats_removed

SHARED = "a passage that is exactly shared among many documents of this little corpus, indeed "


@pytest.mark.parametrize("symbols", [1, 2, 3, 7, 200])
def test_suffix_array(symbols):
    rng = random.Random(symbols)
    for _ in range(150):
        text = [rng.randint(1, symbols) for _ in range(rng.randint(0, 80))] + [0]
        assert op2_gsaca.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_contexts_hold_each_window_once():
    import numpy as np
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab \xc3") for _ in range(n)) for n in (0, 49, 50, 51, 400, 3)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    c = op2_repeats.contexts(np.frombuffer(b"".join(texts), np.uint8), ends)
    starts = [s for lo, hi in zip(c.lo, c.hi, strict=True) for s in range(lo, hi + 1)]
    assert starts == [int(a) + i for a, t in zip(ends, texts, strict=False) for i in range(len(t) - 49)]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus():
    rng = random.Random(3)
    w = lambda n: words(rng, n)
    rows = [(None, None), (None, SHARED * 3), (1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51),
            (6, "y" * 300), (7, "y" * 300), (7, "y" * 300), (7, "other " + SHARED), (8, SHARED + w(20)), (9, w(9) + SHARED),
            (10, w(30) + SHARED + w(30) + SHARED), (11, "\0" * 80 + SHARED), (12, "\0" * 60), (13, "ab" * 400)]
    rows += [(20 + i, w(8) + SHARED[:rng.randint(40, 84)] + w(8)) for i in range(50)]
    rows += [(100 + i, rows[13][1]) for i in range(30)]
    return rows


@pytest.mark.parametrize("hot", [1000, 3])
def test_equals_window_by_window(spark, hot):
    """Small groups by suffix arrays, large ones by counting windows: the same rows."""
    rows = corpus()
    df = spark.createDataFrame([(*r, b"k", "z") for r in rows], DOC + ", packed binary, states string")
    assert by_id(op2_repeats.remove_repeats(df, hot=hot).collect()) == by_id(repeats_removed(rows))


def test_fixture_and_long_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text").limit(120).collect()]
    big = words(random.Random(8), 60_000)
    rows += [(10_001, big), (10_002, big[1000:200_000] + "q" + big[150_000:])]
    df = spark.createDataFrame(rows, DOC)
    assert by_id(op2_repeats.remove_repeats(df).collect()) == by_id(repeats_removed(rows))


def test_segments_change_nothing(monkeypatch):
    import numpy as np
    raw = np.frombuffer((words(random.Random(5), 800) + "ab" * 300 + "c" * 300).encode(), np.uint8)
    ends = np.array([0, 700, 760, len(raw)])
    whole = op2_repeats.contexts(raw, ends)
    monkeypatch.setattr(op2_repeats, "SEGMENT", 257)
    cut = op2_repeats.contexts(raw, ends)
    for name in ("lo", "hi", "place", "anchor", "key"):
        assert getattr(whole, name).tolist() == getattr(cut, name).tolist()


def test_empty_table(spark):
    assert op2_repeats.remove_repeats(spark.createDataFrame([], DOC)).count() == 0


def test_windows_that_share_a_group_stay():
    """Two different windows whose groups agree in all bits kept: none is repeated."""
    import numpy as np
    import pyarrow as pa
    import zstandard
    bodies = [b"a" * 25 + b"b" * 25, b"c" * 25 + b"d" * 25]
    keys = np.concatenate([op2_repeats._window_hashes(b) for b in bodies]) & op2_repeats.MASK48
    packed = op2_repeats._packed(np.array([1, 2]), np.arange(2), np.zeros(2, np.uint64), keys, 5)
    told = op2_repeats._settler(1 << 62)(pa.Table.from_batches([packed])).to_pylist()
    counted = [[t["states"] for t in told if t["doc_id"] == d] for d in (1, 2)]
    rows = pa.record_batch([
        pa.array([1, 2]), pa.array([1, 2]), pa.array([zstandard.compress(b) for b in bodies]), pa.array([b"", b""]),
        pa.array([[{"lo": 0, "body": b}] for b in bodies]),
        pa.array([None, None], pa.list_(pa.struct([("text_key", pa.int64()), ("starts", pa.list_(pa.int32()))]))),
        pa.array(counted, pa.list_(pa.binary()))], ["doc_id", "text_key", "packed", "repeated", "crowded", "sorted", "counted"])
    assert next(op2_repeats._assemble(iter([rows]))).column(2).to_pylist() == [0, 0]


def batch_of(rows):
    import pyarrow as pa
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["doc_id", "text"])


def entries(parts):
    """Entries to be compared per bucket, and those that are settled."""
    kinds = [[], [], []]
    for part in parts:
        for r in part.to_pylist():
            kinds[r["bucket"] % op2_repeats.KINDS].append(len(r["keys"]) // 6)
    return [sum(k) for k in kinds]


def test_common_passage_is_one_entry_per_task():
    """Copies and common passages: a bucket gets no entry for each document."""
    import numpy as np
    rng = random.Random(11)
    text = words(rng, 300)
    one = entries(op2_repeats._packer(5, np.zeros(0, np.uint64))(iter([batch_of([(1, text)])])))
    batches = [batch_of([(i, text) for i in range(lo, lo + 100)]) for lo in (301, 1, 101, 201)]
    found = entries(op2_repeats._packer(5, np.zeros(0, np.uint64))(iter(batches)))
    assert found[0] == 2 * one[0]                          # a smaller document came once
    assert found[2] == 398 * one[0]


def test_crowded_anchors_are_dealt_by_context():
    """Passages that go on differently everywhere: their anchors' entries lie in many buckets."""
    import numpy as np
    rng = random.Random(12)
    rows = [(i, words(rng, 12) + SHARED + words(rng, 12)) for i in range(2000)]
    _, anchor, key = op2_repeats._text_contexts(batch_of(rows))
    each, n = np.unique(anchor, return_counts=True)
    crowded = np.sort([a for a in each[n > 500] if len(np.unique(key[anchor == a])) > 500])
    assert len(crowded)
    largest = {}
    for part in op2_repeats._packer(5, crowded)(iter([batch_of(rows)])):
        for r in part.to_pylist():
            if r["bucket"] % op2_repeats.KINDS == op2_repeats.CROWDED:
                largest[r["bucket"]] = len(r["keys"]) // 6
    assert len(largest) == 32 and max(largest.values()) < 3 * sum(largest.values()) / 32


@pytest.mark.parametrize("sample", [1, 2])
def test_sampled_crowds_change_nothing(spark, sample):
    rows = corpus()
    df = spark.createDataFrame(rows, DOC).repartition(3)
    assert by_id(op2_repeats.remove_repeats(df, hot=3, sample=sample).collect()) == by_id(repeats_removed(rows))


def test_no_group_holds_an_entry_per_document(spark, monkeypatch):
    """A passage in all rows, going on differently in each, and copies of one text."""
    rng = random.Random(13)
    rows = [(i, words(rng, 12) + SHARED * 2 + words(rng, 12)) for i in range(3000)] + [(5000 + i, "copy " * 30) for i in range(3000)]
    real = op2_repeats._settler

    def watched(hot):
        settle = real(hot)

        def check(table):
            from collections import Counter
            sizes = Counter()
            for blob in table.column("groups").to_pylist():
                n = len(blob) // 3
                sizes.update((blob[2 * i:2 * i + 2], blob[2 * n + i]) for i in range(n))
            assert max(sizes.values(), default=0) < 1000, "one group holds an entry per document"
            return settle(table)
        return check

    monkeypatch.setattr(op2_repeats, "_settler", watched)
    df = spark.createDataFrame(rows, DOC).repartition(4)
    got = by_id(op2_repeats.remove_repeats(df, hot=20).collect())
    assert got == by_id(repeats_removed(rows))
