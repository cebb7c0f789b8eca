import zlib

import numpy as np
import pytest

from reconlake.llm import op8_quality
from reconlake.llm.queries import op8_quality_network
from tests.llm.helpers import DOC


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    """On rows that training never saw."""
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op8_quality_network(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    told = [(r, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == y for r, y in told]) > 0.93
    good = [r.predicted for r, y in told if y == 1]
    assert np.mean(good) > 0.97                            # clean documents stay


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    texts = [rng.integers(97, 110, rng.integers(0, 900)).astype(np.uint8) for _ in range(60)]
    texts += [rng.integers(35, 48, rng.integers(1, 900)).astype(np.uint8) for _ in range(60)]
    return op8_quality.fit(texts, np.array([1] * 60 + [0] * 60, np.float32), epochs=6)


def plain_score(model, text):
    """The network, position by position."""
    E, B = model["embed"], op8_quality
    n = (len(text) + B.WIDTH + B.BLOCK - 1) // B.BLOCK
    padded = np.concatenate([np.zeros(B.WIDTH, np.uint8), text, np.zeros(n * B.BLOCK - len(text), np.uint8)])
    response = np.array([E[padded[i:i + B.WIDTH]].reshape(-1) @ model["filters"] for i in range(n * B.BLOCK)])
    chunks = [response[i * B.BLOCK:(i + 2) * B.BLOCK].max(0) for i in range(max(1, n - 1))]
    active = np.maximum(np.array(chunks) + model["bias"], 0)
    joined = np.concatenate([active.max(0), active.mean(0)])
    z = np.maximum(joined @ model["w1"] + model["b1"], 0) @ model["w2"] + model["b2"]
    return 1 / (1 + np.exp(-z))


def test_scores_equal_the_plain_network(model):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 119, 120, 121, 128, 256, 700)]
    np.testing.assert_allclose(op8_quality.scores(model, texts), [plain_score(model, t) for t in texts], atol=1e-4)


def test_blocks_are_streamed(model, monkeypatch):
    """Any number of blocks at a time gives the same scores; a long text needs little more than its bytes."""
    import tracemalloc
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (0, 5, 700, 5000)]
    want = op8_quality.scores(model, texts)
    monkeypatch.setattr(op8_quality, "STREAMED", 3)
    np.testing.assert_allclose(op8_quality.scores(model, texts), want, atol=1e-6)
    monkeypatch.setattr(op8_quality, "STREAMED", 8192)
    text = rng.integers(0, 256, 16 << 20).astype(np.uint8)
    tracemalloc.start()
    op8_quality.scores(model, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(text)


def test_gradients_equal_differences(model):
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 120, n).astype(np.uint8) for n in (50, 300, 600)]
    y, w = np.array([1, 0, 1], np.float32), np.array([2, 1, 2], np.float32)
    wide = {k: v.astype(np.float64) for k, v in model.items()}

    def loss(m):
        flat, first = op8_quality.lay_out(texts)
        p = op8_quality._head(m, *op8_quality.chunk_maxima(op8_quality._convolve(m, flat), first))["p"]
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()
    grad = op8_quality._gradients(wide, texts, y, w)
    for name in ("filters", "bias", "w1", "w2", "embed"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        up, low = ({k: v.copy() for k, v in wide.items()} for _ in range(2))
        up[name][at] += 1e-5
        low[name][at] -= 1e-5
        assert (loss(up) - loss(low)) / 2e-5 == pytest.approx(grad[name][at], rel=2e-2, abs=1e-6)


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (2, "abc"), (None, "abc"), (3, "é" * 100_000), (4, "#!" * 300)]
    df = spark.createDataFrame([(*r, "x") for r in rows], DOC + ", score string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = op8_quality.score_documents(df, labels, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    scores = sorted(r.score for r in got if r.doc_id in (1, 2))
    assert scores[0] == scores[1] or scores[1] == scores[2]     # null counts as empty
    assert op8_quality.score_documents(df.limit(0), labels, model).count() == 0


def test_training_rows(spark):
    """Held-out rows, null labels and rows without a label never reach the network."""
    ids = list(range(40))
    docs = spark.createDataFrame([(i, "good text " * 9 if i % 2 else "##" * 60) for i in ids], DOC)
    labels = spark.createDataFrame([(i, (i % 2) if not held(i) else 1 - i % 2, 0) for i in ids]
                                   + [(0, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = op8_quality.train(docs, labels)
    rows = op8_quality.score_documents(docs, labels, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in rows)
    for none in (labels.limit(0), labels.where("quality = 1")):
        m = op8_quality.train(docs, none)
        assert len({r.score for r in op8_quality.score_documents(docs, none, m).collect()}) == 1


def test_repeated_id_is_one_training_row(spark, monkeypatch):
    got = []
    monkeypatch.setattr(op8_quality, "fit", lambda texts, label: got.append((len(texts), label.tolist())))
    docs = spark.createDataFrame([(i % 40 if i < 80 else 7, f"text number {i} of some length") for i in range(600)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    op8_quality.train(docs, labels)
    known = labels.where(~op8_quality.held_out(op8_quality.F.col("doc_id"))).count()
    assert got[0][0] == known
