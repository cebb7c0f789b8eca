"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded, learned filters run over every position, and
each chunk of 256 bytes (chunks overlap by half and cover the whole text) keeps
each filter's maximum. The chunks' maxima and means over the text pass one hidden
layer to one probability. Trained by back-propagation through the maxima (Adam).

Training takes a bounded sample, by documented parameters: ``per_class`` rows of
each label, those with the least hash of doc_id, and of a longer text one window
of ``window`` bytes. Scoring reads every byte of every text. Labels, lang, source
and doc_id never reach the network.

Nulls, ties, odd rows: a null or empty text is scored as one empty chunk. A row
without doc_id is scored and not held out. Several labels of one doc_id count as
their rounded mean; null labels are left out. If one label is missing altogether,
every text scores the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.llm import words

BLOCK, WIDTH, DIM, FILTERS, HIDDEN = 128, 8, 8, 24, 24
STREAMED = 8192                    # blocks that are embedded at once: a megabyte of text
Model = dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one array, each in blocks of its own that start with WIDTH
    zeros, so that no window sees two texts; and the first block of each (and of the end)."""
    blocks = [(len(t) + WIDTH + BLOCK - 1) // BLOCK for t in texts]
    first = np.concatenate([[0], np.cumsum(blocks)])
    flat = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
    for t, at in zip(texts, first, strict=False):
        flat[at * BLOCK + WIDTH:at * BLOCK + WIDTH + len(t)] = t
    return flat, first


def chunk_maxima(blocks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maxima of the chunks (two neighbouring blocks of a text), and each text's first chunk."""
    n = np.diff(first)
    last = first[1:] - 1
    both = np.maximum(blocks, np.roll(blocks, -1, axis=0))
    both[last] = blocks[last]                          # a text's last block has no neighbour
    drop = np.zeros(len(blocks), bool)
    drop[last[n > 1]] = True
    return both[~drop], np.concatenate([[0], np.cumsum(np.maximum(n - 1, 1))])


def _convolve(model: Model, flat: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each block, ``STREAMED`` blocks at a time: a text's
    bytes are never embedded all at once, however long it is."""
    n = (len(flat) - WIDTH) // BLOCK
    if n > STREAMED:
        return np.concatenate([_convolve(model, flat[lo * BLOCK:min(n, lo + STREAMED) * BLOCK + WIDTH])
                               for lo in range(0, n, STREAMED)])
    embedded = model["embed"][flat]
    best = None
    for shift in range(WIDTH):                         # windows that start at shift, shift + WIDTH, ...
        rows = embedded[shift:shift + n * BLOCK].reshape(-1, WIDTH * DIM)
        top = (rows @ model["filters"]).reshape(n, BLOCK // WIDTH, -1).max(1)
        best = top if best is None else np.maximum(best, top, out=best)
    return best


def _head(model: Model, maxima: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    active = np.maximum(maxima + model["bias"], 0)
    top = np.maximum.reduceat(active, first[:-1], axis=0)
    mean = np.add.reduceat(active, first[:-1], axis=0) / np.diff(first)[:, None].astype(np.float32)
    joined = np.concatenate([top, mean], axis=1)
    hidden = np.maximum(joined @ model["w1"] + model["b1"], 0)
    z = hidden @ model["w2"] + model["b2"]
    return {"active": active, "top": top, "joined": joined, "hidden": hidden,
            "p": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}


def scores(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), float(model["constant"]))
    flat, first = lay_out(texts)
    maxima, at = chunk_maxima(_convolve(model, flat), first)
    return _head(model, maxima, at)["p"].astype(np.float64)


def _gradients(model: Model, texts: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> Model:
    flat, first = lay_out(texts)
    n = first[-1]
    window = np.lib.stride_tricks.sliding_window_view(flat[:n * BLOCK + WIDTH - 1], WIDTH)
    response = (model["embed"][window].reshape(n * BLOCK, -1) @ model["filters"]).reshape(n, BLOCK, -1)
    where = response.argmax(1) + (np.arange(n) * BLOCK)[:, None]        # position of each block's maximum
    block = response.max(1)
    maxima, at = chunk_maxima(block, first)
    # which block each chunk's maximum came from
    n_blocks = np.diff(first)
    left = np.concatenate([np.arange(a, a + max(k - 1, 1)) for a, k in zip(first[:-1], n_blocks, strict=True)])
    right = np.minimum(left + 1, np.repeat(first[1:] - 1, np.maximum(n_blocks - 1, 1)))
    from_right = block[right] > block[left]
    place = np.where(from_right, where[right], where[left])
    got = _head(model, maxima, at)
    g = {}
    dz = (got["p"] - label) * weight / weight.sum()
    g["w2"], g["b2"] = got["hidden"].T @ dz, dz.sum()
    dh = dz[:, None] * model["w2"][None] * (got["hidden"] > 0)
    g["w1"], g["b1"] = got["joined"].T @ dh, dh.sum(0)
    dj = dh @ model["w1"].T
    per_text = np.repeat(np.arange(len(texts)), np.diff(at))
    d_top, d_mean = dj[:, :FILTERS], dj[:, FILTERS:] / np.diff(at)[:, None]
    is_top = (got["active"] == got["top"][per_text]).astype(np.float32)
    is_top /= np.add.reduceat(is_top, at[:-1], axis=0)[per_text]        # neighbours share a block, and its maximum
    da = (d_mean[per_text] + d_top[per_text] * is_top) * (got["active"] > 0)
    g["bias"] = da.sum(0)
    seen = window[place]                                                # (chunks, filters, WIDTH) bytes
    vectors = model["embed"][seen].reshape(*place.shape, -1)
    g["filters"] = np.einsum("cf,cfk->kf", da, vectors)
    d_vec = (da[:, :, None] * model["filters"].T[None]).reshape(-1, DIM)
    g["embed"] = np.stack([np.bincount(seen.reshape(-1), d_vec[:, k], 256) for k in range(DIM)], 1)
    return g


def fit(texts: list[np.ndarray], label: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01,
        seed: int = 7, least_steps: int = 300) -> Model:
    """The trained network; label 1 weighs four times, as good texts outnumber the rest.
    Small samples are gone through more often, for ``least_steps`` steps."""
    if label.min(initial=2) == label.max(initial=-1) or not len(label):
        return {"constant": np.float64((label.sum() + 1) / (len(label) + 2))}
    rng = np.random.default_rng(seed)
    # short pieces of good texts, so that a short text is not judged by its length
    good, short = np.flatnonzero(label == 1), []
    for n in good:
        size = int(rng.integers(12, 120))
        at = int(rng.integers(0, max(1, len(texts[n]) - size + 1)))
        short.append(texts[n][at:at + size])
    texts, label = [*texts, *short], np.concatenate([label, label[good]])
    normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    model = {"embed": normal(256, DIM, by=0.5), "filters": normal(WIDTH * DIM, FILTERS, by=0.2),
             "bias": np.zeros(FILTERS, np.float32), "w1": normal(2 * FILTERS, HIDDEN, by=0.2),
             "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN, by=0.2), "b2": np.zeros((), np.float32)}
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(x) for k, x in model.items()}
    weight = np.where(label == 1, 4.0, 1.0).astype(np.float32)
    a_round = -(-len(texts) // batch)
    epochs = max(epochs, -(-least_steps // a_round))
    step, total = 0, epochs * a_round
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            g = _gradients(model, [texts[i] for i in pick], label[pick].astype(np.float32), weight[pick])
            step += 1
            lr = rate * (1 - step / (total + 1))
            for k in model:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                model[k] = (model[k] - lr * (m[k] / (1 - 0.9 ** step))
                            / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2500, window: int = 1024) -> Model:
    """Fits on labelled rows that are not held out, at most ``per_class`` of each label."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("q"))
             .where("id is not null and q is not null").groupBy("id").agg(F.round(F.avg("q")).cast("int").alias("q"))
             .where(~held_out(F.col("id"))))
    order = F.xxhash64("id", F.lit(11))
    picked = [known.where(F.col("q") == c).orderBy(order, "id").limit(per_class) for c in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    raw = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    spare = F.greatest(F.length(raw) - window, F.lit(0))
    start = F.pmod(F.xxhash64("id", F.lit(12)), spare + 1).cast("int") + 1
    # two per_class rows of window bytes, one of each id, however often rows repeat it: what the driver
    # gets is bounded by the parameters
    piece = F.struct(F.xxhash64("raw", F.lit(13)).alias("h"), "raw")
    rows = (docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(sample), "id")
            .select("id", "q", raw.substr(start, F.lit(window)).alias("raw"))
            .groupBy("id", "q").agg(F.min(piece).alias("least")).select("id", "q", "least.raw").collect())
    rows.sort(key=lambda r: (r["id"], bytes(r["raw"])))
    return fit([np.frombuffer(bytes(r["raw"]), np.uint8) for r in rows], np.array([r["q"] for r in rows], np.float32))


def _scorer(model: Model, column: int, names: list[str]) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = words.text_buffer(batch.column(column))
            for lo, hi in words.slices(ends, 1 << 20):
                p = scores(model, [raw[ends[i]:ends[i + 1]] for i in range(lo, hi)])
                part = batch.slice(lo, hi - lo)
                yield pa.record_batch([*part.columns, pa.array(p, pa.float64())], names)
    return score


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of quality 1 as one more column."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(_scorer(model, docs.columns.index("text"), schema.names), schema)


def score_documents(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    model = model or train(docs, labels)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_score(base, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                          (F.col("score") >= 0.5).cast("int").alias("predicted"))
