"""Main text of web pages by a linear-chain conditional random field.

Each page is a chain of DOM leaf blocks (op1_dom). The field has a weight for every
feature and label, for every pair of neighbouring labels, and for the first and the
last label. It is trained on labelled pages by the gradient of the log-likelihood
(forward-backward), and decoded by Viterbi: blocks labelled 1 are the main text.

Character references are decoded, white space in a block is one space, and blocks
are joined by an empty line, in page order.

Nulls, ties, odd rows: a null or empty page has the empty text. Broken markup is
read as far as it goes (open elements end with their parents). Equal scores go to
label 0. Rows that repeat a page_id are pages of their own. Other columns are not
looked at.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import op1_dom, op1_labelled


@dataclass
class Field:
    index: dict[str, int]
    weight: np.ndarray             # (features, 2)
    step: np.ndarray               # (2, 2): from label, to label
    first: np.ndarray
    last: np.ndarray

    def emissions(self, active: list[list[str]]) -> np.ndarray:
        """Scores of both labels for each block."""
        ids = [[self.index[f] for f in own if f in self.index] for own in active]     # bias is always known
        at = np.concatenate([[0], np.cumsum([len(i) for i in ids])])[:-1]
        return np.add.reduceat(self.weight[np.concatenate(ids).astype(np.int64)], at, axis=0)

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi: the most likely labels of one page."""
        (s00, s01), (s10, s11) = self.step.tolist()
        rows = scores.tolist()
        a, b = rows[0][0] + self.first[0], rows[0][1] + self.first[1]
        back = []
        for e0, e1 in rows[1:]:
            to0, to1 = b + s10 > a + s00, b + s11 > a + s01
            back.append((int(to0), int(to1)))
            a, b = (b + s10 if to0 else a + s00) + e0, (b + s11 if to1 else a + s01) + e1
        label = int(b + self.last[1] > a + self.last[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _expectations(scores, step, first, last, size):
    """Marginals of labels (n, t, 2) and of neighbouring labels (2, 2), by forward-backward."""
    n, t, _ = scores.shape
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + first
    for i in range(1, t):
        go = _log_sum(ahead[:, i - 1, :, None] + step[None], 1) + scores[:, i]
        ahead[:, i] = np.where((i < size)[:, None], go, ahead[:, i - 1])
    for i in range(t - 1, -1, -1):
        if i + 1 < t:
            go = _log_sum(step[None] + (scores[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
            behind[:, i] = np.where((i + 1 < size)[:, None], go, 0)
        behind[:, i] += np.where((i + 1 == size)[:, None], last, 0)
    total = _log_sum(ahead[:, -1] + last, 1)
    single = np.exp(ahead + behind - total[:, None, None])
    pairs = np.zeros((2, 2))
    for i in range(1, t):
        joint = ahead[:, i - 1, :, None] + step[None] + (scores[:, i] + behind[:, i])[:, None, :] - total[:, None, None]
        pairs += (np.exp(joint) * (i < size)[:, None, None]).sum(0)
    return single, pairs, total


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, rate: float = 0.15, decay: float = 1e-3
        ) -> Field:
    """The field for pages given as (active features, labels) of their blocks."""
    pages = [p for p in pages if p[0]]
    index = {f: i for i, f in enumerate(sorted({f for feats, _ in pages for own in feats for f in own}))}
    size = np.array([len(labels) for _, labels in pages])
    n, t = len(pages), int(size.max())
    x = np.zeros((n, t, len(index)), np.float32)
    y = np.zeros((n, t), int)
    inside = np.arange(t)[None] < size[:, None]
    for i, (feats, labels) in enumerate(pages):
        y[i, :len(labels)] = labels
        for j, own in enumerate(feats):
            x[i, j, [index[f] for f in own]] = 1
    truth = np.eye(2)[y] * inside[..., None]
    pair_truth = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pair_truth[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & inside[:, 1:]).sum()
    end = size - 1
    par = {"weight": np.zeros((len(index), 2)), "step": np.zeros((2, 2)), "first": np.zeros(2), "last": np.zeros(2)}
    m = {k: np.zeros_like(v) for k, v in par.items()}
    s = {k: np.zeros_like(v) for k, v in par.items()}
    flat = x.reshape(n * t, -1)
    for r in range(1, rounds + 1):
        scores = (flat @ par["weight"].astype(np.float32)).reshape(n, t, 2).astype(np.float64)
        single, pairs, _ = _expectations(scores, par["step"], par["first"], par["last"], size)
        single *= inside[..., None]
        grad = {"weight": flat.T @ (truth - single).reshape(n * t, 2).astype(np.float32), "step": pair_truth - pairs,
                "first": (truth[:, 0] - single[:, 0]).sum(0),
                "last": (truth[np.arange(n), end] - single[np.arange(n), end]).sum(0)}
        for k in par:                                   # Adam, ascending
            g = grad[k] / n - decay * par[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            par[k] = par[k] + rate * (m[k] / (1 - 0.9 ** r)) / (np.sqrt(s[k] / (1 - 0.999 ** r)) + 1e-8)
    return Field(index, par["weight"], par["step"], par["first"], par["last"])


def training_pages(n: int = 600, seed: int = 5) -> list[tuple[list[list[str]], list[int]]]:
    """``n`` labelled pages as features and labels."""
    rng, reader, out = random.Random(seed), op1_dom.Reader(), []
    for _ in range(n):
        page, labels = op1_labelled.labelled_page(rng)
        blocks = reader.blocks(page)
        if len(blocks) != len(labels):
            raise ValueError("labels and blocks differ")
        out.append((op1_dom.features(blocks), labels))
    return out


def main_texts(field: Field, reader: op1_dom.Reader, pages: list[str]) -> list[str]:
    parsed = [reader.blocks(p) if p else [] for p in pages]
    active = [own for blocks in parsed for own in op1_dom.features(blocks)]
    scores = field.emissions(active) if active else None
    out, at = [], 0
    for blocks in parsed:
        if not blocks:
            out.append("")
            continue
        labels = field.decode(scores[at:at + len(blocks)])
        at += len(blocks)
        out.append("\n\n".join([b.text for b, keep in zip(blocks, labels, strict=True) if keep]))
    return out


def _extractor(field: Field) -> Callable:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = op1_dom.Reader()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                text = main_texts(field, reader, [h or "" for h in part.column(2).to_pylist()])
                yield pa.record_batch([part.column(0), part.column(1), pa.array(text, pa.string()),
                                       pa.array([len(t) for t in text], pa.int64())],
                                      ["page_id", "url", "text", "n_chars"])
    return extract


def main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages`` (page_id, url, html)."""
    field = field or fit(training_pages())
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return base.mapInArrow(_extractor(field), "page_id long, url string, text string, n_chars long")
