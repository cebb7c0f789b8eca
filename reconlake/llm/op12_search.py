"""Ranked lexical search: accumulators of short lists inside document-at-a-time skipping.

``build_index`` cuts the documents into segments of about ``SEGMENT`` bytes. A segment
has a row per term (its documents, ascending by doc_id, and the occurrences in each)
and a row of its own (``term`` null: doc_ids and lengths of all its documents). Terms
are found by hash and compared byte by byte.

``search`` takes the queries in blocks. Document frequencies come from the index; the
lists of a block's terms are brought together by segment, and each segment ranks its
own documents for each query:

* the shortest lists are taken term at a time: their contributions are summed into
  accumulators, which from then on are one more list whose bound is its highest sum;
* this list and the long ones are gone through document at a time, in windows of
  document numbers. Lists whose bounds together can't lift a document above the k-th
  best score so far are not read: they are only probed, by binary search, for the
  documents that the other lists bring up and that can still get there.

A segment gives its k best documents of a query; the k best of those are the result,
found in two steps so that no task gets the candidates of all segments.

Scores are whole numbers: a term's weight w is floor(1000 * ln((2N+2) / (2df+1))), a
document's share w * ((10^9 * tf) div (1000 * tf + 20 * m)) with
m = 50 + ((50 * n * N) div L); N counts the documents with a term, L all terms.

Nulls, ties, odd rows: a null or empty text has no term and is never found, and so a
query without terms finds nothing. Every row of ``docs`` is a document and every row of
``queries`` a query, also where ids repeat. Equal scores go by doc_id, nulls last; ranks
are unique. A row without doc_id counts and is found like any other. Long texts: the
terms are counted in pieces of ``PIECE`` bytes. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reconlake.llm import words
from reconlake.llm.store import written

SEGMENT = 16 << 20             # bytes of text in a segment, unless one text has more
PIECE = 8 << 20                # bytes whose terms are counted at once
WINDOW = 2048                  # document numbers that are gone through together
SALTS = 64

# What a term is made of, by characters and by UTF-8 bytes.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
GAP = np.zeros(256, bool)
GAP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = {i: i + 32 for i in range(65, 91)}

INDEX = "segment long, term string, docs array<int>, tfs array<int>, doc_ids array<long>, lengths array<long>"
_TYPES = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
_NAMES = ["segment", "term", "docs", "tfs", "doc_ids", "lengths"]


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def _counted(raw: np.ndarray, ends: np.ndarray, number: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, sort of term, document, occurrences), by term and document. ``number`` is
    the document number of each text."""
    key, start, stop, at = words.word_hashes(raw, ends, GAP, words.LOWER)
    size = stop - start
    first, sort = words.sorts(key, words.LOWER[raw], start, size)
    base = int(number.max(initial=0)) + 1
    both, tf = np.unique(sort * base + np.repeat(number, np.diff(at)), return_counts=True)
    own = size[first]
    offsets = np.concatenate([[0], np.cumsum(own)])
    data = words.LOWER[raw][words.flat_range(start[first], own)].tobytes()
    names = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data))
    return names, both // base, both % base, tf


def _pieces(raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, ends inside, texts): the buffer in pieces that end between terms."""
    at = 0
    while at < len(raw):
        to = min(len(raw), at + PIECE)
        if to < len(raw):                 # go on to the end of the term
            stop = int(ends[np.searchsorted(ends, to)])
            gap = GAP[raw[to:stop]]
            to = to + int(gap.argmax()) if gap.any() else stop
        lo = int(np.searchsorted(ends, at, "right")) - 1
        hi = int(np.searchsorted(ends, to, "left"))
        yield at, to, np.clip(ends[lo:hi + 1], at, to) - at, np.arange(lo, hi)
        at = to


def _segment(segment: int, ids: pa.Array, text: pa.Array) -> Iterator[pa.RecordBatch]:
    raw, ends = words.text_buffer(text)
    order = pc.sort_indices(pa.table({"id": ids}), sort_keys=[("id", "ascending")], null_placement="at_end").to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    names, sort, doc, tf = pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = [_counted(raw[lo:hi], inner, number[own]) for lo, hi, inner, own in _pieces(raw, ends)]
    if len(parts) == 1:
        names, sort, doc, tf = parts[0]
    elif parts:                        # a term or a long text may be in several pieces
        known = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
        names, index = known.dictionary, known.indices.to_numpy().astype(np.int64)
        begin = np.cumsum([0, *[len(p[0]) for p in parts]])
        key = np.concatenate([index[p[1] + b] * len(order) + p[2] for p, b in zip(parts, begin, strict=False)])
        both, where = np.unique(key, return_inverse=True)
        tf = np.bincount(where, np.concatenate([p[3] for p in parts])).astype(np.int64)
        sort, doc = both // len(order), both % len(order)
    lengths = np.bincount(doc, tf, len(order)).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(np.bincount(sort, minlength=len(names)))]).astype(np.int32)
    docs, tfs = doc.astype(np.int32), tf.astype(np.int32)
    yield pa.record_batch([pa.array([segment]), pa.nulls(1, pa.string()), pa.nulls(1, _TYPES[2]), pa.nulls(1, _TYPES[3]),
                           pa.array([ids.take(pa.array(order)).to_pylist()], _TYPES[4]),
                           pa.array([lengths], _TYPES[5])], _NAMES)
    step = 20_000
    for lo in range(0, len(names), step):
        hi = min(len(names), lo + step)
        cut = pa.array(at[lo:hi + 1] - at[lo])
        yield pa.record_batch([pa.array(np.full(hi - lo, segment)), names.slice(lo, hi - lo).cast(pa.string()),
                               pa.ListArray.from_arrays(cut, docs[at[lo]:at[hi]]), pa.ListArray.from_arrays(cut, tfs[at[lo]:at[hi]]),
                               pa.nulls(hi - lo, _TYPES[4]), pa.nulls(hi - lo, _TYPES[5])], _NAMES)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
    for batch in batches:
        text = batch.column(1).cast(pa.large_string())
        _, ends = words.text_buffer(text)
        for lo, hi in words.slices(ends, SEGMENT):
            if size and size + ends[hi] - ends[lo] > SEGMENT:
                yield from _segment(number, pa.concat_arrays(ids), pa.concat_arrays(texts))
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(batch.column(0).slice(lo, hi - lo))
            texts.append(text.slice(lo, hi - lo))
            size += int(ends[hi] - ends[lo])
    if ids:
        yield from _segment(number, pa.concat_arrays(ids), pa.concat_arrays(texts))


def build_index(docs: DataFrame) -> DataFrame:
    """The inverted index of all rows, written to the shared folder."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(docs.sparkSession, "search-index", base.mapInArrow(_segments, INDEX))


def _summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One list: the documents of several and the sums of their shares."""
    docs, where = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    total = np.zeros(len(docs), np.int64)
    np.add.at(total, where, np.concatenate([s for _, s in lists]))
    return docs, total


def _probe(docs: np.ndarray, share: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The shares of the wanted documents, 0 where the list has none."""
    at = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
    return np.where(docs[at] == wanted, share[at], 0)


def best(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k highest sums above 0, equal ones by document.
    Each list has ascending document numbers and positive shares."""
    lists = sorted([x for x in lists if len(x[0])], key=lambda x: len(x[0]))
    budget, n, total = max(256, n_docs // 16), 0, 0
    while n < len(lists) and total + len(lists[n][0]) <= budget:
        total += len(lists[n][0])
        n += 1
    if n > 1:                                                      # term at a time
        lists = [_summed(lists[:n]), *lists[n:]]
    bound = np.array([int(s.max()) for _, s in lists], np.int64)
    order = np.argsort(bound, kind="stable")
    lists, bound = [lists[i] for i in order], bound[order]
    under = np.concatenate([[0], np.cumsum(bound)])                # what the first i lists give at most
    found, score, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for lo in range(0, n_docs, WINDOW):                            # document at a time
        hi = min(n_docs, lo + WINDOW)
        probed = int(np.searchsorted(under, least, "right")) - 1   # lists that alone lift no document above the least
        if probed >= len(lists):
            break
        sums = np.zeros(hi - lo, np.int64)
        for docs, share in lists[probed:]:
            a, b = np.searchsorted(docs, (lo, hi))
            sums[docs[a:b] - lo] += share[a:b]
        live = np.flatnonzero((sums > 0) & (sums + under[probed] > least))
        sums = sums[live]
        for i in range(probed - 1, -1, -1):
            if not len(live):
                break
            sums = sums + _probe(*lists[i], live + lo)
            on = sums + under[i] > least
            live, sums = live[on], sums[on]
        if len(live):
            found, score = np.concatenate([found, live + lo]), np.concatenate([score, sums])
            top = np.lexsort((found, -score))[:k]
            found, score = found[top], score[top]
            if len(found) == k:
                least = int(score[-1])                             # later documents lose ties
    return found, score


def _ranker(queries: list[tuple[int, int | None, list[str]]], weight: dict[str, int], n: int, total: int, k: int) -> Callable:
    def rank(table: pa.Table) -> pa.Table:
        own = table.filter(pc.is_null(table["term"]))
        ids, lengths = own["doc_ids"][0], own["lengths"][0].values.to_numpy()
        norm = 20 * (50 + (50 * lengths * n) // total)
        lists = {}
        rows = table.filter(pc.is_valid(table["term"])).combine_chunks()
        names = rows["term"].to_pylist()
        at, docs, tfs = (np.zeros(1, np.int64), *[np.zeros(0, np.int64)] * 2) if not names else _columns(rows)
        for i, name in enumerate(names):
            d, t = docs[at[i]:at[i + 1]], tfs[at[i]:at[i + 1]]
            share = weight[name] * ((1_000_000_000 * t) // (1000 * t + norm[d]))
            lists[name] = (d, share) if share.all() else (d[share > 0], share[share > 0])
        out: list[tuple] = []
        for number, item, terms in queries:
            found, score = best([lists[t] for t in terms if t in lists], len(lengths), k)
            out += [(number, item, ids[d].as_py(), s) for d, s in zip(found.tolist(), score.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["number", "item_id", "doc_id", "score"])
    return rank


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, documents, occurrences) of all lists."""
    docs, tfs = (pa.concat_arrays(rows[c].chunks) for c in ("docs", "tfs"))
    return (np.concatenate([[0], np.cumsum(docs.value_lengths().to_numpy())]),
            docs.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64))


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    place = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = 50, block_terms: int = 1_000_000) -> DataFrame:
    """item_id, rank, doc_id, score: each query's k best documents. ``queries`` has item_id
    and text; blocks of about ``block_terms`` terms are collected and sent to the tasks."""
    spark = index.sparkSession
    items = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0] // 2 + 1    # terms at most
    blocks = -(-size // block_terms)
    documents = index.where("term is null")
    stats = documents.agg(F.sum(F.size(F.filter("lengths", lambda x: x > 0))).alias("n"),
                          F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total")).first()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks if stats["total"] else 0):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        parsed = [(i, r["item_id"], sorted(set(terms_of(r["text"])))) for i, r in enumerate(block.collect())]
        wanted = sorted({t for _, _, terms in parsed for t in terms})
        if not wanted:
            continue
        asked = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "term string"))      # block_terms at most
        lists = index.where("term is not null").join(asked, "term")
        df = lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()       # terms of the block
        n, total = stats["n"], stats["total"]
        weight = {r["term"]: math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in df}
        rows = documents.unionByName(lists.select(documents.columns)).groupBy("segment").applyInArrow(
            _ranker(parsed, weight, n, total, k), "number long, item_id long, doc_id long, score long")
        # in two steps, so that no task gets the candidates of all segments
        rows = _first(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), ["number", "salt"], k)
        out = out.unionByName(_first(rows, ["number"], k).select("item_id", "rank", "doc_id", "score"))
    return out
