"""Benchmark decontamination by greedy string tiling with running Karp-Rabin.

Tokens are runs of ASCII letters and digits and of other characters but Unicode
spaces and punctuation, case folded in ASCII and Latin-1. In scripts written without
spaces (Chinese, Japanese, Thai and their like) each character is one. A document and a benchmark item that share a seed
(``seed`` tokens in a row) are compared: the longest matches of unmarked tokens
are marked as tiles, longest first, until none of at least ``seed`` tokens is
left. Order doesn't matter, so reordered passages are caught too. A document is
contaminated if tiles cover at least ``percent`` of an item's tokens.

The benchmark is the stated query set. It goes to the tasks in blocks of at most
``block_tokens`` tokens, one pass over the documents for each block; all usual
benchmarks are one block, and any number of blocks gives the same rows.

Nulls, ties, odd rows: null and empty texts match nothing. Items of fewer than
``seed`` tokens are one seed of their own length: found whole or not at all. Equally long matches are marked by their first
place in the item, then in the document. Items that repeat an item_id or have
none are items of their own. Other columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.llm import words
from reconlake.llm.store import free_name

U = np.uint64
GAPS = np.ones(256, bool)
GAPS[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = False
TILES = "array<struct<item_id:bigint,covered:bigint,tokens:bigint>>"


GAP_RANGES = ((0x80, 0xA9), (0xAB, 0xAC), (0xAE, 0xB1), (0xB4, 0xB4), (0xB6, 0xB8), (0xBB, 0xBB), (0xBF, 0xBF), (0xD7, 0xD7),
              (0xF7, 0xF7), (0x1680, 0x1680), (0x2000, 0x200B), (0x200E, 0x206F), (0x2E00, 0x2E7F), (0x3000, 0x3004),
              (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFE10, 0xFE1F), (0xFE30, 0xFE6F), (0xFEFF, 0xFEFF),
              (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
UNSPACED_RANGES = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x302F),
                   (0x3031, 0x30FA), (0x30FC, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF),
                   (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))


def _in(code: np.ndarray, ranges: tuple) -> np.ndarray:
    edges = np.array(ranges).ravel() + np.tile([0, 1], len(ranges))
    return np.searchsorted(edges, code, "right") % 2 == 1


def _spaced(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``raw`` (changed) with blanks for Unicode gaps and around each character of unspaced scripts."""
    lead = np.flatnonzero(raw >= 0xC2)
    if not len(lead):
        return raw, ends
    width = np.where(raw[lead] < 0xE0, 2, np.where(raw[lead] < 0xF0, 3, 4))
    padded = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int64)
    code = padded[lead] & (0xFF >> (width + 1))
    for i in (1, 2, 3):
        code = np.where(i < width, code << 6 | padded[lead + i] & 63, code)
    gap, alone = _in(code, GAP_RANGES), _in(code, UNSPACED_RANGES)
    for i in range(4):
        raw[lead[gap & (i < width)] + i] = 32
    put = np.sort(np.concatenate([lead[alone], (lead + width)[alone]]))
    return np.insert(raw, put, 32), ends + np.searchsorted(put, ends)


def tokens(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, and the offsets of each text's tokens."""
    raw = raw.copy()
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    second = raw[lead + 1]
    raw[lead + 1] += np.where((second >= 0x80) & (second <= 0x9E) & (second != 0x97), 32, 0).astype(np.uint8)
    raw, ends = _spaced(raw, ends)
    h, _, _, at = words.word_hashes(raw, ends, GAPS)
    return h, at


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> int:
    """Tokens of ``item`` that greedy tiling covers. Both are token hashes.

    The search length starts at the item's length. Each scan hashes the unmarked
    windows of that length on both sides (Karp-Rabin fingerprints); a match that
    extends to twice the length restarts the scan at its own length, else the
    matches are marked longest first and the length halves."""
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    covered, s = 0, max(least, min(len(item), len(doc)))
    while s >= least:
        longest, found = _scan(item, doc, free_i, free_d, s)
        if longest >= 2 * s:
            s = longest
            continue
        queue = [(-length, i, d) for length, places in found.items() for i, d in places]
        heapify(queue)
        while queue:
            length, i, d = heappop(queue)
            length = -length
            run = free_i[i:i + length] & free_d[d:d + length]
            if run.all():
                free_i[i:i + length] = free_d[d:d + length] = False
                covered += length
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], run, [False]])))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if b - a >= s:                           # partly taken: each part left is a match of its own length
                    heappush(queue, (a - b, i + a, d + a))
        s = s // 2 if s > 2 * least else s - 1 if s <= least else least
    return covered


def _windows(values: np.ndarray, free: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and fingerprint of every window of s unmarked tokens."""
    n = len(values) - s + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    marked = np.concatenate([[0], np.cumsum(~free)])
    start = np.flatnonzero(marked[s:] == marked[:n])
    up, down = words._powers(len(values))
    total = np.concatenate([[U(0)], np.cumsum(values * up[:len(values)])])
    return start, (total[start + s] - total[start]) * down[start]


def _scan(item, doc, free_i, free_d, s):
    start_i, key_i = _windows(item, free_i, s)
    start_d, key_d = _windows(doc, free_d, s)
    places = defaultdict(list)
    for at, key in zip(start_d.tolist(), key_d.tolist(), strict=True):
        places[key].append(at)
    found, longest, seen = defaultdict(list), 0, set()
    for i, key in zip(start_i.tolist(), key_i.tolist(), strict=True):
        for d in places.get(key, ()):
            if (i - 1, d - 1) in seen:                   # inside a match that is already extended
                seen.add((i, d))
                continue
            if not np.array_equal(item[i:i + s], doc[d:d + s]):
                continue
            length = s
            while (i + length < len(item) and d + length < len(doc) and free_i[i + length] and free_d[d + length]
                   and item[i + length] == doc[d + length]):
                length += 1
            seen.add((i, d))
            found[length].append((i, d))
            longest = max(longest, length)
    return longest, found


def _index(items: list[tuple[int | None, np.ndarray]], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the items, sorted, and the item that each belongs to."""
    seeds = [words.shingle_hashes(t, seed) for _, t in items]
    key = np.concatenate([np.zeros(0, U), *seeds])
    owner = np.repeat(np.arange(len(items)), [len(s) for s in seeds])
    order = np.argsort(key, kind="stable")
    return key[order], owner[order]


def _matcher(items: list, seed: int, column: int, tiles: int, names: list[str], types: list[pa.DataType]) -> Callable:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # seeds of the usual length, and of each length of shorter items
        indexes = []
        for k in sorted({min(seed, len(t)) for _, t in items}):
            own = [n for n, (_, t) in enumerate(items) if min(seed, len(t)) == k]
            key, owner = _index([items[n] for n in own], k)
            sieve = np.zeros(1 << 22, bool)
            sieve[key >> U(42)] = True
            indexes.append((k, key, np.array(own)[owner], sieve))
        for batch in batches:
            raw, ends = words.text_buffer(batch.column(column))
            for lo, hi in words.slices(ends):
                a = ends[lo]
                token, at = tokens(raw[a:ends[hi]], ends[lo:hi + 1] - a)
                part = batch.slice(lo, hi - lo)
                old = part.column(tiles).to_pylist()
                for k, key, owner, sieve in indexes:
                    hash_of = words.shingle_hashes(token, k)
                    maybe = np.flatnonzero(sieve[hash_of >> U(42)])
                    left = np.searchsorted(key, hash_of[maybe])
                    hit = (left < len(key)) & (key[np.minimum(left, len(key) - 1)] == hash_of[maybe])
                    maybe, left = maybe[hit], left[hit]
                    right = np.searchsorted(key, hash_of[maybe], "right")
                    doc = np.searchsorted(at, maybe, "right") - 1
                    inside = maybe + k <= at[doc + 1]     # not across the end of a text
                    for d in np.unique(doc[inside]):
                        mine = inside & (doc == d)
                        cover = _covered(token, maybe[mine], k)
                        for o in np.unique(np.concatenate([owner[x:y] for x, y in
                                                           zip(left[mine], right[mine], strict=True)])):
                            n = tile(items[o][1], cover, k)
                            old[d] = (old[d] or []) + [{"item_id": items[o][0], "covered": n, "tokens": len(items[o][1])}]
                columns = [*part.columns]
                columns[tiles] = pa.array(old, types[tiles])
                yield pa.record_batch(columns, names)
    return match


def _covered(token: np.ndarray, start: np.ndarray, seed: int) -> np.ndarray:
    """The tokens that shared seeds cover; a gap is one token that equals no other."""
    out, end = [], None
    for n, s in enumerate(start.tolist()):
        if end is None or s > end:
            if end is not None:
                out.append(np.array([(0xFFFF << 48) + n], U))
            out.append(token[s:s + seed])
        else:
            out.append(token[end:s + seed])
        end = s + seed
    return np.concatenate(out)


def with_tiles(docs: DataFrame, benchmark: DataFrame, name: str = "tiles", seed: int = 5,
               block_tokens: int = 4_000_000) -> DataFrame:
    """``docs`` with the tiled items of each row: item_id, covered, tokens."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    # a token has at least two characters with its gap, or is one character of three bytes or more
    half = F.length("text") + 1 + F.ceil((F.octet_length("text") - F.length("text")) / 2)
    size = items.agg(F.coalesce(F.sum(half), F.lit(0))).first()[0] // 2 + 1
    n = -(-size // block_tokens)
    out = docs.withColumn(name, F.lit(None).cast(TILES))
    schema = T.StructType(out.schema.fields)
    empty = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "covered", "tokens")]))
    types = [None] * (len(schema) - 1) + [empty]
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else items
        rows = sorted(block.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        parsed = []
        for r in rows:
            raw = np.frombuffer((r["text"] or "").encode(), np.uint8)
            token, _ = tokens(raw, np.array([0, len(raw)]))
            if len(token):
                parsed.append((r["item_id"], token))
        out = out.mapInArrow(_matcher(parsed, seed, docs.columns.index("text"), len(schema) - 1, schema.names, types),
                             schema)
    return out


def contaminating(name: str, percent: int):
    """The tiles that cover at least ``percent`` of their item."""
    return F.filter(F.coalesce(F.col(name), F.array().cast(TILES)),
                    lambda x: x["covered"] * 100 >= x["tokens"] * percent)


def decontaminated(docs: DataFrame, benchmark: DataFrame, seed: int = 5, percent: int = 50) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, columns as they were."""
    name = free_name(docs, "tiles")
    tiled = with_tiles(docs, benchmark, name, seed)
    return tiled.where(F.size(contaminating(name, percent)) == 0).drop(name)


def coverage(docs: DataFrame, benchmark: DataFrame, seed: int = 5, percent: int = 50) -> DataFrame:
    """doc_id, n_items, items, best_coverage, contaminated per row of ``docs``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tiled = with_tiles(base, benchmark, "tiles", seed)
    bad = contaminating("tiles", percent)
    share = F.transform("tiles", lambda x: x["covered"] / x["tokens"])
    return tiled.select("doc_id", F.size(bad).cast("long").alias("n_items"),
                        F.array_sort(F.transform(bad, lambda x: x["item_id"])).alias("items"),
                        F.coalesce(F.array_max(share), F.lit(0.0)).alias("best_coverage"),
                        (F.size(bad) > 0).alias("contaminated"))
