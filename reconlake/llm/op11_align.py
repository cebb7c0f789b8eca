"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes.

Each text, with a space in front, is encoded by A (byte-level BPE) and B (SentencePiece
BPE, ``op13_pieces``). Places where tokens of both end cut the text into groups; all A
and B tokens of a group are linked. The count of a pair of ids is the number of
documents that hold it linked. Counting is external, by spilled runs:

1. a task takes texts of about ``RUN`` bytes at a time. Their pair-document records
   (pair, document, how often it is linked there) are radix-partitioned by the A id,
   sorted with A as the major side, and spilled as zstd runs;
2. after ``FAN_IN`` runs, a heap merges the runs' pairs, part by part, and counts the
   documents of each pair in this block. A pair goes on once per block, however many
   documents hold it, so that no pair or A id is hot;
3. Spark adds up the blocks' counts by pair; all pairs of an A id, B ids times at most,
   meet for its maximum;
4. counts and maxima stream back to the blocks that hold a pair; there each run is
   gone through once more and its records add to their documents' sums.

Groups of many tokens give each distinct pair once, with its number; they are expanded
``EXPAND`` links at a time.

Nulls, ties, odd rows: null and empty texts, and texts whose tokens' bytes are not the
text's (for instance with U+2581 in it, which B takes for a space), have no tokens: zeros
and an empty ``groups_sha256``. Every row is a document of its own, also where doc_ids
repeat or are null. All pairs with the highest count of their A id count as best. Other
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reconlake.llm import op13_pieces, words
from reconlake.llm.store import written

U = np.uint64
RUN = 2 << 20              # bytes of text in a run
FAN_IN = 32                # runs of a block
PARTS = 16                 # radix parts of the A ids
EXPAND = 4_000_000         # links that are listed at once
MAX_WORDS = 400_000        # words whose A ids a task keeps

WHITE = np.zeros(0x110000, bool)
WHITE[[c for c in range(0x3001) if chr(c).isspace()]] = True

DIGESTS = ["n_a", "n_b", "n_groups", "n_links"]
SPILLED = ("block long, run int, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, records binary, pair array<long>, held array<long>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


class ByteTokenizer:
    """Tokenizer A. A text is cut at single spaces between words, where its pre-tokens
    end in any case; equal words are encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(self.tokenizer.to_str())
        before = config.get("pre_tokenizer") or {}
        if (config.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
                or not before.get("use_regex")):
            raise ValueError("a byte-level BPE without normalization is needed")
        # printable bytes stand for themselves, the others for characters from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        vocabulary = self.tokenizer.get_vocab()
        raw = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            raw[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.raw_flat = np.frombuffer(b"".join(raw), np.uint8)
        self.size = len(raw)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with a space in front, offsets of each text's ids)."""
        n_chars = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        text_at = np.concatenate([[0], np.cumsum(n_chars)])
        flat = "".join([" " + t for t in texts if t])
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        chars = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        white = WHITE[chars]
        cut = np.zeros(len(chars), bool)
        cut[1:-1] = (chars[1:-1] == 32) & ~white[:-2] & ~white[2:]
        cut[text_at[:-1][n_chars > 0]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(chars)))
        first, sort = op13_pieces.equal_words(chars, start, size)
        own = [flat[a:a + n] for a, n in zip(start[first].tolist(), size[first].tolist(), strict=True)]
        new = [w for w in own if w not in self.known]
        if len(self.known) + len(new) > MAX_WORDS:
            self.known.clear()
            new = own
        for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.known[w] = array("i", e.ids).tobytes()
        ids = [self.known[w] for w in own]
        per_word = np.array([len(i) // 4 for i in ids], np.int64)
        word_at = np.cumsum(per_word) - per_word
        ends = np.concatenate([[0], np.cumsum(per_word[sort])])
        return (np.frombuffer(b"".join(ids), np.int32)[words.flat_range(word_at[sort], per_word[sort])],
                ends[np.searchsorted(start, text_at)])


def _byte_tokenizer(path: str) -> ByteTokenizer:
    """The tokenizer, loaded once per worker process."""
    kept = sys.modules.setdefault("reconlake_worker_cache", ModuleType("reconlake_worker_cache"))
    made = kept.__dict__.setdefault("byte_tokenizers", {})
    if path not in made:
        made[path] = ByteTokenizer(path)
    return made[path]


def _same_bytes(raw: np.ndarray, ends: np.ndarray, vocabulary, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts whose tokens' bytes are the text's, the tokens' ends in ``raw``)."""
    size = np.diff(vocabulary.raw_at)[ids]
    stop = np.cumsum(size)
    text_end = np.concatenate([[0], stop])[at]
    good = np.diff(text_end) == np.diff(ends)
    mine = np.repeat(good, np.diff(at))
    made = vocabulary.raw_flat[words.flat_range(vocabulary.raw_at[:-1][ids[mine]], size[mine])]
    here = np.flatnonzero(good)
    wanted = words.flat_range(ends[here], np.diff(ends)[here])
    differ = made != raw[wanted]
    if differ.any():
        good[np.searchsorted(ends, wanted[differ], "right") - 1] = False
    return good, stop - np.repeat(text_end[:-1] - ends[:-1], np.diff(at))


MARKS = (",", "|", ";", "")


def _shown(size: int) -> np.ndarray:
    """Each id's digits with each of the marks."""
    return np.array([f"{i}{mark}" for i in range(size) for mark in MARKS], object)


def _joined(shown: np.ndarray, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray,
            at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[np.append(group_a[1:] != group_a[:-1], True)] = 1
    mark_b[np.append(group_b[1:] != group_b[:-1], True)] = 2
    mark_b[at_b[1:][np.diff(at_b) > 0] - 1] = 3
    # A tokens of a group come before its B tokens
    order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
    parts = shown[np.concatenate([a * 4 + mark_a, b * 4 + mark_b])[order]].tolist()
    at = (at_a + at_b).tolist()
    return ["".join(parts[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]


def _pairs(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, n_b: np.ndarray, first_b: np.ndarray, doc: np.ndarray,
           bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(pair and document, links) of all groups, ascending; ``doc`` is each A token's document."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    size = n_b[group_a]
    total = np.cumsum(size)
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + EXPAND, "right")))
        n = size[at:to]
        other = b[words.flat_range(first_b[group_a[at:to]], n)].astype(U)
        key = (((np.repeat(a[at:to].astype(U), n) << U(bits[0])) | other) << U(bits[1])) | np.repeat(doc[at:to].astype(U), n)
        done.append(np.unique(key, return_counts=True))
        at = to
        if len(done) > 1:
            done = [_added(done)]
    return done[0] if done else (np.zeros(0, U), np.zeros(0, np.int64))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.zeros(len(key), np.int64)
    np.add.at(n, where, np.concatenate([c for _, c in parts]))
    return key, n


def _packed(*arrays: np.ndarray) -> bytes:
    """A zstd run of arrays of whole numbers."""
    head = np.array([len(arrays), *[len(x) for x in arrays]], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join([x.astype("<i8").tobytes() for x in arrays]))


def _unpacked(run: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), "<i8")
    n = int(flat[0])
    return np.split(flat[1 + n:], np.cumsum(flat[1:n]))


def _counted(runs: list[bytes]) -> tuple[list[int], list[int]]:
    """(pair, documents) of the runs of one part: a heap merge, A ids as the major side."""
    pairs, held = [], []
    merged = heapq.merge(*[zip(*[x.tolist() for x in _unpacked(run)], strict=True) for run in runs], key=itemgetter(0))
    for pair, own in groupby(merged, key=itemgetter(0)):
        pairs.append(pair)
        held.append(sum([n for _, n in own]))
    return pairs, held


def _spiller(path_a: str, path_b: str) -> Callable:
    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, m = _byte_tokenizer(path_a), op13_pieces.model(path_b)
        shown = _shown(max(tok.size, m.size))
        block, run, heads = TaskContext.get().partitionId() << 32, 0, [[] for _ in range(PARTS)]
        for batch in batches:
            raw, ends = words.text_buffer(batch.column(1))
            for lo, hi in words.slices(ends, RUN):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                rows, key, links = _aligned(tok, m, shown, texts)
                yield _rows(block, run, batch.column(0).slice(lo, hi - lo), rows)
                row_bits = _bits(hi - lo)
                pair, doc = (key >> U(row_bits)).astype(np.int64), (key & U((1 << row_bits) - 1)).astype(np.int64)
                first = np.flatnonzero(np.append(len(pair) > 0, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
                own, held = pair[first], np.diff(np.append(first, len(pair)))
                part = (own >> _bits(m.size)) * PARTS // tok.size
                for p in range(PARTS):
                    if (mine := part == p).any():
                        heads[p].append(_packed(own[mine], held[mine]))
                yield _spilled(block=[block], run=[run], records=[_packed(own, held, doc, links)])
                run += 1
                if run == FAN_IN:
                    yield from _counts(block, heads)
                    block, run, heads = block + 1, 0, [[] for _ in range(PARTS)]
        yield from _counts(block, heads)
    return spill


def _counts(block: int, heads: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    for runs in heads:
        if runs:
            pair, held = _counted(runs)
            yield _spilled(block=[block], pair=[pair], held=[held])


def _bits(n: int) -> int:
    return max(1, int(n - 1).bit_length())


def _aligned(tok: ByteTokenizer, m: op13_pieces.Model, shown: np.ndarray, texts: list[str]
             ) -> tuple[dict, np.ndarray, np.ndarray]:
    """(columns by text, pair-document keys, their links)."""
    raw, ends = words.text_buffer(pa.array([" " + t if t else "" for t in texts], pa.large_string()))
    a, at_a = tok.encode(texts)
    b, at_b = op13_pieces.encode(m, texts)
    good_a, stop_a = _same_bytes(raw, ends, tok, a, at_a)
    good_b, stop_b = _same_bytes(raw, ends, m, b, at_b)
    good = good_a & good_b
    on_a, on_b = np.repeat(good, np.diff(at_a)), np.repeat(good, np.diff(at_b))
    n_a, n_b = np.where(good, np.diff(at_a), 0), np.where(good, np.diff(at_b), 0)
    a, b, stop_a, stop_b = a[on_a], b[on_b], stop_a[on_a], stop_b[on_b]
    doc = np.repeat(np.arange(len(texts)), n_a)
    # a group ends where tokens of both end
    ends_a = np.zeros(len(raw) + 1, bool)
    ends_a[stop_a] = True
    both = stop_b[ends_a[stop_b]]
    group_a, group_b = np.searchsorted(both, stop_a), np.searchsorted(both, stop_b)
    size_a, size_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
    owner = np.searchsorted(ends, both) - 1
    links = np.zeros(len(texts), np.int64)
    groups = np.zeros(len(texts), np.int64)
    np.add.at(links, owner, size_a * size_b)
    np.add.at(groups, owner, 1)
    at_a, at_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    strings = _joined(shown, a, b, group_a, group_b, at_a, at_b) if len(a) else [""] * len(texts)
    rows = {"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links,
            "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in strings]}
    bits = _bits(m.size), _bits(len(texts))
    key, n = _pairs(a, b, group_a, size_b, np.cumsum(size_b) - size_b, doc, bits)
    return rows, key, n


_TYPES = {"block": pa.int64(), "run": pa.int32(), "row": pa.int32(), "doc_id": pa.int64(),
          **dict.fromkeys(DIGESTS, pa.int64()), "groups_sha256": pa.string(), "records": pa.binary(),
          "pair": pa.list_(pa.int64()), "held": pa.list_(pa.int64())}


def _spilled(**columns) -> pa.RecordBatch:
    n = len(columns["block"])
    return pa.record_batch([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _TYPES.items()],
                           list(_TYPES))


def _rows(block: int, run: int, ids: pa.Array, rows: dict) -> pa.RecordBatch:
    n = len(ids)
    return _spilled(block=np.full(n, block), run=np.full(n, run), row=np.arange(n), doc_id=ids, **rows)


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block; ``right`` has its pairs' counts and whether they are best."""
    pair = right["pair"].to_numpy()
    order = np.argsort(pair)
    pair, count, best = pair[order], right["total"].to_numpy()[order], right["best"].to_numpy()[order]
    docs = left.filter(pc.is_valid(left["row"])).sort_by([("run", "ascending"), ("row", "ascending")])
    run_of = docs["run"].to_numpy()
    n_best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    runs = left.filter(pc.is_valid(left["records"]))
    for run, records in zip(runs["run"].to_pylist(), runs["records"], strict=True):
        own, held, doc, links = _unpacked(records.as_py())
        at = np.searchsorted(pair, own)
        row = doc + np.searchsorted(run_of, run)
        np.add.at(total, row, links * np.repeat(count[at], held))
        np.add.at(n_best, row, links * np.repeat(best[at], held))
    return pa.table([docs["doc_id"], *[docs[c] for c in DIGESTS], pa.array(n_best), pa.array(total), docs["groups_sha256"]],
                    ["doc_id", *DIGESTS, "n_best", "count_sum", "groups_sha256"])


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spilled = written(spark, "aligned-runs", base.mapInArrow(_spiller(path_a, path_b), SPILLED))
    held = spilled.where("pair is not null").select("block", F.inline(F.arrays_zip("pair", "held")))
    counted = pair_counts(held, op13_pieces.Model(path_b).size)
    told = held.select(F.col("block").alias("of_block"), "pair").join(counted.select("pair", "total", "best"), "pair")
    kept = spilled.where("pair is null").drop("pair", "held")
    return kept.groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(_summed, RESULT)


def pair_counts(held: DataFrame, size_b: int) -> DataFrame:
    """pair, a, b, total (documents of the pair), best (1 if none of its A id has more)."""
    bits = _bits(size_b)
    total = held.groupBy("pair").agg(F.sum("held").alias("total")).withColumns(
        {"a": F.shiftright("pair", bits), "b": F.col("pair").bitwiseAND(F.lit((1 << bits) - 1))})
    most = F.max("total").over(Window.partitionBy("a"))          # as many rows as B has ids, at most
    return total.withColumn("best", (F.col("total") == most).cast("long"))
