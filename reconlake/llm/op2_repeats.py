"""Exact removal of repeated byte strings, by suffix arrays over what may repeat.

A byte goes if a string of 50 bytes that covers it also starts in a document with a
smaller doc_id. Suffix-sorting the whole corpus in one piece is no Spark job, so the
strings that can be equal are first brought together:

1. Each window of 50 bytes has an anchor, its least 20-gram by hash (the leftmost of
   several). Equal windows have equal anchors. Neighbouring windows with one anchor
   form a context, about 65 bytes long; the contexts hold each window once.
2. Contexts are hashed, packed (12 bytes each) and grouped by anchor. A context that
   a smaller document has too is repeated as a whole. An anchor with one context only
   is settled. The rest, where equal and different bytes meet, is sent on, one
   document per context. Of contexts that many documents of a task share, only the
   smallest document's is grouped, and the contexts of anchors that a sample of the
   documents shows to be crowded are grouped by themselves, so no group has an entry
   for each document of a common passage.
3. The contexts of an anchor meet in one task. Windows that reach beyond the longest
   agreement of their context with any other, to the left or right of the anchor, are
   cut off. Of contexts that are equal then, the smallest document's stands for all. Of
   the different ones a suffix array is made by linear grouping construction
   (op2_gsaca); runs of suffixes that agree in 50 bytes are equal windows, and each
   run's smallest doc_id decides.
4. An anchor with very many contexts (a passage at whose edges thousands of documents
   go on differently) would be one large task. Its windows are hashed, packed and
   grouped one by one instead, as contexts are in 2: the same answer, in pieces.
5. Each document's repeated windows are joined back to its text, once, and removed.

Copies of a whole text are found by SHA-256 and need no text at all: what follows the
smallest doc_id goes entirely, if it is 50 bytes long or longer. Texts travel packed
(zstd). Windows and contexts count as equal if 64 (48, within one anchor) bits of
their hashes agree, except in suffix arrays, where bytes are compared.

Nulls, ties, odd rows: a null text is empty; a text shorter than 50 bytes keeps all.
Rows that repeat a doc_id are not smaller than each other, so they don't shorten one
another, whatever they hold. A row without doc_id keeps all and shortens no other.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import op2_gsaca, words
from reconlake.llm.store import written

U = np.uint64
LENGTH, GRAM = 50, 20
GRAMS = LENGTH - GRAM + 1                  # 20-grams in a window
SEGMENT = 1 << 18                          # window starts that are hashed at once
FULL, SEND, HOT = 1, 2, 3
CROWDED, DONE, KINDS = 1, 2, 3             # of packed entries; 0 are compared by anchor
MASK48 = U((1 << 48) - 1)
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass
class Contexts:
    """Contexts of a byte buffer: windows that start from lo to hi have the same anchor."""
    lo: np.ndarray
    hi: np.ndarray
    place: np.ndarray                      # of the anchor, from lo
    anchor: np.ndarray                     # hash of the anchor
    key: np.ndarray                        # 48-bit hash of the bytes and of the anchor's place in them


PLACE = U((1 << 24) - 1)                   # lower bits, for a place in a segment


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (by its upper 40 bits; leftmost) of each ``width`` neighbours."""
    best, s = (values & ~PLACE) | np.arange(len(values), dtype=U), 1
    while s * 2 <= width:
        best = np.minimum(best[s:], best[:-s])
        s *= 2
    if width > s:
        best = np.minimum(best[width - s:], best[:s - width])
    return (best & PLACE).astype(np.int64)


def contexts(raw: np.ndarray, ends: np.ndarray) -> Contexts:
    """The contexts of all texts of a buffer, in order; windows never cross texts.

    Long buffers are hashed in segments. A segment sees as many windows before and
    after its own as a context can have, and returns the contexts that start in it,
    so they don't depend on where segments end."""
    parts = []
    n = len(raw)
    rest = np.repeat(ends[1:], np.diff(ends))            # end of each byte's text
    for lo in range(0, max(0, n - LENGTH + 1), SEGMENT):
        base = max(0, lo - GRAMS)
        part = raw[base:lo + SEGMENT + GRAMS + LENGTH - 1]
        m = len(part)
        up, down = words._powers(m + 1)
        total = np.zeros(m + 1, U)
        np.cumsum(words._BYTE[part] * up[:m], out=total[1:])
        gram = words.mix((total[GRAM:] - total[:-GRAM]) * down[:m - GRAM + 1])
        place = _least(gram, GRAMS)
        start = np.flatnonzero(np.arange(base + LENGTH, base + LENGTH + len(place)) <= rest[base:base + len(place)])
        if not len(start):
            continue
        own = place[start]
        fresh = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)]))
        a, b, p = start[fresh], start[np.append(fresh[1:], len(start)) - 1], own[fresh]
        mine = (a + base >= lo) & (a + base < lo + SEGMENT)
        a, b, p = a[mine], b[mine], p[mine]
        body = words.mix((total[b + LENGTH] - total[a]) * down[a] + (b - a).astype(U))
        key = words.mix(body + (p - a).astype(U) * U(0x9FB21C651E98DF25)) & MASK48
        # anchors are least hashes, so their upper bits are mostly zero: mixed again, they deal out evenly
        parts.append((a + base, b + base, p - a, words.mix(gram[p] + U(1)), key))
    if not parts:
        none = np.zeros(0, np.int64)
        return Contexts(none, none, none, np.zeros(0, U), np.zeros(0, U))
    return Contexts(*[np.concatenate(x) for x in zip(*parts, strict=True)])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = words.text_buffer(batch.column(1))
        yield pa.record_batch([
            batch.column(0), pa.array([hashlib.sha256(raw[a:b]).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)],
                                      pa.binary()), pa.array(np.diff(ends), pa.int64())], ["doc_id", "tid", "n_bytes"])


def _pack_ids(ids: np.ndarray) -> bytes:
    """The least id, and the others' distances to it, in four bytes each if they fit."""
    apart = (ids - ids.min()).view(U)
    kind = "<u4" if apart.max() < 1 << 32 else "<u8"
    return np.array([ids.min()], "<i8").tobytes() + kind[2].encode() + apart.astype(kind).tobytes()


def _unpack_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[8:9].decode()}", offset=9).astype(U).view(np.int64) + np.frombuffer(packed, "<i8", 1)


def _packed(ids: np.ndarray, row: np.ndarray, group: np.ndarray, key: np.ndarray, bits: int, kind: int = 0) -> pa.RecordBatch:
    """Rows (bucket, docs, at, groups, keys): entries by the upper bits of their group, and by kind."""
    bucket = (group >> U(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
    out = []
    for b in range(1 << bits):
        mine = order[cut[b]:cut[b + 1]]
        if len(mine):
            docs, at = np.unique(row[mine], return_inverse=True)
            k, g = key[mine], (group[mine] >> U(40 - bits)).astype(np.uint32)
            out.append((b * KINDS + kind, _pack_ids(ids[docs]), at.astype("<u4" if len(docs) > 65535 else "<u2").tobytes(),
                        g.astype("<u2").tobytes() + (g >> 16).astype(np.uint8).tobytes(),
                        k.astype("<u4").tobytes() + (k >> U(32)).astype("<u2").tobytes()))
    return _record(out)


def _packed_done(ids: np.ndarray, row: np.ndarray, key: np.ndarray, bits: int) -> pa.RecordBatch:
    """Entries that need no comparison any more, in pieces that are dealt evenly; they have no group."""
    out = []
    for lo in range(0, len(row), 1 << 16):
        docs, at = np.unique(row[lo:lo + (1 << 16)], return_inverse=True)
        k = key[lo:lo + (1 << 16)]
        own = words.mix(ids[docs[:1]].astype(np.int64).view(U) + words.mix(k[:1]))[0] >> U(64 - bits)
        out.append((int(own) * KINDS + DONE, _pack_ids(ids[docs]), at.astype("<u4" if len(docs) > 65535 else "<u2").tobytes(), b"",
                    k.astype("<u4").tobytes() + (k >> U(32)).astype("<u2").tobytes()))
    return _record(out)


def _record(out: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([o[0] for o in out], pa.int32()), *[
        pa.array([o[i] for o in out], pa.binary()) for i in range(1, 5)]], ["bucket", "docs", "at", "groups", "keys"])


PACKED = "bucket int, docs binary, at binary, groups binary, keys binary"


def _code(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    return words.mix(group + words.mix(key + U(5)))


class _Seen:
    """The smallest document, in one task, of entries that several of its documents have.

    As a partial aggregation does, it leaves one entry for all of a batch, and mostly
    one for all of a task: however many documents share a passage, a bucket gets one
    entry per task, and the others are known to be repeated without it."""

    def __init__(self, limit: int = 1 << 17):
        self.limit = limit
        self.code, self.least = np.zeros(0, U), np.zeros(0, np.int64)

    def split(self, doc: np.ndarray, group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries to be compared elsewhere, and of those that a smaller document has."""
        if not len(doc):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = _code(group, key)
        order = np.lexsort((doc, code))
        c, d = code[order], doc[order]
        new = np.concatenate([[True], c[1:] != c[:-1]])
        once = new | np.concatenate([[True], d[1:] != d[:-1]])          # a document's equal entries are one
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        own, first = c[start], d[start]
        earlier = np.full(len(start), np.iinfo(np.int64).max)
        told = np.zeros(len(start), bool)
        if len(self.code):
            at = np.minimum(np.searchsorted(self.code, own), len(self.code) - 1)
            told = self.code[at] == own
            earlier[told] = self.least[at[told]]
        least = np.minimum(first, earlier)
        fresh = new & ((first < earlier) | ~told)[run]
        known = once & (d > least[run])
        self._remember(own, least, told | (d[np.append(start[1:], len(d)) - 1] > first))
        return order[fresh], order[known]

    def _remember(self, code: np.ndarray, least: np.ndarray, shared: np.ndarray) -> None:
        code, least = np.concatenate([self.code, code[shared]]), np.concatenate([self.least, least[shared]])
        order = np.lexsort((least, code))
        code, least = code[order], least[order]
        first = np.concatenate([[True], code[1:] != code[:-1]])[:len(code)]
        if first.sum() <= self.limit:                      # else entries are left for the buckets, nothing is lost
            self.code, self.least = code[first], least[first]
        else:
            at = np.searchsorted(code, self.code)          # sorted by least, the first is the smallest
            self.least = least[at]


def _text_contexts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, anchor and key of each context of a batch (doc_id, text)."""
    raw, ends = words.text_buffer(batch.column(1))
    found = [(lo, contexts(raw[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo])) for lo, hi in words.slices(ends, 1 << 19)]
    row = np.concatenate([np.zeros(0, np.int64), *[np.searchsorted(ends, c.lo + ends[lo], "right") - 1 for lo, c in found]])
    return (row, np.concatenate([np.zeros(0, U), *[c.anchor for _, c in found]]),
            np.concatenate([np.zeros(0, U), *[c.key for _, c in found]]))


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, anchor, key = _text_contexts(batch)
        _, first = np.unique(_code(anchor, key), return_index=True)
        yield pa.record_batch([pa.array(anchor[first].view(np.int64)), pa.array(key[first].astype(np.int64))], ["anchor", "key"])


def _packer(bits: int, crowded: np.ndarray) -> Callable:
    """A batch's contexts, by anchor; those of ``crowded`` (sorted) anchors by themselves."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            row, anchor, key = _text_contexts(batch)
            fresh, known = seen.split(ids[row], anchor, key)
            yield _packed_done(ids, row[known], key[known], bits)
            row, anchor, key = row[fresh], anchor[fresh], key[fresh]
            apart = np.zeros(len(row), bool)
            if len(crowded):
                apart = crowded[np.minimum(np.searchsorted(crowded, anchor), len(crowded) - 1)] == anchor
                yield _packed(ids, row[apart], _code(anchor[apart], key[apart]), key[apart], bits, CROWDED)
            yield _packed(ids, row[~apart], anchor[~apart], key[~apart], bits)
    return pack


def _window_hashes(body: bytes) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8)
    up, down = words._powers(len(raw) + 1)
    total = np.concatenate([[U(0)], np.cumsum(words._BYTE[raw] * up[:len(raw)])])
    return words.mix((total[LENGTH:] - total[:-LENGTH]) * down[:len(raw) - LENGTH + 1])


def _window_packer(bits: int) -> Callable:
    """The windows of crowded anchors, each its own group: (doc_id, bodies) to packed entries."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [np.concatenate([np.zeros(0, U), *map(_window_hashes, own)]) for own in batch.column(1).to_pylist()]
            h = np.concatenate([np.zeros(0, U), *found])
            row, group, key = np.repeat(np.arange(len(found)), [len(f) for f in found]), words.mix(h + U(3)), h & MASK48
            fresh, known = seen.split(ids[row], group, key)
            yield _packed_done(ids, row[known], key[known], bits)
            yield _packed(ids, row[fresh], group[fresh], key[fresh], bits)
    return pack


def _settler(hot: int) -> Callable:
    """What each document must know of its contexts: (doc_id, states), states as key * 4 + state."""
    def settle(rows: pa.Table) -> pa.Table:
        docs, anchors, keys = [], [], []
        kind = rows.column("bucket")[0].as_py() % KINDS
        for r in rows.to_batches():
            for d, at, g, k in zip(*[r[c].to_pylist() for c in ("docs", "at", "groups", "keys")], strict=True):
                n, ids = len(k) // 6, _unpack_ids(d)
                a = np.zeros(n, np.uint32) if kind == DONE else np.frombuffer(g, "<u2", n).astype(np.uint32) | np.frombuffer(g, np.uint8, n, 2 * n).astype(np.uint32) << 16
                docs.append(ids[np.frombuffer(at, "<u4" if len(ids) > 65535 else "<u2")])
                anchors.append(a)
                keys.append(np.frombuffer(k, "<u4", n).astype(U) | np.frombuffer(k, "<u2", n, 4 * n).astype(U) << U(32))
        doc, anchor, key = np.concatenate(docs), np.concatenate(anchors), np.concatenate(keys)
        if kind == DONE:
            return told(doc, key, np.full(len(doc), FULL))
        order = np.lexsort((key, anchor))
        doc, anchor, key = doc[order], anchor[order], key[order]
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new = new_anchor | np.concatenate([[True], key[1:] != key[:-1]])
        start = np.flatnonzero(new)
        least = np.minimum.reduceat(doc, start)[np.cumsum(new) - 1]
        group = np.cumsum(new_anchor) - 1
        several = np.bincount(group[start])[group]          # contexts of the anchor
        rest = HOT if kind == CROWDED else np.where(several > hot, HOT, np.where(several > 1, SEND, 0))
        state = np.where(doc > least, FULL, rest)
        return told(doc[state > 0], key[state > 0], state[state > 0])

    def told(doc: np.ndarray, key: np.ndarray, state: np.ndarray) -> pa.Table:
        order = np.argsort(doc, kind="stable")
        doc, entry = doc[order], ((key << U(2)) | state.astype(U))[order]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        offsets = (np.append(first, len(doc)) * 8).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(entry)])
        return pa.table({"doc_id": pa.array(doc[first], pa.int64()), "states": blobs})
    return settle


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        raw, ends = words.text_buffer(batch.column(1))
        own = [raw[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.record_batch([batch.column(0), pa.array([_short(hashlib.sha256(t).digest()) for t in own], pa.int64()),
                               pa.array([zip_.compress(t) for t in own], pa.binary())], ["doc_id", "text_key", "packed"])


def _short(tid: bytes) -> int:
    return int.from_bytes(tid[:8], "big", signed=True)


def _groups(packed: list[bytes], limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Neighbouring texts, unpacked, of about ``limit`` bytes together: (first, end, bytes, ends)."""
    unzip = zstandard.ZstdDecompressor()
    at, texts, size = 0, [], 0
    for i, p in enumerate(packed):
        texts.append(unzip.decompress(p))
        size += len(texts[-1])
        if size >= limit or i + 1 == len(packed):
            yield at, i + 1, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            at, texts, size = i + 1, [], 0


SENT = "array<struct<anchor:bigint,hot:boolean,lo:int,place:int,body:binary>>"
MARKED = f"doc_id long, text_key long, packed binary, repeated binary, sent {SENT}"


def _states(row: np.ndarray, key: np.ndarray, told: list[bytes]) -> np.ndarray:
    """State of each context (row of its text, key), as told to the texts; 0 if nothing was."""
    entry = np.frombuffer(b"".join(told), "<u8")
    of = np.repeat(np.arange(len(told)), [len(t) // 8 for t in told]).astype(U)
    known = of << U(48) | entry >> U(2)                    # keys have 48 bits, rows of a group fewer than 16
    order = np.argsort(known)
    known, state = known[order], (entry & U(3))[order]
    mine = row.astype(U) << U(48) | key
    at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
    return np.where(known[at] == mine, state[at], U(0)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's windows known to repeat (pairs lo, hi), and the contexts it must send."""
    sent_type = pa.list_(pa.struct([("anchor", pa.int64()), ("hot", pa.bool_()), ("lo", pa.int32()), ("place", pa.int32()),
                                  ("body", pa.binary())]))
    for batch in batches:
        packed, states = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for lo, hi, raw, ends in _groups(packed):
            c = contexts(raw, ends)
            row = np.searchsorted(ends, c.lo, "right") - 1
            state = _states(row, c.key, [b"".join(states[i]) for i in range(lo, hi)])
            begin, end = c.lo - ends[row], c.hi - ends[row]
            full = np.flatnonzero(state == FULL)
            pairs = np.stack([begin[full], end[full]], 1).astype("<i4")
            cut = (np.searchsorted(row[full], np.arange(hi - lo + 1)) * 8).astype(np.int32)
            repeated = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cut), pa.py_buffer(pairs.tobytes())])
            sent: list[list[dict]] = [[] for _ in range(hi - lo)]
            told = np.flatnonzero(state > FULL)
            for r, a, s, x, at, y, first in zip(*[v[told].tolist() for v in (
                    row, c.anchor.view(np.int64), state, begin, c.place, c.hi, c.lo)], strict=True):
                sent[r].append({"anchor": a, "hot": s == HOT, "lo": x, "place": at, "body": raw[first:y + LENGTH].tobytes()})
            part = batch.slice(lo, hi - lo)
            yield pa.record_batch([*part.columns[:3], repeated, pa.array(sent, sent_type)],
                                  ["doc_id", "text_key", "packed", "repeated", "sent"])


SHORT = LENGTH - GRAM + 1                  # symbols of a window whose anchor is one symbol


def repeated_windows(bodies: list[bytes], places: list[int], anchors: list[int], docs: np.ndarray) -> list[np.ndarray]:
    """For each context, the starts of its windows that a smaller document's context holds too.

    An anchor's 20 bytes are the same in all its contexts, so they are one symbol here."""
    parts = [b[:p] + b"\0" + b[p + GRAM:] for b, p in zip(bodies, places, strict=True)]
    size = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int32) + 2
    text[begin + size] = 1                                 # gaps
    text[-1] = 0                                           # less than all else, as the suffix array needs
    symbol = {a: 258 + n for n, a in enumerate(dict.fromkeys(anchors))}
    text[begin + np.array(places)] = [symbol[a] for a in anchors]
    order = np.array(op2_gsaca.suffix_array(text.tolist()), np.int64)
    # windows inside one context, in suffix order
    owner = np.repeat(np.arange(len(parts)), size + 1)
    whole = np.arange(len(text)) + SHORT <= (begin + size)[owner]
    order = order[whole[order]]
    out = [np.zeros(0, np.int64)] * len(parts)
    if not len(order):
        return out
    window = np.lib.stride_tricks.sliding_window_view(text, SHORT)
    new = np.concatenate([[True], (window[order[1:]] != window[order[:-1]]).any(1)])
    least = np.minimum.reduceat(docs[owner[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
    hit = np.sort(order[least < docs[owner[order]]])
    cut = np.searchsorted(owner[hit], np.arange(len(parts) + 1))
    return [hit[cut[i]:cut[i + 1]] - begin[i] for i in range(len(parts))]


FOUND = "doc_id long, text_key long, starts array<int>"


def _agreement(anchor: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For each row, the longest common start of ``side`` with another row of its anchor."""
    word = np.ascontiguousarray(side).view(">u8").astype(U)
    order = np.lexsort((*[word[:, i] for i in reversed(range(word.shape[1]))], anchor))
    a, b = order[:-1], order[1:]                           # sorted, the longest is a neighbour's
    differ = side[a] != side[b]
    common = np.where(differ.any(1), differ.argmax(1), side.shape[1])
    common[anchor[a] != anchor[b]] = -1
    out = np.full(len(side), -1)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def trimmed(anchor: np.ndarray, place: np.ndarray, bodies: list[bytes]) -> list[tuple[int, int]]:
    """For each context, its first and last window that can equal another's of its anchor.

    Around their anchors, two contexts agree in so many bytes to the left and to the
    right; a window that reaches beyond the best agreement on a side equals none."""
    reach = GRAMS + 1                                      # a window has at most 30 bytes on a side of the anchor
    left, right = np.zeros((2, len(bodies), reach), np.uint8)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(b) for b in bodies])
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    step = np.arange(reach)
    for side, first, sign, room in ((left, begin + place - 1, -1, place),
                                    (right, begin + place + GRAM, 1, size - place - GRAM)):
        inside = step[None] < room[:, None]
        at = first[:, None] + sign * step[None]
        side[inside] = flat[at[inside]]
    lo = np.maximum(place - np.minimum(_agreement(anchor, left), place), 0)
    hi = place + GRAM + np.minimum(_agreement(anchor, right), size - place - GRAM) - LENGTH
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


def _solve(rows: list[tuple]) -> Iterator[tuple]:
    """(doc_id, text_key, window starts) for rows (anchor, doc_id, text_key, lo, place, body) of whole anchors."""
    keep = trimmed(np.array([r[0] for r in rows], np.int64), np.array([r[4] for r in rows], np.int64), [r[5] for r in rows])
    cut = [(r[0], r[1], r[2], r[3] + lo, r[4] - lo, r[5][lo:hi + LENGTH])
           for r, (lo, hi) in zip(rows, keep, strict=True) if lo <= hi]
    # of contexts that are equal now, the smallest document's enters the array; the others are repeated as a whole
    least: dict[tuple, int] = {}
    for r in cut:
        own = (r[0], r[4], r[5])
        least[own] = min(r[1], least.get(own, r[1]))
    left: list[tuple] = []
    size = 0
    for _, group in groupby(cut, key=lambda r: r[0]):
        own = []
        for r in group:
            if r[1] > least[(r[0], r[4], r[5])]:
                yield r[1], r[2], np.arange(r[3], r[3] + len(r[5]) - LENGTH + 1, dtype=np.int32)
            else:
                own.append(r)
        if len(own) > 1:                                   # an anchor's contexts stay together
            left += own
            size += sum(len(r[5]) for r in own)
        if size >= SORTED:
            yield from _sorted_part(left)
            left, size = [], 0
    if left:
        yield from _sorted_part(left)


def _sorted_part(rows: list[tuple]) -> Iterator[tuple]:
    found = repeated_windows([r[5] for r in rows], [r[4] for r in rows], [r[0] for r in rows],
                             np.array([r[1] for r in rows], np.int64))
    for r, f in zip(rows, found, strict=True):
        if len(f):
            yield r[1], r[2], (f + r[3]).astype(np.int32)


SORTED = 1 << 14                           # symbols of a suffix array, about


def _sorter(batch_bytes: int = 1 << 21) -> Callable:
    """Contexts sorted by anchor to repeated windows."""
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        found = list(_solve(rows))
        return pa.record_batch([pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()),
                                pa.array([k[2] for k in found], pa.list_(pa.int32()))], ["doc_id", "text_key", "starts"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= batch_bytes and rows[-1][0] != r[0]:
                    yield batch_of(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[5])
        if rows:
            yield batch_of(rows)
    return sort


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes what is marked in (doc_id, text_key, packed, repeated, crowded, sorted, counted)."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for text_key, packed, repeated, crowded, by_sort, by_count in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
            raw = unzip.decompress(packed)
            starts = [np.asarray(f["starts"], np.int64) for f in by_sort or () if f["text_key"] == text_key]
            told = np.frombuffer(b"".join(by_count or ()), "<u8")
            known = np.unique(told[told & U(3) == FULL] >> U(2))         # others only share a group with another window
            for c in crowded if len(known) else ():
                starts.append(c["lo"] + np.flatnonzero(np.isin(_window_hashes(c["body"]) & MASK48, known)))
            edge = np.zeros(len(raw) + 1, np.int64)
            for lo, hi in np.frombuffer(repeated, "<i4").reshape(-1, 2).tolist():
                edge[lo] += 1
                edge[hi + LENGTH] -= 1
            for own in starts:
                np.add.at(edge, own, 1)
                np.add.at(edge, own + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(raw, np.uint8)[~gone]
            out.append((int(gone.sum()), spans, hashlib.sha256(kept.tobytes()).hexdigest()))
        yield pa.record_batch([*batch.columns[:2], pa.array([o[0] for o in out], pa.int64()),
                               pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())],
                              ["doc_id", "text_key", "n_removed", "n_spans", "kept_sha256"])


def _crowded(docs: DataFrame, crowd: int, sample: int) -> np.ndarray:
    """Anchors with more than ``crowd`` contexts in every ``sample``-th document, sorted.

    A crowded anchor that the sample misses makes a larger group, not another result."""
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    many = some.mapInArrow(_sampler, "anchor long, key long").distinct().groupBy("anchor").count().where(F.col("count") > crowd)
    return np.sort(np.array([r[0] for r in many.select("anchor").collect()], np.int64).view(U))


def remove_repeats(docs: DataFrame, hot: int = 1000, bucket_bytes: int = 16 << 20, sample: int = 16) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = written(spark, "repeats-sketch", base.mapInArrow(_sketch, "doc_id long, tid binary, n_bytes long"))
    texts = written(spark, "repeats-texts", sketch.where("doc_id is not null").groupBy("tid").agg(
        F.min("doc_id").alias("least")))
    total = sketch.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    bits = max(5, int(total // bucket_bytes).bit_length())

    def settled(packed: DataFrame, crowd: int) -> DataFrame:
        states = packed.groupBy("bucket").applyInArrow(_settler(crowd), "doc_id long, states binary")
        # copies of a smaller document's text are settled already
        return states.join(texts.select(F.col("least").alias("doc_id")).distinct(), "doc_id", "left_semi").groupBy(
            "doc_id").agg(F.collect_list("states").alias("states"))

    long_enough = base.where("doc_id is not null and octet_length(text) >= 50")
    # some 16 bytes of text per context, so the driver gets 2**24 / sample anchors at most
    apart = _crowded(long_enough, max(hot, total >> 28), sample)
    told = settled(long_enough.mapInArrow(_packer(bits, apart), PACKED), hot)
    text = long_enough.mapInArrow(_compress, "doc_id long, text_key long, packed binary")
    marked = written(spark, "repeats-marked", text.join(told, "doc_id").select(
        "doc_id", "text_key", "packed", "states").mapInArrow(_mark, MARKED))

    cold = marked.select("doc_id", "text_key", F.explode("sent").alias("s")).where("not s.hot").select(
        F.col("s.anchor").alias("anchor"), "doc_id", "text_key", "s.lo", "s.place", "s.body")
    sorted_ = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorter(), FOUND).groupBy(
        "doc_id").agg(F.collect_list(F.struct("text_key", "starts")).alias("sorted"))
    crowded = F.filter("sent", lambda c: c["hot"])
    windows = marked.select("doc_id", F.transform(crowded, lambda c: c["body"]).alias("bodies")).where(F.size("bodies") > 0)
    counted = settled(windows.mapInArrow(_window_packer(bits), PACKED), 1 << 62).withColumnRenamed("states", "counted")
    found = sorted_.join(counted, "doc_id", "full_outer")

    slim = F.transform(crowded, lambda c: F.struct(c["lo"].alias("lo"), c["body"].alias("body")))
    done = marked.select("doc_id", "text_key", "packed", "repeated", slim.alias("crowded")).join(
        found, "doc_id", "left").mapInArrow(
        _assemble, "doc_id long, text_key long, n_removed long, n_spans long, kept_sha256 string")
    done = done.dropDuplicates(["doc_id", "text_key"])
    key = F.conv(F.hex(F.substring("tid", 1, 8)), 16, -10).cast("long")
    rows = sketch.join(texts, "tid", "left").withColumn("text_key", key).join(done, ["doc_id", "text_key"], "left")
    copy = (F.col("doc_id") > F.col("least")) & (F.col("n_bytes") >= LENGTH)
    return rows.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("tid")))).alias("kept_sha256"))
