"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

The texts of a batch become one flat array of characters (space as U+2581, one more
in front of each text). It is cut into words where no piece of the vocabulary holds
the two characters side by side: no merge can cross such a place, so words are
independent, and equal words are merged once. All words of a batch then go through
rounds over flat numpy arrays of symbols:

1. each pair of neighbours gets the rank of the piece that it would make;
2. the least rank of each word is its segment's minimum;
3. all pairs of that rank are merged at once, the leftmost first where they overlap.
   The library merges one pair at a time, so a merge counts only if none before it
   in its word made a pair of the same or a better rank; the rest wait a round;
4. the arrays are compacted; words without a pair leave.

Words of more than ``LONG`` characters are merged one pair at a time with a heap, as
a round's work is the length of the word and they may need as many rounds.

Characters without a piece become their UTF-8 bytes' pieces. Decoding joins the
bytes of the pieces and takes off the space that encoding put in front.

Nulls, ties, odd rows: a null text is encoded as the empty text (begin and end ids
only, empty decoded text). Rows are independent of each other, repeated ones and rows
without doc_id included. Other columns are not looked at. An empty table gives none.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import sys
from collections.abc import Callable, Iterator
from itertools import pairwise
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.llm import words

U = np.uint64
LONG = 512
SLICE = 4 << 20            # bytes of text whose words are merged together
SPACE = 0x2581             # the mark that stands for a space
NEVER = np.int32(2**31 - 1)


class Model:
    """The vocabulary as lookup tables. Symbols are piece ids; from ``size`` on,
    characters that occur in longer pieces but have none of their own; ``other``
    stands for all other characters."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kind, normal = proto.trainer_spec, proto.normalizer_spec
        piece = sentencepiece_model_pb2.ModelProto.SentencePiece
        if (kind.model_type != kind.BPE or not kind.byte_fallback or kind.treat_whitespace_as_suffix
                or normal.precompiled_charsmap or normal.remove_extra_whitespaces
                or not (normal.add_dummy_prefix and normal.escape_whitespaces)
                or any(p.type not in (piece.NORMAL, piece.UNKNOWN, piece.CONTROL, piece.BYTE) for p in proto.pieces)):
            raise ValueError("a BPE model with byte fallback, plain normalization and a space in front is needed")
        self.size = len(proto.pieces)
        own = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == piece.NORMAL}
        self.begin, self.end = kind.bos_id, kind.eos_id
        self.bytes_id = np.zeros(256, np.int32)
        self.raw: list[bytes] = []               # what each piece decodes to
        for i, p in enumerate(proto.pieces):
            if p.type == piece.BYTE:
                self.bytes_id[int(p.piece[1:-1], 16)] = i
                self.raw.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == piece.NORMAL:
                self.raw.append(p.piece.replace(chr(SPACE), " ").encode())
            else:
                self.raw.append(b"" if p.type == piece.CONTROL else kind.unk_surface.encode())
        self.marked = np.zeros(self.size, bool)          # pieces that start with the space mark
        self.marked[[i for p, i in own.items() if p[0] == chr(SPACE)]] = True
        self.control = np.array([p.type == piece.CONTROL for p in proto.pieces])

        symbol = dict(own)
        for p in own:
            for c in p if len(p) > 1 else ():
                symbol.setdefault(c, len(symbol) - len(own) + self.size)
        self.other = self.size + len(symbol) - len(own)
        self.symbol_of = np.full(0x110000, self.other, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        rank_of = {s: r for r, s in enumerate(sorted({proto.pieces[i].score for i in own.values()}, reverse=True))}
        pairs = sorted((symbol[p[:i]] * (self.other + 1) + symbol[p[i:]], rank_of[proto.pieces[own[p]].score], own[p])
                       for p in own for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol)
        # pairs in a hash table with open addressing, at most a quarter full
        self.shift = U(64 - max(4, (4 * len(pairs)).bit_length()))
        n = 1 << (64 - int(self.shift))
        self.pair_key, self.pair_rank, self.pair_made = np.full(n, -1, np.int64), np.full(n, NEVER, np.int32), np.zeros(n, np.int32)
        slots = self._slots(np.array([k for k, _, _ in pairs], np.int64)).tolist()
        for slot, (k, rank, made) in zip(slots, pairs, strict=True):
            while self.pair_key[slot] >= 0:
                slot = (slot + 1) & (n - 1)
            self.pair_key[slot], self.pair_rank[slot], self.pair_made[slot] = k, rank, made
        # characters that stand side by side in some piece
        inner = sorted({ord(c) for p in own if len(p) > 1 for c in p})
        self.group = np.zeros(0x110000, np.int32)
        self.group[inner] = np.arange(1, len(inner) + 1)
        self.groups = len(inner) + 1
        self.joined = np.zeros(self.groups * self.groups, bool)
        for p in own:
            for a, b in pairwise(p):
                self.joined[self.group[ord(a)] * self.groups + self.group[ord(b)]] = True
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in self.raw])])
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(U) * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, made symbol) of pairs of symbols; NEVER where they make no piece."""
        key = left.astype(np.int64) * (self.other + 1) + right
        at = self._slots(key)
        found = self.pair_key[at]
        on = np.flatnonzero((found != key) & (found >= 0))
        while len(on):
            at[on] = (at[on] + 1) & (len(self.pair_key) - 1)
            found = self.pair_key[at[on]]
            on = on[(found != key[on]) & (found >= 0)]
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER), self.pair_made[at]


def model(path: str) -> Model:
    """The tables, made once per worker process."""
    kept = sys.modules.setdefault("reconlake_worker_cache", ModuleType("reconlake_worker_cache"))
    made = kept.__dict__.setdefault("pieces", {})
    if path not in made:
        made[path] = Model(path)
    return made[path]


def equal_words(chars: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of a word of each sort, each word's sort)."""
    up, down = words._powers(len(chars) + 1)
    total = np.zeros(len(chars) + 1, U)
    np.cumsum(words.mix(chars.astype(U) + U(1)) * up[:len(chars)], out=total[1:])
    key = words.mix((total[start + size] - total[start]) * down[start] + size.astype(U))
    return words.sorts(key, chars, start, size)


def merge_rounds(m: Model, symbol: np.ndarray, word: np.ndarray, place: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges until no pair is left; (symbol, word, place of its first character), by word."""
    done = []
    while len(symbol):
        rank = np.full(len(symbol), NEVER, np.int32)
        made = np.zeros(len(symbol), np.int32)
        rank[:-1], made[:-1] = m.pairs(symbol[:-1], symbol[1:])
        last = np.append(word[1:] != word[:-1], True)
        rank[last] = NEVER
        start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
        size = np.diff(np.append(start, len(symbol)))
        least = np.repeat(np.minimum.reduceat(rank, start), size)
        over = least == NEVER
        if over.any():
            done.append((symbol[over], word[over], place[over]))
            on = ~over
            symbol, word, place, rank, made, least, last = (
                a[on] for a in (symbol, word, place, rank, made, least, last))
            if not len(symbol):
                break
            start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
            size = np.diff(np.append(start, len(symbol)))
        # every other one of pairs that overlap, from the left
        hit = np.flatnonzero(rank == least)
        fresh = np.append(True, np.diff(hit) > 1)
        nth = np.arange(len(hit)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        take = hit[nth % 2 == 0]
        # what a merge makes with its neighbours: the left one may be merged already, the right one is not
        new, old = made[take], least[take]
        bad = np.zeros(len(take), bool)
        merged = symbol.copy()
        merged[take + 1] = new                       # seen from the right, a merged pair is its second place
        left = take > 0
        left[left] = word[take[left] - 1] == word[take[left]]
        bad[left] = m.pairs(merged[take[left] - 1], new[left])[0] <= old[left]
        right = take + 2 < len(symbol)
        right[right] = word[take[right] + 2] == word[take[right]]
        bad[right] |= m.pairs(new[right], symbol[take[right] + 2])[0] <= old[right]
        if bad.any():
            before = np.cumsum(bad) - bad
            own = word[take]
            first = np.append(True, own[1:] != own[:-1])
            take = take[before == before[np.flatnonzero(first)[np.cumsum(first) - 1]]]
        symbol[take] = made[take]
        keep = np.ones(len(symbol), bool)
        keep[take + 1] = False
        symbol, word, place = symbol[keep], word[keep], place[keep]
    if not done:
        return symbol, word, place
    symbol, word, place = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return symbol[order], word[order], place[order]


def merge_heap(m: Model, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One word's merges one by one, the best rank first and then the leftmost; (symbol, place)."""
    own, n = symbol.tolist(), len(symbol)
    after, before, version = list(range(1, n + 1)), list(range(-1, n - 1)), [0] * n
    table: dict[tuple[int, int], tuple[int, int]] = {}

    def pair(i: int, j: int) -> tuple[int, int]:
        key = own[i], own[j]
        if key not in table:
            rank, made = m.pairs(np.array(key[:1]), np.array(key[1:]))
            table[key] = int(rank[0]), int(made[0])
        return table[key]

    rank, made = m.pairs(symbol[:-1], symbol[1:])
    heap = [(r, i, i + 1, 0, 0, x) for i, (r, x) in enumerate(zip(rank.tolist(), made.tolist(), strict=True)) if r != NEVER]
    heapq.heapify(heap)
    while heap:
        _, i, j, vi, vj, x = heapq.heappop(heap)
        if version[i] != vi or version[j] != vj:
            continue
        own[i] = x
        version[i] += 1
        version[j] = -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (found := pair(a, b))[0] != NEVER:
                heapq.heappush(heap, (found[0], a, b, version[a], version[b], found[1]))
    left = [i for i in range(n) if version[i] >= 0]
    return np.array([own[i] for i in left], np.int32), np.array(left, np.int64)


def _as_ids(m: Model, symbol: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per symbol): symbols without a piece become their character's bytes."""
    plain = symbol < m.size
    size = np.where(plain, 1, 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000))
    ids = np.repeat(symbol, size)
    if not plain.all():
        at = np.flatnonzero(np.repeat(~plain, size))
        raw = "".join(map(chr, char[~plain].tolist())).encode()
        ids[at] = m.bytes_id[np.frombuffer(raw, np.uint8)]
    return ids, size


def encode(m: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts without begin and end, offsets of each text's ids)."""
    n_chars = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    chars = np.frombuffer("".join([" " + t for t in texts if t]).encode("utf-32-le"), np.uint32).astype(np.int32)
    text_at = np.concatenate([[0], np.cumsum(n_chars)])
    if not len(chars):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    chars = np.where(chars == 32, np.int32(SPACE), chars)
    group = m.group[chars]
    cut = np.append(True, ~m.joined[group[:-1] * m.groups + group[1:]])
    cut[text_at[:-1][n_chars > 0]] = True
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, len(chars)))
    first, sort = equal_words(chars, start, size)

    begin, length = start[first], size[first]
    short = np.flatnonzero(length <= LONG)
    at = words.flat_range(begin[short], length[short])
    symbol, word, place = merge_rounds(m, m.symbol_of[chars[at]], np.repeat(short, length[short]), at)
    parts = [(symbol, word, place)]
    for w in np.flatnonzero(length > LONG).tolist():
        own, off = merge_heap(m, m.symbol_of[chars[begin[w]:begin[w] + length[w]]])
        parts.append((own, np.full(len(own), w), off + begin[w]))
    if len(parts) > 1:
        symbol, word, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        symbol, word, place = symbol[order], word[order], place[order]
    ids, per_symbol = _as_ids(m, symbol, chars[place])
    per_word = np.bincount(word, per_symbol, len(first)).astype(np.int64)
    word_at = np.cumsum(per_word) - per_word
    n_ids = per_word[sort]
    ends = np.concatenate([[0], np.cumsum(n_ids)])
    return ids[words.flat_range(word_at[sort], n_ids)], ends[np.searchsorted(start, text_at)]


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def raw_bytes(m: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all pieces, offsets of each piece's bytes)."""
    size = np.diff(m.raw_at)[ids]
    return m.raw_flat[words.flat_range(m.raw_at[:-1][ids], size)], np.concatenate([[0], np.cumsum(size)])


def decode(m: Model, ids: np.ndarray, raw: bytes | None = None) -> str:
    """The text of ids; control pieces are nothing, and one space in front is taken off.
    Bytes that are no UTF-8 become U+FFFD each."""
    if raw is None:
        raw = raw_bytes(m, ids)[0].tobytes()
    codecs.register_error("reconlake_each_byte", _each_byte)
    shown = np.flatnonzero(~m.control[ids])
    if len(shown) < len(ids):                    # bytes on both sides of a control piece make no character
        parts = np.split(raw_bytes(m, ids)[0], raw_bytes(m, ids)[1][np.flatnonzero(m.control[ids])])
        text = "".join([p.tobytes().decode(errors="reconlake_each_byte") for p in parts])
    else:
        text = raw.decode(errors="reconlake_each_byte")
    return text[1:] if len(shown) and m.marked[ids[shown[0]]] else text


def _coder(path: str, column: int, full: bool, names: list[str]) -> Callable:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (m.begin, m.end))
        for batch in batches:
            _, ends = words.text_buffer(batch.column(column))
            for lo, hi in words.slices(ends, SLICE):
                part = batch.slice(lo, hi - lo)
                ids, at = encode(m, [t or "" for t in part.column(column).to_pylist()])
                raw, raw_at = raw_bytes(m, ids)
                spans = list(pairwise(at.tolist()))
                texts = [decode(m, ids[a:b], raw[raw_at[a]:raw_at[b]].tobytes()) for a, b in spans]
                if full:
                    made = [pa.array([np.concatenate([[m.begin], ids[a:b], [m.end]]).astype(np.int32) for a, b in spans],
                                     pa.list_(pa.int32())), pa.array(texts, pa.string())]
                else:
                    own = ids.astype("<u4")
                    made = [pa.array([b - a + 2 for a, b in spans], pa.int64()),
                            pa.array([hashlib.sha256(begin + own[a:b].tobytes() + end).hexdigest() for a, b in spans]),
                            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())]
                yield pa.record_batch([*part.columns, *made], names)
    return code


def _apply(docs: DataFrame, path: str, full: bool, added: list[T.StructField]) -> DataFrame:
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*base.schema.fields, *added])
    return base.mapInArrow(_coder(path, 1, full, schema.names), schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text, ids (with begin and end), decoded per row of ``docs``."""
    return _apply(docs, path, True, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                     T.StructField("decoded", T.StringType())])


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of ``docs``."""
    return _apply(docs, path, False, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                      T.StructField("decoded_sha256", T.StringType())]).drop("text")
