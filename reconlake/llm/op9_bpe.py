"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts each text into chunks, at places that depend on
the nearby bytes only, so copies and shared passages give equal chunks. A chunk is
encoded once per task, however many documents hold it, and kept while it is in use
(bounded cache). Chunks are cut anywhere, also inside words, so their joins are
repaired: the window around a join is re-encoded, and grown to both sides until it
starts and ends where the encodings of both chunks agree with it. For a tokenizer
whose pre-tokens never cross white space, that is reached at white space at the
latest, and what lies beyond it is kept from the chunks. So ids are exactly those
of encoding the whole text. A tokenizer of which this isn't known encodes whole texts,
without reuse. Inside new chunks, words and their pre-tokens are
encoded once per task in the same way.

Nulls, ties, odd rows: a null text is encoded as the empty text (no ids, empty
decoded text). Rows are independent of each other. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reconlake.llm import words

U = np.uint64
WINDOW, MASK_BITS = 32, 10         # bytes under the rolling hash; a chunk has 2**10 bytes on average
MAX_PIECES, MAX_CHUNK_BYTES = 200_000, 16 << 20

# How the word tokenizer splits, and the end of a word's last token.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Characters of which the same is known here: ASCII but quotes (contractions) and
# < (special tokens), and the letters of Latin-1. All other words are left to the tokenizer.
PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
PRETOKEN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def cuts(raw: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one buffer: where the hash of the last bytes ends in zeros,
    never inside a character. The end of the buffer is not among them."""
    out = []
    for lo in range(0, len(raw), words.PIECE):
        a = max(0, lo - WINDOW)
        part = raw[a:lo + words.PIECE]
        if len(part) <= WINDOW:
            continue
        up, down = words._powers(len(part))
        total = np.concatenate([[U(0)], np.cumsum(words._BYTE[part] * up[:len(part)])])
        rolling = words.mix((total[WINDOW:] - total[:-WINDOW]) * down[:len(total) - WINDOW])
        end = np.flatnonzero(rolling & U((1 << MASK_BITS) - 1) == 0) + WINDOW + a
        out.append(end[end > lo])
    end = np.concatenate(out) if out else np.zeros(0, np.int64)
    end = end[end < len(raw)]
    return end[(raw[end] & 0xC0) != 0x80]


@dataclass(frozen=True)
class _Loaded:
    tokenizer: object
    token: list[str]               # by id
    ends: np.ndarray | None        # by id: the token ends a pre-token; None if words can't be split here


def _splits_known(config: dict) -> bool:
    """The tokenizer normalizes and splits as PLAIN and PRETOKEN assume."""
    normal, before = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    return ([n.get("type") for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [b.get("type") for b in before.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and before["pretokenizers"][0]["pattern"] == {"Regex": SPLIT}
            and config["model"].get("end_of_word_suffix") == WORD_END)


def _tokenizer(path: str) -> _Loaded:
    """The tokenizer, loaded once per worker process; Spark's tasks are the only parallelism."""
    kept = sys.modules.setdefault("reconlake_worker_cache", ModuleType("reconlake_worker_cache"))
    loaded = kept.__dict__.setdefault("tokenizers", {})
    if path not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        token = [t.id_to_token(i) for i in range(max(t.get_vocab().values()) + 1)]
        known = _splits_known(json.loads(t.to_str()))
        loaded[path] = _Loaded(t, token, np.array([x.endswith(WORD_END) for x in token]) if known else None)
    return loaded[path]


class Codec:
    """Encodes texts by chunks; ``chunks`` and ``hits`` count the reuse."""

    def __init__(self, path: str):
        self.loaded = _tokenizer(path)
        self.pieces: dict[str, tuple[bytes, str]] = {}          # words
        self.parts: dict[str, tuple[bytes, str]] = {}           # pre-tokens of plain words
        self.cache: OrderedDict[bytes, tuple] = OrderedDict()
        self.cached = self.chunks = self.hits = 0

    def _learn(self, wanted: set[str]) -> None:
        """Encodes the words that are not known yet. A word of plain characters is put
        together from its pre-tokens, which many words share."""
        new = [w for w in wanted if w not in self.pieces]
        if len(self.pieces) + len(new) > MAX_PIECES:
            self.pieces.clear()
            self.parts.clear()
            new = list(wanted)
        split = {w: PRETOKEN.findall(w.lower()) for w in new if PLAIN.fullmatch(w)} if self.loaded.ends is not None else {}
        self._learn_parts([p for p in {p for ps in split.values() for p in ps} if p not in self.parts])
        for w, ps in split.items():
            if len(ps) == 1:
                self.pieces[w] = self.parts[ps[0]]
            else:
                got = [self.parts[p] for p in ps]
                self.pieces[w] = b"".join([g[0] for g in got]), " ".join([g[1] for g in got])
        for w, e in self._each([w for w in new if w not in split]):
            self.pieces[w] = e

    def _learn_parts(self, parts: list[str]) -> None:
        """Many pre-tokens in one call; each one's last token tells where it ends."""
        rows = self.loaded.tokenizer.encode_batch_fast(
            [" ".join(parts[i:i + 50]) for i in range(0, len(parts), 50)], add_special_tokens=False)
        ids = np.array([i for r in rows for i in r.ids], np.int64)
        cut = (np.flatnonzero(self.loaded.ends[ids]) + 1).tolist()
        if len(cut) != len(parts):
            self.parts.update(self._each(parts))
            return
        packed, names, at = ids.astype("<u4").tobytes(), [self.loaded.token[i] for i in ids.tolist()], 0
        for p, end in zip(parts, cut, strict=True):
            self.parts[p] = packed[4 * at:4 * end], " ".join(names[at:end])
            at = end

    def _each(self, parts: list[str]) -> Iterator[tuple[str, tuple[bytes, str]]]:
        for w, e in zip(parts, self.loaded.tokenizer.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            ids = e.ids
            yield w, (np.array(ids, "<u4").tobytes(), " ".join([self.loaded.token[i] for i in ids]))

    def _joined(self, parts: list[str]) -> tuple[bytes, str]:
        got = [self.pieces[w] for w in parts]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])

    def _split(self, raw: bytes) -> list:
        """[text before the first white space, words up to the last, text after it], or
        [the whole text, None, ""] if there is no white space in it."""
        # to this tokenizer, white space is white space
        flat = raw.decode().replace("\n", " ").replace("\t", " ").replace("\r", " ")
        first, last = flat.find(" "), flat.rfind(" ")
        if first < 0:
            return [flat, None, ""]
        return [flat[:first], [w for w in flat[first:last].split(" ") if w], flat[last + 1:]]

    def _whole(self, texts: list[bytes]) -> list[tuple[bytes, str]]:
        """Without chunks: for tokenizers of which it is not known that white space parts their tokens."""
        rows = self.loaded.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [(np.array(r.ids, "<u4").tobytes(), self.loaded.tokenizer.decode(r.ids, skip_special_tokens=False)) for r in rows]

    def encode(self, texts: list[tuple[bytes, list[int]]]) -> list[tuple[bytes, str]]:
        """(ids as little-endian words, decoded text) of each text, cut at the given places."""
        if self.loaded.ends is None:
            return self._whole([raw for raw, _ in texts])
        own: dict[bytes, list | tuple] = {}            # chunks of these texts
        keys, wanted = [], set()
        for raw, ends in texts:
            row, at = [], 0
            for end in [*ends, len(raw)]:
                chunk = raw[at:end]
                at = end
                key = hashlib.blake2b(chunk, digest_size=16).digest()
                self.chunks += 1
                if key in own:
                    self.hits += 1
                elif key in self.cache:
                    self.hits += 1
                    self.cache.move_to_end(key)
                    own[key] = self.cache[key]
                else:
                    own[key] = self._split(chunk)
                    wanted.update(own[key][1] or ())
                row.append(key)
            keys.append(row)
        # the window around a join grows from the end of one chunk into the next ones, up to white space
        rows = []
        for row in keys:
            out, window = [], ""
            for key in row:
                head, middle, tail = own[key]
                window += head
                if middle is not None:
                    out += [window, key]
                    window = tail
            out.append(window)
            wanted.update([w for w in out[::2] if w])
            rows.append(out)
        self._learn(wanted)
        for key, chunk in own.items():
            if isinstance(chunk, list):
                own[key] = made = (chunk[0], self._joined(chunk[1]) if chunk[1] is not None else None, chunk[2])
                self._keep(key, made)
        result = []
        for out in rows:
            # windows and what lies between them, in turns; both sides agree where a window ends
            parts = [(self.pieces[w] if w else NOTHING) if n % 2 == 0 else own[w][1] for n, w in enumerate(out)]
            result.append((b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[1]])))
        return result

    def _keep(self, key: bytes, made: tuple) -> None:
        size = 200 + len(made[0]) + len(made[2]) + (len(made[1][0]) + len(made[1][1]) if made[1] else 0)
        self.cache[key] = made
        self.cached += size
        while self.cached > MAX_CHUNK_BYTES and len(self.cache) > 1:
            _, old = self.cache.popitem(last=False)
            self.cached -= 200 + len(old[0]) + len(old[2]) + (len(old[1][0]) + len(old[1][1]) if old[1] else 0)


NOTHING = (b"", "")


def _coder(path: str, column: int, full: bool, names: list[str]) -> Callable:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            raw, ends = words.text_buffer(batch.column(column))
            for lo, hi in words.slices(ends, 1 << 20):
                own = [raw[ends[i]:ends[i + 1]] for i in range(lo, hi)]
                got = codec.encode([(o.tobytes(), cuts(o).tolist()) for o in own])
                part = batch.slice(lo, hi - lo)
                if full:
                    made = [pa.array([np.frombuffer(g[0], "<u4").astype(np.int32) for g in got], pa.list_(pa.int32())),
                            pa.array([g[1] for g in got], pa.string())]
                else:
                    made = [pa.array([len(g[0]) // 4 for g in got], pa.int64()),
                            pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string()),
                            pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got], pa.string())]
                yield pa.record_batch([*part.columns, *made], names)
    return code


def _apply(docs: DataFrame, path: str, full: bool, added: list[T.StructField]) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(_coder(path, docs.columns.index("text"), full, schema.names), schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text, ids, decoded per row of ``docs``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _apply(base, path, True, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                     T.StructField("decoded", T.StringType())])


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of ``docs``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _apply(base, path, False, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                      T.StructField("decoded_sha256", T.StringType())]).drop("text")
