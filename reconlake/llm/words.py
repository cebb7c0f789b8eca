"""Vectorised word hashing over Arrow text columns.

A batch's text column is read as one byte buffer plus offsets, so no Python
string is made per word. Word hashes are polynomial prefix sums modulo 2**64,
finished with a 64-bit mixer; memory is bounded by cutting the buffer into
pieces at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 20            # bytes hashed at once; a longer word extends its piece
_BASE = 0x9E3779B97F4A7C15 | 1

SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher, elementwise."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD1B54A32D192ED03))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below n."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            run = np.full(size, base, U)
            run[0] = 1
            _POWERS[name] = np.multiply.accumulate(run)
    return _POWERS["up"], _POWERS["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset:
        column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def _pieces(is_space: np.ndarray) -> Iterator[tuple[int, int]]:
    at, n = 0, len(is_space)
    while at < n:
        end = min(n, at + PIECE)
        while end < n and not is_space[end]:
            step = np.flatnonzero(is_space[end:end + PIECE])
            end = end + int(step[0]) if len(step) else min(n, end + PIECE)
        yield at, end
        at = end


def word_hashes(raw: np.ndarray, ends: np.ndarray, spaces: np.ndarray = SPACES,
                fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word, and the offsets of each text's words.

    Words are maximal runs of bytes that ``spaces`` does not mark; a word never
    crosses the end of a text. ``fold`` maps bytes before hashing."""
    is_space = spaces[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[ends] = True                       # a text's first byte starts a word
    hashes, starts, stops = [], [], []
    for lo, hi in _pieces(is_space):
        word = ~is_space[lo:hi]
        fresh = first[lo:hi].copy()
        fresh[1:] |= is_space[lo:hi - 1]
        fresh[0] = True
        s = np.flatnonzero(word & fresh)
        if not len(s):
            continue
        up, down = _powers(hi - lo)
        total = np.zeros(hi - lo + 1, U)
        np.cumsum(np.where(word, _BYTE[fold[raw[lo:hi]]], U(0)) * up[:hi - lo], out=total[1:])
        after = np.append(fresh[1:] | ~word[1:], True)     # the byte after this one is not of its word
        e = np.flatnonzero(word & after) + 1
        hashes.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(U)))
        starts.append(s + lo)
        stops.append(e + lo)
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    return (np.concatenate(hashes) if hashes else np.zeros(0, U), start,
            np.concatenate(stops) if stops else none, np.searchsorted(start, ends))


_STEP = mix(np.arange(1, 65, dtype=U) * U(0xA0761D6478BD642F)) | U(1)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for j in range(k):
        total += words[j:j + n] * _STEP[j]
    return mix(total)


def slices(ends: np.ndarray, limit: int = 4 * PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes (one text at least)."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, to
        at = to


def flat_range(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (size[0] of them), then from start[1] on, and so on."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def sorts(key: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of a word of each sort, each word's sort) of the words data[start:start + size].
    Equal words have equal keys; words of one key are compared, and those that differ
    from the sort's word are sorts of their own."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, sort = np.unique(key, return_index=True, return_inverse=True)
    like = first[sort]
    odd = size != size[like]
    short = np.minimum(size, size[like])
    differ = data[flat_range(start, short)] != data[flat_range(start[like], short)]
    if differ.any():
        odd |= np.add.reduceat(differ, np.cumsum(short) - short) > 0
    if odd.any():
        n = len(first)
        first = np.concatenate([first, np.flatnonzero(odd)])
        sort[odd] = n + np.arange(int(odd.sum()))
    return first, sort
