"""Plain-Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

DOC = "doc_id long, text string"
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words_of(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def shingles_of(text: str | None) -> frozenset:
    w = words_of(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(rows: list[tuple], percent: int = 85) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of rows."""
    sets = [shingles_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for own in holders.values():
        for n, i in enumerate(own):
            for j in own[:n]:
                common[j, i] += 1
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            root[find(j)] = find(i)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = d if not sets[i] else min(ids[find(i)], default=None)
        out.append((d, len(sets[i]), c, c is None if d is None else d == c))
    return out


def repeats_removed(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) window by window."""
    first: dict[bytes, int] = {}
    for d, t in rows:
        raw = (t or "").encode()
        if d is not None:
            for i in range(len(raw) - 49):
                w = raw[i:i + 50]
                first[w] = min(d, first.get(w, d))
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        if d is not None:
            for i in range(len(raw) - 49):
                if first[raw[i:i + 50]] < d:
                    gone[i:i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, sha(bytes(c for c, g in zip(raw, gone, strict=True) if not g))))
    return out


def _digits(m) -> str:
    return re.sub("[^0-9]", "", m[0])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15),
]
SECRETS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def base_spans(text: str | None, kinds: list) -> list[tuple]:
    """(start, rank, end, kind), sorted."""
    return sorted((m.start(), i, m.end(), kind) for i, (kind, pattern, good) in enumerate(kinds)
                  for m in re.finditer(pattern, text or "") if good(m))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def by_id(rows) -> list[tuple]:
    """Rows as tuples, in one order; nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))
