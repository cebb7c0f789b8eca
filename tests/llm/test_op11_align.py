import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reconlake.llm import op11_align, op13_pieces
from reconlake.llm.queries import op11_aligned_tokens
from tests.llm.helpers import DOC, sha

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """The contract, text by text and link by link."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in plain]
        self.byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}

    def tokens(self, text):
        raw = (" " + text).encode()
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        same = b"".join(r for _, r in a) == raw == b"".join(r for _, r in b)
        return (a, b) if same else ([], [])

    def groups(self, text):
        if not text:
            return []
        a, b = self.tokens(text)
        out, x, y = [([], [])], 0, 0
        while a or b:
            side = 0 if a and (not b or x + len(a[0][1]) <= y + len(b[0][1])) else 1
            i, raw = (a, b)[side].pop(0)
            out[-1][side].append(i)
            x, y = (x + len(raw), y) if side == 0 else (x, y + len(raw))
            if x == y:
                out.append(([], []))
        return out[:-1]

    def alignment(self, rows):
        groups = [self.groups(t) for _, t in rows]
        links = [Counter((a, b) for g in own for a in g[0] for b in g[1]) for own in groups]
        count = Counter(p for own in links for p in own)
        most = defaultdict(int)
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        out = []
        for (d, _), own, pairs in zip(rows, groups, links, strict=True):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
            out.append((d, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(pairs.values()),
                        sum(n for p, n in pairs.items() if count[p] == most[p[0]]),
                        sum(n * count[p] for p, n in pairs.items()), sha(text) if text else ""))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def aligned(df):
    return sorted([tuple(r) for r in op11_align.alignment(df, A, B).collect()], key=str)


def test_fixture(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = op11_aligned_tokens(spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == plain.alignment(rows)


def test_odd_rows(spark, plain):
    long = "漢字😀é " * 300 + "0123456789" * 40 + "abcdefgh" * 50 + " " * 70 + "=" * 100
    rows = [(1, None), (2, ""), (2, " "), (None, "no id"), (3, long), (3, long), (4, "a ▁ b"), (5, "▁"), (6, "<|endoftext|> </s><s>"),
            (7, "don't  \n\n x  y \x85\0"), (8, "x" * 3000)]
    df = spark.createDataFrame([(*r, "z", [1]) for r in rows], DOC + ", pair string, row array<int>")
    assert aligned(df) == plain.alignment(rows)
    assert op11_align.alignment(df.limit(0), A, B).count() == 0


@pytest.mark.parametrize("run,fan_in,parts,expand", [(60, 2, 3, 5), (400, 3, 1, 50)])
def test_any_runs_give_the_same_counts(spark, plain, monkeypatch, run, fan_in, parts, expand):
    for name, value in (("RUN", run), ("FAN_IN", fan_in), ("PARTS", parts), ("EXPAND", expand), ("MAX_WORDS", 5)):
        monkeypatch.setattr(op11_align, name, value)
    rng = random.Random(run)
    words = ["the", "théâtre", "漢字", "1234567", "aaaaaaa", " ", "don't", "😀😀", "▁", "\n\n", "Wörter", "qzxkjv"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    assert aligned(spark.createDataFrame(rows, DOC)) == plain.alignment(rows)


def test_the_heap_merge_counts_pairs():
    rng = np.random.default_rng(1)
    runs, want = [], Counter()
    for _ in range(7):
        pair = np.unique(rng.integers(0, 500, 120))
        held = rng.integers(1, 9, len(pair))
        want.update(dict(zip(pair.tolist(), held.tolist(), strict=True)))
        runs.append(op11_align._packed(pair, held))
    pairs, held = op11_align._counted(runs)
    assert pairs == sorted(want) and held == [want[p] for p in pairs]


def test_words_are_encoded_as_whole_texts(plain):
    rng = random.Random(4)
    pieces = ["a", " ", "  ", "\n", "'s", " 'll", "don't", "12", "é", "漢", "　", " ", "\x85", "\x1c", ".", "...", "<|endoftext|>", "_"]
    tok = op11_align.ByteTokenizer(A)
    for _ in range(300):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        ids, at = tok.encode(texts)
        for i, t in enumerate(texts):
            want = plain.a.encode(" " + t, add_special_tokens=False).ids if t else []
            assert ids[at[i]:at[i + 1]].tolist() == want, t


def test_a_hot_pair_goes_on_once_per_block(spark):
    """A pair of every document is one row of its block, not one of each document."""
    df = spark.createDataFrame([(i, "the same words") for i in range(3000)], DOC).coalesce(1)
    batches = op11_align._spiller(A, B)
    rows = df.mapInArrow(batches, op11_align.SPILLED).where("pair is not null")
    assert rows.count() <= op11_align.PARTS
    assert {h for r in rows.collect() for h in r["held"]} == {3000}


def test_counts_and_maxima(spark):
    size = op13_pieces.model(B).size
    bits = op11_align._bits(size)
    held = spark.createDataFrame([(0, (7 << bits) + 1, 3), (1, (7 << bits) + 1, 2), (0, (7 << bits) + 2, 5), (0, (8 << bits) + 1, 1),
                                  (0, (7 << bits) + 3, 4)], "block long, pair long, held long")
    got = {(r.a, r.b): (r.total, r.best) for r in op11_align.pair_counts(held, size).collect()}
    assert got == {(7, 1): (5, 1), (7, 2): (5, 1), (7, 3): (4, 0), (8, 1): (1, 1)}
