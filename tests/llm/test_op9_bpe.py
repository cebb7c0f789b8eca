import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reconlake.llm import op9_bpe
from reconlake.llm.queries import op9_bpe_chunks
from tests.llm.helpers import DOC, sha

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(tokenizer.decode(ids, skip_special_tokens=False))


def check(tokenizer, rows, got):
    want = sorted((str(d), *whole(tokenizer, t)) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_fixture(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(tokenizer, rows, op9_bpe_chunks(spark, SMALL).collect())


@pytest.mark.parametrize("bits", [1, 4, 10])
def test_any_chunks_give_the_same_ids(tokenizer, monkeypatch, bits):
    """Chunks of a few bytes, cut inside words, special tokens and accents' sequences."""
    import numpy as np
    monkeypatch.setattr(op9_bpe, "MASK_BITS", bits)
    rng = random.Random(bits)
    pieces = ["<|endoftext|>", "<|start", "oftext|>", "don't", "I'LL ", "é", "é", "Σ", "ΑΣ ", "\x85", "\xa0", " ",
              "\x1c", " ", "\n\n", "\t", "12 ", "3.5", "漢字", "😀", "à́b", "word ", "The", "'", "s ", "\r\n", "\0"]
    codec = op9_bpe.Codec(PATH)
    for _ in range(150):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 120)))
        raw = text.encode()
        ids, decoded = codec.encode([(raw, op9_bpe.cuts(np.frombuffer(raw, np.uint8)).tolist())])[0]
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
        assert decoded == tokenizer.decode(want, skip_special_tokens=False)


def test_chunks_are_reused():
    import numpy as np
    rng = random.Random(1)
    shared = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(4000)).encode()
    codec = op9_bpe.Codec(PATH)
    for i in range(5):
        raw = f"start {i} ".encode() * (i + 1) + shared
        codec.encode([(raw, op9_bpe.cuts(np.frombuffer(raw, np.uint8)).tolist())])
    assert codec.hits > 0.7 * codec.chunks


def test_small_caches_change_nothing(tokenizer, monkeypatch):
    import numpy as np
    monkeypatch.setattr(op9_bpe, "MAX_PIECES", 3)
    monkeypatch.setattr(op9_bpe, "MAX_CHUNK_BYTES", 100)
    text = "some words that come and come again " * 400
    codec = op9_bpe.Codec(PATH)
    ids, _ = codec.encode([(text.encode(), op9_bpe.cuts(np.frombuffer(text.encode(), np.uint8)).tolist())])[0]
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_odd_rows(spark, tokenizer):
    rows = [(1, None), (2, ""), (2, "  \n"), (None, "no id"), (3, "x" * 100_000), (4, "one two " * 50_000), (4, "one two"),
            (4, "one two"), (5, "<|endoftext|> a<|startoftext|>b")]
    df = spark.createDataFrame([(*r, "z", [1]) for r in rows], DOC + ", n_tokens string, ids array<int>")
    check(tokenizer, rows, op9_bpe.encoding_digests(df, PATH).collect())
    full = op9_bpe.encoded(df, PATH).collect()
    assert len(full) == len(rows)
    for r in full:
        assert list(r.ids) == tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == tokenizer.decode(r.ids, skip_special_tokens=False)
    assert op9_bpe.encoding_digests(df.limit(0), PATH).count() == 0


def test_another_tokenizer_gives_the_library_ids(spark):
    other = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, None), (2, " two  words\n\nand don't "), (3, "<|endoftext|> é漢字 " * 200)]
    t = Tokenizer.from_file(other)
    for r in op9_bpe.encoded(spark.createDataFrame(rows, DOC), other).collect():
        want = t.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == t.decode(want, skip_special_tokens=False)
