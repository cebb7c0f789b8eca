import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from reconlake.llm import op13_pieces
from reconlake.llm.queries import op13_piece_rounds
from tests.llm.helpers import DOC, sha

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  ", "   ", " ", "=", "==", "-----", "a", "the", "ing", "\n", "\t", "\0", "é", "é", "漢", "字", "😀", "▁",
       "ا", "12", "don't", "<s>", "</s>", "<0x41>", " " * 37, " ", "\x85", "Ω"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return op13_pieces.model(PATH)


def check(model, library, texts):
    ids, at = op13_pieces.encode(model, texts)
    for i, want in enumerate(library.encode(texts, num_threads=1)):
        assert ids[at[i]:at[i + 1]].tolist() == want, texts[i][:300]
        assert op13_pieces.decode(model, ids[at[i]:at[i + 1]]) == library.decode(want)


def digests(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids))


def test_fixture(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in op13_piece_rounds(spark, SMALL).collect()]
    assert sorted(got) == sorted((r.doc_id, *digests(library, r.text)) for r in rows)


@pytest.mark.parametrize("long", [2, 40, 512])
def test_odd_texts(model, library, monkeypatch, long):
    """Words longer than ``long`` are merged with the heap, the others in rounds."""
    monkeypatch.setattr(op13_pieces, "LONG", long)
    rng = random.Random(long)
    for _ in range(20):
        check(model, library, ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(40)])


def test_pieces_in_any_order(model, library):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    for _ in range(10):
        check(model, library, ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(100)])
        check(model, library, ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(0, 600))) for _ in range(20)])


def test_equal_ranks_and_long_runs(model, library):
    """Pieces of spaces all have the same score: they can't be merged at once."""
    check(model, library, [" " * k for k in range(0, 1200, 7)] + ["=" * k for k in range(500, 600)] + ["ab" * 700 + " " * 600 + "c"])


def test_words_with_equal_hashes_stay_apart(model, library, monkeypatch):
    monkeypatch.setattr(op13_pieces.words, "mix", lambda x: x & np.uint64(3))
    check(model, library, ["some words that share a hash and some that do not", "other words"])


def test_decoding_any_ids(model, library):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 32000), rng.randrange(3, 259), rng.randrange(259, 275), 1, 2])
               for _ in range(rng.randint(0, 12))]
        assert op13_pieces.decode(model, np.array(ids, np.int64)) == library.decode(ids), ids


def test_time_grows_with_the_text(model):
    """One word, a run of spaces and dense text, each doubled."""
    from time import process_time
    for unit in ("abcdefgh", " ", "漢=a "):
        spent = []
        for n in (200_000, 400_000):
            text = (unit * n)[:n]
            start = process_time()
            op13_pieces.encode(model, [text])
            spent.append(process_time() - start)
        assert spent[1] < 3.5 * spent[0] + 0.3, (unit, spent)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        op13_pieces.Model(str(path))


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (2, "  \n"), (None, "no id"), (3, "x" * 100_000), (4, "one two " * 50_000), (4, "one two"),
            (4, "one two"), (5, "<s> a</s>b▁c")]
    df = spark.createDataFrame([(*r, "z", [1]) for r in rows], DOC + ", n_tokens string, ids array<int>")
    got = op13_pieces.encoding_digests(df, PATH).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((d, *digests(library, t))) for d, t in rows)
    for r in op13_pieces.encoded(df, PATH).collect():
        assert list(r.ids) == library.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.decoded == library.decode(list(r.ids))
    assert op13_pieces.encoding_digests(df.limit(0), PATH).count() == 0
