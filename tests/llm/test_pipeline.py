import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reconlake.llm.store import written
from tests.llm.helpers import SECRETS, base_spans, near_components, sha

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and output on the fixture, with odd rows and an extra column added."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("kept", F.lit("extra"))
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(120)) + ".\nEnd."
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, text), (10**6 + 3, text + " more"), (10**6 + 4, text + " token = abcdef123"),
           (10**6 + 5, text[300:] + item), (None, text), (10**6 + 6, "Some fine words here. " + "AKIA" + "A1" * 10 + " and after it.")]
    more = spark.createDataFrame([(d, t, "en", "odd", len(t or ""), "kept") for d, t in odd],
                                 "doc_id long, text string, lang string, source string, n_chars long, kept string")
    out = [docs.unionByName(more)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(spark, f"test-{name}", stage(spark, out[-1], SMALL)))
    return [(o.columns, o.collect()) for o in out]


def key(rows):
    return sorted(str(tuple(r)) for r in rows)


def test_stages_keep_columns_and_whole_rows(steps):
    for (columns, rows), (after, kept) in zip(steps[:3], steps[1:4], strict=True):
        assert after == columns
        assert set(key(kept)) <= set(key(rows))


def test_quality_keeps_clean_documents(spark, steps):
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in steps[1][1]}
    assert len(kept & good) >= 0.97 * len(good & {r.doc_id for r in steps[0][1]})
    assert len(kept) < len(steps[0][1])


def one_of_each(rows):
    """(doc_id, text) of the rows that stay: of each component the least doc_id, nulls last."""
    groups = {}
    for (i, _, c, _), r in zip(sorted(near_components(list(enumerate(r.text for r in rows)), 80)), rows, strict=True):
        groups.setdefault(c, []).append((r.doc_id is None, r.doc_id or 0, i))
    return [rows[min(g)[2]] for g in groups.values()]


def test_near_duplicates(steps):
    rows = steps[1][1]
    got, want = steps[2][1], one_of_each(rows)
    assert set(key(got)) <= set(key(rows)) and sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in want)


def test_near_duplicates_row_by_row(spark):
    """Repeated and missing ids: no unique row goes, and one row of each text stays."""
    t, u, k = ("".join(f"{w}{i} " for i in range(40)) for w in "tuk")
    rows = [(1, t), (2, t), (2, u), (3, k), (3, k), (None, t), (None, t), (None, "alone"), (None, None), (None, None), (4, ""), (4, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert got.columns == docs.columns
    assert key((r.doc_id, r.text) for r in got.collect()) == key(
        [(1, t), (2, u), (3, k), (None, "alone"), (None, None), (None, None), (4, ""), (4, "")])


def test_near_duplicates_from_four_fifths_on(spark):
    """Six words of 104 replaced: 90 of 110 shingles are shared, 82 percent."""
    text = [f"w{i}" for i in range(104)]
    near = " ".join([*text[:52], *[f"x{i}" for i in range(6)], *text[58:]])
    docs = spark.createDataFrame([(1, " ".join(text)), (2, near)], "doc_id long, text string")
    shared = len({*range(100)} - {*range(48, 58)})
    assert 80 * (200 - shared) <= 100 * shared < 85 * (200 - shared)
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()] == [1]


def test_decontamination(spark, steps):
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    gone = set(key(steps[2][1])) - set(key(steps[3][1]))
    for r in steps[2][1]:
        if any(i in " ".join((r.text or "").split()) for i in items):
            assert str(tuple(r)) in gone


def test_secrets_are_redacted(steps):
    def brute(text):
        out, at = [], 0
        for start, _, end, _ in base_spans(text, SECRETS):
            if start >= at:
                out += [text[at:start], "[REDACTED]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    want = [tuple(r) if not base_spans(r.text, SECRETS) else
            (r.doc_id, brute(r.text), r.lang, r.source, len(brute(r.text)), r.kept) for r in steps[3][1]]
    assert key(steps[4][1]) == key(want)
    assert any("[REDACTED]" in (r.text or "") for r in steps[4][1])


def test_tokens(steps):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for r in steps[4][1]:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), len(ids), sha(t.decode(ids, skip_special_tokens=False))))
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in steps[5][1]) == sorted(want)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_stages_name_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None and re.match(r"The corpus pipeline", corpus_pipeline.__doc__)
