import random

from reconlake.llm import op4_pii
from reconlake.llm.queries import op4_contextual_pii
from tests.llm.helpers import DOC, PII, base_spans, joined, sha

SMALL = "/root/testdata/sf0.001"


def check(rows, got):
    assert len(got) == len(rows)
    left = sorted(rows, key=repr)
    for r in got:
        fit = [(d, t) for d, t in left if d == r.doc_id and sha(joined(base_spans(t, PII))) == r.base_sha256]
        assert fit, r
        left.remove(fit[0])
        spans = base_spans(fit[0][1], PII)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k, *_ in PII]
        own = r.spans.split(",") if r.spans else []
        assert set(joined(spans).split(",") if spans else []) <= set(own)
    assert not left


def test_fixture(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, op4_contextual_pii(spark, SMALL).collect())


def test_odd_texts(spark):
    rng = random.Random(2)
    noise = ["".join(rng.choice("a1.@+ -(_%é") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts = [None, "", "a@b", "a@b.c_d@e.f", "x@y.z@w.v", "a.b%c+d@e-f.gh.", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.0.0.1",
             "1.2.3", "4111 1111-1111 1111", "4111111111111112", "+1 (974) 555-3436", "+1+12345678901", "++49 30 1234567",
             "ünïcode é a@b.cd 10.0.0.1", "1" * 30_000, "a" * 30_000, "1 " * 20_000, "@" * 5000, "." * 5000,
             "a@b.cc " * 3000, *noise, *noise[:20]]
    rows = [(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOC + ", base int")
    check(rows, op4_pii.digest(op4_pii.personal_data(df)).collect())


def test_bootstrapping_finds_unseen_identifiers(spark):
    """A pattern that precedes many base phones also precedes numbers that are no base phones."""
    rng = random.Random(1)
    rows = [(i, f"word{'x' * (i % 3)} call me: +49 30 {rng.randint(1000000, 9999999)} thanks") for i in range(30)]
    rows += [(100, "you can call me: 030/12345-99 soon"), (101, "we counted 030/12345-98 birds")]
    # a second round: 'ring:' has few base phones, but the number found above
    got = {r.doc_id: r for r in op4_pii.digest(op4_pii.personal_data(spark.createDataFrame(rows, DOC))).collect()}
    text = rows[30][1]
    start = text.index("030")
    assert got[100].spans == f"phone:{start}:{start + len('030/12345-99')}"
    assert got[100].n_phone == 0 and got[100].base_sha256 == sha("")
    assert got[101].spans == ""


def test_rounds_spread_confidence(spark):
    seeds = [("p", f"i{n}", 3) for n in range(8)] + [("q", f"j{n}", 3) for n in range(4)]
    unseen = [("p", "new"), *[("q", "new")], ("q", "other")]
    args = (spark.createDataFrame(seeds, "pattern string, instance string, rank int"),
            spark.createDataFrame(unseen, "pattern string, instance string"))
    one = {r.pattern for r in op4_pii.trusted_patterns(*args, rounds=1, trust=0.65, support=4).collect()}
    three = {r.pattern for r in op4_pii.trusted_patterns(*args, rounds=3, trust=0.65, support=4).collect()}
    assert one == {"p"} and three == {"p", "q"}


def test_found_instances_induce_patterns(spark):
    """'s' precedes no seed: the instances that 'p' finds make it trusted, and it finds one more."""
    seeds = [("p", f"i{n}", 2) for n in range(20)]
    unseen = [(p, f"new{n}") for n in range(4) for p in ("p", "s")] + [("s", "last"), ("t", "new0"), ("t", "other")]
    args = (spark.createDataFrame(seeds, "pattern string, instance string, rank int"),
            spark.createDataFrame(unseen, "pattern string, instance string"))
    trusted = [{r.pattern for r in op4_pii.trusted_patterns(*args, rounds=n, trust=0.5, support=4).collect()} for n in (1, 2, 3)]
    assert trusted == [{"p"}, {"p", "s"}, {"p", "s"}]


def test_bootstrapping_in_texts(spark):
    """Phones follow 'call'; a code that follows 'call' in some texts follows 'desk' in others."""
    rng = random.Random(6)
    rows = [(i, f"please call +49 30 {rng.randint(1000000, 9999999)} now") for i in range(40)]
    codes = [f"030/{rng.randint(10000, 99999)}-{n}" for n in range(6)]
    rows += [(100 + n, f"please call {c} now") for n, c in enumerate(codes)]
    rows += [(200 + n, f"at the desk {c} today") for n, c in enumerate(codes)]
    rows += [(300, "at the desk 030/99999-77 today"), (301, "at the zoo 030/99999-78 today")]
    got = {r.doc_id: r.spans for r in op4_pii.digest(op4_pii.personal_data(
        spark.createDataFrame(rows, DOC), trust=0.6)).collect()}
    assert got[300].startswith("phone:") and got[200].startswith("phone:") and got[301] == ""


def test_empty_table(spark):
    assert op4_pii.digest(op4_pii.personal_data(spark.createDataFrame([], DOC))).count() == 0
