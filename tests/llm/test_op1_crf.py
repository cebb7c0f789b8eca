import html
import random
import re

import pytest

from reconlake.llm import op1_crf, op1_dom, op1_labelled
from reconlake.llm.queries import op1_html_crf

SMALL = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def field():
    return op1_crf.fit(op1_crf.training_pages(250))


def test_fixture_pages_give_the_article(spark):
    """Brute force knows this layout: the blocks between <article> and </article>."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in op1_html_crf(spark, SMALL).collect():
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_unseen_layouts(field):
    rng, reader, right, total = random.Random(99), op1_dom.Reader(), 0, 0
    for _ in range(150):
        page, labels = op1_labelled.labelled_page(rng)
        blocks = reader.blocks(page)
        assert len(blocks) == len(labels)
        got = field.decode(field.emissions(op1_dom.features(blocks)))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.95


def test_viterbi_is_the_best_labelling(field):
    from itertools import product
    import numpy as np
    scores = np.random.default_rng(1).normal(size=(6, 2)) * 2

    def value(y):
        v = field.first[y[0]] + field.last[y[-1]] + sum(scores[i, a] for i, a in enumerate(y))
        return v + sum(field.step[a, b] for a, b in zip(y, y[1:], strict=False))
    assert tuple(field.decode(scores)) == max(product((0, 1), repeat=6), key=value)


def test_odd_pages(spark, field):
    body = "<p>One &amp; two&nbsp;&#233; three\n  four.</p>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no markup at all, just a sentence."),
            (4, "u", f"<nav><a href=x>Home</a></nav><article><h1>T</h1>{body}<p>open <b>bold<p>next.<br></article>"
                     "<div class='comments'><p>Nice post!</p></div><footer>&copy; x</footer>"),
            (4, "u", "<article><p>same id</p></article>"), (None, "u", "<article><p>no id</p></article>"),
            (5, "u", "<script>if (a < b) document.write('<p>x</p>')"), (6, "u", "<article><p>a < b & c > d</article"),
            (7, "u", "<article>" + "<p>word word word.</p>" * 5000 + "</article>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], PAGE + ", text string")       # a clashing name
    got = {(r.page_id, r.text): r for r in op1_crf.main_text(df, field).collect()}
    assert len(got) == len(rows)
    texts = {}
    for (i, t) in got:
        texts.setdefault(i, []).append(t)
    assert texts[1] == [""] and texts[2] == [""] and texts[5] == [""]
    assert "T\n\nOne & two é three four.\n\nopen bold\n\nnext." in texts[4]
    assert sorted(texts[4])[-1] == "same id" and texts[None] == ["no id"]
    assert len(texts[7][0].split("\n\n")) == 5000
    assert op1_crf.main_text(df.limit(0), field).count() == 0


@pytest.mark.parametrize("odd", [
    "<svg-icon name=x></svg-icon>", "<title-bar></title-bar>", "<template-x/>", "<object-view>", "<svg class='i'/>", "<svg/>",
    "<math/>", "<object data=x>", "<svg viewBox='0 0 1 1'>", "<canvas>", "<script src='x' />", "<title_x>"])
def test_odd_tags_drop_no_text(odd):
    blocks = op1_dom.Reader().blocks(f"<article><p>One.</p>{odd}<p>Two.</p></article>")
    assert [b.text for b in blocks] == ["One.", "Two."]


def test_formulas_and_fallbacks_are_text():
    page = ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>x=2</annotation></math> hold.</p>"
            "<object data=f><p>Fallback.</p></object><svg><text>no</text></svg><script src=/a/>no</script><p>End.</p>")
    assert [b.text for b in op1_dom.Reader().blocks(page)] == ["Let x=2 hold.", "Fallback.", "End."]


def test_cues_in_the_middle_of_a_long_block():
    block = op1_dom.Block("word " * 60 + "we use cookies, all rights reserved " + "word " * 60 + "end.", (), 0, 0)
    assert {"cue:act", "cue:legal"} <= set(op1_dom.features([block])[0])
