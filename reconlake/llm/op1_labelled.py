"""Labelled pages for training: layouts drawn at random, whose blocks are known.

Words are drawn from letters, so nothing is learned of a language. Every layout
element is either part of the article (label 1) or not (label 0)."""

from __future__ import annotations

import random

AD = ["ad", "ads", "ad-slot", "advert", "advertisement", "sponsored", "promo-box", "banner"]
NOTICE = ["cookie-notice", "cookie-banner", "gdpr", "notice", "alert", "site-notice", "popup", "paywall"]
SIDE = ["sidebar", "widget", "related", "rail", "trending", "recommended"]
COMMENT = ["comments", "comment-list", "reader-comments", "discussion", "replies", "respond"]
BODY = ["content", "post-body", "entry-content", "story", "article-body", "main-text", "x1", "c-7", ""]


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.html, self.labels = rng, [], []

    def word(self) -> str:
        return "".join(self.rng.choice("etaoinshrdluéüñöà") for _ in range(self.rng.randint(1, 9)))

    def words(self, low: int, high: int, end: str = "") -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high))).capitalize() + end

    def tag(self, name: str, text: str, label: int, attributes: str = "", close: bool = True) -> None:
        self.html.append(f"<{name}{attributes}>{text}" + (f"</{name}>" if close else ""))
        self.labels.append(label)

    def sentence(self, low: int = 4, high: int = 60) -> str:
        text = ". ".join(self.words(2, 15) for _ in range(self.rng.randint(1, 4))) if high > 20 else self.words(low, high)
        return text + self.rng.choice([".", ".", ".", "!", "?", "", " ***", " |"])

    def links(self, wrap: str, item: str, label: int) -> None:
        self.html.append(f"<{wrap}>")
        for _ in range(self.rng.randint(2, 7)):
            self.tag(item, f'<a href="/{self.word()}">{self.words(1, 3)}</a>', label)
        self.html.append(f"</{wrap}>")


def _top(p: _Page) -> None:
    r = p.rng
    if r.random() < 0.5:
        name = r.choice(["header", 'div class="masthead"', 'div id="site-header"', 'div class="top header"'])
        p.html.append(f"<{name}>")
        p.tag(r.choice(["h1", "h2", "div", "p"]), p.words(1, 4), 0)
        if r.random() < 0.6:
            p.tag("p", p.words(3, 9), 0)
        p.html.append(f"</{name.split()[0]}>")
    if r.random() < 0.8:
        name = r.choice(["nav", "nav", 'div class="menu"', 'div id="navbar"', 'ul class="nav"'])
        p.html.append(f"<{name}>")
        p.links("ul", "li", 0)
        p.html.append(f"</{name.split()[0]}>")
    if r.random() < 0.2:
        p.tag("div", f'<a href="/">{p.word()}</a> / <a href="/x">{p.word()}</a>', 0, ' class="breadcrumbs"')


def _boxes(p: _Page, chance: float) -> None:
    """Adverts, notices, forms and sidebars, wherever they stand."""
    r = p.rng
    if r.random() < chance:
        p.tag(r.choice(["div", "div", "section", "aside"]), p.sentence(4, 25), 0, f' class="{r.choice(AD)}"')
    if r.random() < chance:
        p.html.append(f'<div class="{r.choice(NOTICE)}"' + r.choice(["", ' role="alert"']) + ">")
        p.tag("p", r.choice(["We use cookies. ", "Please read: ", ""]) + p.sentence(4, 18), 0)
        if r.random() < 0.5:
            p.tag("button", p.words(1, 2), 0)
        p.html.append("</div>")
    if r.random() < chance:
        p.html.append('<form action="/s"' + r.choice(["", ' class="newsletter"', ' id="search-form"']) + ">")
        p.tag(r.choice(["p", "div", "h3"]), r.choice(["Subscribe ", "Sign up ", ""]) + p.words(2, 12), 0)
        if r.random() < 0.5:
            p.tag("button", p.words(1, 2), 0)
        p.html.append("</form>")
    if r.random() < chance:
        name = r.choice(["aside", "aside", "div"])
        p.html.append(f'<{name} class="{r.choice(SIDE)}">' if name == "div" or r.random() < 0.5 else f"<{name}>")
        p.tag(r.choice(["h2", "h3", "h4"]), p.words(1, 4), 0)
        if r.random() < 0.6:
            p.links("ul", "li", 0)
        else:
            for _ in range(r.randint(1, 3)):
                p.tag("p", p.sentence(3, 30), 0)
        p.html.append(f"</{name}>")


def _comments(p: _Page) -> None:
    r = p.rng
    p.html.append(f'<{(name := r.choice(["section", "div", "div", "ol"]))} '
                  f'{r.choice(["class", "id"])}="{r.choice(COMMENT)}">')
    if r.random() < 0.5:
        p.tag("h3", r.choice(["Comments", "3 replies", p.words(1, 2)]), 0)
    for _ in range(r.randint(1, 5)):
        style = r.random()
        if style < 0.5:
            p.html.append('<div class="comment">' if r.random() < 0.6 else "<div>")
            p.tag("p", p.words(1, 2), 0)
            p.tag("p", p.sentence(), 0)
            p.html.append("</div>")
        else:
            p.tag(r.choice(["p", "li", "div"]), p.sentence(), 0)
    p.html.append(f"</{name}>")


def _article(p: _Page) -> None:
    r = p.rng
    close = r.random() < 0.7                            # paragraphs are often left open
    if r.random() < 0.85:
        inner = r.random() < 0.1
        p.html.append("<header>" * inner)
        p.tag("h1" if r.random() < 0.85 else "h2", p.sentence(1, 12), 1)
        p.html.append("</header>" * inner)
    for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4, 6, 9, 14])):
        kind = r.random()
        if kind < 0.06:
            p.tag(r.choice(["h2", "h3"]), p.words(1, 7), 1)
        elif kind < 0.1:
            p.html.append(f"<{(lst := r.choice(['ul', 'ol']))}>")
            for _ in range(r.randint(2, 5)):
                p.tag("li", p.sentence(2, 14), 1)
            p.html.append(f"</{lst}>")
        elif kind < 0.14:
            p.tag("blockquote", p.sentence(), 1)
        elif kind < 0.16:
            p.tag("pre", p.sentence(), 1)
        elif kind < 0.18:
            p.html.append("<table><tr>")
            for _ in range(r.randint(2, 4)):
                p.tag("td", p.words(1, 4), 1)
            p.html.append("</tr></table>")
        else:
            text = p.sentence(1, r.choice([3, 12, 60]))
            if r.random() < 0.15:
                text += f' <a href="/{p.word()}">{p.words(1, 4)}</a> {p.words(1, 6, ".")}'
            p.tag(r.choice(["p", "p", "p", "p", "div"]), ("<b>" if r.random() < 0.2 else "") + text, 1, close=close)
            if not close and p.html[-1].startswith("<div"):
                p.html.append("</div>")
        _boxes(p, 0.02)
    if not p.labels:
        p.tag("p", p.sentence(1, 4), 1)
    if r.random() < 0.08:
        _comments(p)


def _bottom(p: _Page) -> None:
    r = p.rng
    if r.random() < 0.85:
        name = r.choice(["footer", "footer", 'div class="footer"', 'div id="colophon"'])
        p.html.append(f"<{name}>")
        if r.random() < 0.4:
            p.links("ul", "li", 0)
        p.tag(r.choice(["p", "div", "small"]) if r.random() < 0.4 else "div",
              r.choice(["&copy; ", "&copy; ", "Copyright ", ""]) + p.sentence(3, 25), 0)
        p.html.append(f"</{name.split()[0]}>")


def labelled_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page and the label of each of its blocks, in page order."""
    p = _Page(rng)
    p.html.append('<!DOCTYPE html><html lang="x"><head><meta charset="utf-8"><title>' + p.words(1, 6)
                  + '</title><style>p{margin:0}</style></head><body><script>var t="</p>";</script>')
    bare = rng.random() < 0.15                          # nothing but the article
    if not bare and rng.random() < 0.9:
        _top(p)
        _boxes(p, 0.2)
    wrap = rng.random()
    if wrap < 0.55:
        name = "article"
    elif wrap < 0.65:
        name = "main"
    else:
        name = f'div {rng.choice(["class", "id"])}="{rng.choice(BODY)}"'
    outer = rng.choice(["", "", "<main>", '<div class="wrap">'])
    p.html.append(f"{outer}<{name}>")
    _article(p)
    p.html.append(f"</{name.split()[0]}>")
    if not bare and rng.random() < 0.25:
        _comments(p)
    p.html.append(f"</{outer[1:].split()[0].rstrip('>')}>" if outer else "")
    if not bare:
        _boxes(p, 0.15)
        _bottom(p)
    p.html.append("</body></html>")
    return "".join(p.html), p.labels
