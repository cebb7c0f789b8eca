"""DOM leaf blocks of a web page, and the features that the field sees.

A block is the text between two block-level boundaries, with the tags and the
class, id and role words of its ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<(/?)([a-z][a-z0-9:-]*)([^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+)>"""
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*+)>"
    r"|<[!?][^>]*+>", re.S | re.I)
#: Elements without article text, up to their end tag. What an unclosed one of RAW holds is no markup to
#: a browser, so it runs to the end of the page; an unclosed one of the others is the tag only.
RAW = frozenset("script style noscript template title iframe".split())
SKIPPED = RAW | {"svg", "canvas", "annotation", "annotation-xml"}
_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in SKIPPED}
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/\Z""")
_NAMES = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img picture source br audio video track map "
                   "area label object math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup "
                   "munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd mstyle mpadded "
                   "mphantom menclose mfenced merror maction".split())
VOID = frozenset("br hr img input meta link area base col embed param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
KEEPS = frozenset("ul ol dl table body html article section main div".split())
TAGS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "ul", "ol", "dl", "table", "figure",
        "h1", "h2", "h3", "p", "blockquote", "pre", "button", "select", "dialog", "address", "menu", "fieldset",
        "details", "li", "td", "dd")
#: Words of class, id and role names, by what they speak for.
NAMES = {
    "advert": "ad ads advert advertisement adverts adsense sponsor sponsored promo promotion banner dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay toast paywall disclaimer warning",
    "letter": "newsletter subscribe subscription signup login signin register search form contact",
    "side": "sidebar side aside widget widgets rail related recommended trending popular more read also tags tag cloud",
    "share": "share sharing social follow facebook twitter",
    "comment": "comment comments reply replies respond disqus discussion reader readers feedback",
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs toc pagination pager skip toolbar topbar",
    "head": "header masthead top logo brand site branding",
    "foot": "footer foot copyright legal bottom colophon",
    "body": "content article post entry story main body text prose page",
}
_NAME_OF = {w: group for group, ws in NAMES.items() for w in ws.split()}
CUES = {
    "legal": re.compile(r"©|\(c\)|copyright|all rights reserved|terms of|privacy", re.I),
    "act": re.compile(r"\b(?:cookies?|subscribe|sign (?:up|in)|log ?in|newsletter|advertisement|sponsored|share this|"
                      r"follow us|read more|click here|accept|leave a (?:reply|comment)|comments?|repl(?:y|ies))\b", re.I),
}


@dataclass
class Block:
    text: str
    context: tuple[str, ...]
    parent: int
    links: int


def _names(attributes: str) -> set[str]:
    found = set()
    for _, a, b, c in _NAMES.findall(attributes):
        for word in _WORDS.findall((a or b or c).lower()):
            if word in _NAME_OF:
                found.add("name:" + _NAME_OF[word])
    return found


class Reader:
    """Splits pages into blocks; contexts are kept between pages."""

    def __init__(self):
        self.contexts: dict[tuple, tuple[str, ...]] = {}

    def _context(self, outer: tuple[str, ...], tag: str, attributes: str) -> tuple[str, ...]:
        key = outer, tag, attributes
        if key not in self.contexts:
            if len(self.contexts) > 20_000:
                self.contexts.clear()
            own = {"in:" + tag} if tag in TAGS else set()
            self.contexts[key] = tuple(sorted({*outer, *own, *_names(attributes)}))
        return self.contexts[key]

    def blocks(self, page: str) -> list[Block]:
        out: list[Block] = []
        stack: list[tuple[str, tuple[str, ...], int]] = [("", (), 0)]
        text: list[str] = []
        state = {"link": 0, "links": 0, "n": 0}

        def flush() -> None:
            if text:
                words = html.unescape("".join(text)).split()
                if words:
                    out.append(Block(" ".join(words), stack[-1][1], stack[-1][2], state["links"]))
                text.clear()
            state["links"] = 0

        def add(piece: str) -> None:
            text.append(piece)
            if state["link"]:
                state["links"] += len(piece)

        at, unclosed = 0, set()
        while m := _TOKEN.search(page, at):
            if m.start() > at:
                add(page[at:m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
            if tag in SKIPPED and not closing and (not attributes or attributes[0] in " \t\r\n\f/"):
                text.append(" ")
                if not _SELF_CLOSED.search(attributes) and tag not in unclosed:
                    end = _END[tag].search(page, at)
                    if end:
                        at = end.end()
                    elif tag in RAW:
                        at = len(page)
                    else:
                        unclosed.add(tag)
                continue
            if tag in INLINE:
                if tag == "a":
                    state["link"] = 0 if closing else 1
                elif tag == "br":
                    text.append(" ")
                continue
            flush()
            state["link"] = 0
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                continue
            if tag in VOID:
                continue
            if stack[-1][0] == "p":                     # a block ends an open paragraph
                stack.pop()
            if tag in CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in CLOSES[tag]:
                        del stack[i:]
                        break
                    if stack[i][0] in KEEPS:
                        break
            state["n"] += 1
            stack.append((tag, self._context(stack[-1][1], tag, attributes if "=" in attributes else ""),
                          stack[-1][2] if tag in ("p", "li") else state["n"]))
        if at < len(page):
            add(page[at:])
        flush()
        return out


def features(blocks: list[Block]) -> list[list[str]]:
    """The active features of each block of one page."""
    out, seen_title = [], False
    for i, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        own = ["bias", *b.context,
               f"words:{min(6, words.bit_length())}",
               f"links:{min(3, int(4 * b.links / max(n, 1)))}",
               "ends" if b.text[-1] in ".!?:\"'”»…)" else "open",
               f"third:{3 * i // len(blocks)}"]
        if not any(f in b.context for f in ("in:article", "in:main", "name:body")):
            own.append("outside")
        if not b.context:
            own.append("bare")
        for cue, pattern in CUES.items():
            if pattern.search(b.text):
                own.append("cue:" + cue)
                if words < 20:
                    own.append("short cue:" + cue)
        if seen_title:
            own.append("after h1")
        if i and b.parent == blocks[i - 1].parent:
            own.append("same parent")
        if "in:h1" in b.context:
            seen_title = True
        out.append(own)
    return out
