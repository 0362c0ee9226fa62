"""Leaf blocks of an HTML page: runs of text between block tags, with their ancestors.

A tolerant reader for pages as they are found: end tags may be missing, tags may
stand unclosed, scripts may hold tags in strings. Blocks keep page order.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

#: One token: a comment, a declaration, a tag. Text is what lies between.
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'>]+))?(?![\w-])""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Elements whose content is no text of the page, elements without content,
# inline elements (all others end a block), and what closes an open element of the same kind.
SILENT = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "svg",
                    "math", "object", "canvas", "video", "audio", "head", "select", "datalist"))
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"))
HEAD = frozenset(("title", "meta", "link", "base", "style", "script", "noscript", "template"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
                    "img", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
                    "sub", "sup", "time", "tt", "u", "var", "wbr"))
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
#: Elements that an implied end never passes.
WALLS = frozenset(("table", "ul", "ol", "dl", "div", "article", "section", "main", "body", "nav", "aside", "form"))


#: Ancestors that a block tells.
NEAR = 40


class Block(NamedTuple):
    """Text with single blanks, its innermost ``NEAR`` ancestors from outside in, characters inside links."""

    text: str
    path: tuple[str, ...]
    linked: int


def names(tag: str, rest: str) -> str:
    """A tag with the words of its class, id, role and the like, as one string."""
    found = [tag]
    if rest and not rest.isspace():
        for kind, value in _ATTRIBUTE.findall(rest):
            kind, value = kind.lower(), value.strip("\"'")
            if kind in ("hidden", "aria-hidden", "style"):
                low = value.lower().replace(" ", "")
                if kind == "hidden" or low == "true" or "display:none" in low or "visibility:hidden" in low:
                    found.append("hidden")
            else:
                found += [w.lower() for w in _WORDS.findall(html.unescape(value))]
    return " ".join(found)


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; none for a null or empty page.

    A start or end tag of a block element ends the block before it; ``br`` is a
    blank. Inline elements end with their block, apart from links around blocks.
    """
    reader = _Reader()
    page = page or ""
    at, match = 0, _MARKUP.search(page)
    while match:
        reader.say(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if tag and match[1]:
            reader.end(tag)
        elif tag:
            reader.start(tag, match[3])
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
        match = _MARKUP.search(page, at)
    reader.say(page[at:])
    reader.flush()
    return reader.found


class _Reader:
    """Open elements and the text of the block that is being read."""

    def __init__(self):
        self.found: list[Block] = []
        self.open: list[tuple[str, str]] = []  # tag and its names
        self.times: Counter[str] = Counter()  # open elements of each tag
        self.silent = 0  # open elements whose text is not shown
        self.held: list[str] = []
        self.linked: list[str] = []

    def say(self, raw: str) -> None:
        if raw and not self.silent:
            text = html.unescape(raw) if "&" in raw else raw
            self.held.append(text)
            if self.times["a"]:
                self.linked.append(text)

    def flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                inside = len(" ".join("".join(self.linked).split()))
                self.found.append(Block(text, tuple(n for _, n in self.open[-NEAR:]), min(inside, len(text))))
            self.held, self.linked = [], []

    def start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.say(" ")
        elif tag not in INLINE:
            self.flush()
            while self.open and self.open[-1][0] in INLINE and self.open[-1][0] != "a":
                self.close(len(self.open) - 1)
            self.imply(tag)
        elif tag == "a" and self.times["a"]:  # links do not nest
            self.close(self.last("a"))
        if tag not in VOID and (tag in RAW or not rest.endswith("/")):
            self.open.append((tag, names(tag, rest)))
            self.times[tag] += 1
            self.silent += tag in SILENT

    def end(self, tag: str) -> None:
        if self.times[tag]:
            self.close(self.last(tag))
        elif tag not in INLINE:
            self.flush()

    def last(self, tag: str) -> int:
        return next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag)

    def close(self, depth: int) -> None:
        """End the elements from a depth on; a block ends before any of them is gone."""
        if any(t not in INLINE for t, _ in self.open[depth:]):
            self.flush()
        for t, _ in self.open[depth:]:
            self.times[t] -= 1
            self.silent -= t in SILENT
        del self.open[depth:]

    def imply(self, tag: str) -> None:
        """What a new block ends: the head, a paragraph, an element of the same kind in the same list or table."""
        if self.times["head"] and tag not in HEAD:
            self.close(self.last("head"))
        ends = ("p", *CLOSED_BY.get(tag, ()))
        depth = len(self.open)
        while any(self.times[t] for t in ends):
            depth -= 1
            if self.open[depth][0] in ends:
                self.close(depth)
            elif self.open[depth][0] in WALLS:
                break
