"""Generated pages whose blocks bear labels, to train and test the extraction.

Layouts, element names and class names vary; words are invented. A block's text
begins with a private-use sign that tells its label.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

from shelfwise.llm.html_blocks import Block, blocks

OTHER, CONTENT = "", ""
_SYLLABLES = (
    "the an er in on re ti es or ea at en th nd ha he st ou ing ly ble tion".split(),
    "de le la que é ai ou eau ment ier on ré en è ç tre vi pa aux ch".split(),
    "der die ung sch ein ver ich en be zu ge ß ä ö ü auf keit lich er st".split(),
    "el la os que ción ñ í ar en es do to mi ra ca da re al ó no".split(),
    "по на ст ро ка то не ре ни ва ли ко ра де но".split(),
    "的 一 是 不 了 人 我 在 有 他 这 中 大 来 上".split(),
)

# Class and id names of the parts of a page; a layout draws from them.
_NAMES = {
    "article": "article post entry story content post-content entry-content article-body articleBody story-body main-content page-content "
    "body-text text single hentry blog-post body copy richtext markdown prose".split(),
    "nav": "nav navbar menu main-menu navigation topnav site-nav breadcrumb breadcrumbs tabs pagination pager toc sub-menu links skip".split(),
    "header": "header site-header masthead top top-bar branding logo page-header hero-bar banner-top head".split(),
    "footer": "footer site-footer page-footer bottom copyright legal colophon foot footer-links credits imprint".split(),
    "side": "sidebar side aside widget widget-area related related-posts popular recent-posts rail right-column secondary more-stories "
    "recommended teaser tags tag-cloud author-box trending most-read".split(),
    "notice": "notice cookie cookie-notice cookie-banner consent gdpr alert warning message info-bar disclaimer announcement paywall "
    "notification popup modal overlay toast browser-upgrade".split(),
    "ad": "ad ads advert advertisement adsbygoogle sponsored sponsor promo promotion banner banner-ad ad-slot ad-container commercial "
    "affiliate dfp-ad outbrain taboola".split(),
    "form": "form search search-form newsletter newsletter-signup subscribe signup login contact-form comment-form poll survey".split(),
    "share": "share social social-share sharing share-buttons follow addthis toolbar tools print actions".split(),
    "comments": "comments comment comment-list commentlist comments-area disqus_thread replies reply responses discussion reader-comments "
    "user-comments feedback thread".split(),
}
_TAGS = {"nav": ("nav", "div", "ul", "div"), "header": ("header", "div", "header"), "footer": ("footer", "div", "footer"),
         "side": ("aside", "div", "section", "aside"), "notice": ("div", "section", "p", "div"), "ad": ("div", "aside", "section", "ins", "div"),
         "form": ("form", "form", "div"), "share": ("div", "ul", "p"), "comments": ("section", "div", "ol", "div")}
_SAYS = {
    "notice": ("We use cookies", "By continuing you accept our terms", "This site uses cookies", "Your browser is out of date", "Accept"),
    "ad": ("Advertisement", "Sponsored", "Buy now", "Promoted content", "Save 20 % today"),
    "form": ("Subscribe to our newsletter", "Your name", "Search", "Sign up", "E-mail", "Password", "Log in"),
    "share": ("Share", "Tweet", "Follow us", "Print", "Send"),
    "comments": ("Comments", "Reply", "3 comments", "Leave a comment", "says:", "2 days ago", "Report"),
    "footer": ("Privacy", "Terms", "All rights reserved", "About us", "Contact", "Imprint"),
    "side": ("Related", "Most read", "More from", "Popular", "Recent posts", "Tags", "Read more", "About the author"),
    "nav": ("Home", "About", "Contact", "News", "Next", "Previous", "Menu"),
    "header": ("Log in", "Search", "Menu", "Sign up"),
}


class _Maker:
    """One page in the making."""

    def __init__(self, r: random.Random):
        self.r, self.out = r, []
        self.syllables = r.choice(_SYLLABLES[:4] * 3 + _SYLLABLES[4:])
        self.noise = r.random() < 0.12
        self.bars = r.random() < 0.06  # words of the article stand between bars
        self.named = r.random() < 0.92  # whether parts bear telling names
        self.semantic = r.random() < 0.6  # whether they are elements of their own
        self.sloppy = r.random() < 0.3  # end tags are missing, inline tags unclosed

    def word(self) -> str:
        found = "".join(self.r.choice(self.syllables) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))
        return found + self.r.choice(("###", "%%%", "***", "$$$", "&&&")) if self.noise else found

    def phrase(self, low: int, high: int) -> str:
        found = " ".join(self.word() for _ in range(self.r.randint(low, high)))
        return found[:1].upper() + found[1:]

    def sentences(self, n: int) -> str:
        return " ".join(self.phrase(1, 25) + self.r.choice("....?!") for _ in range(n))

    def named_as(self, kind: str, tag: str) -> str:
        """A start tag, with a name of its kind where this page has such names."""
        r = self.r
        if tag in ("article", "main", "nav", "header", "footer", "aside", "form") and r.random() < 0.5:
            return f"<{tag}>"
        if not self.named and kind != "comments":
            return f"<{tag}>" if r.random() < 0.5 else f'<{tag} class="{r.choice("abcxyz")}{r.randint(1, 99)}">'
        name = r.choice(_NAMES[kind])
        if r.random() < 0.25:
            name = r.choice((f"{name} {r.choice('abc')}{r.randint(1, 9)}", f"js-{name}", f"{name}-{r.randint(1, 99)}", f"{name}__inner",
                             f"site {name}", f"{name}-wrapper", f"block {name}"))
        if r.random() < 0.12:
            name = name.title().replace("-", "")
        return f'<{tag} {r.choice(("class", "class", "class", "id"))}="{name}">'

    def leaf(self, tag: str, text: str, label: str, linked: bool = False, attributes: str = "") -> None:
        """One block; its sign stands before any inline tag."""
        r = self.r
        raw = html.escape(text, quote=r.random() < 0.5)
        if linked:
            raw = f'<a href="/{r.randint(1, 999)}">{raw}</a>'
        elif r.random() < 0.12 and " " in raw:
            first, rest = raw.split(" ", 1)
            mark = r.choice(("b", "em", "strong", "span", "a", "i"))
            raw = f"<{mark}>{first}</{mark}> {rest}"
        if self.sloppy and tag == "p" and label == CONTENT and r.random() < 0.3:
            self.out.append(f"<p{attributes}>{label}<b>{raw}<br>")
            return
        close = "" if self.sloppy and tag in ("p", "li") and r.random() < 0.7 else f"</{tag}>"
        self.out.append(f"<{tag}{attributes}>{label}{raw}{close}" + r.choice(("", "\n")))

    def links(self, kind: str, low: int, high: int) -> None:
        """A list of links."""
        r = self.r
        flat = r.random() < 0.25
        self.out.append("" if flat else "<ul>")
        for _ in range(r.randint(low, high)):
            text = r.choice(_SAYS[kind]) if r.random() < 0.25 else self.phrase(1, 9 if kind == "side" else 3)
            self.leaf("div" if flat else "li", text, OTHER, linked=r.random() < 0.9)
        self.out.append("" if flat else "</ul>")

    def part(self, kind: str) -> None:
        """A part that is no content."""
        r = self.r
        tag = r.choice(_TAGS[kind]) if self.semantic else "div"
        if tag == "p":
            start = self.named_as(kind, "p")
            self.out.append(start + OTHER + self.sentences(1) + "</p>")
            return
        self.out.append(self.named_as(kind, tag))
        if r.random() < 0.3 and kind not in ("nav", "ad"):
            self.leaf(r.choice(("h2", "h3", "h4")), r.choice(_SAYS[kind]) if r.random() < 0.5 else self.phrase(1, 4), OTHER)
        if kind in ("nav", "share"):
            self.links(kind, 2, 8)
        elif kind in ("header", "footer"):
            if r.random() < 0.5:
                self.leaf(r.choice(("p", "div", "div")), self.phrase(1, 6), OTHER, linked=r.random() < 0.4)
            if r.random() < 0.5:
                self.links(kind, 2, 6)
            if kind == "footer" and r.random() < 0.8:
                text = f"© {r.choice(('', '2024 '))}{self.word()}.example.org {r.choice(('·', '|', '-', ''))} {self.sentences(r.randint(1, 2))}"
                self.out.append(r.choice(("{}", "<p>{}</p>", "<div>{}</div>", "<small>{}</small>")).format(OTHER + html.escape(text)))
        elif kind == "side":
            if r.random() < 0.6:
                self.links(kind, 2, 7)
            else:
                for _ in range(r.randint(1, 3)):
                    self.leaf("p", self.sentences(r.randint(1, 3)), OTHER)
        elif kind == "form":
            for _ in range(r.randint(1, 4)):
                text = r.choice(_SAYS["form"]) if r.random() < 0.6 else self.sentences(1)
                self.leaf(r.choice(("label", "p", "div", "button", "h3")) if tag != "form" else r.choice(("p", "div", "button", "h3")), text, OTHER)
                self.out.append('<input type="text" name="q"><br>' if r.random() < 0.5 else "<select><option>a<option>b</select>")
        elif kind == "comments":
            for _ in range(r.randint(1, 6)):
                wrap = r.choice(("div", "li", "article"))
                self.out.append(self.named_as("comments", wrap))
                if r.random() < 0.6:
                    self.leaf(r.choice(("div", "h4", "p")), self.phrase(1, 2) + r.choice(("", " says:", " 2 days ago")), OTHER)
                for _ in range(r.randint(1, 2)):
                    self.leaf("p", self.sentences(r.randint(1, 4)), OTHER)
                if r.random() < 0.4:
                    self.leaf("div", "Reply", OTHER, linked=True)
                self.out.append(f"</{wrap}>")
        elif r.random() < 0.5:  # notices and adverts
            text = r.choice(_SAYS[kind]) if r.random() < 0.5 else self.sentences(r.randint(1, 3))
            self.out.append(OTHER + html.escape(text))
        else:
            for _ in range(r.randint(1, 3)):
                text = r.choice(_SAYS[kind]) if r.random() < 0.4 else self.sentences(r.randint(1, 3))
                self.leaf(r.choice(("p", "p", "div", "h3")), text, OTHER, linked=r.random() < 0.25)
        self.out.append(f"</{tag}>" + r.choice(("", "\n")))

    def body(self) -> None:
        """The blocks of the article, with a few parts among them."""
        r = self.r
        for _ in range(r.choice((1, 2, 3, 4, 5, 6, 8, 12, 20))):
            x = r.random()
            if x < 0.66:
                text = self.sentences(r.choice((1, 1, 2, 3, 5, 8))) if r.random() < 0.85 else self.phrase(1, 6)
                text = text.replace(" ", " | ") + " |" if self.bars else text
                self.leaf("p", text, CONTENT)
            elif x < 0.74:
                self.leaf(r.choice(("h2", "h3", "h4")), self.phrase(1, 8), CONTENT)
            elif x < 0.80:
                tag = r.choice(("ul", "ol"))
                self.out.append(f"<{tag}>")
                for _ in range(r.randint(2, 5)):
                    self.leaf("li", self.phrase(1, 15) + r.choice(("", ".")), CONTENT)
                self.out.append(f"</{tag}>")
            elif x < 0.84:
                self.out.append("<blockquote>")
                self.leaf("p", self.sentences(2), CONTENT)
                self.out.append("</blockquote>")
            elif x < 0.87:
                self.leaf("pre", self.phrase(3, 20), CONTENT)
            elif x < 0.90:
                self.out.append("<table>")
                for _ in range(r.randint(1, 3)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.leaf(r.choice(("td", "td", "th")), self.phrase(1, 4), CONTENT)
                    self.out.append("</tr>")
                self.out.append("</table>")
            elif x < 0.92:
                self.out.append("<figure><img src=x>")
                self.leaf("figcaption", self.phrase(2, 12), CONTENT)
                self.out.append("</figure>")
            elif x < 0.94:
                self.leaf("div", self.sentences(2), CONTENT)
            elif self.named:
                self.part(r.choice(("ad", "ad", "side", "notice", "form", "share", "nav")))

    def page(self) -> str:
        r = self.r
        title = self.phrase(2, 10)
        self.out.append(f"<!DOCTYPE html><html><head><title>{html.escape(title)}</title><style>p{{margin:0}}</style>"
                        '<script>var t="</p><p>";</script></head><body>')  # fmt: skip
        before = [k for k, p in (("notice", 0.3), ("header", 0.6), ("nav", 0.75), ("ad", 0.45), ("form", 0.15), ("side", 0.15)) if r.random() < p]
        after = [k for k, p in (("share", 0.25), ("comments", 0.4), ("side", 0.4), ("form", 0.2), ("nav", 0.2), ("ad", 0.3), ("notice", 0.15),
                                ("footer", 0.85)) if r.random() < p]
        if r.random() < 0.2:
            r.shuffle(before)
        wraps = []
        if r.random() < 0.4:
            self.out.append(r.choice(('<div id="page">', '<div class="wrapper">', "<div>", '<div class="container">')))
            wraps.append("div")
        for kind in before:
            self.part(kind)
        holders = []
        if self.semantic:
            holders = r.choice((["article"], ["main"], ["main", "article"], ["article"], ["div"], ["article", "div"]))
        elif r.random() < 0.92:
            holders = r.choice((["div"], ["div", "div"], ["td"], ["section"]))
        for tag in holders:
            if tag == "td":
                self.out.append("<table><tr>")
            self.out.append(self.named_as("article", tag))
        if r.random() < 0.85:
            inside = self.semantic and r.random() < 0.2
            self.out.append("<header>" if inside else "")
            self.leaf(r.choice(("h1", "h1", "h1", "h2")), title, CONTENT)
            self.out.append("</header>" if inside else "")
        self.body()
        within = [k for k in after if k != "footer" and self.named and r.random() < 0.25]
        for kind in within:
            self.part(kind)
        for tag in reversed(holders):
            self.out.append(f"</{tag}>")
            if tag == "td":
                self.out.append("</tr></table>")
        for kind in after:
            if kind not in within:
                self.part(kind)
        self.out += [f"</{t}>" for t in wraps]
        if r.random() < 0.85:
            self.out.append("</body></html>")
        return "".join(self.out)


def signed_pages(n: int, seed: int) -> Iterator[str]:
    """Pages whose blocks begin with the sign of their label; the same for a seed."""
    r = random.Random(seed)
    for _ in range(n):
        yield _Maker(r).page()


def read_signs(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a signed page without their signs, and their labels; a block has the first sign in it."""
    found, labels = [], []
    for b in blocks(page):
        text = b.text.replace(OTHER, "").replace(CONTENT, "")
        sign = next((c for c in b.text if c in OTHER + CONTENT), OTHER)
        if text.strip():
            found.append(Block(text.strip(), b.path, min(b.linked, len(text.strip()))))
            labels.append(int(sign == CONTENT))
    return found, labels


def plain(page: str) -> str:
    """A signed page without its signs."""
    return page.replace(OTHER, "").replace(CONTENT, "")
