import html
import itertools
import re
import time

import numpy as np
import pytest

from shelfwise.llm import html_extraction, html_pages
from shelfwise.llm.html_blocks import Block, blocks
from tests.llm.conftest import SMALL

HANDMADE = [
    (
        """<html><head><title>River | Daily</title><script>if (a < b) { document.write("<p>no</p>"); }</script></head><body>
        <div class="cookie-banner" role="alert"><p>We use cookies to improve this site.</p><button>Accept</button></div>
        <header class="masthead"><a href="/">The Daily</a><form action="/s"><label>Search</label><input name=q></form></header>
        <nav id="main-nav"><ul><li><a href="/n">News</a><li><a href="/s">Sport</a></ul></nav>
        <main><article><h1>River rises after a week of rain</h1>
        <p>The river rose by two metres on Monday.<br>People left their houses &mdash; most of them on foot.
        <p>&ldquo;We had no time&rdquo;, said a   farmer.</p>
        <aside class="related"><h3>Related</h3><ul><li><a href="/1">Older floods</a></li></ul></aside>
        <h2>What comes next</h2><ul><li>More rain on Friday.</li><li>A dry week after that.</li></ul>
        </article></main>
        <section id="comments"><h3>2 comments</h3><div class="comment"><p>Stay safe, all of you. This was a bad week.</p></div></section>
        <footer><p>&copy; 2024 The Daily. All rights reserved.</p></footer></body></html>""",
        ["River rises after a week of rain", "The river rose by two metres on Monday. People left their houses — most of them on foot.",
         "“We had no time”, said a farmer.", "What comes next", "More rain on Friday.", "A dry week after that."],
    ),
    (
        """<body><div id="wrapper"><div class="topbar menu"><a href=/a>Home</a> <a href=/b>Archive</a></div>
        <div class="ad-slot"><p>Buy two, get one free. Only today!</p></div>
        <div class="post-content"><h1>How to bake bread</h1><p>Mix flour and water.</p><p>Wait for an hour, then knead the dough again.</p>
        <blockquote>Bread needs time.</blockquote><div class="share-buttons"><a href=x>Share</a><a href=y>Tweet</a></div></div>
        <div class="sidebar"><h4>Popular</h4><p>Ten cakes that you must try this year.</p></div>
        <div class="newsletter"><form><p>Subscribe to our newsletter</p><input><button>Sign up</button></form></div>
        <div class="comments-area"><ol class="commentlist"><li class="comment"><p>I tried this and it was great. Thank you.</p></ol></div>
        <div id="footer">Privacy | Terms</div></div>""",
        ["How to bake bread", "Mix flour and water.", "Wait for an hour, then knead the dough again.", "Bread needs time."],
    ),
]


@pytest.fixture(scope="module")
def field():
    return html_extraction.train()


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>a<p>b<br>c<ul><li>x<li>y</ul>z") == ["a", "b c", "x", "y", "z"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert texts("<title>t</title><script>'</p>' <p>no</script><style>p{}</style><p>yes &lt;b&gt; &amp &nbsp; x") == ["yes <b> & x"]
    assert texts("a < b <!-- <p>no --> c") == ["a < b c"]
    assert texts("<select><option>a<option>b</select><textarea><p>no</textarea>r") == ["r"]
    assert texts("<div>one<div>two</div>three</div>") == ["one", "two", "three"]
    assert texts(None) == texts("") == texts("<!-- open") == texts("<script>open <p>") == []
    block = blocks("<div class='Side-Bar commentList' id=x9>see <a href=1>this  page</a>")[0]
    assert block == Block("see this page", ("div side bar comment list x 9",), 9)
    assert blocks("<nav><p><b>x<p>y")[1].path == ("nav", "p")


@pytest.mark.parametrize("part", ["<div>", "<font>x<h1>", "<foo><p>x", "<b>x</b", "<", "<!--", "<a ", "<p class='", "<a>x", "</", "<li><foo>", "<br>&"])
def test_broken_pages_take_linear_time(part):
    began = time.process_time()
    blocks(part * 20_000)
    assert time.process_time() - began < 20


def test_viterbi_is_the_best_path(field):
    r = np.random.default_rng(1)
    model = html_extraction.BlockField(r.normal(size=field.weights.shape), r.normal(size=(2, 2)))
    for n in range(1, 9):
        flat, starts = r.integers(0, html_extraction.BUCKETS, 4 * n), np.arange(0, 4 * n, 4)
        scores = model.scores(flat, starts)

        def total(way):
            return sum(scores[i, y] for i, y in enumerate(way)) + sum(model.moves[a, b] for a, b in itertools.pairwise(way))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert tuple(model.decode(flat, starts)) == best


def test_held_out_pages(field):
    """Generated pages of another seed, by block."""
    hit = found = wanted = 0
    for page in html_pages.signed_pages(200, 4711):
        met, labels = html_pages.read_signs(page)
        assert [b.text for b in met] == texts(html_pages.plain(page))
        got = field.decode(*html_extraction.page_features(met))
        hit += sum(a and b for a, b in zip(got, labels))
        found, wanted = found + sum(got), wanted + sum(labels)
    assert hit / found > 0.96 and hit / wanted > 0.96


@pytest.mark.parametrize("page, want", HANDMADE)
def test_handmade_pages(field, page, want):
    assert html_extraction.main_text(page, field).split("\n") == want


def test_given_pages(spark):
    """The given pages hold one article element each."""
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in html_extraction.extract(df).collect()}
    rows = df.collect()
    assert len(got) == len(rows)
    for r in rows:
        body = r["html"].split("<article>")[1].split("</article>")[0]
        lines = [html.unescape(re.sub("<[^>]*>", "", x)).split() for x in re.split("</?(?:p|h1)>", body)]
        want = "\n".join(" ".join(x) for x in lines if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
        assert got[r["page_id"]]["url"] == r["url"]


def test_odd_rows(spark):
    page = HANDMADE[0][0]
    long = "<article>" + "".join(f"<p>Sentence number {i} of a very long page.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", page), (3, "u", page), (3, "u", page), (4, "", "no tags, only a few words."),
            (5, "u", long), (6, "u", "<nav><a href=x>Home</a></nav>"), (7, "u", "\x00<p>😀 &#x1F600; &#0;"), (8, "u", "   ")]
    schema = "page_id bigint, url string, html string"

    def result(data):
        df = spark.createDataFrame(data, schema).selectExpr("*", *(f"'x' AS {c}" for c in ("id", "text", "n_chars", "label")))
        return html_extraction.extract(df).collect()

    got = result(rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
        assert r["n_chars"] == len(r["text"])
    want = "\n".join(HANDMADE[0][1])
    assert [r["text"] for r in by[3]] == [want, want] and by[None][0]["text"] == want
    assert [by[i][0]["text"] for i in (1, 2, 6, 8)] == [""] * 4
    assert by[5][0]["text"].count("\n") == 19_999 and by[2][0]["url"] is None
    assert result([]) == []
