"""Against pages built around a known article, and against a plain walk with the standard library's parser."""

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm import html_text as x
from pricelens.llm.common import prepare

STORY = ("The <b>first</b> paragraph, with a comma &amp; a <a href='/x'>link</a>.", "Second&nbsp;one,\n  over two lines.", "Short.")
PLAIN = "The first paragraph, with a comma & a link. Second one, over two lines. Short."
PARAS = "".join(f"<p>{p}</p>" for p in STORY)
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>'

SIDES = [
    NAV, '<div class="main-menu"><a href="/">One, two, three, four, five and more words of a menu</a></div>',
    '<header><h1>The Site</h1><p>A slogan, long and with, many, commas</p></header>', '<footer>&copy; 2020, all rights, reserved</footer>',
    '<aside><p>Aside, with a long, long text of its own that could look like an article.</p></aside>',
    '<div id="sidebar"><p>More to read, here, there and everywhere in a long text.</p></div>',
    '<div class="cookie-notice"><p>We use cookies, many of them, to make this site better.</p></div>',
    '<div role="alert">Mind, the, gap, always</div>', '<div class="ad">Buy, buy, buy this now, it is cheap.</div>',
    '<form action="/s"><label>Search, all</label><input name="q"><button>Go, go</button></form>',
    '<script>var a = "<p>not, this, text</p>"; if (a < 3 && b > 2) {}</script>', "<style>p > a { color: red }</style>",
    "<!-- a comment <p>with, markup</p> -->", '<noscript>Turn it on, please</noscript>', '<div hidden>Unseen, text</div>',
    '<p style="display: none">Unseen, too</p>', '<svg><text>drawn, text</text></svg>',
    '<section id="comments"><h2>3 comments</h2><article class="comment"><p>Great, really great, truly, deeply great article, '
    'I read it twice, and then again, and my friends, all of them, did so too.</p></article></section>',
    '<div class="related-posts"><ul><li><a href="/1">Another, story</a></li></ul></div>',
    "<select><option>one<option>two</select>", "<iframe src='x'>no, frames</iframe>", '<template><p>tem, plate</p></template>',
]


def page(body, head="<title>A title, of the page</title>"):
    return f"<!DOCTYPE html><html><head><meta charset=utf-8>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("side", SIDES)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div class='content'>{}</div></main>",
                                  "<div class='wrapper with-sidebar'><div id='content'>{}</div></div>", "<div>{}</div>"])
def test_what_is_beside_the_article_goes(side, wrap):
    assert x.main_text(page(side + wrap.format(PARAS) + side)) == PLAIN
    if "<header>" not in side:  # one inside may hold the article's headline
        assert x.main_text(page(side + wrap.format(PARAS + side))) == PLAIN


@pytest.mark.parametrize("html, text", [
    ("", ""), ("just text, no markup", "just text, no markup"), ("<p>one<p>two<br>three</p>four", "one two three four"),
    ("<article><h1>Head</h1><p><b>bold<br><p>next</b> line</article>after", "Head bold next line"),
    ("<article><ul><li>one<li>two, 2<ul><li>in</ul><li>three</ul></article>", "one two, 2 in three"),
    ("<article><table><tr><td>a<td>b, c<tr><td>d</table></article>", "a b, c d"),
    ("<div><p>x &lt; y &#x41;&#66; &notanentity; &eacute</p></div>", "x < y AB ¬anentity; é"),
    ("<p>3 < 4, 5 <6 and</p>", "3 < 4, 5 <6 and"), ("<p title='a > b' class=x>in quotes, yes</p>", "in quotes, yes"),
    ("<p>in<i>li</i>ne <span>t</span>ext</p><!-- open", "inline text"), ("<nav>only a menu</nav>", ""),
    ("<script>never closed <p>text</p>", ""), ("</div></p>stray ends, </b>only", "stray ends, only"),
    ("<article><header><h1>Headline</h1><p>By me</p></header><p>Text, here.</p></article>", "Headline By me Text, here."),
    ("<form id=aspnet><div>" + PARAS + "</div></form>", PLAIN), ("<p>a<!-->b<!-- c --!>d</p>", "abd"),
    ("<article><section><p>Part one, long enough.</p></section><section><p>2</p></section></article>", "Part one, long enough. 2"),
])
def test_markup(html, text):
    assert x.main_text(html) == text


class Plain(HTMLParser):
    """Text of well-nested markup outside of cut elements."""

    def __init__(self):
        super().__init__()
        self.out, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in x.CUT
        self.out.append(" " if tag in x.BLOCKS else "")

    def handle_endtag(self, tag):
        self.depth -= tag in x.CUT
        self.out.append(" " if tag in x.BLOCKS else "")

    def handle_data(self, data):
        self.out.append("" if self.depth else data)


words = st.lists(st.sampled_from(["alpha", "be,ta", "γάμμα", "&amp;", "a&nbsp;b", "\n", "3 < 4"]), min_size=1, max_size=6).map(" ".join)
inline = st.recursive(words, lambda t: st.tuples(st.sampled_from(["b", "i", "span", "em"]), t).map(lambda p: f"<{p[0]}>{p[1]}</{p[0]}>"))
blocks = st.lists(st.tuples(st.sampled_from(["p", "div", "h2", "blockquote", "nav", "script", "li", "td"]), inline), max_size=8).map(
    lambda bs: "".join(f"<{t}>{i}</{t}>" if t != "script" else f"<script>{i.replace('<', ' ')}</script>" for t, i in bs))


@settings(max_examples=200, deadline=None)
@given(blocks)
def test_the_whole_article_comes_out(body):
    plain = Plain()
    plain.feed(body)
    plain.close()
    text = " ".join("".join(plain.out).split())
    got = x.main_text(f"<html><body>{NAV}<article>{body}</article></body></html>")
    assert got == text


def naive_scores(root):
    """Every container's value from its definition, by walking up from every text."""
    kept = [n for n in x.in_page_order(root) if not any(a.cut for a in above(n))]
    points, held = {id(n): 0.0 for n in kept}, {}
    for n in kept:
        block = next((a for a in above(n) if a.tag in x.BLOCKS), root)
        for c in n.children:
            if type(c) is str and c.strip():
                size, commas = held.get(id(block), (block, 0, 0))[1:]
                held[id(block)] = (block, size + len(c.strip()), commas + len(x.COMMA.findall(c)))
    for block, size, commas in held.values():
        ups = above(block)
        if block.tag in x.PARAGRAPHS:
            ups = ups[1:] or ups
        for level, a in enumerate(ups[:x.LEVELS]):
            own = 0.1 if block.tag in x.HEADINGS else 1 + commas + min(size / 100, 3)
            points[id(a)] += own / (1 if level == 0 else 2 if level == 1 else 3 * level)
    return points


def above(n):
    out = []
    while n is not None:
        out.append(n)
        n = n.parent
    return out


def test_scores_from_their_definition(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    for html in pages + [page(s + f"<div>{PARAS}</div>" + s) for s in SIDES]:
        root = x.tree(html)
        kept = x.prune(root)
        x.score(kept)
        want = naive_scores(root)
        assert {id(n) for n in kept} == set(want)
        assert all(abs(n.points - want[id(n)]) < 1e-9 for n in kept)


def test_long_and_deep_pages_take_linear_time():
    assert x.main_text("<div>" * 50_000 + "deep, text" + "</div>" * 50_000) == "deep, text"
    assert x.main_text("<p>" + "word, " * 300_000).count("word,") == 300_000
    assert x.main_text("<b>" * 30_000 + "</i>" * 30_000 + "x") == "x"
    assert x.main_text("<p a='" * 20_000 + "x") == ""
    assert x.main_text("<p>x</p>" + "<!-" * 50_000) == "x"


def test_pages_of_every_kind(spark):
    prepare(spark)
    rows = [(1, "u", page(NAV + PARAS), "x", 5), (2, None, None, None, None), (None, "v", "", "y", 1), (3, "w", page(PARAS), "x", 2),
            (3, "w", page(PARAS), "x", 2), (4, "z", page(f"<article>{PARAS * 20_000}</article>"), "x", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(2)
    got = sorted(tuple(r) for r in x.extract_text(pages).fillna({"page_id": -1, "url": ""}).collect())
    long = " ".join([PLAIN] * 20_000)
    assert got == [(-1, "v", "", 0), (1, "u", PLAIN, len(PLAIN)), (2, "", "", 0), (3, "w", PLAIN, len(PLAIN)),
                   (3, "w", PLAIN, len(PLAIN)), (4, "z", long, len(long))]
    assert x.extract_text(pages.where("false")).collect() == []
