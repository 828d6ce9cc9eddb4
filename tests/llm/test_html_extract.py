import random
import re
import time
from html import unescape
from math import e, isclose, log

import pytest

from eventflow.llm import html_extract as he
from eventflow.llm.html_extract import extract, extract_pages
from tests.conftest import SF_SMALL

TEXT = "The quick brown fox jumps over the lazy dog and runs through the long green field until the night falls. " * 3


def by_pattern(html):
    """The article of a generated page, cut out by its own tags."""
    article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    article = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(h1|p)>", "\x01", article)))
    parts = (re.sub(r"\s+", " ", unescape(p)).strip() for p in article.split("\x01"))
    return "\n\n".join(p for p in parts if p)


def test_generated_pages_with_and_without_article_tags(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert len(pages) > 20
    for html in pages:
        assert extract(html) == by_pattern(html)
        assert extract(html.replace("article>", "div>")) == by_pattern(html)


def page(inner, before="", after=""):
    menu = "<div class='top-menu'><a href=/a>Home</a> <a href=/b>About us</a></div>"
    return f"<html><head><title>T</title></head><body>{menu}{before}<div id=wrap>{inner}</div>{after}<div class=site-footer>(c) x</div></body></html>"


ARTICLE = f"<h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p>"
WANT = ["Title", TEXT.strip(), TEXT.strip()]


@pytest.mark.parametrize("inner, want", [
    (ARTICLE, WANT),
    (ARTICLE + "<aside>Read more: other stories that are long enough to matter</aside>", WANT),
    (ARTICLE + f"<div class='comments'><p>{TEXT}</p></div>", WANT),
    (ARTICLE + f"<section id='reader-comments'><article class=comment><p>{TEXT}</p></article></section>", WANT),
    (f"<div class='cookie-notice'>We use cookies. {TEXT}</div>" + ARTICLE, WANT),
    (f"<form><label>Your name</label><p>{TEXT}</p><input></form>" + ARTICLE, WANT),
    (f"<div class='content has-sidebar'>{ARTICLE}</div><div class='sidebar'>{TEXT}</div>", WANT),
    (f"<div style='display: none'>{TEXT}</div>{ARTICLE}<!-- {TEXT} --><script>var a='</p>{TEXT}'</script>", WANT),
    (f"<section><h2>One</h2><p>{TEXT}</p><p>{TEXT}</p></section><section><h2>Two</h2><p>{TEXT}</p></section>",
     ["One", TEXT.strip(), TEXT.strip(), "Two", TEXT.strip()]),
    (f"<h1>A &amp; B&#33; &lt;i&gt;</h1><p>x <b>y</b>z<br>w  \n v<p>{TEXT}<ul><li>one<li>two</ul>",
     ["A & B! <i>", "x yz w v", TEXT.strip(), "one", "two"]),
    (f"<p>{TEXT}</p><table><tr><td>a<td>b<tr><td>c</table>", [TEXT.strip(), "a", "b", "c"]),
])
def test_article_only(inner, want):
    assert extract(page(inner)) == "\n\n".join(want)


def test_odd_pages(spark):
    deep = "<div>" * 5000 + TEXT + "</div>" * 5000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "just text 1 < 2"), (3, "u", "just text 1 < 2"), (None, "u", deep),
            (5, "u", "<p>cut off <a href='x"), (6, "u", "<nav>menu</nav>"), (7, "u", "<p>" + "word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("x", "text")
    got = {(r["id"], r["url"]): r["text"] for r in extract_pages(pages).collect()}
    assert extract_pages(pages).count() == len(rows)
    assert got == {(1, "u"): "", (2, None): "", (3, "u"): "just text 1 < 2", (None, "u"): TEXT.strip(),
                   (5, "u"): "cut off", (6, "u"): "", (7, "u"): ("word " * 50_000).strip()}
    assert extract_pages(pages.limit(0)).collect() == []
    assert extract_pages(pages.drop("url")).filter("url IS NULL").count() == len(rows)


@pytest.mark.parametrize("body, want", [
    (f"<div class='widget Blog'><div class=post>{ARTICLE}</div></div><div class='widget PopularPosts'><a href=/x>Popular post</a></div>", WANT),
    ("".join(f"<div class='elementor-widget elementor-widget-text-editor'>{part}</div>" for part in
             ("<h1>Title</h1>", f"<p>{TEXT}</p>", f"<p>{TEXT}</p>")), WANT),
    (f"<form id=aspnetForm action=/p><input type=hidden value=x><div class=main>{ARTICLE}</div><div class=sidebar>{TEXT}</div></form>", WANT),
    (f"<h1 class='page-header'>Title</h1><p>{TEXT}</p><h2 id='related-work'>Related work</h2><p>{TEXT}</p><h2 id=search-engines>Search</h2><p>{TEXT}</p>",
     ["Title", TEXT.strip(), "Related work", TEXT.strip(), "Search", TEXT.strip()]),
    (ARTICLE + "<div class=comments>" + f"<p>{TEXT}</p>" * 6 + "</div>", WANT),
    (f"<div class='post comments'>{ARTICLE}</div>", WANT),
])
def test_names_only_mark(body, want):
    assert extract(page(body)) == "\n\n".join(want)


SHORT = "A reader said a few words about it here."


@pytest.mark.parametrize("inner, want", [
    # a short article under comments many times as long
    (f"<h1>Title</h1><p>{TEXT}</p><div class=comments>" + f"<div><b>Joe</b><p>{TEXT}</p></div>" * 15 + "</div>", ["Title", TEXT.strip()]),
    # comments under other names, by microdata, and as articles of the article
    (ARTICLE + f"<div class=discussion-thread><p>{TEXT}</p></div>", WANT),
    (ARTICLE + f"<ul><li itemprop='comment'><p>{TEXT}</p></ul>", WANT),
    (ARTICLE + f"<div itemscope itemtype='https://schema.org/Comment'><p>{TEXT}</p></div>", WANT),
    (f"<article>{ARTICLE}<section><article><p>{SHORT}</p></article><article><p>{SHORT}</p></article></section></article>", WANT),
    # but not what only looks like them
    (f"<article><article>{ARTICLE}</article></article>", WANT),
    (f"<h1>Title</h1><p>{TEXT}</p><section id=discussion><p>{TEXT}</p></section>", WANT),
    (f"<h1>Title</h1><div class=search><p>{TEXT}</p></div><p>{TEXT}</p>", WANT),
    (ARTICLE + "<div class=search>Find more of our many stories here <input> <button>Go</button></div>", WANT),
    (f"<div class='comments'>{ARTICLE}</div>", WANT),
])
def test_comments_and_controls(inner, want):
    assert extract(page(inner)) == "\n\n".join(want)


LINKED = "<p>See <a href=/x>The very long title of another work that this one cites at length</a></p>"


@pytest.mark.parametrize("inner, want", [
    (f"<h1>Title</h1><p>{TEXT}</p>{LINKED}<p>{TEXT}</p>",
     ["Title", TEXT.strip(), "See The very long title of another work that this one cites at length", TEXT.strip()]),
    (ARTICLE + "<h2>References</h2><ul><li><a href=/1>First work cited here</a><li><a href=/2>Second work cited here</a></ul>",
     [*WANT, "References", "First work cited here", "Second work cited here"]),
    (f"<h1>Title</h1><p>{TEXT}</p><blockquote>A word. <a href=/s>The source of the word quoted above</a></blockquote><p>{TEXT}</p>",
     ["Title", TEXT.strip(), "A word. The source of the word quoted above", TEXT.strip()]),
    (ARTICLE + "<ul><li><a href=/1>Further story one</a><li><a href=/2>Further story two</a></ul>", WANT),
    (f"<h1>Title</h1><div id=share-prices><p>{TEXT}</p></div><p>{TEXT}</p>", WANT),
    (ARTICLE + f"<div class=share-buttons>{TEXT}</div>", WANT),
    (f"<article><header><h1>Title</h1></header><p>{TEXT}</p><p>{TEXT}</p></article>", WANT),
])
def test_links_and_names_inside_the_article(inner, want):
    assert extract(page(inner)) == "\n\n".join(want)


@pytest.mark.parametrize("piece", ["<a ", '<a b="x ', "<a b='x ", "</a \"", "<!-", "<", "<!x ", "<div>", "<b>", "</section>", "<a b=\"'", "<script>", "&#", "<li>"])
@pytest.mark.parametrize("tail", ["", ">", "\">", "'\">"])
def test_broken_markup_takes_linear_time(piece, tail):
    html = (f"<p>{TEXT}</p>" + piece * (1_000_000 // len(piece)) + tail)
    began = time.perf_counter()
    extract(html)
    assert time.perf_counter() - began < 20  # 1 MB; quadratic reading takes hours


# the same reading of tags as one pattern, which is quadratic on broken markup
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|$)", re.S)


def test_tags_equal_the_pattern():
    rng = random.Random(3)
    for _ in range(4000):
        html = "".join(rng.choice(["<", ">", "<a", " x=", ' "', ' "', "'", "t", "<!--", "-->", "</", "/", "<!d", " ", "b1"]) for _ in range(rng.randint(0, 24)))
        if re.search(r"<[^\s>]*[\"']", html):
            continue  # a quote inside a name: the pattern tries shorter names
        expected = [(*m.span(), bool(m[1]), m[2], m[3] or "") for m in TOKEN.finditer(html)]
        tags, at, got = he.Tags(html), 0, []
        while (token := tags.after(at)) is not None:
            got.append(token)
            at = token[1]
        assert got == expected, html


def plain(node):
    """Characters, tags, link characters and link tags by plain recursion."""
    def size(n, link):
        c = t = lc = lt = 0
        link = link or n.tag == "a"
        for i in n.items:
            if isinstance(i, str):
                k = he.text_size(i)
                c, lc = c + k, lc + (k if link else 0)
            elif not i.away:
                a, b, x, d = size(i, link)
                c, t, lc, lt = c + a, t + b + 1, lc + x, lt + d + (i.tag == "a")
        return c, t, lc, lt

    out = {}

    def walk(n, link):
        out[id(n)] = size(n, link)
        for i in n.items:
            if not isinstance(i, str) and not i.away:
                walk(i, link or n.tag == "a")

    walk(node, False)
    return out


def test_densities_equal_plain_recursion(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()][:20]
    pages += [page(ARTICLE + LINKED * 3), page(f"<a href=x>{TEXT}</a>"), "", "x", "<a>y</a>"]
    for html in pages:
        root = he.parse(html)
        he.heed_marks(root)
        want = plain(root)
        article, threshold = he.choose(root)  # measures every node
        nodes, stack = [], [root]
        while stack:
            nodes.append(stack.pop())
            stack += [i for i in reversed(nodes[-1].items) if not isinstance(i, str) and not i.away]
        assert {id(n) for n in nodes} == set(want)
        body_c, _, body_lc, _ = want[id(root)]

        def density(n, want=want, body_c=body_c, body_lc=body_lc):
            c, t, lc, lt = want[id(n)]
            if not c:
                return 0.0
            base = log(c * max(lc, 1) / max(c - lc, 1) + body_lc / max(body_c, 1) * c + e)
            return max(0.0, c / max(t, 1) * log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1.0)) / base)

        for n in nodes:
            assert (n.chars, n.tags, n.link_chars, n.link_tags) == want[id(n)]
            assert isclose(n.density, density(n))
            inner = [i for i in n.items if not isinstance(i, str) and not i.away]
            assert isclose(n.total, sum(map(density, inner)) + sum(he.text_size(i) for i in n.items if isinstance(i, str)))
        if article is not None:
            core, path = max(nodes, key=lambda n: n.total), []
            while core is not None:
                path.append(density(core))
                core = core.parent
            assert isclose(threshold, min(path))
